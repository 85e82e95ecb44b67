import random
import zlib

import numpy as np

from terrane.llm import lang_id

ALPHABETS = {"aa": "etaoinshr", "bb": "éèàçuqieo", "cc": "ßäöüzkwvn"}


def texts(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(ALPHABETS))
        words = ["".join(rng.choices(ALPHABETS[lang], k=rng.randint(2, 9))) for _ in range(rng.randint(3, 60))]
        out.append((i, " ".join(words), lang))
    return out


def test_held_out_accuracy_and_defined_cases(spark):
    rows = texts(400) + [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 ... !!", "cc"), (1003, "tea " * 300_000, None), (None, "tea shot in rain", "aa"), (5, "tea", "aa"), (5, "tea", "aa")]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, score string")
    model = lang_id.train(frame)
    got = lang_id.identify(frame, model).collect()
    assert len(got) == len(rows)
    known = {r[0]: r for r in texts(400)}
    held = [r for r in got if r.doc_id in known and r.doc_id != 5 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 50 and np.mean([r.lang_pred == known[r.doc_id][2] for r in held]) > 0.97
    odd = {r.doc_id: r for r in got}
    assert [odd[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and odd[1001].score == 0 and odd[1000].rejected
    assert odd[1003].lang_pred == "aa" and odd[None].lang_pred == "aa"
    assert all(0 <= r.score <= 1 and (r.lang == "und") == (r.rejected or r.lang_pred == "und") for r in got)


def test_no_labels_and_no_rows(spark):
    frame = spark.createDataFrame([(1, "tea", None)], "doc_id long, text string, lang string")
    assert lang_id.train(frame) is None
    assert lang_id.identify(frame, None).first().lang_pred == "und"
    assert lang_id.identify(frame.limit(0), None).count() == 0


def test_averages_equal_the_histograms():
    docs = [t.encode() for _, t, _ in texts(30, 3)] + [b"", b"x", b"  ", "日本".encode(), b"a" * 5000]
    table = np.random.default_rng(0).normal(size=(1 << lang_id.BITS, 3))
    want = np.stack([s @ table[a] for a, s in lang_id.histograms(docs)])
    assert np.allclose(lang_id.averages(docs, table), want, atol=1e-5)


def test_uncertain_texts_are_rejected():
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(600):  # half of the rows tell their label, half do not
        tells, label = i % 2, int(rng.integers(2))
        at = np.arange(10, dtype=np.int32) + (20 * (label + 1) if tells else 0)
        rows.append((at, np.full(10, 0.1, np.float32)))
        labels.append("ab"[label])
    model = lang_id.fit(rows, labels)
    p = model.probabilities(np.stack([s @ model.table[a] for a, s in rows])).max(1)
    assert (p[1::2] >= model.threshold).mean() > 0.95 and (p[::2] < model.threshold).mean() > 0.95
