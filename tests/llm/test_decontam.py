import hashlib
import random
import re

from terrane.llm import decontam


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[x]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(30)] + ["Été", "ça", "don", "t", "x2"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 40)))) for i in range(20)]
    items += [(20, "Short item here"), (21, ""), (22, None), (23, "... ! ?"), (24, items[3][1]), (None, "nameless item of six words now"), (25, "a " * 15)]
    docs = []
    for i in range(120):
        parts = [rng.choice(items)[1] or "" for _ in range(rng.randint(0, 3))]
        parts = [" ".join(p.split()[rng.randint(0, 4) : rng.randint(8, 40)]).upper() if rng.random() < 0.5 else p for p in parts]
        parts += [" ".join(rng.choices(vocabulary + ["outside", "beyond"], k=rng.randint(0, 30)))]
        rng.shuffle(parts)
        docs.append((i, "; ".join(parts)))
    docs += [(200, None), (201, ""), (None, "short ITEM-here"), (5, items[2][1]), (5, items[2][1]), (202, "a " * 5000 + items[0][1])]
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, items string")
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, spans int")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    order = lambda rows: sorted(map(tuple, rows), key=str)
    for size in (8 << 20, 200):  # one block of the benchmark, then many
        monkeypatch.setattr(decontam, "BLOCK_BYTES", size)
        got = decontam.find_contamination(frame, bench).select(*columns).collect()
        assert order(got) == order(brute(docs, items, 10))


def test_longest_match_and_empty_tables(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, f"zero {item} zero"), (2, "nothing")], "doc_id long, text string")
    bench = spark.createDataFrame([("a", item)], "item_id string, text string")
    got = {r.doc_id: r for r in decontam.find_contamination(docs, bench).collect()}
    assert got[1].longest_match == 12 and got[1].n_hit == 12 and got[1]["items"] == ["a"] and got[1].spans[:3] == [1, 10, 12]
    assert not got[2].contaminated
    assert not any(r.contaminated for r in decontam.find_contamination(docs, bench.limit(0)).collect())
    assert decontam.find_contamination(docs.limit(0), bench).count() == 0
