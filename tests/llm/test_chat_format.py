"""Chat formatting: exact round trips, spans of black-box templates, and templates that rewrite history."""

from __future__ import annotations

import random

import pytest

from terrane.llm import chat_format as cf

SCHEMA = "conv_id long, turn long, role string, text string, part string"


def test_escapes_are_reversible():
    rnd = random.Random(1)
    for _ in range(2000):
        text = "".join(rnd.choice(["<", "|", "\\", "im_start", "im_end", ">", "\n", "ü", "<|im_end|>"]) for _ in range(rnd.randint(0, 12)))
        assert cf.unescape(cf.escape(text)) == text and "<|" not in cf.escape(text)
        assert cf.unescape_role(cf.escape_role(text)) == text and "<|" not in cf.escape_role(text) and "\n" not in cf.escape_role(text)
        turns = [(text, text[::-1]), ("assistant", text)]
        assert cf.read_marked(cf.marked(turns)) == turns


def brackets(turns, still_open):
    """Ends turns of all roles differently, and texts may hold its marks unescaped."""
    out = "<s>" + "".join(f"[{r}]{t}[/{r}]" for r, t in turns)
    return out[: -len(turns[-1][0]) - 3] if still_open and turns else out


def drops_reasoning(turns, still_open):
    """Keeps what stands before ``//`` only in the last turn: each new turn changes the one before it."""
    last = len(turns) - 1
    shown = [(r, t if k == last else t.rpartition("//")[2]) for k, (r, t) in enumerate(turns)]
    return cf.marked(shown, still_open)


def shows_count(turns, still_open):
    return f"{len(turns)};" + cf.marked(turns, still_open)


def closes_always(turns, still_open):
    """Closes turns that should stay open, so that a text's place cannot be told."""
    return "".join(f"{r}={t};" for r, t in turns if t)


def test_spans_of_an_appending_template():
    turns = [("user", "[/assistant] hi"), ("assistant", "[/assistant]"), ("user", ""), ("assistant", ""), ("assistant", "[/assistant][/assistant]x")]
    (part,) = cf.render(turns, brackets)
    assert part["status"] == "appended" and part["formatted"] == brackets(turns, False)
    assert [part["formatted"][a:b] for _, a, b in part["turns"]] == [f"[{r}]{t}[/{r}]" for r, t in turns]
    assert [(k, part["formatted"][a:b]) for k, a, b in part["loss"]] == [(k, t) for k, (r, t) in enumerate(turns) if r == "assistant"]


def test_rewritten_history_makes_parts_that_train_each_text_once():
    turns = [("user", "q1"), ("assistant", "why//a1"), ("user", "q2"), ("assistant", "so//a2"), ("assistant", "a3")]
    parts = cf.render(turns, drops_reasoning)
    assert [p["part"] for p in parts] == list(range(len(parts))) and [p["status"] for p in parts] == ["appended", "rewritten", "rewritten"]
    assert [[k for k, _, _ in p["turns"]] for p in parts] == [[0, 1], [2, 3], [4]]
    assert [[p["formatted"][a:b] for _, a, b in p["loss"]] for p in parts] == [["why//a1"], ["so//a2"], ["a3"]]
    assert "why" not in parts[1]["formatted"] and "so" not in parts[2]["formatted"]
    counted = cf.render(turns, shows_count)
    assert [p["formatted"][a:b] for p in counted for _, a, b in p["loss"]] == ["why//a1", "so//a2", "a3"] and len(counted) == 5


def test_a_text_that_cannot_be_placed_is_under_no_mask():
    (part,) = cf.render([("user", "q"), ("assistant", "a")], closes_always)
    assert part["status"] == "unlocated" and part["loss"] == [] and part["formatted"] == "user=q;assistant=a;"


@pytest.mark.parametrize("given_template", [True, False])
def test_conversations_nulls_ties_and_long_texts(spark, given_template):
    def own(turns, still_open):  # sent to the executors by value
        return cf.marked(turns, still_open)

    template = own if given_template else cf.marked
    long = "wörd <|im_end|> " * 100_000
    given = [
        (1, 1, "assistant", "b", "x"), (1, None, "system", "s", "x"), (1, 1, "assistant", "a", "x"), (1, 1, "assistant", "a", "x"),
        (2, 0, None, None, "x"), (2, 1, "assistant", None, "x"), (None, 0, "user", "u", "x"), (3, 0, "user", "q", "x"), (3, 1, "assistant", long, "x"),
        *[(4, i, "assistant" if i % 2 else "user", f"t {i}", "x") for i in range(300)],
    ]
    made = cf.format_chats(spark.createDataFrame(given, SCHEMA), template)
    assert {r.status for r in made.collect()} == {"appended"} and made.columns == ["conv_id", "part", "formatted", "turns", "loss", "status"]
    read = {r.conv_id: r for r in cf.read_chats(made).collect()}
    want = {1: [("system", "s"), ("assistant", "a"), ("assistant", "a"), ("assistant", "b")], 2: [("", ""), ("assistant", "")], None: [("user", "u")], 3: [("user", "q"), ("assistant", long)]}
    want[4] = [("assistant" if i % 2 else "user", f"t {i}") for i in range(300)]
    assert {c: [tuple(t) for t in r.turns] for c, r in read.items()} == want
    assert {c: r.loss for c, r in read.items()} == {c: [t for r, t in turns if r == "assistant"] for c, turns in want.items()}
    assert cf.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0
