"""Chat formatting with a template that is a black box: a function of turns that returns a string.

The template is rendered for each prefix of a conversation's turns. What a rendering has beyond the
one before is the span of the new turn. If a rendering does not begin with the one before, the template
has rewritten history (dropped old reasoning, moved a system turn): spans found so far do not hold in it, so what there
was is closed as one part of the output and the new rendering begins the next, which trains on turns from
there on only. So every trained text is under exactly one loss mask, in the context that it would be generated in.

Within a turn's span its text lies between what the template puts before a text of one letter in a turn that is still
open, and what it adds to close it. No mark is searched for, so texts that hold the template's own control strings change nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm._common import text_of, tidy

#: (role, text) of each turn, and whether the last one stays open; the formatted string.
Template = Callable[[list[tuple[str, str]], bool], str]

#: A text that a template has no reason to change.
PROBE = "x"
START, END = "<|im_start|>", "<|im_end|>"
SPANS = "array<struct<turn: long, start: long, end: long>>"
FORMATTED = f"part long, formatted string, turns {SPANS}, loss {SPANS}, status string"


def escape(text: str) -> str:
    """``text`` without control strings: a backslash more between ``<`` and ``|``, of those that are there."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    """A role within its line: backslashes are doubled, line feeds spelled, control strings escaped."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def marked(turns: list[tuple[str, str]], still_open: bool = False) -> str:
    """The default template: marks around each turn, the role in a line of its own."""
    out = "".join(f"{START}{escape_role(role)}\n{escape(text)}{END}\n" for role, text in turns)
    return out[: -len(END) - 1] if still_open and turns else out


def read_marked(formatted: str) -> list[tuple[str, str]]:
    """The turns of a string that ``marked`` has made."""
    at, out = 0, []
    while at < len(formatted):
        line, end = formatted.index("\n", at), formatted.index(END, at)
        if not formatted.startswith(START, at) or not formatted.startswith(END + "\n", end):
            raise ValueError("not a formatted conversation")
        out.append((unescape_role(formatted[at + len(START) : line]), unescape(formatted[line + 1 : end])))
        at = end + len(END) + 1
    return out


def render(turns: list[tuple[str, str]], template: Template, trained: tuple[str, ...] = ("assistant",)) -> list[dict]:
    """The parts of one conversation, see ``format_chats``."""
    part = {"formatted": template([], False), "turns": [], "loss": [], "status": "appended"}
    out, before = [part], part["formatted"]
    for k, (role, _) in enumerate(turns):
        now = template(turns[: k + 1], False)
        if not now.startswith(before):
            kept = next((i for i, (a, b) in enumerate(zip(before, now, strict=False)) if a != b), min(len(before), len(now)))
            part = {"formatted": now, "turns": [], "loss": [], "status": "rewritten"}
            if out[-1]["turns"]:
                out.append(part)
            else:  # nothing but the opening of the template has gone
                out[-1] = part
            start = kept
        else:
            start = len(before)
        part["formatted"] = now
        part["turns"].append((k, start, len(now)))
        if role in trained:
            probe = [*turns[:k], (role, PROBE)]
            head, still_open, sep = template(probe, True).rpartition(PROBE)
            close = len(template(probe, False)) - len(head) - len(PROBE)
            if still_open and not sep and close >= 0 and len(head) + close <= len(now) and now.startswith(head):
                part["loss"].append((k, len(head), len(now) - close))
            else:
                part["status"] = "unlocated"
        before = now
    return [x | {"part": i} for i, x in enumerate(out)]


def _format(template: Template, trained: tuple[str, ...]):
    names = ["part", "formatted", "turns", "loss", "status"]
    span = pa.list_(pa.struct([(c, pa.int64()) for c in ("turn", "start", "end")]))
    types = [pa.int64(), pa.string(), span, span, pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at = [], []
            for i, turns in enumerate(batch.column(1).to_pylist()):
                parts = render([(t["role"], t["text"]) for t in turns], template, trained)
                rows += parts
                at += [i] * len(parts)
            for x in rows:
                x |= {c: [dict(zip(("turn", "start", "end"), s, strict=True)) for s in x[c]] for c in ("turns", "loss")}
            columns = [pa.array([x[c] for x in rows], t) for c, t in zip(names, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], ["conv_id", *names])

    return run


def format_chats(turns: DataFrame, template: Template = marked, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, part, formatted, turns, loss, status of every conversation (conv_id, turn, role, text), one row a part.

    ``turns`` has each turn's span in code points of ``formatted``, ``loss`` those of the texts of trained roles; part 0 is all
    that there is unless the template rewrites history. status: ``appended``, ``rewritten`` (this part begins with a turn
    that changed what stood before it) or ``unlocated`` (the template puts something behind the text of an open turn, so a text's place
    is unknown and it is under no mask).

    Rows are in order of turn (null first), then role and text. A null role or text is empty; rows without conv_id are one
    conversation; repeated rows are turns of their own; other columns are ignored; no rows give none. A conversation is one row of one task, and each
    of its prefixes is rendered there, so time grows with the square of the number of turns of the longest.
    """
    turn = F.struct("turn", text_of("role").alias("role"), text_of("text").alias("text"))
    grouped = turns.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    id_type = grouped.schema["conv_id"].dataType.simpleString()
    grouped = grouped.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    return grouped.mapInArrow(tidy(_format(template, trained)), f"conv_id {id_type}, {FORMATTED}")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    for batch in batches:
        texts, masks = (batch.column(i).to_pylist() for i in (2, 3))
        turns = [[{"role": r, "text": t} for r, t in read_marked(x)] for x in texts]
        loss = [[unescape(x[s["start"] : s["end"]]) for s in mask] for x, mask in zip(texts, masks, strict=True)]
        columns = [batch.column(0), batch.column(1), pa.array([len(x) for x in texts], pa.int64()), pa.array(turns, kind), pa.array(loss, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "part", "formatted_chars", "turns", "loss"])


def read_chats(formatted: DataFrame) -> DataFrame:
    """conv_id, part, formatted_chars, turns (role and text), loss (texts under the mask) of what ``format_chats`` made with ``marked``: from the string and its mask alone."""
    id_type = formatted.schema["conv_id"].dataType.simpleString()
    rows = formatted.select("conv_id", "part", "formatted", "loss")
    return rows.mapInArrow(tidy(_read), f"conv_id {id_type}, part long, formatted_chars long, turns array<struct<role: string, text: string>>, loss array<string>")
