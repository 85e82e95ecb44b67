"""Row-at-a-time evaluation of the rules: the fallback for very long rule sets, and what the plans are tested against."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.plans.rules import And, Compare, Not, Or, Ref, Rule, RuleSet, Value
from terrane.plans.semantics import ACCESS_CLASSES, filtered, number, speed

FEATURE = "ord int, type int, low int, high int, road_class int, road_speed int, label string, labels array<string>, tags map<string,string>"


def holds(p, tags: dict, geometry: dict) -> bool:
    if isinstance(p, And):
        return all(holds(x, tags, geometry) for x in p.parts)
    if isinstance(p, Or):
        return any(holds(x, tags, geometry) for x in p.parts)
    if isinstance(p, Not):
        return not holds(p.part, tags, geometry)
    return _compare(p, tags, geometry)


def _compare(p: Compare, tags: dict, geometry: dict) -> bool:
    if p.function:
        left = speed(tags.get("maxspeed")) if p.key == "maxspeedkmh" else geometry.get(p.key)
    else:
        left = tags.get(p.key)
    right = tags.get(p.value) if p.other else p.value
    if p.value is None:
        there = left is not None and left != ""
        return there if p.op == "=" else not there
    if p.function:
        if isinstance(left, bool) or p.key == "is_closed":
            same = left is not None and str(bool(left)).lower() == {"yes": "true", "no": "false"}.get(right, right)
            return same if p.op == "=" else not same
        left, right = left, number(right)
        if p.op == "!=":
            return left is None or right is None or left != right
    elif p.op == "=":
        return left is not None and right is not None and left == right
    elif p.op == "!=":
        return left != right
    elif p.op == "~":
        return left is not None and right is not None and re.fullmatch(right, left) is not None
    else:
        left, right = number(left), number(right)
    if left is None or right is None:
        return False
    return {"=": left == right, "<": left < right, "<=": left <= right, ">": left > right, ">=": left >= right}[p.op]


def value_of(v: Value, tags: dict) -> str | None:
    out = ""
    for part in v.parts:
        x = filtered(tags.get(part.key), part.filters, tags) if isinstance(part, Ref) else part
        if x is None:
            return None
        out += x
    return out


def first_value(values: tuple, tags: dict) -> str | None:
    return next((x for x in (value_of(v, tags) for v in values) if x is not None), None)


class State:
    def __init__(self, tags: dict, label: str | None = None, labels: list | None = None):
        self.tags, self.label, self.labels = dict(tags), label, list(labels or [])

    def act(self, rule: Rule, prefix: str | None) -> None:
        for a in rule.actions:
            if a.kind == "delete":
                self.tags.pop(a.key, None)
            elif a.kind == "deletealltags":
                self.tags.clear()
            elif a.kind in ("set", "add", "name", "addlabel", "setaccess", "addaccess"):
                value = first_value(a.values, self.tags)
                if value is None:
                    continue
                if a.kind == "name":
                    self.label = value if self.label is None else self.label
                elif a.kind == "addlabel":
                    self.labels += [value] if value not in self.labels else []
                else:
                    for key in [a.key] if a.kind in ("set", "add") else [(prefix or "") + c for c in ACCESS_CLASSES]:
                        if a.kind.startswith("set") or self.tags.get(key) is None:
                            self.tags[key] = value


def evaluate(rules: RuleSet, tags: dict, geometry: dict | None = None, prefix: str | None = None) -> list[dict]:
    """The features of one entity, in order."""
    geometry, state, out = geometry or {}, State(tags), []
    for rule in rules.rules:
        if not holds(rule.predicate, state.tags, geometry):
            continue
        after = State(state.tags, state.label, state.labels)
        after.act(rule, prefix)
        c = rule.clause
        if c is None:
            state = after
            continue
        emitted = State(after.tags, after.label, after.labels)
        for last in rules.finalize:
            if holds(last.predicate, emitted.tags, geometry):
                emitted.act(last, prefix)
        label = emitted.label if emitted.label is not None else c.default_name
        out.append({"ord": rule.ord, "type": c.type, "low": c.low, "high": c.high, "road_class": c.road_class, "road_speed": c.road_speed, "label": label, "labels": emitted.labels, "tags": emitted.tags})
        if not c.goes_on:
            break
        if c.with_actions:
            state = after
    return out


def interpret(df: DataFrame, rules: RuleSet, id_col: str = "id", tags_col: str = "tags", geometry: tuple = (), prefix: str | None = None) -> DataFrame:
    """id, then the columns of a feature, by an Arrow-batched interpreter."""
    id_type = df.schema[id_col].dataType
    schema = f"id {id_type.simpleString()}, {FEATURE}"
    names = ["ord", "type", "low", "high", "road_class", "road_speed", "label", "labels", "tags"]
    kinds = [pa.int32()] * 6 + [pa.string(), pa.list_(pa.string()), pa.map_(pa.string(), pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], {n: [] for n in names}
            extra = [dict(zip(geometry, x, strict=True)) for x in zip(*(batch.column(2 + i).to_pylist() for i in range(len(geometry))), strict=True)] if geometry else [{}] * batch.num_rows
            for i, (tags, g) in enumerate(zip(batch.column(1).to_pylist(), extra, strict=True)):
                for f in evaluate(rules, {k: v for k, v in tags or [] if v is not None}, g, prefix):
                    rows.append(i)
                    for n in names:
                        out[n].append(list(f[n].items()) if n == "tags" else f[n])
            columns = [batch.column(0).take(pa.array(rows, pa.int64()))] + [pa.array(out[n], k) for n, k in zip(names, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["id", *names])

    return df.select(F.col(id_col).alias("id"), F.col(tags_col).alias("tags"), *geometry).mapInArrow(run, schema)
