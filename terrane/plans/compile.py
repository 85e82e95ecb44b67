"""Rules to a DataFrame plan.

Referenced tags become columns of their own, so that predicates stay inside generated code and a
scan of promoted columns is pruned; all other tags stay in the map untouched. Rules that do not
depend on each other share a projection (``apply_rules``). Equality ladders that only classify can
also run as a broadcast join with the rule table (``classify_by_join``).
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.plans.interpret import interpret
from terrane.plans.rules import And, Compare, Not, Or, Ref, Rule, RuleSet, Value, referenced_keys
from terrane.plans.semantics import ACCESS_CLASSES, COUNTRIES, FACTORS, MPH, NUMBER, SPEED, substitution
from terrane.session import checkpointed

#: Projections after which the state is written, so that plans and generated code stay short.
LEVELS = 24


def sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def as_number(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, NUMBER, 1), F.lit("")).try_cast("double")


def as_speed(c: Column) -> Column:
    """Kilometres an hour; a value in mph is converted, an unreadable one is null."""
    x = F.nullif(F.regexp_extract(c, SPEED, 1), F.lit("")).try_cast("double")
    return F.when(F.regexp_extract(c, SPEED, 2) == "mph", x * float(MPH)).otherwise(x)


def full_match(c: Column, pattern: str) -> Column:
    return c.rlike(f"\\A(?:{pattern})\\z")


def predicate(p, tag, geometry) -> Column:
    """A predicate as a column that is never null; ``tag`` and ``geometry`` give columns by name."""
    if isinstance(p, (And, Or)):
        parts = [predicate(x, tag, geometry) for x in p.parts]
        out = parts[0]
        for x in parts[1:]:
            out = out & x if isinstance(p, And) else out | x
        return out
    if isinstance(p, Not):
        return ~predicate(p.part, tag, geometry)
    return _compare(p, tag, geometry)


def _compare(p: Compare, tag, geometry) -> Column:
    if p.function:
        left = as_speed(tag("maxspeed")) if p.key == "maxspeedkmh" else geometry(p.key)
    else:
        left = tag(p.key)
    if p.value is None:
        there = left.isNotNull() if p.function else sure(left.isNotNull() & (left != ""))
        return there if p.op == "=" else ~there
    right = tag(p.value) if p.other else F.lit(p.value)
    if p.function and p.key == "is_closed":
        same = sure(left.cast("boolean") == F.lit(p.value in ("yes", "true", "1")))
        return same if p.op == "=" else ~same
    if not p.function:
        if p.op == "=":
            return sure(left == right)
        if p.op == "!=":
            return ~left.eqNullSafe(right)
        if p.op == "~":
            return sure(full_match(left, p.value))
        left = as_number(left)
    else:
        left = left.cast("double")
    right = as_number(right)
    if p.op == "!=":
        return ~sure(left == right)
    return sure({"=": left == right, "<": left < right, "<=": left <= right, ">": left > right, ">=": left >= right}[p.op])


def apply_filters(c: Column, filters: tuple, tag) -> Column:
    for name, arg in filters:
        if name == "def":
            c = F.coalesce(c, F.lit(arg))
        elif name == "subst":
            c = F.replace(c, *map(F.lit, substitution(arg)))
        elif name == "part":
            sep, _, n = arg.rpartition(":")
            c = F.nullif(F.split_part(c, F.lit(sep or ";"), F.lit(int(n))), F.lit("")) if int(n) > 0 else F.lit(None).cast("string")
        elif name in ("conv", "height"):
            c = F.round(as_number(c) * float(FACTORS[arg])).cast("long").cast("string")
        elif name == "not-contained":
            sep, _, key = arg.rpartition(":")
            held = F.array_contains(F.split(tag(key), "\\Q" + (sep or ";") + "\\E", -1), c)
            c = F.when(~sure(held), c)
        elif name == "country-ISO":
            table = F.create_map(*[F.lit(x) for kv in COUNTRIES.items() for x in kv])
            c = F.coalesce(F.element_at(table, F.upper(c)), F.upper(c))
        elif name == "highway-symbol":
            c = F.concat(F.lit(f"[{arg.split(':')[0]}]"), c)
        else:
            raise ValueError(f"unknown filter {name!r}")
    return c


def value(v: Value, tag) -> Column:
    parts = [apply_filters(tag(x.key), x.filters, tag) if isinstance(x, Ref) else F.lit(x) for x in v.parts]
    return F.concat(*parts)


def values(vs: tuple, tag) -> Column:
    return F.coalesce(*[value(v, tag) for v in vs])


@dataclass
class _State:
    """Which column holds each tag (and label, labels, rest) after the rules so far, and after how many projections it is there.

    A rule that changes a tag makes a new column, so a rule reads what was true in its place whenever it is told.
    """

    tags: list[str]
    geometry: tuple
    prefix: str
    place: dict[str, str]
    serial: int = 0
    level: dict[str, int] = field(default_factory=dict)
    steps: dict[int, dict[str, Column]] = field(default_factory=dict)
    history: dict[str, list[tuple[int, str]]] = field(default_factory=dict)

    def __post_init__(self):
        self.place = dict(self.place)
        self.history = {name: [(-1, c)] for name, c in self.place.items()}

    def geo(self, name: str) -> Column:
        if name not in self.geometry:
            raise ValueError(f"{name}() needs a column of that name")
        return F.col(name)

    def reader(self) -> tuple[Callable[[str], Column], set[str]]:
        """A function from names to columns as they are now, and the columns that it has given."""
        read: set[str] = set()

        def get(name: str) -> Column:
            read.add(self.place[name])
            return F.col(self.place[name])

        return get, read

    def holds(self, rule: Rule) -> tuple[Column, set[str]]:
        get, read = self.reader()
        return predicate(rule.predicate, lambda k: get(f"tag {k}"), self.geo), read

    def changes(self, rule: Rule, hit: Column) -> tuple[dict[str, Column], set[str]]:
        """By name, what the rule's actions make where ``hit``; an action sees what the ones before did."""
        get, read = self.reader()
        now: dict[str, Column] = {}

        def has(name: str) -> Column:
            return now[name] if name in now else get(name)

        def tag(key: str) -> Column:
            return has(f"tag {key}")

        for a in rule.actions:
            if a.kind == "delete":
                now[f"tag {a.key}"] = F.when(~hit, tag(a.key))
            elif a.kind == "deletealltags":
                now |= {name: F.when(~hit, has(name)) for name in ("rest", *(f"tag {k}" for k in self.tags))}
            elif a.kind in ("set", "add", "name", "addlabel", "setaccess", "addaccess"):
                v = values(a.values, tag)
                if a.kind == "name":
                    now["label"] = F.coalesce(has("label"), F.when(hit, v))
                elif a.kind == "addlabel":
                    labels = has("labels")
                    now["labels"] = F.when(hit & v.isNotNull() & ~sure(F.array_contains(labels, v)), F.array_append(labels, v)).otherwise(labels)
                else:
                    for key in [a.key] if a.kind in ("set", "add") else [self.prefix + c for c in ACCESS_CLASSES]:
                        new = F.when(hit, v)
                        now[f"tag {key}"] = F.coalesce(new, tag(key)) if a.kind.startswith("set") else F.coalesce(tag(key), new)
        return now, read

    def written_by(self, rule: Rule) -> set[str]:
        """The columns that a rule's actions read or replace."""
        return self.changes(rule, F.lit(True))[1]

    def put(self, column: Column, read: set[str]) -> str:
        """A new column, in the first projection that has all it reads."""
        name = f"v{self.serial}_{sum(map(len, self.steps.values()))}"
        at = 1 + max((self.level.get(c, 0) for c in read), default=0)
        self.level[name] = at
        self.steps.setdefault(at, {})[name] = column
        return name

    def act(self, n: int, hit: Column, read: set[str], rule: Rule) -> None:
        """Let what comes after rule n see its changes."""
        now, more = self.changes(rule, hit)
        if len(now) > 2:
            known = self.put(hit, read)
            now, more = self.changes(rule, F.col(known))
            read = {known}
        for name, column in now.items():
            self.place[name] = self.put(column, more | read)
            self.history[name].append((n, self.place[name]))

    def project(self, df: DataFrame) -> DataFrame:
        for at in sorted(self.steps):
            df = df.withColumns(self.steps[at])
        return df

    def at(self, name: str, n: Column) -> Column:
        """What a name held for rule n."""
        out, (_, first) = None, self.history[name][0]
        for place, column in reversed(self.history[name][1:]):
            out = F.when(n > place, F.col(column)) if out is None else out.when(n > place, F.col(column))
        return F.col(first) if out is None else out.otherwise(F.col(first))


def _keys(rules: RuleSet, prefix: str | None) -> list[str]:
    found = referenced_keys(rules)
    kinds = {a.kind for r in [*rules.rules, *rules.finalize] for a in r.actions}
    if prefix is None and kinds & {"setaccess", "addaccess"}:
        raise ValueError("setaccess and addaccess need the prefix of the keys that they write")
    prefix = prefix or ""
    return found + [prefix + c for c in ACCESS_CLASSES if kinds & {"setaccess", "addaccess"} and prefix + c not in found]


def _seen_later(rule: Rule) -> bool:
    """Whether later rules see what this one does: it does not end an entity, and does not go on without its actions."""
    return bool(rule.actions) and (rule.clause is None or (rule.clause.goes_on and rule.clause.with_actions))


def needed_key(p) -> str | None:
    """A tag without which a predicate cannot hold: what the index of rules goes by."""
    found = _needed(p)
    return min(found) if found else None


def _needed(p) -> set[str]:
    if isinstance(p, And):
        return set().union(*map(_needed, p.parts))
    if isinstance(p, Or):
        return set.intersection(*map(_needed, p.parts))
    if isinstance(p, Not) or p.function or p.op == "!=":
        return set()
    return {p.key}


@dataclass
class _Segment:
    """Rules that one pass tells: the state after them, hits of typed ones by the column of a tag that they need, and what each changes for its own feature."""

    state: _State
    hits: dict[str | None, list[Column]] = field(default_factory=dict)
    own: dict[str, list[tuple[int, Column]]] = field(default_factory=dict)


def _segments(rules: list[Rule], start: _State) -> list[_Segment]:
    """Rules in order, cut where a chain of rules that see each other's changes is longer than LEVELS projections.

    A part goes on with the columns that the one before ends with: to rename them would make Spark state each thing that it knows of a column twice.
    """
    out = [_Segment(start)]
    for n, rule in enumerate(rules):
        now = out[-1].state
        hit, read = now.holds(rule)
        if _seen_later(rule) and now.steps and 2 + max((now.level.get(c, 0) for c in read | now.written_by(rule)), default=0) > LEVELS:
            out.append(_Segment(_State(now.tags, now.geometry, now.prefix, now.place, now.serial + 1)))
            now = out[-1].state
            hit, read = now.holds(rule)
        if rule.clause is not None:
            key = needed_key(rule.predicate)
            out[-1].hits.setdefault(key and now.place[f"tag {key}"], []).append(F.when(hit, F.lit(2 * n + (not rule.clause.goes_on))))
            for name, column in (now.changes(rule, F.lit(True))[0] if rule.actions else {}).items():
                kind = {"labels": "array<string>", "rest": "map<string,string>"}.get(name, "string")
                out[-1].own.setdefault(name, []).append((n, column.cast(kind)))
        if _seen_later(rule):
            now.act(n, hit, read, rule)
    return out


def _start(keys: list[str], geometry: tuple, prefix: str | None, serial: int = 0) -> _State:
    return _State(keys, geometry, prefix or "", {c: c for c in ("label", "labels", "rest")} | {f"tag {k}": f"t{i}" for i, k in enumerate(keys)}, serial)


def passes(rules: RuleSet, geometry: tuple = (), prefix: str | None = None) -> int:
    """How often the entities are gone through: once, and once more for each LEVELS rules of which each sees the changes of the one before."""
    return len(_segments(rules.rules, _start(_keys(rules, prefix), geometry, prefix)))


def _hits(segment: _Segment) -> Column:
    """Twice the number of each typed rule that holds, and one more if it ends the entity; in order, and rules of a tag that is not there passed over together."""
    none = F.array().cast("array<int>")
    groups = [F.array_compact(F.array(*hits)) if c is None else F.when(F.col(c).isNotNull(), F.array_compact(F.array(*hits))).otherwise(none) for c, hits in segment.hits.items()]
    return F.array_sort(F.concat(*groups)) if groups else none


def apply_rules(df: DataFrame, rules: RuleSet, id_col: str = "id", tags_col: str = "tags", geometry: tuple = (), prefix: str | None = None, strategy: str = "columns") -> DataFrame:
    """The features of every entity: id, ord, type, low, high, road_class, road_speed, label, labels, tags.

    The first typed rule that holds ends an entity; ``continue`` emits and goes on, with the rule's
    own changes kept only under ``with_actions``. ``geometry`` names columns that stand for
    functions such as length. ``prefix`` is that of the keys which setaccess and addaccess write; rules that
    use them need one. strategy: columns, or interpreter (row by row, for tests).

    Rules are a graph: one depends on another if it reads what that changes. Changes are new columns, those that do not depend on each
    other in one projection, whatever stands between them; all typed rules are then told in one more, and what a
    feature's tags were is looked up by its rule's number. A state is written only after LEVELS projections.
    """
    if strategy == "interpreter":
        return interpret(df, rules, id_col, tags_col, geometry, prefix)
    keys = _keys(rules, prefix)
    tags = F.col(tags_col)
    columns = [F.element_at(tags, F.lit(k)).alias(f"t{i}") for i, k in enumerate(keys)]
    rest = F.map_filter(tags, lambda k, v: ~k.isin(keys) & v.isNotNull()) if keys else tags
    none = F.lit(None).cast("string")
    df = df.select(F.col(id_col).alias("id"), *geometry, *columns, rest.alias("rest"), none.alias("label"), F.array().cast("array<string>").alias("labels"))
    start = _start(keys, geometry, prefix)
    first, names = dict(start.place), list(start.place)
    segments = _segments(rules.rules, start)
    features = []
    for part, segment in enumerate(segments):
        state = segment.state
        df = state.project(df).withColumn("hits", _hits(segment))
        df = df.withColumn("end", F.array_min(F.filter("hits", lambda h: h % 2 == 1)))
        if part < len(segments) - 1:
            df = checkpointed(df)
        shown = F.filter("hits", lambda h: F.col("end").isNull() | (h <= F.col("end")))
        # The outer form: of the plain one Spark infers a filter on the hits, and pushing it below the rules tells them twice.
        found = df.withColumn("hit", F.explode_outer(shown)).where("hit IS NOT NULL").withColumn("rule", F.expr("hit div 2").cast("int"))
        features.append(found.select("id", *geometry, "rule", *[_emitted(name, segment, first[name]) for name in names]))
        df = df.where("end IS NULL").select("id", *geometry, *[state.place[name] for name in names])
    out = features[0]
    for more in features[1:]:
        out = out.union(more)
    clauses = {n: r for n, r in enumerate(rules.rules) if r.clause is not None}
    fields = ("ord", "type", "low", "high", "road_class", "road_speed", "default_name")
    listed = json.dumps([None if n not in clauses else {"ord": clauses[n].ord} | {f: getattr(clauses[n].clause, f) for f in fields[1:]} for n in range(len(rules.rules))])
    kind = "array<struct<ord:int,type:int,low:int,high:int,road_class:int,road_speed:int,default_name:string>>"
    out = out.withColumn("clause", F.get(F.from_json(F.lit(listed), kind), F.col("rule")))
    place = first
    for part, segment in enumerate(_segments([replace(r, clause=None) for r in rules.finalize], _start(keys, geometry, prefix, len(segments)))):
        out, place = checkpointed(out) if part else out, segment.state.place
        out = segment.state.project(out)
        out = out.select("id", *geometry, "clause", *[place[name] for name in names])
    mine = F.array(*[F.struct(F.lit(k).alias("k"), F.col(place[f"tag {k}"]).alias("v")) for k in keys]) if keys else F.array().cast("array<struct<k:string,v:string>>")
    kept = F.map_from_entries(F.filter(mine, lambda e: e["v"].isNotNull()))
    label = F.coalesce(place["label"], "clause.default_name").alias("label")
    return out.select("id", *[f"clause.{f}" for f in fields[:-1]], label, F.col(place["labels"]).alias("labels"), F.map_concat(F.coalesce(place["rest"], F.create_map().cast("map<string,string>")), kept).alias("tags"))


def _emitted(name: str, segment: _Segment, column_name: str) -> Column:
    """What a name holds in the feature of the rule in column ``rule``: by its own actions, or by the rules before."""
    out = None
    for n, column in segment.own.get(name, ()):
        out = F.when(F.col("rule") == n, column) if out is None else out.when(F.col("rule") == n, column)
    history = segment.state.history[name]
    if out is None and len(history) == 1:
        return F.col(history[0][1])  # as it is, under its own name
    before = segment.state.at(name, F.col("rule"))
    return (before if out is None else out.otherwise(before)).alias(column_name)


def classify_by_join(df: DataFrame, rules: RuleSet, key: str, column: Column) -> DataFrame:
    """First-match classification for a ladder of ``key = value`` rules without actions: a join with the rule table."""
    table = []
    for r in rules.rules:
        p = r.predicate
        if not isinstance(p, Compare) or p.op != "=" or p.key != key or p.value is None or r.actions or r.clause is None or r.clause.goes_on:
            raise ValueError("only ladders of equalities on one key can be joined")
        table.append((p.value, r.ord, r.clause.type))
    spark = df.sparkSession
    first = spark.createDataFrame(table, "value string, ord int, type int").groupBy("value").agg(F.min_by("type", "ord").alias("type"), F.min("ord").alias("ord"))
    return df.withColumn("value", column).join(F.broadcast(first), "value").drop("value")  # as long as the rule text
