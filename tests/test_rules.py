import random

import pytest

from terrane.plans.compile import apply_rules
from terrane.plans.interpret import evaluate
from terrane.plans.preprocess import preprocess
from terrane.plans.rules import RuleError, parse_rules, referenced_keys

RULES = r"""
# a comment
a = 1 & b != * { set c = '${a}-${d}' | 'none' ; add d = x }
b = * & (a = 2 | d ~ 'x.*') { delete d; name '${name} (${ele|conv:m=>ft})' | '${name}' } [0x01 resolution 20-22 continue]
c = none { set m = yes } [0x02 continue with_actions]
m = yes & ele > 100 [0x03 road_class=3 road_speed=5 resolution 18]
!(a = 1 | a = 2) & d != x { name "other ${ref|part:;:2}" }
ref ~ '(?i)[a-z]+[0-9];.*' { set list = '${ref|subst:;=>,|subst:A}'; addlabel '${ref|part:;:1}'; addlabel '${ref|part:;:1}' } [0x04 continue]
a = ${b} { setaccess no } [0x05 continue]
maxspeedkmh() >= 50 { addaccess yes } [0x06 default_name 'fast' continue]
maxspeedkmh() != * & a = * { set n = '${name|def:nobody|not-contained:;:ref}' } [0x07 continue]
a = 3 { deletealltags } [0x08]
c = * | d = '' [0x09]
<finalize>
name = * { name '${name}' }
ref = * { addlabel '${ref}'; set fin = '${country|country-ISO}' }
"""


def tags(rng):
    choices = {"a": ["1", "2", "3"], "b": ["1", "2"], "c": ["none"], "d": ["x", "xy", ""], "name": ["N", "A1"], "ele": ["99", "101.5", "150 m", "bad"], "ref": ["A1;B2", "a1;", "zz"], "maxspeed": ["30 mph", "50", "x", "49.9"], "country": ["de", "ZZ"], "spare": ["kept"]}
    return {k: rng.choice(v) for k, v in choices.items() if rng.random() < 0.55}


def test_plan_equals_interpreter(spark):
    rng = random.Random(4)
    rules = parse_rules(RULES)
    rows = [(i, tags(rng)) for i in range(400)] + [(400, {})]
    frame = spark.createDataFrame(rows, "id long, tags map<string,string>")
    want = sorted(((i, f) for i, t in rows for f in evaluate(rules, t, prefix="map:")), key=lambda x: (x[0], x[1]["ord"]))
    assert len({f["type"] for _, f in want}) == 9
    for strategy in ("columns", "interpreter"):
        got = sorted(apply_rules(frame, rules, prefix="map:", strategy=strategy).collect(), key=lambda r: (r.id, r.ord))
        assert [(r.id, r.asDict() | {"tags": dict(r.tags)}) for r in got] == [(i, {"id": i} | f) for i, f in want]


def test_parsing():
    rules = parse_rules("include 'x';\na=b [0x10 resolution 24]", {"x": "k=* {set v = 'a' | b;}\n<finalize>"}.__getitem__)
    assert len(rules.rules) == 1 and len(rules.finalize) == 1 and rules.finalize[0].clause.type == 16
    assert referenced_keys(rules) == ["k", "v", "a"]
    for bad in ("a=b", "a [0x1]", "a=b {frobnicate x}", "a=b [0x1 what]", "a=b {set x = }", "a=b & {set c=d}"):
        with pytest.raises(RuleError):
            parse_rules(bad)


def test_absent_and_empty_tags():
    rules = parse_rules("a != 1 {set x = absent}\na = * {set y = there}\nx = absent [0x1]")
    assert evaluate(rules, {})[0]["tags"] == {"x": "absent"}
    assert "y" not in evaluate(rules, {"a": ""})[0]["tags"]
    assert evaluate(rules, {"a": "1"}) == []


def test_preprocessor():
    text = "#define $__HUT__ Alpine hut\n#define PAIR(a, b) a = b\n#ifdef WINTER\nPAIR(x, 1) [0x1]\n#else\nPAIR(y, 2) {name '$__HUT__'} [0x2]\n#endif\n#if !defined(WINTER) && (2 > 1)\nz=1 \\\n[0x3]\n#endif\n#include \"more\"\n#undef PAIR\nPAIR(x, 1)"
    out = preprocess(text, (), {"more": "#define IN 7\nq = IN [0x4]"}.__getitem__)
    assert out.split("\n") == ["y = 2 {name 'Alpine hut'} [0x2]", "z=1 [0x3]", "q = 7 [0x4]", "PAIR(x, 1)"]
    assert preprocess(text, ["WINTER"], lambda _: "").startswith("x = 1 [0x1]")
    with pytest.raises(ValueError):
        preprocess("#ifdef X")


def test_plain_comments_are_no_directives():
    text = "# if a road has no name, leave it\n# else take the ref\n # include nothing here\na = 1 [0x1]"
    assert preprocess(text) == text


def test_500_rules_run_as_a_plan(spark):
    text = "\n".join(f"k{i % 9} = {i} & n < {i % 40 + 5} {{ set seen = '${{seen|def:}}{i},' }} [0x{i + 1:x} resolution 20" + (" continue with_actions]" if i % 3 else "]") for i in range(500))
    rows = [(i, {f"k{i % 9}": str(i), "n": str(i % 45)} | ({f"k{(i + 1) % 9}": str(i + 1)} if i % 2 else {})) for i in range(500)]
    frame = spark.createDataFrame(rows, "id long, tags map<string,string>")
    rules = parse_rules(text)
    plan, plain = (sorted((r.id, r.ord, r.type, sorted(r.tags.items())) for r in apply_rules(frame, rules, strategy=s).collect()) for s in ("columns", "interpreter"))
    assert plan == plain and len(plan) > 300


def test_a_long_set_takes_few_passes(spark):
    """A quarter of the rules change tags that others read, by chains of many lengths; the rest are typed."""
    from terrane.plans.compile import passes

    rng = random.Random(5)
    keys, made, lines = [f"k{i}" for i in range(12)], [f"m{i}" for i in range(20)], []
    for i in range(90):
        k, v, to = rng.choice(keys), rng.randrange(3), rng.choice(made)
        if i % 4 == 0:
            lines.append([f"{k} = {v} & {rng.choice(keys + made)} != 9 {{ set {to} = '${{{rng.choice(keys + made)}|def:none}}{v}' }}", f"{k} ~ '[0{v}]' {{ add {to} = {v}; name '${{{k}}} ${{{to}}}' }}", f"{rng.choice(made)} = * & {k} = * {{ delete {rng.choice(keys)}; set {to} = x; set {rng.choice(made)} = y }}"][rng.randrange(3)])
        else:
            lines.append(f"{rng.choice(keys + made)} = * & {k} = {v} {{ name '${{{rng.choice(keys)}}}'; set own{i % 3} = '${{{rng.choice(made)}}}' }} [0x{i + 1:x} resolution 20" + ["]", " continue]", " continue]", " continue with_actions]"][i % 7 % 4])
    rules = parse_rules("\n".join(lines))
    assert passes(rules) <= 3
    frame = spark.createDataFrame([(i, {k: str(rng.randrange(3)) for k in keys if rng.random() < 0.5}) for i in range(200)], "id long, tags map<string,string>")
    plan, plain = (sorted((r.id, r.ord, r.type, r.label, sorted(r.tags.items())) for r in apply_rules(frame, rules, strategy=s).collect()) for s in ("columns", "interpreter"))
    assert plan == plain and len(plan) > 100
