"""Macro preprocessing of rule text, at plan time: dead rules never reach a plan.

#define NAME [text], #define NAME(a, b) text, #define_block NAME ... #enddef, #undef, #ifdef,
#ifndef, #if, #else, #endif (nested), #include "file"; a backslash continues a line. Names are
replaced as whole words, also inside strings where they start with $.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

MOST_INCLUDES, MOST_EXPANSIONS = 20, 50


def evaluate(expression: str, defined: dict[str, object]) -> bool:
    """|| && == != > < >= <= + - ! ( ) and defined(NAME), from left to right without precedence."""
    tokens = re.findall(r"\|\||&&|[!=<>]=|[-+<>!()]|defined|[\w$.]+|\"[^\"]*\"", expression)
    at = 0

    def number(x):
        try:
            return float(x)
        except (TypeError, ValueError):
            return x

    def one():
        nonlocal at
        if at >= len(tokens):
            raise ValueError(f"#if {expression}: incomplete")
        t = tokens[at]
        at += 1
        if t == "!":
            return not one()
        if t == "(":
            out = many()
            at += 1
            return out
        if t == "defined":
            at += tokens[at] == "("
            out = tokens[at] in defined
            at += 1
            at += at < len(tokens) and tokens[at] == ")"
            return out
        return number(t.strip('"')) if t not in defined else number(defined[t])

    def many():
        nonlocal at
        left = one()
        while at < len(tokens) and tokens[at] != ")":
            op = tokens[at]
            at += 1
            right = one()
            if op in ("+", "-", "<", ">", "<=", ">=") and (isinstance(left, str) or isinstance(right, str)):
                left, right = str(left), str(right)
            left = {
                "||": lambda a, b: bool(a) or bool(b), "&&": lambda a, b: bool(a) and bool(b), "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
                ">": lambda a, b: a > b, "<": lambda a, b: a < b, ">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b, "+": lambda a, b: a + b, "-": lambda a, b: a - b,
            }[op](left, right)
        return left

    return bool(many())


def preprocess(text: str, options: Iterable[str] = (), load: Callable[[str], str] | None = None, defines: dict[str, str] | None = None) -> str:
    """The text with directives carried out and names replaced; ``options`` are names defined from outside."""
    names: dict[str, object] = {o: "1" for o in options} | dict(defines or {})
    lines = _run(text, names, load, 0)
    return "\n".join(lines)


def _expand(line: str, names: dict[str, object]) -> str:
    for _ in range(MOST_EXPANSIONS):
        before = line
        for name in sorted(names, key=len, reverse=True):
            value = names[name]
            plain = re.escape(name)
            pattern = rf"{plain}(?!\w)" if name.startswith("$") else rf"(?<![\w$]){plain}(?!\w)"
            if isinstance(value, tuple):
                args, body = value

                def call(m, args=args, body=body):
                    given = [x.strip() for x in m[1].split(",")]
                    out = body
                    for a, g in zip(args, given, strict=False):
                        out = re.sub(rf"(?<!\w){re.escape(a)}(?!\w)", lambda _, g=g: g, out)
                    return out

                line = re.sub(pattern + r"\(([^()]*)\)", call, line)
            elif value != "":
                line = re.sub(pattern, lambda _, v=str(value): v, line)
        if line == before:
            return line
    raise ValueError(f"names expand without end in: {line[:60]!r}")


def _run(text: str, names: dict[str, object], load, depth: int) -> list[str]:
    if depth > MOST_INCLUDES:
        raise ValueError("includes nest too deep")
    out: list[str] = []
    live: list[bool] = []
    lines = iter(re.sub(r"\\\n", "", text).split("\n"))
    for line in lines:
        m = re.match(r"#(define_block|define|undef|ifdef|ifndef|if|else|endif|include)\b\s*(.*)", line)
        if not m:
            if all(live):
                out.append(_expand(line, names))
            continue
        what, rest = m[1], m[2].strip()
        if what in ("ifdef", "ifndef"):
            live.append((rest in names) == (what == "ifdef"))
        elif what == "if":
            live.append(all(live) and evaluate(rest, names))
        elif what in ("else", "endif"):
            if not live:
                raise ValueError(f"#{what} without #if")
            last = live.pop()
            if what == "else":
                live.append(not last)
        elif what == "define_block":
            block = []
            for x in lines:
                if re.match(r"#enddef\b", x):
                    break
                block.append(x)
            if all(live):
                names[rest] = "\n".join(block)
        elif not all(live):
            continue
        elif what == "define":
            d = re.match(r"([\w$]+)(?:\(([^)]*)\))?\s*(.*)", rest)
            if not d:
                raise ValueError(f"#define needs a name: {line!r}")
            names[d[1]] = (tuple(a.strip() for a in d[2].split(",")), d[3]) if d[2] is not None else d[3]
        elif what == "undef":
            names.pop(rest, None)
        else:
            name = rest.strip('"<>')
            if load is None:
                raise ValueError(f"no loader for {name!r}")
            out += _run(load(str(names.get(name, name))), names, load, depth + 1)
    if live:
        raise ValueError("#if without #endif")
    return out
