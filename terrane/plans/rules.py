"""The rule language: text to an ordered list of rules.

    predicate [ '{' action ';' ... '}' ] [ '[' type clause ']' ]

Rules may span lines, # starts a comment, quotes are ' or ", ``include 'file';`` splices a file and
``<finalize>`` starts the second phase.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field


class RuleError(ValueError):
    pass


# Predicates ------------------------------------------------------------------


@dataclass(frozen=True)
class Compare:
    """key op value. op: = != ~ < <= > >=, value None stands for *; ``other`` compares with that tag."""

    key: str
    op: str
    value: str | None
    function: bool = False
    other: bool = False


@dataclass(frozen=True)
class And:
    parts: tuple


@dataclass(frozen=True)
class Or:
    parts: tuple


@dataclass(frozen=True)
class Not:
    part: object


# Values and actions ------------------------------------------------------------


@dataclass(frozen=True)
class Ref:
    """${key|filter:arg|...}; ``member``: $(key), a relation member's own tag."""

    key: str
    filters: tuple = ()
    member: bool = False


@dataclass(frozen=True)
class Value:
    """Texts and references in a row; usable only if all references exist."""

    parts: tuple


@dataclass(frozen=True)
class Action:
    """set, add, delete, deletealltags, name, addlabel, setaccess, addaccess, echo, echotags, apply."""

    kind: str
    key: str = ""
    values: tuple = ()
    role: str | None = None
    actions: tuple = ()


@dataclass(frozen=True)
class TypeClause:
    type: int
    low: int = 24
    high: int = 24
    road_class: int | None = None
    road_speed: int | None = None
    default_name: str | None = None
    goes_on: bool = False
    with_actions: bool = False


@dataclass(frozen=True)
class Rule:
    ord: int
    predicate: object
    actions: tuple = ()
    clause: TypeClause | None = None


@dataclass
class RuleSet:
    rules: list[Rule] = field(default_factory=list)
    finalize: list[Rule] = field(default_factory=list)


TOKEN = re.compile(r"""\s+|\#[^\n]*|(?P<str>'[^']*'|"[^"]*")|(?P<ref>\$[{(][^})]*[})])|(?P<op>!=|<=|>=|&&|\|\||[=~<>!&|(){}\[\];])|(?P<word>[^\s=~<>!&|(){}\[\];'"]+)""")


def _tokens(text: str) -> list[tuple[str, str, int]]:
    out, at = [], 0
    while at < len(text):
        if text.startswith("<finalize>", at):
            out.append(("finalize", "", at))
            at += len("<finalize>")
            continue
        m = TOKEN.match(text, at)
        if not m:
            raise RuleError(f"cannot read rule text at: {text[at : at + 40]!r}")
        at = m.end()
        if m.lastgroup:
            out.append((m.lastgroup, m[m.lastgroup], m.start()))
    return out


def _filters(text: str) -> tuple:
    return tuple(tuple(f.split(":", 1)) if ":" in f else (f, "") for f in _split_filters(text))


def _split_filters(text: str) -> list[str]:
    """Filters are separated by |, which may stand in quotes inside one."""
    out, now, quote = [], "", ""
    for c in text:
        if quote:
            quote = "" if c == quote else quote
            now += c if quote else ""
        elif c in "'\"":
            quote = c
        elif c == "|":
            out.append(now)
            now = ""
        else:
            now += c
    return [*out, now]


def parse_value(text: str) -> Value:
    parts, at = [], 0
    for m in re.finditer(r"\$\{([^}]*)\}|\$\(([^)]*)\)", text):
        if m.start() > at:
            parts.append(text[at : m.start()])
        body = m[1] if m[1] is not None else m[2]
        key, _, filters = body.partition("|")
        parts.append(Ref(key.strip(), _filters(filters) if filters else (), m[1] is None))
        at = m.end()
    if at < len(text) or not parts:
        parts.append(text[at:])
    return Value(tuple(parts))


class _Parser:
    def __init__(self, text: str, load: Callable[[str], str] | None):
        self.text, self.load = text, load
        self.tokens, self.at = _tokens(text), 0

    def peek(self, ahead: int = 0) -> tuple[str, str, int]:
        i = self.at + ahead
        return self.tokens[i] if i < len(self.tokens) else ("end", "", len(self.text))

    def take(self, *wanted: str) -> str:
        kind, value, at = self.peek()
        if wanted and value not in wanted:
            raise RuleError(f"expected {' or '.join(wanted)} before: {self.text[at : at + 40]!r}")
        self.at += 1
        return value

    def take_text(self) -> str:
        kind, value, at = self.peek()
        if kind not in ("str", "word", "ref"):
            raise RuleError(f"expected a value before: {self.text[at : at + 40]!r}")
        self.at += 1
        return value[1:-1] if kind == "str" else value

    def either(self):
        parts = [self.both()]
        while self.peek()[1] in ("|", "||"):
            self.take()
            parts.append(self.both())
        return parts[0] if len(parts) == 1 else Or(tuple(parts))

    def both(self):
        parts = [self.one()]
        while self.peek()[1] in ("&", "&&"):
            self.take()
            parts.append(self.one())
        return parts[0] if len(parts) == 1 else And(tuple(parts))

    def one(self):
        if self.peek()[1] == "!":
            self.take()
            return Not(self.one())
        if self.peek()[:2] == ("op", "("):
            self.take()
            inner = self.either()
            self.take(")")
            return inner
        key, function = self.take_text(), False
        if self.peek()[1] == "(" and self.peek(1)[1] == ")":
            self.take(), self.take()
            function = True
        op = self.take("=", "!=", "~", "<", "<=", ">", ">=")
        kind, raw, _ = self.peek()
        value = self.take_text()
        if kind == "ref":
            return Compare(key, op, raw[2:-1], function, True)
        return Compare(key, op, None if kind == "word" and value == "*" else value, function)

    def values(self) -> tuple:
        out = [parse_value(self.joined())]
        while self.peek()[1] in ("|", "||"):
            self.take()
            out.append(parse_value(self.joined()))
        return tuple(out)

    def joined(self) -> str:
        """A value; words and references without a space between are one."""
        out = self.take_text()
        while self.peek()[0] in ("word", "ref") and self.tokens[self.at - 1][2] + len(self.tokens[self.at - 1][1]) == self.peek()[2]:
            out += self.take_text()
        return out

    def actions(self) -> tuple:
        self.take("{")
        out = []
        while self.peek()[1] != "}":
            if self.peek()[1] == ";":
                self.take()
                continue
            out.append(self.action())
        self.take("}")
        return tuple(out)

    def action(self) -> Action:
        kind = self.take_text()
        if kind in ("set", "add"):
            key = self.take_text()
            self.take("=")
            return Action(kind, key, self.values())
        if kind == "delete":
            return Action(kind, self.take_text())
        if kind in ("name", "addlabel", "setaccess", "addaccess", "echo"):
            return Action(kind, "", self.values())
        if kind in ("deletealltags", "echotags"):
            if self.peek()[0] == "str":
                self.take()
            return Action(kind)
        if kind in ("apply", "apply_once"):
            role = None
            if self.peek()[1] == "role":
                self.take()
                self.take("=")
                role = self.take_text()
                role = None if role == "*" else role
            return Action("apply", kind, (), role, self.actions())
        raise RuleError(f"unknown action {kind!r}")

    def clause(self) -> TypeClause:
        self.take("[")
        found: dict = {"type": int(self.take_text(), 16)}
        while self.peek()[1] != "]":
            word = self.take_text()
            if self.peek()[1] == "=":
                self.take()
            if word in ("resolution", "level"):
                a, _, b = self.take_text().partition("-")
                found["low"], found["high"] = int(a), int(b) if b else 24
            elif word in ("road_class", "road_speed"):
                found[word] = int(self.take_text())
            elif word == "default_name":
                found[word] = self.take_text()
            elif word == "continue":
                found["goes_on"] = True
            elif word == "with_actions":
                found["with_actions"] = True
            else:
                raise RuleError(f"unknown word in a type clause: {word!r}")
        self.take("]")
        return TypeClause(**found)

    def run(self, into: RuleSet, into_finalize: bool = False) -> bool:
        last = into_finalize
        while self.peek()[0] != "end":
            if self.peek()[0] == "finalize":
                self.at += 1
                last = True
                continue
            if self.peek()[1] == "include" and self.peek(1)[0] == "str":
                self.take()
                name = self.take_text()
                if self.peek()[1] == ";":
                    self.take()
                if self.load is None:
                    raise RuleError(f"no loader for {name!r}")
                last = _Parser(self.load(name), self.load).run(into, last)
                continue
            predicate = self.either()
            actions = self.actions() if self.peek()[1] == "{" else ()
            clause = self.clause() if self.peek()[1] == "[" else None
            if not actions and clause is None:
                raise RuleError("a rule needs actions or a type")
            to = into.finalize if last else into.rules
            to.append(Rule(len(into.rules) + len(into.finalize), predicate, actions, clause))
        return last


def parse_rules(text: str, load: Callable[[str], str] | None = None) -> RuleSet:
    """Rules in order, then those after <finalize>; ``load`` gives the text of an included file."""
    out = RuleSet()
    _Parser(text, load).run(out)
    return out


def referenced_keys(rules: RuleSet) -> list[str]:
    """Every tag that a rule reads or writes, in first-use order: the only ones a plan has to promote."""
    found: dict[str, None] = {}

    def predicate(p) -> None:
        if isinstance(p, Compare):
            if not p.function:
                found.setdefault(p.key)
            elif p.key == "maxspeedkmh":
                found.setdefault("maxspeed")
            if p.other:
                found.setdefault(p.value)
        elif isinstance(p, Not):
            predicate(p.part)
        else:
            for x in p.parts:
                predicate(x)

    def actions(many) -> None:
        for a in many:
            if a.kind in ("set", "add", "delete"):
                found.setdefault(a.key)
            for v in a.values:
                for part in v.parts:
                    if isinstance(part, Ref):
                        found.setdefault(part.key)
                        for name, arg in part.filters:
                            if name == "not-contained":
                                found.setdefault(arg.rpartition(":")[2])
            actions(a.actions)

    for r in [*rules.rules, *rules.finalize]:
        predicate(r.predicate)
        actions(r.actions)
    return list(found)
