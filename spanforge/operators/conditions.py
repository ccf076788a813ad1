"""Conditions over a state, parsed on the driver into Spark columns with three-valued logic.

Grammar: `or`, `and`, `not`, comparisons, `in [a, b]`, parentheses, dates, numbers (with _ and %),
quoted strings and bare words. Anything else is refused, and text never reaches the SQL parser.
A variable that the state lacks is null, so a condition may be unknown. Text compares without case.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


class ConditionError(ValueError):
    """The condition is not in the grammar."""


_TOKEN = re.compile(r"\s*(?:(?P<date>\d{4}-\d{2}-\d{2})|(?P<number>\d[\d_]*(?:\.\d+)?%?)|(?P<text>'[^']*'|\"[^\"]*\")|(?P<op><=|>=|==|!=|<|>|\(|\)|\[|\]|,)|(?P<word>[A-Za-z_][A-Za-z0-9_.]*))")


def tokenize(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    source = source.rstrip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m or m.end() == at:
            raise ConditionError(f"can't read {source[at : at + 20]!r}")
        out.append((m.lastgroup or "", m.group(m.lastgroup or 0)))
        at = m.end()
    return out


class _Parser:
    """Recursive descent over the tokens. value(name) gives a variable as a text column; f makes columns."""

    f = F

    def __init__(self, tokens: list[tuple[str, str]], value: Callable[[str], Column]):
        self.tokens, self.at, self.value, self.names = tokens, 0, value, set()

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, expected: str | None = None) -> tuple[str, str]:
        t = self.peek()
        if t[0] == "end" or expected is not None and t[1] != expected:
            raise ConditionError(f"expected {expected or 'more'}, found {t[1] or 'the end'}")
        self.at += 1
        return t

    def either(self) -> Column:
        out = self.both()
        while self.peek()[1] == "or":
            self.take()
            out = out | self.both()
        return out

    def both(self) -> Column:
        out = self.negated()
        while self.peek()[1] == "and":
            self.take()
            out = out & self.negated()
        return out

    def negated(self) -> Column:
        if self.peek()[1] == "not":
            self.take()
            return ~self.negated()
        if self.peek()[1] == "(":
            self.take()
            out = self.either()
            self.take(")")
            return out
        return self.comparison()

    def variable(self) -> tuple[str, Column]:
        kind, word = self.take()
        if kind != "word" or word in ("and", "or", "not", "in"):
            raise ConditionError(f"{word!r} is no variable")
        self.names.add(word)
        return word, self.value(word)

    def literal(self) -> tuple[str, Column]:
        kind, word = self.take()
        if kind == "number":
            return kind, self.f.lit(word.replace("_", "").rstrip("%")).cast("decimal(38,10)")
        if kind == "date":
            return kind, self.f.lit(word).cast("date")
        if kind == "text":
            return kind, self.f.lit(word[1:-1].lower())
        if kind == "word" and word not in ("and", "or", "not", "in"):
            return "text", self.f.lit(word.lower())
        raise ConditionError(f"{word!r} is no value")

    def typed(self, kind: str, c: Column) -> Column:
        return c.try_cast("decimal(38,10)") if kind == "number" else self.f.try_to_date(c, "yyyy-MM-dd") if kind == "date" else self.f.lower(c)

    def comparison(self) -> Column:
        _, left = self.variable()
        op = self.peek()[1]
        if op == "in":
            self.take()
            self.take("[")
            items = [self.literal()]
            while self.peek()[1] == ",":
                self.take()
                items.append(self.literal())
            self.take("]")
            found = self.f.lit(False)
            for kind, x in items:
                found = found | self.f.coalesce(self.typed(kind, left) == x, self.f.lit(False))
            return self.f.when(left.isNotNull(), found)
        if op not in ("<=", ">=", "==", "!=", "<", ">"):
            return self.f.when(self.f.lower(left).isin("true", "false"), self.f.lower(left) == "true")
        self.take()
        kind, right = self.literal()
        a = self.typed(kind, left)
        return {"<=": a <= right, ">=": a >= right, "==": a == right, "!=": a != right, "<": a < right, ">": a > right}[op]


class _Nothing:
    """Stands for columns where only the grammar counts, in a worker too."""

    def __getattr__(self, name: str) -> Callable:
        return lambda *_: self

    __or__ = __and__ = __eq__ = __ne__ = __lt__ = __gt__ = __le__ = __ge__ = lambda self, _: self  # type: ignore[assignment]
    __invert__ = lambda self: self
    __hash__ = None


class _Grammar(_Parser):
    f = _Nothing()


def condition(source: str, value: Callable[[str], Column]) -> Column:
    """The condition as a nullable boolean column."""
    p = _Parser(tokenize(source), value)
    if not p.tokens:
        raise ConditionError("empty condition")
    out = p.either()
    if p.peek()[0] != "end":
        raise ConditionError(f"{p.peek()[1]!r} is left over")
    return out


def from_map(state: Column) -> Callable[[str], Column]:
    """Variables looked up in a map column of text."""
    return lambda name: F.try_element_at(state, F.lit(name))


def variables(source: str) -> set[str]:
    """Names that a condition refers to."""
    p = _Grammar(tokenize(source), lambda name: _Grammar.f)
    p.either()
    if p.peek()[0] != "end":
        raise ConditionError(f"{p.peek()[1]!r} is left over")
    return p.names


def in_window(at: Column, start: Column, end: Column) -> Column:
    """Inclusive window; an open end or an unknown date passes."""
    return F.coalesce(at >= start, F.lit(True)) & F.coalesce(at <= end, F.lit(True))


def governs(window: Column, *conditions: Column) -> Column:
    """False if the window or any condition is false, unknown if any is unknown, else true."""
    out = window
    for c in conditions:
        out = out & c
    return F.when(~window, False).otherwise(out)
