"""Catalogue queries in the usual search syntax, compiled to predicates.

    field:value            equal; of an array column: a member
    field:(a OR "b c")     any of the values; AND and NOT inside apply to the same field
    field:[a TO b]         inclusive range
    field:*part*           wildcard
    AND, OR, NOT, (...)    AND binds stronger than OR; terms side by side are joined by AND
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r'\s*(?:(\()|(\))|(AND|OR|NOT)\b|\[([^\]]*?)\s+TO\s+([^\]]*)\]|([A-Za-z_][\w.]*):|"([^"]*)"|([^\s()"]+))')


def _tokens(query: str) -> list[tuple[str, tuple[str, ...]]]:
    out, at = [], 0
    query = query.rstrip()
    while at < len(query):
        m = _TOKEN.match(query, at)
        if not m:
            raise ValueError(f"cannot read the query at {query[at : at + 20]!r}")
        kind = next(k for k, g in zip(("(", ")", "op", "range", "range", "field", "value", "value"), m.groups(), strict=True) if g is not None)
        out.append((kind, tuple(g for g in m.groups() if g is not None)))
        at = m.end()
    return out


class _Reader:
    """Recursive descent over the tokens; field is the one that a group of values applies to."""

    def __init__(self, tokens, arrays: frozenset[str]):
        self.tokens, self.at, self.arrays = tokens, 0, arrays

    def peek(self) -> tuple[str, tuple[str, ...]]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", ("",))

    def take(self) -> tuple[str, tuple[str, ...]]:
        token = self.peek()
        self.at += 1
        return token

    def any_of(self, field: str | None) -> Column:
        left = self.all_of(field)
        while self.peek() == ("op", ("OR",)):
            self.take()
            left = left | self.all_of(field)
        return left

    def all_of(self, field: str | None) -> Column:
        left = self.term(field)
        while self.peek()[0] not in ("end", ")") and self.peek() != ("op", ("OR",)):
            if self.peek() == ("op", ("AND",)):
                self.take()
            left = left & self.term(field)
        return left

    def term(self, field: str | None) -> Column:
        kind, value = self.take()
        if (kind, value) == ("op", ("NOT",)):
            return ~self.term(field)
        if kind == "(":
            inner = self.any_of(field)
            if self.take()[0] != ")":
                raise ValueError("a parenthesis is not closed")
            return inner
        if kind == "field":
            return self.term(value[0])
        if field is None or kind not in ("value", "range"):
            raise ValueError(f"unexpected {value[0]!r}")
        return self.test(field, kind, value)

    def test(self, field: str, kind: str, value: tuple[str, ...]) -> Column:
        c = F.col(field)
        if kind == "range":
            low, high = (float(v) if re.fullmatch(r"-?\d+(\.\d+)?", v) else v for v in value)
            return F.coalesce(c.between(low, high), F.lit(False))
        pattern = re.sub(r"([%_\\])", r"\\\1", value[0]).replace("*", "%")

        def holds(x: Column) -> Column:
            return x.cast("string").like(pattern) if "*" in value[0] else x.cast("string") == value[0]

        return F.coalesce(F.exists(c, holds) if field in self.arrays else holds(c), F.lit(False))


def predicate(query: str, arrays: frozenset[str] = frozenset()) -> Column:
    """The query as a predicate; a null value meets no condition, so NOT of it holds."""
    reader = _Reader(_tokens(query), arrays)
    out = reader.any_of(None)
    if reader.peek()[0] != "end":
        raise ValueError(f"unexpected {reader.peek()[1][0]!r}")
    return out
