"""Reference expressions of a study design (a channel name, ``1``, or arithmetic).

A reference is evaluated per (feature, plex) against a map column
``channel -> intensity``. Only names, numbers, ``+ - * /``, parentheses and
``mean(a, b, ...)`` are accepted; anything else raises. The few distinct
expressions of a design (one per plex at most) are turned into Spark SQL on
the driver; the data never leaves the executors.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r"\s*(?:(?P<num>\d+(?:\.\d*)?(?:[eE][-+]?\d+)?)"
                    r"|(?P<name>[A-Za-z.][A-Za-z0-9_.]*)"
                    r"|(?P<op>[-+*/(),]))")


def tokenize(text: str) -> list[tuple[str, str]]:
    pos, out = 0, []
    text = text.strip()
    while pos < len(text):
        m = _TOKEN.match(text, pos)
        if not m or m.end() == pos:
            raise ValueError(f"reference expression {text!r}: bad token at {pos}")
        kind = m.lastgroup
        out.append((kind, m.group(kind)))
        pos = m.end()
    return out


def reference_sql(text: str, map_col: str) -> str:
    """Spark SQL for one reference expression over ``map_col``.

    Grammar (whitelist): sums and differences of products / quotients of
    numbers, channel names, parenthesised terms, unary minus and
    ``mean(a, b, ...)``. Names become ``try_element_at(map_col, 'name')``
    (null when the channel is absent), ``/`` becomes ``try_divide`` (null on
    a zero channel instead of an error), ``mean`` the average of its terms.
    """
    toks = tokenize(str(text))
    pos = 0

    def peek():
        return toks[pos] if pos < len(toks) else (None, None)

    def take(kind=None, val=None):
        nonlocal pos
        k, v = peek()
        if k is None or (kind and k != kind) or (val and v != val):
            raise ValueError(f"reference expression {text!r}: unexpected {v!r}")
        pos += 1
        return v

    def expr():
        out = term()
        while peek() in (("op", "+"), ("op", "-")):
            op = take()
            out = f"({out} {op} {term()})"
        return out

    def term():
        out = unary()
        while peek() in (("op", "*"), ("op", "/")):
            op = take()
            rhs = unary()
            out = f"({out} * {rhs})" if op == "*" else f"try_divide({out}, {rhs})"
        return out

    def unary():
        if peek() == ("op", "-"):
            take()
            return f"(- {unary()})"
        return atom()

    def atom():
        k, v = peek()
        if k == "num":
            take()
            return f"CAST({v} AS DOUBLE)"
        if k == "name":
            take()
            if peek() == ("op", "("):
                if v != "mean":
                    raise ValueError(f"function {v!r} is not allowed in a reference")
                take("op", "(")
                args = [expr()]
                while peek() == ("op", ","):
                    take()
                    args.append(expr())
                take("op", ")")
                return f"(({' + '.join(args)}) / {len(args)})"
            return f"try_element_at({map_col}, '{v}')"
        if (k, v) == ("op", "("):
            take()
            inner = expr()
            take("op", ")")
            return inner
        raise ValueError(f"reference expression {text!r}: unexpected {v!r}")

    sql = expr()
    if pos != len(toks):
        raise ValueError(f"reference expression {text!r}: trailing {toks[pos][1]!r}")
    return sql


def reference_value(ref_col: str, map_col: str, expressions: list[str]) -> Column:
    """One CASE over the distinct expressions of the design."""
    c = None
    for e in expressions:
        branch = F.expr(reference_sql(e, map_col))
        cond = F.col(ref_col) == F.lit(e)
        c = F.when(cond, branch) if c is None else c.when(cond, branch)
    return c if c is not None else F.lit(None).cast("double")


# Append _<pass> to every symbol of an R expression, keep numbers, operators
# and function names, drop blanks. A symbol starts with a letter or a dot and is
# not preceded by a letter, digit, '_' or '.', nor followed by '('.
SYMBOL_PATTERN = r"(?<![A-Za-z0-9_.])([A-Za-z.][A-Za-z0-9_.]*+)(?!\s*\()"


def suffix_expression(col: Column, pass_col: Column) -> Column:
    spaced = F.regexp_replace(col, SYMBOL_PATTERN, "$1\u0001")
    out = F.replace(spaced, F.lit("\u0001"), F.concat(F.lit("_"), pass_col))
    return F.regexp_replace(out, r"\s+", "")
