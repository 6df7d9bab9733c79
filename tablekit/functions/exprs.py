"""Column-expression helpers shared by the operators (all JVM-side)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hit(cond: Column | str | None) -> Column:
    """Three-valued WHERE.  Only rows where ``cond`` is TRUE are hit;
    FALSE and NULL rows are left alone (SQL standard for UPDATE/DELETE).
    ``filter`` and ``when`` treat NULL as not TRUE themselves, so the bare
    condition keeps its form and reaches the scan."""
    if cond is None:
        return F.lit(True)
    return F.expr(cond) if isinstance(cond, str) else cond


def miss(cond: Column | str | None) -> Column:
    """The complement of ``hit``: ``cond`` is FALSE or NULL, in a form whose
    comparisons are pushed to the scan: NOT (a = b) OR a IS NULL OR b IS NULL.
    The NULL test goes to the operands of an equality or of IN over constants,
    and AND / OR are taken apart; anything else is tested as a whole (Catalyst
    itself moves the NULL test of <, <=, >, >= to their operands)."""
    return _complement(hit(cond))


def _complement(c: Column) -> Column:
    op, args = _operands(c)
    if op == "and":
        return reduce(Column.__or__, map(_complement, args))
    if op == "or":
        return reduce(Column.__and__, map(_complement, args))
    if op in ("=", "in"):
        return reduce(Column.__or__, [a.isNull() for a in args], ~c)
    return ~c | c.isNull()


def _operands(c: Column) -> tuple[str, list[Column]]:
    """(operator, operands whose NULL makes ``c`` NULL) of AND, OR, = and IN
    over constants; ("", []) for all else and outside a classic session."""
    if not hasattr(c, "_jc"):
        return "", []
    node = c._jc.node()
    if node.getClass().getSimpleName() == "SqlExpression":
        tree = parse(node.expression())
        op = {"And": "and", "Or": "or", "EqualTo": "=", "In": "in"}.get(tree.getClass().getSimpleName(), "")
        kids = _items(tree.children())
        constant = [k.getClass().getSimpleName() == "Literal" and k.value() is not None for k in kids]
        as_column = lambda k: F.expr(k.sql())
    elif node.getClass().getSimpleName() == "UnresolvedFunction":
        op = {"==": "="}.get(node.functionName().lower(), node.functionName().lower())
        kids = _items(node.arguments())
        constant = [k.getClass().getSimpleName() == "Literal" and k.value() is not None for k in kids]
        as_column = lambda k: Column(k_column(k))
        k_column = SparkSession.active()._jvm.org.apache.spark.sql.Column
    else:
        return "", []
    if op == "in":
        return (op, [as_column(kids[0])]) if all(constant[1:]) else ("", [])
    return (op, [as_column(k) for k in kids]) if op in ("and", "or", "=") else ("", [])


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def parse(expr: str):
    """Spark's parsed form of a SQL expression."""
    return SparkSession.active()._jsparkSession.sessionState().sqlParser().parseExpression(expr)


def column_refs(expr: str) -> list[tuple[list[str], int, int]]:
    """(name parts, first, last position) of every column that
    a SQL expression names; functions, types, literals and lambda variables
    are none."""
    out = []

    def walk(node, bound: frozenset[str]) -> None:
        kind = node.getClass().getSimpleName()
        if kind == "LambdaFunction":       # its arguments hide columns of the same name
            walk(node.function(), bound | {a.nameParts().apply(0).lower() for a in _items(node.arguments())})
            return
        if kind in ("UnresolvedAttribute", "UnresolvedNamedLambdaVariable"):
            parts = _items(node.nameParts())
            if parts[0].lower() not in bound:
                out.append((parts, node.origin().startIndex().get(), node.origin().stopIndex().get()))
        for kid in _items(node.children()):
            walk(kid, bound)

    walk(parse(expr), frozenset())
    return out


def names_in(expr: str) -> set[str]:
    """The columns, in lower case, that a SQL expression names."""
    return {parts[0].lower() for parts, _, _ in column_refs(expr)}


def rename_in(expr: str, old: str, new: str) -> str:
    """``expr`` with the column ``old`` called ``new``; the rest keeps its text."""
    def quoted(name: str) -> str:
        return name if re.fullmatch(r"[A-Za-z_]\w*", name) else "`" + name.replace("`", "``") + "`"

    for parts, first, last in sorted(column_refs(expr), key=lambda r: -r[1]):
        if parts[0].lower() == old.lower():
            expr = expr[:first] + ".".join(quoted(p) for p in [new, *parts[1:]]) + expr[last + 1:]
    return expr


def order_cols(order: Sequence[str | Column]) -> list[Column]:
    """Accept 'col', 'col DESC', 'col ASC NULLS LAST' or Column objects."""
    out = []
    for o in order:
        if isinstance(o, Column):
            out.append(o)
            continue
        parts = o.split()
        c = F.col(parts[0])
        words = [p.upper() for p in parts[1:]]
        desc = "DESC" in words
        nulls_first = None
        if "NULLS" in words:
            nulls_first = words[words.index("NULLS") + 1] == "FIRST"
        if desc:
            c = c.desc_nulls_first() if nulls_first else c.desc_nulls_last() if nulls_first is False else c.desc()
        else:
            c = c.asc_nulls_last() if nulls_first is False else c.asc_nulls_first() if nulls_first else c.asc()
        out.append(c)
    return out


def order_names(order: Sequence[str]) -> list[tuple[str, bool]]:
    """('col', descending?) pairs for string order specs."""
    res = []
    for o in order:
        parts = o.split()
        res.append((parts[0], len(parts) > 1 and parts[1].upper() == "DESC"))
    return res


def any_differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """TRUE when any (new, old) pair differs, NULL-safe (M16 touch rule)."""
    cond = F.lit(False)
    for new, old in pairs:
        cond = cond | ~new.eqNullSafe(old)
    return cond

