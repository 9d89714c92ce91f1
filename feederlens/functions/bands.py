"""Labels from ordered thresholds and from name prefixes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

_TESTS = {
    "<": lambda c, b: c < b,
    "<=": lambda c, b: c <= b,
    ">": lambda c, b: c > b,
    ">=": lambda c, b: c >= b,
    "between": lambda c, b: c.between(*b),
    "missing": lambda c, _: c.isNull(),
}


def first_match(cases: Iterable[tuple[Column, str]], default: str) -> Column:
    """Label of the first true condition; NULL conditions fall through."""
    chain = F
    for condition, label in cases:
        chain = chain.when(condition, label)
    return F.lit(default) if chain is F else chain.otherwise(default)


def band(value: Column, rules, default: str) -> Column:
    """Label a number by ordered ``(comparison, bound, label)`` rules."""
    return first_match(((_TESTS[op](value, bound), label) for op, bound, label in rules), default)


def prefix_label(name: Column, prefixes, default: str) -> Column:
    """Label a name by the first prefix it starts with."""
    return first_match(((name.startswith(p), label) for p, label in prefixes), default)
