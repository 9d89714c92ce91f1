"""Cleaning steps for raw exports."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from feederlens.functions import numbers as N
from feederlens.settings import LINEAGE, NULL_TOKENS, UNNAMED_PREFIX


def quoted(name: str) -> Column:
    """Column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def normalize_name(raw: str, position: int) -> str:
    """Header rule: trim, blanks to ``_``, ``%`` spelled out, ``/`` to ``_``, no parentheses."""
    if not raw.strip() or raw == f"_c{position}":
        return f"{UNNAMED_PREFIX}{position}"
    name = re.sub(r"[ /]", "_", raw.strip())
    return re.sub(r"[()]", "", name.replace("%", "Percent"))


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column by the header rule; names that collide are an error."""
    names = [normalize_name(raw, i) for i, raw in enumerate(df.columns)]
    clashes = sorted(n for n, times in Counter(n.lower() for n in names).items() if times > 1)
    if clashes:
        raise ValueError(f"columns {clashes} collide after cleaning {df.columns}")
    return df.toDF(*names)


def null_tokens(df: DataFrame, tokens: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """Turn cells that spell "missing" into NULL, in every text column."""
    tokens = list(tokens)

    def cell(field):
        value = quoted(field.name)
        if isinstance(field.dataType, StringType):
            value = F.when(~value.isin(tokens), value)
        return value.alias(field.name)

    return df.select([cell(f) for f in df.schema.fields])


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop rows without a single value."""
    return df.na.drop(how="all", subset=[f"`{c}`" for c in df.columns])


def trim_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    return df.withColumns({k: N.strip(quoted(k)) for k in keys})


def coerce_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Cast the named columns to double; names the frame lacks are skipped."""
    return _recast(df, columns, N.to_number)


def coerce_terminal(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Cast the named columns to int; names the frame lacks are skipped."""
    return _recast(df, columns, N.to_terminal)


def _recast(df, columns, convert):
    wanted = set(columns)
    return df.select([
        convert(quoted(f.name), f.dataType).alias(f.name) if f.name in wanted else quoted(f.name)
        for f in df.schema.fields
    ])


def dedupe(df: DataFrame, include_lineage: bool = False, one_file: bool = False) -> DataFrame:
    """Keep one row per distinct set of business values, the first in file order.

    A grouping with a partial stage: copies collapse before the shuffle, so a
    row repeated any number of times costs one shuffled row per task. With
    ``include_lineage`` the lineage columns count as values too; file and row
    id differ on every row, so then nothing can be removed. ``one_file`` says
    all rows are of one file; comparing row ids alone saves two sorts.
    """
    lineage = [c for c in LINEAGE if c in df.columns]
    if include_lineage:
        return df.dropDuplicates()
    if not lineage:
        return df.distinct()
    if lineage == ["source_row_id"] or (one_file and len(lineage) == 2):
        values = [quoted(c) for c in df.columns if c != "source_row_id"]
        kept = df.groupBy(*values).agg(F.min("source_row_id").alias("source_row_id"))
    else:
        values = [quoted(c) for c in df.columns if c not in lineage]
        first = F.min(F.struct(*lineage)).alias("_first")
        kept = df.groupBy(*values).agg(first).select(
            *values, *[F.col(f"_first.{c}").alias(c) for c in lineage]
        )
    return kept.select(*map(quoted, df.columns))


def require_key(df: DataFrame, key: str, null_key: str = "reject") -> DataFrame:
    """Drop rows whose key is missing or blank; apply it after trimming.

    ``null_key="keep_literal"`` keeps a missing key as the text ``nan``, as
    text-based tools do; only blanks are dropped then.
    """
    value = quoted(key)
    if null_key == "keep_literal":
        df = df.withColumn(key, F.coalesce(value, F.lit("nan")))
    elif null_key != "reject":
        raise ValueError(f"null_key must be 'reject' or 'keep_literal', not {null_key!r}")
    return df.filter(value.isNotNull() & (value != ""))


def drop_unnamed(df: DataFrame) -> DataFrame:
    """Drop columns that had a blank header cell."""
    return df.drop(*[c for c in df.columns if c.startswith(UNNAMED_PREFIX)])


def with_limit_flags(df: DataFrame) -> DataFrame:
    """Flag rows for which any of the two normal / emergency limits is given."""

    def given(kind):
        return F.col(f"P_{kind}").isNotNull() | F.col(f"Q_{kind}").isNotNull()

    return df.withColumns({
        "has_normal_limit": given("Normal"),
        "has_emergency_limit": given("Emergency"),
    })


def resolve(df: DataFrame, candidates: Iterable[str]) -> str:
    """The column meant by the first candidate there is; see ``resolve_all``."""
    [found] = resolve_all(df, {"": candidates}).values()
    return found


def resolve_all(df: DataFrame, wanted: Mapping[str, Iterable[str]]) -> dict[str, str]:
    """The frame's column for each wanted name, from the spellings it may have.

    Case, blanks and underscores do not count; earlier spellings go first. One
    error names all that is missing or could mean several columns.
    """
    folded = defaultdict(list)
    for column in df.columns:
        folded[_fold(column)].append(column)
    found, faults = {}, []
    for name, spellings in wanted.items():
        spellings = list(spellings)
        hits = next(filter(None, (folded.get(_fold(s)) for s in spellings)), [])
        if len(hits) == 1:
            found[name] = hits[0]
        else:
            faults.append(f"{spellings}: {'one of ' + str(hits) if hits else 'missing'}")
    if faults:
        raise KeyError(f"{'; '.join(faults)} (columns: {df.columns})")
    return found


def _fold(name: str) -> str:
    return name.translate({ord(" "): None, ord("_"): None}).strip().casefold()
