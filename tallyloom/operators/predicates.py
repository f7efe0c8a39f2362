"""Row filters and column assignment."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Step = Callable[[DataFrame], DataFrame]


def allow(df: DataFrame, column_values: Mapping[str, Iterable[str] | None]) -> DataFrame:
    """Keep rows whose columns are in the given lists; an empty or missing list does not restrict."""
    for name, values in column_values.items():
        if values:
            df = df.filter(F.col(name).isin(*values))
    return df


def allow_tuples(df: DataFrame, names: list[str], tuples: Iterable[tuple]) -> DataFrame:
    """Keep rows whose columns together equal one of the listed tuples."""
    wanted = [F.struct(*[F.lit(v) for v in t]) for t in tuples]
    return df.filter(F.struct(*[F.col(n) for n in names]).isin(*wanted))


def live(df: DataFrame, flag: str, null_is_live: bool = True) -> DataFrame:
    """Drop logically deleted rows: `N` (and null, unless told otherwise) is live."""
    alive = F.col(flag) == "N"
    return df.filter(alive | F.col(flag).isNull() if null_is_live else alive)


def add_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Literal columns; a `(None, type)` pair gives a typed null."""
    out = {}
    for name, value in values.items():
        typed_null = isinstance(value, tuple) and value[0] is None
        out[name] = F.lit(None).cast(value[1]) if typed_null else F.lit(value)
    return df.withColumns(out)


def set_when(df: DataFrame, condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """Assign columns on rows that meet the condition; null counts as not met."""
    return df.withColumns({name: F.when(condition, value).otherwise(F.col(name))
                           for name, value in assignments.items()})


def apply_steps(df: DataFrame, names: Iterable[str], registry: Mapping[str, Step]) -> DataFrame:
    """Chain named steps from a registry, in the order named."""
    for name in names:
        if name not in registry:
            raise KeyError(f"unknown step {name!r}; known: {sorted(registry)}")
        df = df.transform(registry[name])
    return df
