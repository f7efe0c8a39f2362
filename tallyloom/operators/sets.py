"""Unions and snapshot differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.functions.text import changed
from tallyloom.operators.merge import unique_on


def union_layouts(frames: Sequence[DataFrame], schema: StructType | None = None,
                  distinct: bool = True) -> DataFrame:
    """Stack differently shaped frames in one layout, absent columns null."""
    if schema is not None:
        frames = [f.select(*[
            (F.col(c.name) if c.name in f.columns else F.lit(None)).cast(c.dataType).alias(c.name)
            for c in schema]) for f in frames]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out.distinct() if distinct else out


def diff(now: DataFrame, before: DataFrame, keys: Sequence[str], watch: Sequence[str],
         keep_same: bool = False) -> DataFrame:
    """`change` per key: new, changed, removed (or same), with old and new watched values.

    One full outer join of the two snapshots; a key twice in either is an error.  A null and a blank
    value are the same.  Rows of `before` come back as `old_<col>`.
    """
    left = unique_on(now, keys, "the snapshot").select(*keys, *[F.col(c).alias(f"new_{c}") for c in watch], F.lit(True).alias("_now"))
    right = unique_on(before, keys, "the snapshot before").select(*keys, *[F.col(c).alias(f"old_{c}") for c in watch],
                          F.lit(True).alias("_before"))
    both = left.join(right, list(keys), "full_outer")
    differs = F.lit(False)
    for c in watch:
        differs = differs | changed(f"new_{c}", f"old_{c}")
    change = (F.when(F.col("_before").isNull(), "new").when(F.col("_now").isNull(), "removed")
              .when(differs, "changed").otherwise("same"))
    out = both.withColumn("change", change).drop("_now", "_before")
    return out if keep_same else out.filter(F.col("change") != "same")
