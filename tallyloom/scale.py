"""Size checks, lineage cuts and the range split that keeps one hot group off one task.

Spark already combines sums and counts before the shuffle, splits skewed joins, and trims
`row_number() <= n` before the shuffle.  What it cannot split is a window over one huge group.
`range_slices` does that: rows are range-partitioned by (group, order), so a group that holds a
third of the table spans many slices; per-slice totals (one row per group and slice) then carry
the running state from slice to slice.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# An aggregated join side below this need not be written first.
ONE_TASK_BYTES = 256 * 1024 * 1024
# A window's group of more rows than this, counted and not estimated, is split.
HOT_ROWS = 2_000_000
# Rows handled by one slice of a split group.
SLICE_ROWS = 500_000


# Rows in memory against their Parquet files, with room for columns that lookups add.
GROWTH = 4


def estimated_bytes(df: DataFrame) -> int:
    """Size of a plan's output, judged without running a job.

    Catalyst multiplies the sizes of joined tables, which no lookup on a unique key comes near, so
    the size of everything the plan reads, grown by a factor, stands in where it is the smaller.
    Only the choice between two exact ways hangs on it, never a broadcast.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    read = sum(int(str(leaves.apply(n).stats().sizeInBytes())) for n in range(leaves.size()))
    return min(int(str(plan.stats().sizeInBytes())), GROWTH * read)


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows in the largest group: a column-pruned count, combined before its shuffle."""
    if not keys:
        return df.count()
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def has_hot_group(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a window over `keys` would put more rows into one task than a task should hold.

    The rows are counted: estimates miss what generators and joins multiply.
    """
    return largest_group(df, keys) > HOT_ROWS


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables, as the session names it."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):  # one machine; local-cluster[...] has several workers
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyloom-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: lineage cut, and its size known to the planner."""
    path = fresh_path(df.sparkSession, "side")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_side(df: DataFrame) -> DataFrame:
    """An aggregated frame about to be joined to a large one.

    Adaptive execution splits a skewed partition only where both join inputs come straight from a
    shuffle, which an aggregate does not.  A possibly large side is therefore written first: read
    back it is either broadcast, its true size being known, or shuffled plainly.
    """
    return written(df) if estimated_bytes(df) > ONE_TASK_BYTES or _multiplies(df) else df


def _multiplies(df: DataFrame) -> bool:
    """Whether a generator makes rows in the plan, so that sizes say little."""
    return "Generate " in df._jdf.queryExecution().optimizedPlan().toString()


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "left") -> DataFrame:
    """Join on `keys` with null equal to null, keeping the left copy of the keys.

    `right` is aggregated per key.
    """
    renamed = join_side(right).select(*[F.col(k).alias(f"__{k}") if k in keys else F.col(k)
                             for k in right.columns])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    joined = left.join(renamed, on, how)
    return joined.drop(*[f"__{k}" for k in keys])


def range_slices(df: DataFrame, part: Sequence[str], order: Sequence[Column],
                 slices: int | None = None, out: str = "_slice") -> DataFrame:
    """Number the range partitions of (part, order); the result is checkpointed.

    Range bounds come from a sample, so a recomputed plan could draw other bounds; the checkpoint
    fixes them for every later use.  `order` must be total for rows of equal order to be split.
    """
    if slices is None:
        slices = max(2, df.count() // SLICE_ROWS)
    ranged = df.repartitionByRange(slices, *[F.col(p) for p in part], *order)
    return cut_lineage(ranged.withColumn(out, F.spark_partition_id()))
