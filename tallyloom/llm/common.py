"""Column helpers and distributed prefix sums shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The six white-space characters that separate words: tab to carriage return, and the space.
SPACES = "\t\n\x0b\x0c\r "


BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of at most BATCH_ROWS rows and about BATCH_BYTES bytes, one row at least, however long the texts.

    Spark's default of 10,000 documents costs each worker ten times as much.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that `df` does not use, whatever columns its owner added."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name in taken:
        name = f"_{name}"
    return name


def free_prefix(df: DataFrame, stem: str) -> str:
    """A prefix with which no column of `df` begins."""
    taken = [c.lower() for c in df.columns]
    prefix = f"_{stem}_"
    while any(c.startswith(prefix) for c in taken):
        prefix = f"_{prefix}"
    return prefix


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_of(text: str | Column) -> Column:
    """Maximal runs of characters other than SPACES; none for null."""
    plain = F.translate(text_or_empty(text), SPACES, " " * len(SPACES))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def word_count(text: str | Column) -> Column:
    """Number of words, without building them: blanks that a word follows, one blank put in front."""
    spaced = F.concat(F.lit(" "), F.translate(text_or_empty(text), SPACES, " " * len(SPACES)))
    return F.length(spaced) - F.length(F.regexp_replace(spaced, " (?=[^ ])", ""))


def uniform_key(seed: int, *columns: str | Column) -> Column:
    """48 random bits that depend on the values alone, so a rerun or a retried task draws the same.

    MD5 rather than Spark's own hashes, so that plain SQL elsewhere can repeat the draw.
    """
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("null")) for c in columns]
    digest = F.md5(F.concat_ws("/", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


KEY_BITS = 48
COPIES_AT_ONCE = 10_000


def each_copy(df: DataFrame, n: str, out: str) -> DataFrame:
    """`df` with a row for each of the `n` rows that one of its rows stands for, numbered from 0 in `out`.

    Rows are dealt out between two steps of COPIES_AT_ONCE each, so that one repeated a hundred million times is no
    array of that size and not the work of one task.
    """
    start = free_name(df, "from")
    steps = df.withColumn(start, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(COPIES_AT_ONCE).cast("long"))))
    until = F.least(F.col(start) + COPIES_AT_ONCE, F.col(n)) - 1
    return steps.repartition(*steps.columns).withColumn(out, F.explode(F.sequence(F.col(start), until))).drop(start)


def slices_for(rows: int) -> int:
    """Slices per group: as many as the rows of each, so neither a slice nor the list of slices grows large."""
    return max(1, int(rows**0.5))


def equal_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    """Join condition in which null equals null."""
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right, strict=True)])


def prefix_sums(df: DataFrame, group: Sequence[str], key: str, ties: Sequence[str], values: dict[str, str],
                slices: int) -> DataFrame:
    """Adds for each `values` item (new column: value column) the sum over earlier rows of the group.

    Order is `key` (a `uniform_key`), then `ties`.  Equal widths of a uniform key hold about equally many
    rows, so a group is cut into `slices` ranges by arithmetic alone: no sampling, the same cut on every
    run, and a group with a third of all rows spans all its slices.  Slice totals (a row per group and
    slice) are summed first; only then is each slice sorted, by itself.
    """
    part = free_name(df, "slice")
    # shiftright keeps the product inside 63 bits: 24 bits of the key times at most 2^31 slices
    cut = df.withColumn(part, F.shiftright(F.shiftright(F.col(key), KEY_BITS - 30) * F.lit(slices), 30))
    sums = cut.groupBy(*group, part).agg(*[F.sum(v).alias(f"{c}__sum") for c, v in values.items()])
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    keys = [*group, part]
    starts = sums.select(*[F.col(k).alias(f"{k}__at") for k in keys],
                         *[F.coalesce(F.sum(f"{c}__sum").over(before), F.lit(0)).alias(f"{c}__start") for c in values])
    inside = Window.partitionBy(*keys).orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    joined = cut.join(starts, equal_keys(keys, [f"{k}__at" for k in keys]), "left")
    return joined.select(*df.columns, *[
        (F.col(f"{c}__start") + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(c) for c, v in values.items()])
