"""Keyed tables that grow: rows by key in buckets of bounded size, and versions whose files never change.

A version is a manifest: which folder holds each bucket.  An upsert reads and writes only the buckets its rows fall
in, and announces the new manifest by one ledger row, so readers see the old version or the new one and a failed write
changes nothing.  Buckets are those of linear hashing: their number follows the rows, and when it grows, only the
buckets that new ones split off from are rewritten with the others.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Collection, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.operators.groups import dedupe_keep
from tallyloom.operators.merge import merge_snapshot
from tallyloom.scale import written
from tallyloom.sources import retention

LEDGER = ("version bigint, manifest string, buckets bigint, n_rows bigint, mark timestamp, token string, schema string, "
          "committed_at timestamp")
MANIFEST = "bucket bigint, folder string, n_rows bigint"
# Rows of a bucket on average; the largest hold about twice as many.
BUCKET_ROWS = 2_000_000
# Buckets, at most, of a table whose buckets hold fewer rows than that. Each is a folder that an upsert makes, lists and opens, and Spark lists
# more folders than these by a job with a task for each.
SMALL_BUCKETS = 32


class Version(NamedTuple):
    version: int
    manifest: str | None
    buckets: int
    n_rows: int
    mark: dt.datetime | None
    schema: StructType | None


NONE = Version(0, None, 0, 0, None, None)


class Conflict(RuntimeError):
    """Another writer has announced a version since this one began."""


def bucket_of(hashed: Column, buckets: int) -> Column:
    """The bucket among `buckets`: the hash modulo the next power of two, or modulo half of it where that bucket does not exist yet."""
    half = 1 << (buckets.bit_length() - 1)
    place = F.pmod(hashed, F.lit(2 * half).cast("long"))
    return F.when(place >= buckets, place - half).otherwise(place)


def buckets_for(n_rows: int, bucket_rows: int) -> int:
    """Buckets of `bucket_rows` rows on average; more than `SMALL_BUCKETS` only where they hold `BUCKET_ROWS` at least."""
    return max(1, min(-(-n_rows // bucket_rows), max(SMALL_BUCKETS, n_rows // BUCKET_ROWS)))


class KeyedTable:
    """One table under `root`, unique on `keys`.  One writer at a time; any number of readers.

    Buckets hold `bucket_rows` rows on average while there are few of them (`buckets_for`).
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], bucket_rows: int = BUCKET_ROWS):
        self.spark, self.root, self.keys, self.bucket_rows = spark, root.rstrip("/"), list(keys), bucket_rows

    # --- versions

    def ledger(self) -> DataFrame:
        try:
            return self.spark.read.schema(LEDGER).parquet(f"{self.root}/_ledger")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LEDGER)

    def version(self, number: int | None = None) -> Version:
        """The newest version, or that of a number; `NONE` where there is none yet."""
        rows = self.ledger() if number is None else self.ledger().filter(F.col("version") == number)
        row = rows.orderBy(F.desc("version")).first()
        if row is None:
            if number is not None:
                raise LookupError(f"{self.root} has no version {number}")
            return NONE
        return Version(row["version"], row["manifest"], row["buckets"], row["n_rows"], row["mark"],
                       StructType.fromJson(json.loads(row["schema"])))

    def mark(self) -> dt.datetime | None:
        """Up to where the source has been taken (see `apply_window`)."""
        return self.version().mark

    def _manifest(self, at: Version) -> DataFrame:
        if at.manifest is None:  # no rows
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/_manifests/{at.manifest}")

    def _rows(self, manifest: DataFrame, schema: StructType) -> DataFrame:
        """The rows of the buckets in a manifest.  The driver gets a path per bucket, as a scan's file listing does."""
        paths = [f"{self.root}/data/{r['folder']}/_bucket={r['bucket']}" for r in manifest.select("folder", "bucket").collect()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, number: int | None = None) -> DataFrame:
        at = self.version(number)
        if at.schema is None:
            raise LookupError(f"{self.root} holds no version yet")
        return self._rows(self._manifest(at), at.schema)

    # --- writes

    def _hash(self, df: DataFrame) -> Column:
        """Keys decide; rows with a null key match nothing and are dealt by all their columns."""
        keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])
        return F.when(keyed, F.xxhash64(*self.keys)).otherwise(F.xxhash64(*df.columns))

    def _placed(self, df: DataFrame, buckets: int) -> DataFrame:
        return df.withColumn("_bucket", bucket_of(self._hash(df), buckets))

    def upsert(self, rows: DataFrame, at: dt.datetime, order: Sequence[Column] | None = None, mark: dt.datetime | None = None,
               token: str | None = None) -> Version:
        """Replace or add rows by key, as the next version.

        Among a stored row and a new one of a key the new one stays, or with `order` the one that comes first; without
        `order` a key twice in `rows` is an error.  Rows with a null key are added.  `mark` is stored with the version, so the
        data and how far the source has been taken change together.  A `token` that some version already bears
        changes nothing: a replay is recognised.
        """
        old = self.version()
        if token is not None and not self.ledger().filter(F.col("token") == token).isEmpty():
            return old
        if old.schema is not None:
            rows = rows.select(*old.schema.names)
        schema = old.schema or rows.schema
        staged = written(rows)
        added = staged.count()
        if added == 0:
            return self._announce(old, old.manifest, old.buckets, old.n_rows, mark, token, schema, at)
        buckets = max(old.buckets, buckets_for(old.n_rows + added, self.bucket_rows))
        manifest = self._manifest(old)
        touched = None
        if old.buckets:
            split = self.spark.range(old.buckets, buckets).select(bucket_of(F.col("id"), old.buckets).alias("bucket"))
            touched = written(self._placed(staged, old.buckets).select(F.col("_bucket").alias("bucket")).unionByName(split).distinct())
            before = self._rows(manifest.join(touched, "bucket", "left_semi"), schema)
        else:
            before = staged.limit(0)
        new, held = self._placed(staged, buckets), self._placed(before, buckets)
        if order is None:
            merged = merge_snapshot(held, new, self.keys, delete="keep")
        else:
            merged = dedupe_keep(held.unionByName(new), self.keys, order)
        folder = f"v{old.version + 1:06d}-{uuid.uuid4().hex}"
        data = f"{self.root}/data/{folder}"
        merged.hint("rebalance", F.col("_bucket")).write.partitionBy("_bucket").parquet(data)
        counted = self.spark.read.parquet(data).groupBy(F.col("_bucket").cast("long").alias("bucket")).agg(F.count("*").alias("n_rows"))
        kept = manifest if touched is None else manifest.join(touched, "bucket", "left_anti")
        listed = kept.select("bucket", "folder", "n_rows").unionByName(counted.select("bucket", F.lit(folder).alias("folder"), "n_rows"))
        listed.coalesce(1).write.parquet(f"{self.root}/_manifests/{folder}")
        total = self._manifest(old._replace(manifest=folder)).agg(F.sum("n_rows")).first()[0] or 0
        return self._announce(old, folder, buckets, total, mark, token, schema, at)

    def replace(self, rows: DataFrame, at: dt.datetime, mark: dt.datetime | None = None) -> Version:
        """The next version holds `rows` and nothing else."""
        old = self.version()
        staged = written(rows)
        n_rows = staged.count()
        if n_rows == 0:
            return self._announce(old, None, 0, 0, mark, None, rows.schema, at)
        buckets = buckets_for(n_rows, self.bucket_rows)
        folder = f"v{old.version + 1:06d}-{uuid.uuid4().hex}"
        self._placed(staged, buckets).hint("rebalance", F.col("_bucket")).write.partitionBy("_bucket").parquet(f"{self.root}/data/{folder}")
        counted = self._placed(staged, buckets).groupBy(F.col("_bucket").alias("bucket")).agg(F.count("*").alias("n_rows"))
        counted.select("bucket", F.lit(folder).alias("folder"), "n_rows").coalesce(1).write.parquet(f"{self.root}/_manifests/{folder}")
        return self._announce(old, folder, buckets, n_rows, mark, None, rows.schema, at)

    def sweep(self, before: dt.datetime, versions: Collection[int] = ()) -> list[str]:
        """Remove folders last changed before `before` that neither the newest version nor `versions` hold; the others cannot be read any more."""
        ledger = self.ledger()
        newest = self.version().version
        kept = {r["manifest"] for r in ledger.filter(F.col("version").isin([newest, *versions])).select("manifest").collect() if r["manifest"]}
        if not kept:
            live = set()
        else:  # a folder holds what one version wrote
            listed = self.spark.read.schema(MANIFEST).parquet(*[f"{self.root}/_manifests/{m}" for m in sorted(kept)])
            live = {r["folder"] for r in listed.select("folder").distinct().collect()}
        return retention.sweep(f"{self.root}/data", live, before) + retention.sweep(f"{self.root}/_manifests", kept, before)

    def _announce(self, old: Version, manifest: str | None, buckets: int, n_rows: int, mark: dt.datetime | None, token: str | None,
                  schema: StructType, at: dt.datetime) -> Version:
        newest = self.version().version
        if newest != old.version:
            raise Conflict(f"{self.root} is at version {newest}, this write began at {old.version}")
        mark = old.mark if mark is None else mark
        row = (old.version + 1, manifest, buckets, n_rows, mark, token, schema.json(), at)
        self.spark.createDataFrame([row], LEDGER).coalesce(1).write.mode("append").parquet(f"{self.root}/_ledger")
        return Version(old.version + 1, manifest, buckets, n_rows, mark, schema)


class Applied(NamedTuple):
    """Whether a window was taken, and the table's version after it."""

    taken: bool
    version: Version


def apply_window(table: KeyedTable, source: DataFrame, ts: str, until: dt.datetime, at: dt.datetime, retired: str | None = None,
                 order: Sequence[Column] | None = None) -> Applied:
    """Take the source rows changed in `[mark, until)` into a keyed table, and move its mark to `until` in the same version.

    On a first run all rows before `until` are taken.  A window that ends at or before the mark has been taken: nothing happens, so
    every window counts once, however often it is run.  A run that was left out is made up for by the next, whose window
    begins at the mark.  Of a key changed several times in the window the newest row stays (`order`, by default the newest `ts`); rows
    whose `retired` time has come by `until` are left out.  Rows without a time never fall in a window.
    """
    mark = table.mark()
    if mark is not None and until <= mark:
        return Applied(False, table.version())
    hi = F.lit(until).cast("timestamp")
    rows = source.filter(F.col(ts) < hi)
    if mark is not None:
        rows = rows.filter(F.col(ts) >= F.lit(mark).cast("timestamp"))
    if retired:
        rows = rows.filter(F.col(retired).isNull() | (F.col(retired) > hi))
    newest = dedupe_keep(rows, table.keys, order or [F.desc(ts)])
    return Applied(True, table.upsert(newest, at, mark=until))
