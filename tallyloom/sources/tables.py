"""Writing and publishing tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.operators.merge import diff_feed
from tallyloom.operators.quality import Gate
from tallyloom.sources import retention
from tallyloom.sources.keyed import BUCKET_ROWS, KeyedTable

# Between a keyed table's root and its version in a ledger row's path.
KEYED = "@version="
VERSION_SCHEMA = "name string, version bigint, path string, n_rows bigint, published_at timestamp"


def write_partitions(df: DataFrame, path: str, parts: Sequence[str], files: int | None = None) -> None:
    """Overwrite only the partitions present in the frame.

    Rows are rebalanced by partition, so a partition gets few files and a huge one is spread over
    several tasks; `files` asks for a fixed number of tasks instead.
    """
    shaped = df.repartition(files) if files and files > 0 else df.hint("rebalance", *[F.col(p) for p in parts])
    (shaped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(path))


def insert_partitions(df: DataFrame, table: str) -> None:
    """The same for a catalog table partitioned already; columns go by position, as in INSERT."""
    df.sparkSession.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    df.select(*df.sparkSession.table(table).columns).write.mode("overwrite").insertInto(table)


def ctas(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Create (or replace) a catalog table from a query, at `path` if one is given."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def refresh(df: DataFrame, path: str) -> None:
    """Full refresh; the frame must not read from `path`."""
    df.write.mode("overwrite").parquet(path)


def refresh_slice(df: DataFrame, path: str, slice_cols: Sequence[str],
                  slices: Sequence[Sequence] = ()) -> None:
    """Replace the year/term slices present in the frame, empty the other named `slices`, leave the rest.

    `slices` are the values (in the order of `slice_cols`) that the refresh covers; one that has no rows any
    more loses its stale ones.
    """
    write_partitions(df, path, slice_cols)
    if slices:
        held = df.select(*[F.col(c).cast("string") for c in slice_cols]).distinct()
        asked = df.sparkSession.createDataFrame([tuple(str(v) for v in s) for s in slices],
                                                ", ".join(f"`{c}` string" for c in slice_cols))
        plain = df.drop(*slice_cols).limit(0)
        for gone in asked.join(held, list(slice_cols), "left_anti").collect():  # as many as the caller named
            folder = "/".join(f"{c}={gone[c]}" for c in slice_cols)
            plain.write.mode("overwrite").parquet(f"{path}/{folder}")


def append(df: DataFrame, path: str, parts: Sequence[str] = ()) -> None:
    """Add the rows, those of every slice (`parts`) in one job."""
    shaped = df.hint("rebalance", *[F.col(p) for p in parts]) if parts else df
    shaped.write.mode("append").partitionBy(*parts).parquet(path)


class Published:
    """Named tables as numbered versions under a root folder.

    A version is written whole, checked, and then announced by one appended ledger row; readers
    take the newest announced version.  A failed write announces nothing.  Names that are upserted become
    keyed tables (`sources.keyed`): a version of theirs shares the files of the buckets it did not touch.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.ledger = f"{self.root}/_versions"

    def _versions(self, name: str):
        try:
            rows = self.spark.read.schema(VERSION_SCHEMA).parquet(self.ledger)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        newest = rows.filter(F.col("name") == name).orderBy(F.desc("version")).first()
        return None if newest is None or newest["path"] is None else newest

    def exists(self, name: str) -> bool:
        return self._versions(name) is not None

    def read(self, name: str) -> DataFrame:
        newest = self._versions(name)
        if newest is None:  # never announced, or retired
            raise LookupError(f"{name} has not been published under {self.root}")
        root, keyed, version = newest["path"].rpartition(KEYED)
        if keyed:
            return KeyedTable(self.spark, root, []).read(int(version))
        return self.spark.read.parquet(newest["path"])

    def publish(self, df: DataFrame, name: str, published_at: dt.datetime, min_rows: int = 1,
                max_rows: int | None = None) -> Gate:
        """Write the next version and announce it if the gate passes.

        Rows are counted on the written files, which reads their footers, not the query again.
        """
        # a path of its own for every attempt: two writers never meet, the ledger row decides
        path = f"{self.root}/{name}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        rows = self.spark.read.parquet(path).count()
        if rows == 0:
            return Gate(False, 0, "nothing to do")
        if rows < min_rows:
            return Gate(False, rows, f"fewer than {min_rows} rows")
        if max_rows is not None and rows > max_rows:
            return Gate(False, rows, f"more than {max_rows} rows")
        self._announce(name, path, rows, published_at)
        return Gate(True, rows, "ok")

    def _announce(self, name: str, path: str | None, rows: int, published_at: dt.datetime) -> None:
        self._announce_all([(name, path, rows)], published_at)

    def _announce_all(self, entries: Sequence[tuple[str, str | None, int]], published_at: dt.datetime) -> None:
        """Several names at once: one ledger file, so readers see all of them change or none.  A path of None retires the name."""
        names = [name for name, _, _ in entries]
        try:
            seen = self.spark.read.schema(VERSION_SCHEMA).parquet(self.ledger).filter(F.col("name").isin(names))
            last = {r["name"]: r["version"] for r in seen.groupBy("name").agg(F.max("version").alias("version")).collect()}
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            last = {}
        made = [(name, last.get(name, 0) + 1, path, rows, published_at) for name, path, rows in entries]
        self.spark.createDataFrame(made, VERSION_SCHEMA).coalesce(1).write.mode("append").parquet(self.ledger)

    def retire(self, name: str, at: dt.datetime) -> None:
        """The name is gone for readers; its files stay for versions and names that share them."""
        self._announce(name, None, 0, at)

    def sweep(self, before: dt.datetime, keep: int = 1) -> list[str]:
        """Remove version folders last changed before `before` that no name needs; returns them, below the root.

        Needed are the newest `keep` versions of every name that is not retired.  Files that several names share stay while
        one of them needs them; what a refused or failed write left goes; buckets that an older version shares with a needed one stay.
        """
        back = Window.partitionBy("name").orderBy(F.desc("version"))
        newest = F.first("path").over(back.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        try:
            ledger = self.spark.read.schema(VERSION_SCHEMA).parquet(self.ledger)
            ranked = ledger.select("path", F.row_number().over(back).alias("nth"), newest.alias("newest"))
            needed = [r["path"] for r in ranked.where(F.col("newest").isNotNull() & (F.col("nth") <= keep)).collect() if r["path"]]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            needed = []  # nothing was ever announced
        live, versions = set(), {}
        for path in needed:
            root, keyed, version = path.rpartition(KEYED)
            if keyed:
                versions.setdefault(root, set()).add(int(version))
            else:
                live.add(path)
        gone = []
        for name, _ in retention.subfolders(self.root):
            if name.startswith("_"):
                continue
            folder = f"{self.root}/{name}"
            here = {p.rpartition("/")[2] for p in live if p.rpartition("/")[0] == folder}
            gone += [f"{name}/{g}" for g in retention.sweep(folder, here | {"keyed"}, before)]
            table = f"{folder}/keyed"
            gone += [f"{name}/keyed/{g}" for g in KeyedTable(self.spark, table, []).sweep(before, versions.get(table, ()))]
        return gone

    def roll_forward(self, name: str, now: DataFrame, keys: Sequence[str], watch: Sequence[str], published_at: dt.datetime,
                     send: Callable[[DataFrame], None] | None = None) -> DataFrame:
        """Send what is new or changed since the last snapshot, back it up as `<name>_feed` and keep the snapshot as `<name>_before`.

        Both names change by one ledger entry, after `send`: a run that fails before it leaves the old snapshot, so the next one
        finds the same differences again, and a second run on the same snapshot finds none.  The snapshot is written first and
        compared as written, so a source that changes meanwhile cannot part the two.  Returns the rows sent, with `change`.
        """
        backup, before = (f"{self.root}/{name}_{part}/{uuid.uuid4().hex}" for part in ("feed", "before"))
        now.write.parquet(before)
        kept = self.spark.read.schema(now.schema).parquet(before)
        old = self.read(f"{name}_before") if self.exists(f"{name}_before") else kept.limit(0)
        diff_feed(kept, old, keys, watch).rows.write.parquet(backup)
        sent = self.spark.read.parquet(backup)
        if send is not None:
            send(sent)
        self._announce_all([(f"{name}_feed", backup, sent.count()), (f"{name}_before", before, kept.count())], published_at)
        return sent

    def upsert(self, df: DataFrame, name: str, keys: Sequence[str], published_at: dt.datetime, bucket_rows: int = BUCKET_ROWS) -> Gate:
        """Publish the current version with rows of `df` replaced or added by key; only the buckets they fall in are rewritten.

        A name published whole before becomes a keyed table first, which rewrites it once; a retired one begins anew.
        """
        newest = self._versions(name)
        root = f"{self.root}/{name}/keyed"
        table = KeyedTable(self.spark, root, keys, bucket_rows)
        if newest is None and table.version().version:
            table.replace(df.limit(0), published_at)
        elif newest is not None and not newest["path"].startswith(root + KEYED):
            table.replace(self.read(name), published_at)
        made = table.upsert(df, published_at)
        if made.n_rows == 0:
            return Gate(False, 0, "nothing to do")
        self._announce(name, f"{root}{KEYED}{made.version}", made.n_rows, published_at)
        return Gate(True, made.n_rows, "ok")

    def publish_dated(self, df: DataFrame, name: str, day: str, published_at: dt.datetime,
                      min_rows: int = 1) -> Gate:
        """Publish a dated result and, once it is seen to hold rows, its files under the stable name; the dated name is then gone.

        The files are written once; that the stable name takes them and the dated one loses them is one ledger entry.
        """
        stamped = f"{name}_{day.replace('-', '')}"
        dated = self.publish(df, stamped, published_at, min_rows)
        if dated.passed:
            self._announce_all([(name, self._versions(stamped)["path"], dated.rows), (stamped, None, 0)], published_at)
        return dated


FILE_LEDGER = ("file string, create_time timestamp, day string, hr string, flow_name string, "
               "flow_id string, status string")
DATE_LEDGER = ("flow_name string, flow_id string, day string, hr string, log_time timestamp, "
               "create_time timestamp")
RESULT_LEDGER = "flow_name string, flow_id string, table_name string, status string, create_time timestamp"


def file_ledger_rows(files: DataFrame, flow_name: str, flow_id: str, at: dt.datetime,
                     status: str = "INSERT") -> DataFrame:
    """Ledger rows for files taken (file, day, hr)."""
    return files.select("file", F.lit(at).alias("create_time"), "day", "hr",
                        F.lit(flow_name).alias("flow_name"), F.lit(flow_id).alias("flow_id"),
                        F.lit(status).alias("status"))


def date_ledger_rows(hours: DataFrame, flow_name: str, flow_id: str, at: dt.datetime) -> DataFrame:
    """Ledger rows for the newest event time per hour (day, hr, max_ts)."""
    return hours.select(F.lit(flow_name).alias("flow_name"), F.lit(flow_id).alias("flow_id"),
                        "day", "hr", F.col("max_ts").alias("log_time"), F.lit(at).alias("create_time"))


def write_ledger(rows: DataFrame, path: str) -> None:
    """Append progress rows, in few files however many rows there are."""
    rows.hint("rebalance").write.mode("append").parquet(path)
