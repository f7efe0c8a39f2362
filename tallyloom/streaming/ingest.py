"""Structured Streaming ingestion (M1-M9): the batch functions inside micro-batches."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallyloom.scale import fresh_path
from tallyloom.sources.events import (ENVELOPE, align_to, checked_payloads, flat_columns, fold_shards, parse_events,
                                      parse_lines)
from tallyloom.sources.tables import RESULT_LEDGER, write_ledger, write_partitions


@dataclass(frozen=True)
class Target:
    """Where rows of one folded (database, table) go and in which columns."""

    database: str
    table: str
    schema: StructType
    path: str


def stream_lines(spark: SparkSession, path: str, max_files: int = 500,
                 max_bytes: str | None = None, latest_first: bool = False,
                 max_age: str = "36500d") -> DataFrame:
    """Lines of files as they arrive, `max_files` per micro-batch.

    Files already seen are logged in the checkpoint, so a late file in an old hour directory is
    still taken.  `max_age` (a century: none) is there for sources that want old files forgotten.
    """
    reader = (spark.readStream.format("text").option("recursiveFileLookup", "true")
              .option("latestFirst", str(latest_first).lower()).option("maxFileAge", max_age))
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    else:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path).select("value", F.col("_metadata.file_path").alias("file"))


def stream_events(spark: SparkSession, path: str, schema: str = ENVELOPE,
                  max_files: int = 500) -> DataFrame:
    """Well-formed events of arriving files (the fan-out below also keeps the bad lines)."""
    return parse_events(stream_lines(spark, path, max_files), schema).good


def write_batch(lines: DataFrame, batch_id: int, targets: list[Target], ledger: str,
                quarantine: str, flow_name: str = "ingest", workers: int = 4, run_id: str = "",
                now: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.timezone.utc)) -> None:
    """Fan one micro-batch out to its tables.

    The lines are read and parsed once and written to the shared folder by table, so each table then reads its own
    rows only, and a lost executor costs no second parse.  A replay writes the same `(dt, flowid)` partitions again: the
    flow id is `run_id` (that of the checkpoint, see `ingest`) and the batch id.  Every line ends in a table or in
    quarantine with its `reason`: broken lines, events of tables without a target, payloads that do not fit their table.
    One table's failure does not stop the others; each leaves a ledger row and the batch fails
    at the end if any did.
    """
    spark = lines.sparkSession
    flow_id = f"{run_id}{batch_id:014d}"
    staged = staged_by_table(lines, targets)
    present = {r["_target"] for r in staged.select("_target").distinct().collect()}  # targets at most, and one more

    def rejects(bad: DataFrame, origin: str) -> None:
        rows = bad.select(*lines.columns, "reason", F.lit(flow_id).alias("flowid"), F.lit(origin).alias("origin"))
        write_partitions(rows, quarantine, ["flowid", "origin"])

    def one(place: int) -> tuple[str, str]:
        target = targets[place]
        try:
            if place in present:
                seen = Observation()
                checked = checked_payloads(staged.filter(F.col("_target") == place), target.schema)
                flat = flat_columns(checked.observe(seen, F.count("reason").alias("unfit")), flow_id)
                columns = StructType([*target.schema, *[f for f in flat.schema if f.name not in target.schema.names]])
                write_partitions(align_to(flat, columns).df, target.path, ["dt", "flowid"])
                if seen.get["unfit"]:
                    rejects(checked.filter("reason is not null"), f"{target.database}.{target.table}")
            return target.table, "OK"
        except Exception as error:
            return target.table, f"FAILED {type(error).__name__}"

    if NO_TARGET in present:
        rejects(staged.filter(F.col("_target") == NO_TARGET), "lines")
    with ThreadPoolExecutor(max_workers=workers) as pool:
        results = list(pool.map(one, range(len(targets))))
    rows = [(flow_name, flow_id, table, status.split()[0], now()) for table, status in results]
    write_ledger(spark.createDataFrame(rows, RESULT_LEDGER), ledger)
    failed = [f"{table}: {status}" for table, status in results if status != "OK"]
    if failed:
        raise RuntimeError("tables failed in batch " + flow_id + ": " + "; ".join(failed))


NO_TARGET = -1


def staged_by_table(lines: DataFrame, targets: list[Target]) -> DataFrame:
    """The parsed lines, written by `_target`, the number of their table in the list; `NO_TARGET` for those with a `reason`.

    One scan and one parse of the lines, however many tables there are.
    """
    parsed = fold_shards(parse_lines(lines))
    names = F.create_map(*[F.lit(x) for k, t in enumerate(targets) for x in (f"{t.database}.{t.table}", k)])
    place = F.coalesce(F.element_at(names, F.concat_ws(".", "database", "table")), F.lit(NO_TARGET))
    broken = F.when(F.col("_broken"), NO_TARGET).otherwise(place).cast("int")
    reason = F.when(F.col("_broken"), "not an event").when(place == NO_TARGET, "no target for this table")
    path = fresh_path(lines.sparkSession, "batch")
    routed = parsed.withColumns({"reason": reason, "_target": broken})
    routed.hint("rebalance", F.col("_target")).write.partitionBy("_target").parquet(path)
    return lines.sparkSession.read.schema(routed.schema).parquet(path)


def run_token(spark: SparkSession, checkpoint: str) -> str:
    """The token of the runs of a checkpoint, kept inside it: a replay finds the one it left, a checkpoint made anew at the same path gets another."""
    path = f"{checkpoint.rstrip('/')}/_run"
    for _ in range(2):
        try:
            return spark.read.text(path).first()[0]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            spark.createDataFrame([(uuid.uuid4().hex[:16],)], "value string").coalesce(1).write.text(path)
    raise RuntimeError(f"no token can be kept in {path}")


def ingest(spark: SparkSession, path: str, targets: list[Target], root: str, checkpoint: str,
           max_files: int = 500, flow_name: str = "ingest") -> StreamingQuery:
    """Take every file that has arrived, in micro-batches, and stop.

    A checkpoint counts its batches from 0, so its token (`run_token`) goes into the flow ids: a checkpoint made anew, at
    another path or the same, does not overwrite what an earlier one wrote, and a replay of either writes its own
    partitions again.  A run whose checkpoint has been cleared under it stops before it writes another batch.
    """
    lines = stream_lines(spark, path, max_files)
    token = run_token(spark, checkpoint)

    def batch(df: DataFrame, batch_id: int) -> None:
        if run_token(spark, checkpoint) != token:
            raise RuntimeError(f"{checkpoint} was made anew while a run used it")
        write_batch(df, batch_id, targets, f"{root}/_results", f"{root}/_quarantine", flow_name, run_id=f"{token}-")

    return (lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def hourly_progress(df: DataFrame, ts: str = "event_time", lateness: str = "2 hours") -> DataFrame:
    """Newest event time per hour; an hour is final once the watermark has passed it."""
    return (df.withWatermark(ts, lateness).groupBy(F.window(ts, "1 hour").alias("w"))
            .agg(F.max(ts).alias("max_ts"), F.count("*").alias("n_events"))
            .select(F.date_format("w.start", "yyyy-MM-dd").alias("day"),
                    F.date_format("w.start", "HH").alias("hr"), "max_ts", "n_events"))


def completed_days(progress: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Days whose end the watermark (newest event minus lateness) has passed."""
    mark = progress.select((F.max("max_ts") - F.expr(f"interval {lateness}")).alias("m")).scalar()
    day_end = F.to_timestamp("day", "yyyy-MM-dd") + F.expr("interval 1 day")
    return progress.select("day").distinct().filter(day_end <= mark)


def stream_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over what has arrived into a Parquet folder and wait."""
    query = (df.writeStream.format("parquet").outputMode(mode).option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def stream_upsert(df: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run `merge` once per micro-batch (a keyed upsert, say) over what has arrived."""
    query = (df.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()

