"""Change-log files: finding, reading and flattening them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

# One change event per line; `data` stays raw JSON so that every table parses its own columns.
ENVELOPE = "database string, table string, type string, ts bigint, xid bigint, data string"
REQUIRED = ("database", "table", "ts", "data")


@dataclass
class Events:
    good: DataFrame
    bad: DataFrame


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of many files with the file each came from."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.option("recursiveFileLookup", "true").text(paths)
            .select("value", F.col("_metadata.file_path").alias("file")))


def parse_events(lines: DataFrame, schema: str = ENVELOPE, bad: str = "quarantine") -> Events:
    """Parse JSON lines; lines that fail go to `bad`, or abort the job with `bad='abort'`."""
    parsed = parse_lines(lines, schema)
    keep = [c for c in parsed.columns if c not in ("value", "_broken")]
    if bad == "abort":
        alarm = F.raise_error(F.concat(F.lit("bad event line: "), "value"))
        stopped = F.when(F.col("_broken"), alarm).otherwise(F.lit(True))
        return Events(parsed.filter(stopped.cast("boolean")).select(*keep), lines.limit(0))
    return Events(parsed.filter(~F.col("_broken")).select(*keep),
                  parsed.filter("_broken").select(*lines.columns))


def parse_lines(lines: DataFrame, schema: str = ENVELOPE) -> DataFrame:
    """The envelope's columns beside each line and whether the line is `_broken`.

    The parsed record is unnested by a generator: filters on its columns stay above it, so each
    line is parsed once, where filters on a parsed struct would be pushed down and parse it again.
    """
    record = F.array(F.from_json("value", schema))
    parsed = lines.select(*lines.columns, F.inline_outer(record))
    return parsed.withColumn("_broken", F.greatest(*[F.col(c).isNull() for c in REQUIRED]))


def read_events(spark: SparkSession, paths: str | Sequence[str], schema: str = ENVELOPE,
                bad: str = "quarantine") -> Events:
    return parse_events(read_lines(spark, paths), schema, bad)


# Directory layout `<root>/<topic>/yyyy/MM/dd/HH/<file>`, or with a name before each part as Spark writes it (`year=yyyy/...`).
_HOUR_PATH = r"/(?:\w+=)?(\d{4})/(?:\w+=)?(\d{2})/(?:\w+=)?(\d{2})/(?:\w+=)?(\d{2})/[^/]+$"
EVERY_HOUR = "*/*/*/*"


def with_path_hour(df: DataFrame, file: str = "file") -> DataFrame:
    """Day and hour parsed back from the file path."""
    parts = [F.regexp_extract(file, _HOUR_PATH, n) for n in range(1, 5)]
    known = F.col(file).rlike(_HOUR_PATH)
    return df.withColumns({"day": F.when(known, F.concat_ws("-", *parts[:3])),
                           "hr": F.when(known, parts[3])})


def list_files(spark: SparkSession, root: str, topic: str, hours: str = EVERY_HOUR) -> DataFrame:
    """Files under the hour directories; only names and times are read, not contents.

    `hours` is a glob below the topic, by default all of them; see `hours_glob`.  No directory found
    gives an empty frame.
    """
    reader = spark.read.format("binaryFile")
    try:
        files = reader.option("recursiveFileLookup", "true").load(f"{root}/{topic}/{hours}/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "path string, modificationTime timestamp, length bigint")
    return with_path_hour(files.select(F.col("path").alias("file"), "modificationTime", "length"))


def recorded_hours(ledger: DataFrame, n: int = 2) -> list[tuple[str, str]]:
    """The newest `n` recorded hours, newest first."""
    hours = ledger.select("day", "hr").distinct().orderBy(F.desc("day"), F.desc("hr")).limit(n)
    return [(r["day"], r["hr"]) for r in hours.collect()]  # n rows


def hours_glob(ledger: DataFrame, max_hours: int = 24, rescan: int = 2, root: str | None = None, topic: str | None = None,
               history: bool = False, names: Sequence[str] = ("", "", "", "")) -> str:
    """The hour directories worth listing: those to rescan and the `max_hours` after the newest.

    With `root` and `topic` these are listed, and if they hold no file that the ledger lacks, all hours are worth
    listing: a pause may have been longer.  Without them the glob cannot see past a pause of more than `max_hours`.
    `history` lists all hours, as long as older ones are still to be taken (`history_open`).  `names` stand before the
    four parts of a directory (`year=` and so on), if they do.
    """
    again = recorded_hours(ledger, rescan)
    if not again or history:
        return EVERY_HOUR
    newest = dt.datetime.strptime(" ".join(again[0]), "%Y-%m-%d %H")
    ahead = [newest + dt.timedelta(hours=n) for n in range(1, max_hours + 1)]
    stamps = [f"{d}-{h}" for d, h in again] + [a.strftime("%Y-%m-%d-%H") for a in ahead]
    folders = ["/".join(n + part for n, part in zip(names, stamp.split("-"), strict=True)) for stamp in stamps]
    window = "{" + ",".join(folders) + "}"
    if root is None or topic is None:
        return window
    unseen = list_files(ledger.sparkSession, root, topic, window).join(ledger.select("file"), "file", "left_anti")
    return EVERY_HOUR if unseen.isEmpty() else window


def hour_stamp(day: Column | str, hr: Column | str) -> Column:
    return F.try_to_timestamp(F.concat_ws(" ", day, hr), F.lit("yyyy-MM-dd HH"))


def select_new_files(candidates: DataFrame, ledger: DataFrame, max_hours: int = 24,
                     max_files: int = 500, first_files: int = 100, rescan: int = 2, history: bool = True) -> DataFrame:
    """Files to take next.

    Rescans the newest `rescan` recorded hours for late files, then walks forward hour by hour
    up to `max_hours` past the newest one, or, after a longer pause, from the next hour that has files; at most
    `max_files`, oldest hour first, the others next time.  With an empty
    ledger the newest `first_files` files start the flow; what was there before them is history.  While there is room among
    the `max_files`, history follows, oldest hour first, until every listed file has been taken once (`history`).
    """
    hours = recorded_hours(ledger, rescan)
    if not hours:
        return candidates.orderBy(F.desc("modificationTime"), "file").limit(first_files)
    newest = hour_stamp(F.lit(hours[0][0]), F.lit(hours[0][1]))
    at = hour_stamp(F.col("day"), F.col("hr"))
    again = F.struct("day", "hr").isin(*[F.struct(F.lit(d), F.lit(h)) for d, h in hours])
    span = F.expr(f"interval {int(max_hours)} hours")
    resumed = candidates.filter(at > newest).select(F.min(at)).scalar()  # after a pause, the hour that ends it
    until = F.when(resumed > newest + span, resumed + span - F.expr("interval 1 hour")).otherwise(newest + span)
    ahead = (at > newest) & (at <= until)
    older = F.lit(history) & ~again & (at < newest)
    wanted = candidates.filter(again | ahead | older).withColumn("_later", older)
    unseen = wanted.join(ledger.filter(again | ahead | older).select("file"), "file", "left_anti")
    return unseen.orderBy("_later", "day", "hr", "file").limit(max_files).select(*candidates.columns)


def hour_coverage(candidates: DataFrame, ledger: DataFrame) -> DataFrame:
    """(day, hr, n_files, n_taken) of every hour with listed files."""
    taken = ledger.select("file").distinct().withColumn("_taken", F.lit(True))
    return candidates.join(taken, "file", "left").groupBy("day", "hr").agg(
        F.count("*").alias("n_files"), F.count("_taken").alias("n_taken"))


def covered_intervals(coverage: DataFrame) -> DataFrame:
    """Runs of hours whose files have all been taken: (from_hour, to_hour, n_hours, n_files), hours without files between them included.

    One row per hour goes through the window, whatever the number of files.
    """
    at = coverage.filter("day is not null").withColumn("_at", hour_stamp("day", "hr"))
    whole = F.col("n_taken") >= F.col("n_files")
    gaps = F.sum((~whole).cast("int")).over(Window.orderBy("_at"))  # how many open hours come before
    return (at.withColumn("_run", gaps).filter(whole).groupBy("_run")
            .agg(F.min("_at").alias("from_hour"), F.max("_at").alias("to_hour"), F.count("*").alias("n_hours"), F.sum("n_files").alias("n_files"))
            .drop("_run"))


def history_open(coverage: DataFrame) -> bool:
    """Whether files of hours before the newest taken one are still to be taken."""
    newest = coverage.filter("n_taken > 0").select(F.max(F.struct("day", "hr"))).scalar()
    return not coverage.filter((F.col("n_taken") < F.col("n_files")) & (F.struct("day", "hr") < newest)).isEmpty()


def fold_shards(df: DataFrame) -> DataFrame:
    """Shard numbers off the names; the originals stay as `etl_db` and `etl_table`."""
    return (df.withColumns({"etl_db": F.col("database"), "etl_table": F.col("table")})
            .withColumns({"database": F.regexp_replace("database", r"\d+$", ""),
                          "table": F.regexp_replace("table", r"_\d+$", "")}))


def flatten_events(df: DataFrame, schema: StructType | str, batch_id: str) -> Events:
    """Payload columns plus event type, time, transaction, batch id and date; `bad` holds the events whose payload does not fit, with the `reason`."""
    rest = [c for c in df.columns if c != "reason"]
    checked = checked_payloads(df, schema)
    return Events(flat_columns(checked, batch_id), checked.filter("reason is not null").select(*rest, "reason"))


def checked_payloads(df: DataFrame, schema: StructType | str) -> DataFrame:
    """The events with their payload in `_d` and the `reason` why it does not fit, or null.

    Every payload is read once as typed columns and once as texts, by a generator: what is built on them does not
    read it again.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    both = F.struct(F.from_json("data", schema).alias("_d"), _as_text("data", schema).alias("_given"))
    read = df.select(*[c for c in df.columns if c != "reason"], F.inline(F.array(both)))
    return read.withColumn("reason", _fault("data", schema, F.col("_d"), F.col("_given"))).drop("_given")


def flat_columns(checked: DataFrame, batch_id: str) -> DataFrame:
    """Rows of a table from the `checked_payloads` that fit."""
    extra = [c for c in ("etl_db", "etl_table") if c in checked.columns]
    flat = checked.filter("reason is null").select(
        "_d.*", F.col("type").alias("etl_type"), F.timestamp_seconds("ts").alias("etl_time"),
        F.col("xid").alias("etl_xid"), *extra)
    return flat.withColumns({"flowid": F.lit(batch_id), "dt": F.to_date("etl_time")})


def _as_text(data: str, schema: StructType) -> Column:
    return F.from_json(data, StructType([StructField(f.name, StringType()) for f in schema]))


def _fault(data: str, schema: StructType, parsed: Column, given: Column) -> Column:
    """Why a payload does not fit its table, or null: not an object, or a value that its column's type cannot hold.

    A value counts as lost if the payload gives it (not as null) and reading it as the column's type makes it null.
    """
    lost = [F.when(given[f.name].isNotNull() & parsed[f.name].isNull(), F.lit(f.name)) for f in schema]
    names = F.concat_ws(",", *lost)
    return F.when(F.get_json_object(data, "$").isNull() | ~F.ltrim(F.col(data)).startswith("{"), F.lit("payload is not an object")) \
        .when(names != "", F.concat(F.lit("payload does not fit: "), names))


@dataclass
class Aligned:
    df: DataFrame
    missing: list[str]
    extra: list[str]


def _filler(data_type: DataType) -> Column:
    """Blank for text, null for anything else."""
    return F.lit("") if isinstance(data_type, StringType) else F.lit(None).cast(data_type)


def align_to(df: DataFrame, target: StructType, ignore: Iterable[str] = ()) -> Aligned:
    """The batch in the columns, types and order of the target; names compare without case."""
    have = {c.lower(): c for c in df.columns}
    columns: list[Column] = []
    missing: list[str] = []
    for field in target:
        source = have.get(field.name.lower())
        if source is None:
            missing.append(field.name)
            columns.append(_filler(field.dataType).alias(field.name))
        else:
            columns.append(F.col(source).cast(field.dataType).alias(field.name))
    wanted = {f.name.lower() for f in target} | {i.lower() for i in ignore}
    extra = [c for low, c in have.items() if low not in wanted]
    return Aligned(df.select(*columns), missing, extra)


def drift_rows(spark: SparkSession, table: str, aligned: Aligned) -> DataFrame:
    """Schema drift of a batch as rows for a report."""
    rows = ([(table, c, "missing in batch") for c in aligned.missing]
            + [(table, c, "not in target") for c in aligned.extra])
    return spark.createDataFrame(rows, "table string, column string, finding string")


def payload_columns(events: DataFrame) -> DataFrame:
    """Column names that occur in the payloads, per table: drift seen without inference."""
    return (events.select("table", F.explode(F.json_object_keys("data")).alias("column"))
            .groupBy("table", "column").agg(F.count("*").alias("n_events")))


def target_columns(spark: SparkSession, db: str, table: str,
                   partition_cols: Sequence[str] = ("dt", "flowid")) -> StructType:
    """The table's columns in order, partition columns last."""
    schema = spark.table(f"{db}.{table}").schema
    plain = [f for f in schema if f.name not in partition_cols]
    parts = [schema[c] if c in schema.names else StructField(c, StringType()) for c in partition_cols]
    return StructType([*plain, *parts])


def catalog_columns(spark: SparkSession, db: str) -> dict[str, StructType]:
    """Every table of a database with its ordered columns."""
    return {t.name: target_columns(spark, db, t.name)
            for t in spark.catalog.listTables(db) if not t.isTemporary}


def to_lines(df: DataFrame, database: Column, table: Column, kind: Column, ts: Column, xid: Column,
             data: Column) -> DataFrame:
    """Wrap rows as envelope lines: the inverse of `parse_events`, used to build change logs.

    `data` is the JSON text of the payload.
    """
    members: Mapping[str, Column] = {"database": database, "table": table, "type": kind, "ts": ts,
                                     "xid": xid}
    head = F.to_json(F.struct(*[c.alias(n) for n, c in members.items()]))
    body = F.expr("substring(_head, 1, length(_head) - 1)")
    return (df.withColumns({"_head": head, "_data": data})
            .select(F.concat(body, F.lit(',"data":'), F.col("_data"), F.lit("}")).alias("value")))

