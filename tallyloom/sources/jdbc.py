"""Relational databases."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    url: str
    driver: str
    user: str
    password: str
    fetch_rows: int = 10_000


@dataclass(frozen=True)
class Slices:
    """How a read is cut: one query per range of a numeric or date column."""

    column: str
    lower: str
    upper: str
    count: int


def jdbc_options(conf: Database, query: str, session_init: str | None = None,
                 slices: Slices | None = None) -> dict[str, str]:
    """Reader options; a sliced read needs the query as a derived table."""
    options = {"url": conf.url, "driver": conf.driver, "user": conf.user, "password": conf.password,
               "fetchsize": str(conf.fetch_rows)}
    if session_init:
        options["sessionInitStatement"] = session_init
    if slices is None:
        return options | {"query": query}
    return options | {"dbtable": f"({query}) q", "partitionColumn": slices.column,
                      "lowerBound": slices.lower, "upperBound": slices.upper,
                      "numPartitions": str(slices.count)}


def read_jdbc(spark: SparkSession, conf: Database, query: str, session_init: str | None = None,
              slices: Slices | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(conf, query, session_init, slices)).load()


# Statement per database family; `{marks}` are bound parameters.
UPSERT = {
    "mysql": "INSERT INTO {table} ({cols}) VALUES ({marks}) ON DUPLICATE KEY UPDATE {mysql_sets}",
    "sqlite": "INSERT INTO {table} ({cols}) VALUES ({marks}) ON CONFLICT ({keys}) DO UPDATE SET {sets}",
    "postgresql": "INSERT INTO {table} ({cols}) VALUES ({marks}) ON CONFLICT ({keys}) DO UPDATE SET {sets}",
}


def upsert_statement(table: str, columns: Sequence[str], keys: Sequence[str], family: str = "mysql",
                     mark: str = "%s") -> str:
    rest = [c for c in columns if c not in keys]
    return UPSERT[family].format(
        table=table, cols=", ".join(columns), marks=", ".join([mark] * len(columns)),
        keys=", ".join(keys), sets=", ".join(f"{c} = excluded.{c}" for c in rest),
        mysql_sets=", ".join(f"{c} = VALUES({c})" for c in rest))


def upsert_jdbc(df: DataFrame, connect: Callable[[], object], table: str, keys: Sequence[str],
                family: str = "mysql", mark: str = "%s", batch: int = 1000,
                writers: int | None = None) -> None:
    """Upsert by primary key in batches with bound parameters, one transaction per partition.

    Upserts may repeat after a lost task and still leave the same rows.  `writers` bounds the
    number of connections.
    """
    columns = df.columns
    statement = upsert_statement(table, columns, keys, family, mark)

    def write(rows) -> None:
        connection = connect()
        try:
            cursor, pending = connection.cursor(), []
            for row in rows:
                pending.append(tuple(row))
                if len(pending) >= batch:
                    cursor.executemany(statement, pending)
                    pending = []
            if pending:
                cursor.executemany(statement, pending)
            connection.commit()
        finally:
            connection.close()

    (df.repartition(writers) if writers else df).foreachPartition(write)


def write_jdbc(df: DataFrame, conf: Database, table: str, mode: str = "append", batch: int = 5000,
               extra: Mapping[str, str] | None = None) -> None:
    """Bulk insert in batches."""
    options = {"url": conf.url, "driver": conf.driver, "user": conf.user, "password": conf.password,
               "dbtable": table, "batchsize": str(batch)} | dict(extra or {})
    df.write.format("jdbc").options(**options).mode(mode).save()
