"""JSON documents and stable row ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import _col


def json_image(*cols: Column | str) -> Column:
    """A JSON object of the columns with null members kept."""
    return F.to_json(F.struct(*[_col(c) for c in cols]), {"ignoreNullFields": "false"})


def row_id(*cols: Column | str) -> Column:
    """A stable id from the key columns; null and blank keys differ."""
    marked = [F.coalesce(F.concat(F.lit("="), _col(c).cast("string")), F.lit("~")) for c in cols]
    return F.sha2(F.concat_ws("\u0001", *marked), 256)
