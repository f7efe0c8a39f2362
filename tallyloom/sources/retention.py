"""Retention by mark and sweep: folders that no kept version names go, once they are old enough.

A folder's age guards writes that are not announced yet, so `before` lies further back than the longest job runs.  What
goes through the driver is folder names, one per version or staged table and never one per file or bucket.  Folders
are listed and removed through Arrow's file systems: local and mounted paths, HDFS and object stores.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Collection

from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql import SparkSession

from tallyloom.scale import shared_dir

# what `scale.fresh_path` names: a label and 32 digits
STAGED = re.compile(r".+-[0-9a-f]{32}")


def plain(path: str) -> str:
    """The path without the scheme of local files, which Spark writes with one slash."""
    return re.sub(r"^file:/+", "/", path.rstrip("/"))


def subfolders(path: str) -> list[tuple[str, dt.datetime | None]]:
    """Names and modification times of the folders in `path`; none where it does not exist."""
    system, inside = FileSystem.from_uri(plain(path))
    found = system.get_file_info(FileSelector(inside, allow_not_found=True))
    return sorted((f.base_name, f.mtime) for f in found if f.type == FileType.Directory)


def sweep(path: str, live: Collection[str], before: dt.datetime, among: re.Pattern | None = None) -> list[str]:
    """Remove the folders in `path` that are not `live`, were last changed before `before`, and match `among`; returns their names.

    A time without a zone is UTC.  A folder whose store tells no time stays.  A run that fails half way is made up for by the next.
    """
    limit = before if before.tzinfo else before.replace(tzinfo=dt.timezone.utc)
    gone = [name for name, changed in subfolders(path)
            if name not in live and changed is not None and changed < limit and (among is None or among.fullmatch(name))]
    system, inside = FileSystem.from_uri(plain(path))
    for name in gone:
        system.delete_dir(f"{inside}/{name}")
    return gone


def sweep_staged(spark: SparkSession, before: dt.datetime, live: Collection[str] = ()) -> list[str]:
    """Remove staged tables of the shared folder that were written before `before`, but for those named in `live`."""
    return sweep(shared_dir(spark), live, before, STAGED)
