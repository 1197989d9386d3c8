"""File sinks: distributed writers, an output replaced whole or not at all, none for empty results.

A result is written beside its target, under a name that readers skip, and its
rows are counted on their way to the files, so the plan runs once. Only a whole
result with rows takes the target's place; an empty result or a failed write leaves
what an earlier run wrote. Works on any file system that Hadoop knows; where
folders are renamed file by file (object stores) the change of place is not atomic, but
the earlier output is kept until the new one stands.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> bool:
    """Write ``df`` as CSV with a header; ``single_file`` only for bounded results.

    Returns False, and leaves ``path`` as it is, when ``df`` has no rows.
    """
    return _write(df.coalesce(1) if single_file else df, path, lambda w, p: w.option("header", True).csv(p))


def write_parquet(df: DataFrame, path: str) -> bool:
    """Write ``df`` as parquet; returns False (``path`` left as it is) when empty."""
    return replace_parquet(df, path)


def replace_parquet(df: DataFrame, path: str, by: Sequence[str] = ()) -> bool:
    """:func:`write_parquet` in folders by the columns ``by``."""
    return _write(df, path, lambda w, p: w.partitionBy(*by).parquet(p))


def _write(df: DataFrame, path: str, write: Callable[[DataFrameWriter, str], None]) -> bool:
    folder, name = path.rstrip("/").rpartition("/")[::2]
    beside = f"{folder}/" if folder or path.startswith("/") else ""
    run = uuid.uuid4().hex
    staging, earlier = f"{beside}_staging-{run}-{name}", f"{beside}_earlier-{run}-{name}"
    files = _Files(df)
    seen = Observation()
    try:
        write(df.observe(seen, F.count(F.lit(1)).alias("rows")).write, staging)
        if not seen.get.get("rows", 0):
            return False
        files.replace(path, staging, earlier)
        return True
    finally:
        files.delete(staging)


class _Files:
    """Folders of the file system that a path names."""

    def __init__(self, df: DataFrame):
        spark = df.sparkSession
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        target = self.path(path)
        return target.getFileSystem(self.conf), target

    def delete(self, path: str) -> None:
        fs, target = self._at(path)
        if fs.exists(target):
            fs.delete(target, True)

    def replace(self, path: str, new: str, aside: str) -> None:
        """``new`` takes the place of ``path``; should that fail, what stood there comes back."""
        fs, target = self._at(path)
        had = fs.exists(target)
        if had:
            self._move(fs, path, aside)
        try:
            self._move(fs, new, path)
        except Exception:
            if had:
                self._move(fs, aside, path)
            raise
        if had:
            self.delete(aside)

    def _move(self, fs, path: str, to: str) -> None:
        if not fs.rename(self.path(path), self.path(to)):  # some file systems raise, others say no
            raise OSError(f"cannot move {path} to {to}")
