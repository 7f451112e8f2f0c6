"""Snapshots that readers see whole or not at all.

A snapshot's tables are staged in a folder of their own while their rows are counted, all checks run on the
counts, and only then a small pointer file is replaced in one atomic rename of Hadoop's FileSystem.  A writer
that fails or is refused leaves the old snapshot in place; readers follow the pointer, so they never meet half
of a new one.  Layout of a snapshot folder: ``_current`` (the pointer) and one folder for each version.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

POINTER = "_current"


class Refused(Exception):
    """A check failed: nothing was published."""

    def __init__(self, reasons: list[str]):
        super().__init__("; ".join(reasons))
        self.reasons = reasons


class _Files:
    """The few calls of Hadoop's file system that publishing needs, for any of its stores."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def replace(self, old: str, new: str) -> None:
        """Renames over what is there, in one step."""
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        kind = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.gateway.new_array(kind, 1)
        how[0] = kind.OVERWRITE
        context.rename(self.fs.makeQualified(self.path(old)), self.fs.makeQualified(self.path(new)), how)

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def folders(self, name: str) -> list[str]:
        if not self.exists(name):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(name)) if s.isDirectory()]


def version(spark: SparkSession, root: str) -> str | None:
    """The name of the version that is published; None before the first."""
    files = _Files(spark, root)
    return files.read(f"{root}/{POINTER}").strip() if files.exists(f"{root}/{POINTER}") else None


def current(spark: SparkSession, root: str, table: str, format: str = "parquet") -> DataFrame | None:
    """A table of the published snapshot; None where there is none."""
    now = version(spark, root)
    if now is None or not _Files(spark, root).exists(f"{root}/{now}/{table}"):
        return None
    return spark.read.format(format).load(f"{root}/{now}/{table}")


def publish(
    spark: SparkSession,
    root: str,
    tables: dict[str, DataFrame],
    checks: Callable[[dict[str, dict]], Iterable[str]] = lambda counts: (),
    measures: dict[str, dict[str, str]] | None = None,
    formats: dict[str, str] | None = None,
    dry: bool = False,
    keep: int = 1,
) -> dict[str, dict]:
    """Stages ``tables``, checks what was counted, and makes them the snapshot at ``root``; returns the counts.

    Each table's ``rows``, and the SQL aggregates that ``measures`` names for it, are observed in the very scan
    that writes it.  ``checks`` gets all of them and gives reasons against publishing; any reason, or any
    failure before the rename, deletes the staged folder and leaves the old version.  ``dry`` checks
    without publishing.  After the rename all but the last ``keep`` older versions are deleted, so that
    readers of the version before can finish.
    """
    measures, formats = measures or {}, formats or {}
    files, before = _Files(spark, root), version(spark, root)
    number = int(before.split("-")[1]) + 1 if before else 1
    name = f"version-{number:08d}-{uuid.uuid4().hex[:8]}"
    staged = f"{root}/{name}"
    try:
        counts = {}
        for table, df in tables.items():
            seen = Observation()
            wanted = {"rows": "count(*)", **measures.get(table, {})}
            df.observe(seen, *[F.expr(e).alias(n) for n, e in wanted.items()]).write.format(formats.get(table, "parquet")).save(f"{staged}/{table}")
            counts[table] = seen.get
        reasons = list(checks(counts))
        if reasons:
            raise Refused(reasons)
        if version(spark, root) != before:
            raise Refused(["another writer has published meanwhile"])
        if dry:
            files.delete(staged)
            return counts
        files.write(f"{root}/{POINTER}-{name}", name)
        files.replace(f"{root}/{POINTER}-{name}", f"{root}/{POINTER}")
    except BaseException:
        files.delete(staged)
        files.delete(f"{root}/{POINTER}-{name}")
        raise
    old = sorted(v for v in files.folders(root) if v.startswith("version-") and v < f"version-{number:08d}")
    for v in old[: max(0, len(old) - keep)]:
        files.delete(f"{root}/{v}")
    return counts


#: Fixed value: a snapshot with fewer pages than this share of the last one is refused.
FLOOR = 0.8


def publish_pages(spark: SparkSession, pages: DataFrame, root: str) -> DataFrame:
    """Publishes ``pages(title, text)`` by file name; returns the stale names, those of the version before that are gone.

    Refused: no pages at all, a title that no file name can have, and fewer than FLOOR of the pages before.
    Stale names are known before the rename and vanish with it; of titles with one name the last stays.
    """
    from ..functions.text import page_file

    named = pages.select(page_file(F.col("title")).alias("file"), "title", "text")
    old = current(spark, root, "pages")
    before = 0 if old is None else old.count()

    def checks(counts: dict) -> Iterable[str]:
        c = counts["pages"]
        if not c["rows"]:
            yield "there are no pages"
        if c["bad"]:
            yield f"{c['bad']} titles have a character that no file name can have"
        if c["rows"] < FLOOR * before:
            yield f"the snapshot shrinks from {before} to {c['rows']} pages, below {FLOOR} of them"

    unique = named.groupBy("file").agg(F.max_by("title", "title").alias("title"), F.max_by("text", "title").alias("text"))
    none = spark.createDataFrame([], "file string")
    # the names are compared while the old version surely stands, and kept beside the pages
    stale = none if old is None else old.select("file").join(named.select("file"), "file", "left_anti")
    publish(spark, root, {"pages": unique, "stale": stale}, checks, {"pages": {"bad": "count_if(contains(file, chr(0)))"}})
    return current(spark, root, "stale")
