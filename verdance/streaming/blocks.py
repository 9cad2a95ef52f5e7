"""Stored tables in blocks, of which a batch reads and rewrites only those it touches.

A block is a number from a bounded range, such as a calendar month.  Every batch
writes the touched blocks below a version of its own, ``<table>/<version>``, and
then a manifest that names the version of each block.  The version's name is the
streaming query and its batch, so a replayed batch writes the same place again
and finds the manifest from before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance.streaming.versions import commits, folder_of, latest_version, read_version, running_query, write_next

BLOCK = "_part"
MANIFEST = f"{BLOCK} long, version string"
#: Blocks of dates are calendar months; entries without a date come before all others.
NO_DATE = -1


def month_block(date: Column) -> Column:
    return F.coalesce((F.year(date) * 12 + F.month(date) - 1).cast("long"), F.lit(NO_DATE).cast("long"))


class Blocks:
    """Tables below ``base`` that share their blocks; ``names`` are the tables' names."""

    def __init__(self, spark: SparkSession, base: str, names: tuple[str, ...]):
        self.spark, self.base, self.names = spark, base, names
        #: Blocks that the last batch read, for tests and logs.
        self.last_read: list[int] = []

    def manifest(self) -> dict[int, str]:
        try:
            rows = latest_version(self.spark, f"{self.base}/manifest").collect()
        except LookupError:
            return {}
        return {r[BLOCK]: r.version for r in rows}

    def _paths(self, name: str, live: dict[int, str]) -> list[str]:
        return [f"{self.base}/{name}/{version}/{BLOCK}_of={block}" for block, version in sorted(live.items())]

    def read(self, name: str, live: dict[int, str] | None = None) -> DataFrame | None:
        """A table's live blocks, all of the newest manifest by default; None if there is none."""
        live = self.manifest() if live is None else live
        return self.spark.read.parquet(*self._paths(name, live)) if live else None

    def advance(
        self, batch: DataFrame, batch_id: int, block: Column, make: Callable[[DataFrame | None, DataFrame], dict[str, DataFrame]]
    ) -> None:
        """Replaces the touched blocks by what ``make`` forms from their first table and the batch.

        The tables that it returns have the column ``BLOCK``.
        """
        version = f"{running_query(self.spark)}-{batch_id}"
        placed = batch.withColumn(BLOCK, block)
        touched = [r[0] for r in placed.select(BLOCK).distinct().collect()]  # bounded by the range of blocks

        def manifest(before: DataFrame | None) -> DataFrame:
            known = {} if before is None else {r[BLOCK]: r.version for r in before.collect()}
            live = {b: known[b] for b in touched if b in known}
            self.last_read = sorted(live)
            for name, table in make(self.read(self.names[0], live), placed).items():
                by_block = table.withColumn(f"{BLOCK}_of", F.col(BLOCK)).hint("rebalance", BLOCK)
                by_block.write.mode("overwrite").partitionBy(f"{BLOCK}_of").parquet(f"{self.base}/{name}/{version}")
            now = {**known, **dict.fromkeys(touched, version)}
            return self.spark.createDataFrame(sorted(now.items()), MANIFEST)

        write_next(self.spark, f"{self.base}/manifest", batch_id, manifest, keep=2)

    def vacuum(self) -> int:
        """Removes blocks that neither the newest manifest nor the one before it names; returns how many."""
        place = f"{self.base}/manifest"
        live = set()
        for commit in commits(self.spark, place):
            live |= {(r.version, r[BLOCK]) for r in read_version(self.spark, place, commit.v).collect()}
        removed = 0
        for name in self.names:
            for version in _children(self.spark, f"{self.base}/{name}"):
                blocks = {b: int(b.split("=")[1]) for b in _children(self.spark, f"{self.base}/{name}/{version}") if "=" in b}
                dead = [b for b, number in blocks.items() if (version, number) not in live]
                whole = len(dead) == len(blocks)
                for path in [version] if whole else [f"{version}/{b}" for b in dead]:
                    files, folder = folder_of(self.spark, f"{self.base}/{name}/{path}")
                    files.delete(folder, True)
                removed += len(dead)
        return removed


def _children(spark: SparkSession, path: str) -> list[str]:
    files, folder = folder_of(spark, path)
    return [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []
