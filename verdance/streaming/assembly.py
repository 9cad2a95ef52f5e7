"""Bands of tiles as they arrive, put together per tile, or given up after a while.

A tile waits in state until its four bands are there.  A timer in event time ends
the wait, and the tile is reported as failed with the bands it lacks; both ways
its state goes.  The session's state store must be RocksDB (``ROCKSDB``), which
holds more tiles than memory does.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from verdance.functions.indices import BANDS
from verdance.streaming.versions import write_version

ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
PLACE = ["scene_id", "scene_date", "tile_id", "width", "height", "x0", "y0", "dx", "dy"]
_PLACE_DDL = "scene_id long, scene_date date, tile_id int, width int, height int, x0 double, y0 double, dx double, dy double"
_BANDS_DDL = ", ".join(f"{b}_dn array<int>" for b in BANDS)
ASSEMBLED = f"{_PLACE_DDL}, {_BANDS_DDL}, status string, missing array<string>"
WAIT = "1 day"


class Assembly(StatefulProcessor):
    """State of one tile: its bands, and when its wait ends.

    The bands are one value, as each call for state goes from Python to the JVM and back.
    """

    def __init__(self, wait_ms: int):
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bands = handle.getValueState("bands", _BANDS_DDL)
        self.ends = handle.getValueState("ends", "at long")

    def _done(self, key, found: dict, status: str):
        import pandas as pd

        missing = [b for b in BANDS if found.get(b) is None]
        return pd.DataFrame({name: [value] for name, value in [
            *zip(PLACE, key), *((f"{b}_dn", found.get(b)) for b in BANDS), ("status", status), ("missing", missing),
        ]})

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        before, newest = self.bands.get(), None
        found = dict(zip(BANDS, before or [None] * len(BANDS)))
        for frame in rows:
            for band, dn in zip(frame["band"], frame["dn"]):
                if band in BANDS and dn is not None:
                    found[band] = [int(x) for x in dn]
            last = frame["arrived_at"].max().value // 1_000_000
            newest = last if newest is None else max(newest, last)
        if all(found[b] is not None for b in BANDS):
            if before is not None:
                self.handle.deleteTimer(self.ends.get()[0])
                self.ends.clear()
                self.bands.clear()
            yield self._done(key, found, "complete")
            return
        if before is None:
            at = newest + self.wait_ms
            self.ends.update((at,))
            self.handle.registerTimer(at)
        self.bands.update(tuple(found[b] for b in BANDS))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        ends = self.ends.get()
        if ends is not None and ends[0] <= expiredTimerInfo.getExpiryTimeInMs():
            found = dict(zip(BANDS, self.bands.get()))
            self.ends.clear()
            self.bands.clear()
            yield self._done(key, found, "failed")

    def close(self) -> None:
        pass


def assembled_tiles(bands: DataFrame, wait_ms: int, late: str = "0 seconds") -> DataFrame:
    """Wide tiles with ``status`` complete, or failed with the ``missing`` bands.

    ``bands`` are rows of tiles in the long form with ``arrived_at``.  A tile is
    failed once an entry arrives that is ``wait_ms`` later than its first bands.
    A band that comes twice replaces itself; one that comes after its tile was
    given up opens the tile anew.
    """
    stream = bands.select(*PLACE, "band", "dn", "arrived_at").withWatermark("arrived_at", late)
    placed = stream.withColumns({"scene_id": F.col("scene_id").cast("long"), "tile_id": F.col("tile_id").cast("int")})
    return placed.groupBy(*PLACE).transformWithStateInPandas(
        statefulProcessor=Assembly(wait_ms), outputStructType=ASSEMBLED, outputMode="Append", timeMode="EventTime"
    )


def assembly_writer(bands: DataFrame, base: str, checkpoint: str, wait_ms: int) -> DataStreamWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        write_version(batch, base, batch_id)

    tiles = assembled_tiles(bands, wait_ms)
    return tiles.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
