"""Bitmaps of bounded size that rows are sifted by before an exact join.

Rows whose key is in no bitmap cannot meet anything, so they need not be shuffled;
those that stay, a few by chance among them, meet in the join as before.  Keys are
longs that are hashes already; their highest bits are the place in the bitmap, which
has 16 places for each key up to ``MOST`` bits (16 MB).

Defined cases: without keys nothing stays; repeated keys are one; a null key has no place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, MOST = 24, 27
CELL = 15  # bits of a place inside a row of Spark's bitmaps


class Sieve:
    def __init__(self, bits: int, cells: list[tuple[int, bytes]]):
        self.bits = bits
        self.map = np.zeros((1 << (bits - CELL), 1 << (CELL - 3)), np.uint8)
        for cell, content in cells:
            self.map[cell] = np.frombuffer(content, np.uint8)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Which of the longs may be among the keys."""
        at = keys.view(np.uint64) >> np.uint64(64 - self.bits)
        return (self.map.ravel()[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def sieve(keys: DataFrame, key: str, most: int = MOST) -> Broadcast:
    """The bitmap of a stored table's ``key``, on all executors; at most 2^most bits reach the driver."""
    keys = keys.where(F.col(key).isNotNull())
    bits = min(max((16 * keys.count()).bit_length(), LEAST), most)
    at = F.shiftrightunsigned(F.col(key), 64 - bits)
    cells = keys.select(F.shiftright(at, CELL).cast("int").alias("cell"),
                        at.bitwiseAND(F.lit((1 << CELL) - 1)).alias("bit"))
    # Dealt before they are put together, so a cell is made once.
    rows = cells.repartition("cell").groupBy("cell").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    return keys.sparkSession.sparkContext.broadcast(Sieve(bits, [(r["cell"], bytes(r["bits"])) for r in rows]))


def sifted(rows: DataFrame, key: str, by: Broadcast) -> DataFrame:
    """The ``rows`` whose ``key``, a long that is never null, may be in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(by.value.holds(batch.column(key).to_numpy())))

    return rows.mapInArrow(run, rows.schema)
