"""A set of hashes as a bitmap, for dropping rows early.

The bitmap never misses a member; it may take a few other hashes for members.
So it only ever saves work before an exact join. Its size follows its members, up
to ``2**MOST_BITS`` bits (32 MB), which is the most that reaches the driver and each worker.
Up to 16 million members at most one other hash in sixty passes, at 50 million one in ten.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.sources.staging import tidy

LEAST_BITS, MOST_BITS = 25, 28
BITS_PER_MARK = 8  # a member makes two marks


def bitmap(keys: DataFrame, column: str, least: int = LEAST_BITS, most: int = MOST_BITS) -> Broadcast:
    """Broadcast bitmap of the hashes (longs, evenly spread) in ``column``."""
    mask = (1 << most) - 1
    with tidy(keys.sparkSession):
        spots = keys.select(F.explode(F.expr(f"array({column} & {mask}L, shiftrightunsigned({column}, 32) & {mask}L)")).alias("spot"))
        words = spots.groupBy(F.expr("cast(spot >> 6 as int)").alias("word")).agg(
            F.expr("bit_or(shiftleft(1L, cast(spot & 63 as int)))").alias("flags")
        )
        table: pa.Table = words.toArrow()
    found = np.zeros(1 << (most - 6), np.uint64)
    for batch in table.to_batches():
        found[batch["word"].to_numpy()] = batch["flags"].to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(_folded(found, least))


def _folded(found: np.ndarray, least: int) -> np.ndarray:
    """The bitmap of the same members with fewer bits: ``BITS_PER_MARK`` times its marks, ``2**least`` at least."""
    wanted = max(int(np.bitwise_count(found).sum()) * BITS_PER_MARK, 1 << least)
    size = min(1 << (wanted - 1).bit_length(), 64 * len(found)) // 64
    return np.bitwise_or.reduce(found.reshape(-1, size), axis=0)


def contains(found: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes may be members."""
    hashes = hashes.view(np.uint64)
    mask = np.uint64(len(found) * 64 - 1)
    hit = np.ones(len(hashes), bool)
    for spot in (hashes & mask, (hashes >> np.uint64(32)) & mask):
        hit &= (found[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
    return hit
