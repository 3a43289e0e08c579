"""Sets of 64-bit hashes as bit maps of a size fixed beforehand.

A bit map says of a hash either that it may be in the set or that it is not. It only saves work: what
passes is always judged exactly afterwards. Bits are set by Spark, a block of the map for each group,
so the driver receives at most the map itself, 16 MB unless told otherwise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2^27 bits are 16 MB; blocks of 2^16 bits
BITS, BLOCK_BITS = 27, 16


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where the hashes' bits are: their upper bits."""
    return hashes.view(np.uint64) >> np.uint64(64 - bits)


def bit_map(hashes: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The map of all hashes in a long column, as bytes."""
    block_bits = min(BLOCK_BITS, bits)
    place = F.shiftrightunsigned(F.col(column), 64 - bits)
    split = hashes.select(F.shiftright(place, block_bits).cast("int").alias("_block"), (place.bitwiseAND((1 << block_bits) - 1)).cast("int").alias("_bit"))

    def made(group: pa.Table) -> pa.Table:
        on = np.zeros(1 << block_bits, np.uint8)
        on[group.column("_bit").to_numpy()] = 1
        packed = np.packbits(on, bitorder="little").tobytes()
        return pa.table({"block": pa.array([group.column("_block")[0].as_py()], pa.int32()), "content": pa.array([packed], pa.binary())})

    # equal bits fall together before the shuffle, so a group holds a block's bits at most
    blocks = split.distinct().groupBy("_block").applyInArrow(made, "block int, content binary")
    out = np.zeros(1 << max(0, bits - 3), np.uint8)
    size = 1 << (block_bits - 3)
    for block, content in blocks.collect():
        out[block * size : (block + 1) * size] = np.frombuffer(content, np.uint8)
    return out


def held(bit_bytes: np.ndarray, hashes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Whether each hash may be in the set."""
    place = places(hashes, bits)
    return (bit_bytes[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
