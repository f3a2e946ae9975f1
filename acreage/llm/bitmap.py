"""A filter of fixed size on 64-bit numbers: it only saves work, for a number that isn't in it may still pass."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from acreage.llm.words import mix, pair_hash

#: Full, it lets all pass; so its size needn't follow the data.
BITS, BLOCK = 24, 1 << 16


def slots(values: np.ndarray) -> np.ndarray:
    return (mix(values.view(np.uint64)) >> np.uint64(64 - BITS)).astype(np.int64)


def holds(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = slots(values)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def bitmap(values: DataFrame) -> np.ndarray:
    """The filter over the only column of values, or over pair_hash of its two. Each task sends blocks of its own filter, which are merged block by block."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(1 << (BITS - 3), np.uint8)
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            at = slots(columns[0] if len(columns) == 1 else pair_hash(*columns))
            np.bitwise_or.at(out, at >> 3, (1 << (at & 7)).astype(np.uint8))
        blocks = out.reshape(-1, BLOCK)
        some = np.flatnonzero(blocks.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array([blocks[k].tobytes() for k in some], pa.binary())], ["block", "bits"]
        )

    def merge(table: pa.Table) -> pa.Table:
        out = np.zeros(BLOCK, np.uint8)
        for x in table["bits"]:
            out |= np.frombuffer(x.as_py(), np.uint8)
        return pa.table({"block": table["block"].slice(0, 1), "bits": pa.array([out.tobytes()], pa.binary())})

    got = values.dropna().mapInArrow(make, "block int, bits binary").groupBy("block").applyInArrow(
        merge, "block int, bits binary"
    ).collect()
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for r in got:
        out[r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(r.bits, np.uint8)
    return out
