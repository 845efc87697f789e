"""Bloom filters over long values, of a fixed size.

A filter of ``FILTER_BITS`` bits is what a task needs to pass over rows that
certainly have no partner.  Its size bounds the broadcast; a filter that
fills up lets more rows pass, which the join behind it sorts out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import arrays as A
from tallyspark.llm.frames import arrow_map

FILTER_BITS = 1 << 26


def _places(x: np.ndarray) -> list[np.ndarray]:
    """Places of values in a filter."""
    return [(A.mix(x + s) & A.U64(FILTER_BITS - 1)).astype(np.int64) for s in A.seeds(3, 41)]


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = np.unique(np.concatenate(_places(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))))
        word, start = np.unique(at >> 6, return_index=True)
        bit = A.U64(1) << (at & 63).astype(np.uint64)
        held = np.bitwise_or.reduceat(bit, start) if len(at) else bit
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(held.view(np.int64))], names=["word", "bits"])


def bloom(values: DataFrame) -> np.ndarray:
    """Filter over the one long column of ``values`` (without nulls)."""
    words = (arrow_map(values, _words, "word long, bits long").groupBy("word")
             .agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def maybe(held: np.ndarray, x: np.ndarray) -> np.ndarray:
    """False where a uint64 value is certainly not in the filter."""
    yes = np.ones(len(x), dtype=bool)
    for at in _places(x):
        yes &= (held[at >> 6] >> (at & 63).astype(np.uint64)) & A.U64(1) == 1
    return yes
