"""Whole-batch text processing on Arrow buffers with numpy.

The text operators run inside ``mapInArrow``: Spark hands a task Arrow
batches, and these helpers view the UTF-8 bytes of many documents as one
array.  Word boundaries, word hashes and n-gram hashes are then array
operations; there is no loop over words.  Batches are cut into chunks of
``CHUNK`` bytes (a longer text is a chunk of its own), which bounds the
memory of a task whatever the batch size.

Hashes are 64-bit polynomials over random byte values, finished with an
avalanche step.  They identify words and n-grams within a task and between
tasks; operators say where they rely on them.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche a uint64 array (each bit of the result hangs on all bits)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed pseudo-random uint64 values."""
    return mix((np.arange(1, n + 1, dtype=U64) + U64(salt) * U64(1 << 32)) * U64(0x9E3779B97F4A7C15))


BYTE_VALUES = seeds(256, 11) | U64(1)
BASE = 0x5851F42D4C957F2D
GRAM_BASE = 0xD1342543DE82EF95


def byte_set(keep) -> np.ndarray:
    """Boolean table over the 256 byte values."""
    return np.array([bool(keep(b)) for b in range(256)])


LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
#: Bytes of words that white space (space, tab to carriage return) separates.
SPACED = byte_set(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Bytes of words of lower-case letters, digits and all beyond ASCII.
ALNUM = byte_set(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


@functools.lru_cache(maxsize=4)
def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of ``base`` modulo 2^64 and of its inverse."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.full(n + 1, U64(b))
        p[0] = U64(1)
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    size = CHUNK
    while size < n:
        size *= 2
    return _powers(size, base)


def chunks(batch: pa.RecordBatch, text: str = "text",
           limit: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) pieces of a batch; a null text is empty."""
    col = pc.fill_null(batch.column(text), "")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    _, off_buf, data_buf = col.buffers()
    n = len(col)
    offs = np.frombuffer(off_buf, dtype=np.int64)[col.offset: col.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1
        to = min(n, max(to, at + 1))
        lo, hi = int(offs[at]), int(offs[to])
        yield batch.slice(at, to - at), data[lo:hi], offs[at:to + 1] - lo
        at = to


def word_spans(data: np.ndarray, offs: np.ndarray, inside: np.ndarray):
    """Starts and ends of words, and per document the first word's index.

    ``inside`` says which bytes belong to words; a word never crosses a
    document's end.
    """
    is_w = np.zeros(len(data) + 2, dtype=bool)
    is_w[1:-1] = inside[data]
    cut = offs[(offs > 0) & (offs < len(data))]
    edge = is_w[1:] != is_w[:-1]
    begin = edge[:-1] & is_w[1:-1]
    end = edge[1:] & is_w[1:-1]
    both = cut[is_w[cut + 1] & is_w[cut]]  # a word byte on both sides of a document's end
    begin[both] = True
    end[both - 1] = True
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offs)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span."""
    up, down = powers(len(data))
    total = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(BYTE_VALUES[data] * up[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64))


def grams(words: np.ndarray, first: np.ndarray, width: int):
    """Hashes of the ``width``-word sequences of each document.

    A document of fewer words, but not none, gives its whole sequence as
    one.  Returns (hashes, per document the first one's index).
    """
    counts = np.diff(first)
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    at = np.zeros(len(made) + 1, dtype=np.int64)
    np.cumsum(made, out=at[1:])
    doc = np.repeat(np.arange(len(made)), made)
    pos = np.arange(at[-1]) - at[:-1][doc] + first[:-1][doc]
    size = np.minimum(counts, width)[doc]
    out = np.full(len(pos), U64(0))
    for j in range(width):
        inside = size > j
        nxt = words[np.minimum(pos + j, len(words) - 1)] if len(words) else words
        out = np.where(inside, out * U64(GRAM_BASE) + nxt, out)
    return mix(out + size.astype(U64)), at
