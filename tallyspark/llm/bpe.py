"""Token counts by byte-pair merging, without emitting identifiers.

The vocabulary is that of a sentencepiece BPE model with byte fallback (32
thousand pieces, so its broadcast is bounded by the file).  A text is cut
where no piece can reach across: before each run of spaces, around line feeds,
and between letters and marks (see ``cutter``).  Each cut stretch is merged on its own with a
heap of adjacent pairs over a linked list of symbols: the pair of the best
score, leftmost among equals, is merged until none is in the vocabulary.
The count is the initial symbols less the merges; a character outside the
vocabulary counts as its UTF-8 bytes from the start.

Counts of short stretches are remembered per Python worker, up to
``REMEMBER`` of them (then forgotten and begun anew: memory only, never the
result).  A null text is empty; an empty text has no tokens.  Rows map one
to one, so null or repeated ids, ties and extra columns change nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from operator import add

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.frames import arrow_map, texts

REMEMBER = 500_000
SHORT = 40
SPACE = "▁"

_counters: dict[str, Counter] = {}


def read_ranks(model_file: str) -> dict[str, int]:
    """piece -> rank (lower merges first, equal scores alike) of the mergeable pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    plain = (i for i in range(sp.get_piece_size())
             if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)))
    score = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
    place = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
    return {p: place[s] for p, s in score.items()}


def merged_count(stretch: str, ranks: dict[str, int], known: set[str]) -> int:
    """Tokens of one stretch.

    A heap entry packs (rank, left symbol, length of the pair) into one
    integer, so the smallest is the best pair, leftmost among equals.
    """
    n = len(stretch)
    count = n if known.issuperset(stretch) else sum(
        1 if c in known else len(c.encode("utf-8", "replace")) for c in stretch)
    if n == 1:
        return count
    bits = n.bit_length()
    high, mask = 2 * bits, (1 << bits) - 1
    rank = ranks.get
    heap = [(r << high) | (i << bits) | 2
            for i, r in enumerate(map(rank, map(add, stretch, stretch[1:]))) if r is not None]
    heapify(heap)
    size = [1] * n  # of the symbol that begins there; 0 once merged into its left neighbour
    before = list(range(-1, n - 1))
    while heap:
        top = heappop(heap)
        length = top & mask
        left = (top >> bits) & mask
        own = size[left]
        right = left + own
        # A pair is out of date unless its two symbols still make up its length.
        if not own or right >= n or own + size[right] != length:
            continue
        size[left], size[right] = length, 0
        count -= 1
        after = left + length
        if after < n:
            before[after] = left
            end = after + size[after]
            r = rank(stretch[left:end])
            if r is not None:
                heappush(heap, (r << high) | (left << bits) | (end - left))
        prior = before[left]
        if prior >= 0:
            r = rank(stretch[prior:after])
            if r is not None:
                heappush(heap, (r << high) | (prior << bits) | (after - prior))
    return count


MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def cutter(ranks: dict[str, int]) -> re.Pattern:
    """The pattern of stretches that merge on their own.

    A stretch begins with spaces, or where the one before ends: at a line
    feed, before spaces, and between a letter and a mark if no piece has that
    letter before any mark.  All of it is read off the vocabulary.
    """
    if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in ranks):  # no cut is safe
        return re.compile(r"(?s).+")
    before_marks = {a for p in ranks for a, b in zip(p, p[1:], strict=False) if b in MARKS}
    letters = "".join(sorted({c for p in ranks for c in p if c.isalnum()} - before_marks))
    if not letters:
        return re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n+")
    other, others = f"[^{SPACE}\n{letters}{re.escape(MARKS)}]", f"[^{SPACE}\n{letters}]*"
    return re.compile(f"(?!\n)(?=.){SPACE}*{others}(?:[{letters}]+{other}{others})*[{letters}]*|\n+")


class Counter:
    """Counts the tokens of texts; remembers short stretches."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        self.known = {p for p in ranks if len(p) == 1}
        self.cut = cutter(ranks)
        self.seen: dict[str, int] = {}

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        stretches = self.cut.findall(SPACE + text.replace(" ", SPACE))
        counts = list(map(self.seen.get, stretches))
        if None in counts:
            for i, n in enumerate(counts):
                if n is None:
                    counts[i] = self._fresh(stretches[i])
        return sum(counts)

    def _fresh(self, stretch: str) -> int:
        n = self.seen.get(stretch)
        if n is None:
            n = merged_count(stretch, self.ranks, self.known)
            if len(stretch) <= SHORT:
                if len(self.seen) >= REMEMBER:
                    self.seen.clear()
                self.seen[stretch] = n
        return n


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_ranks(model_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model_file not in _counters:
            _counters[model_file] = Counter(shared.value)
        count = _counters[model_file]
        for batch in batches:
            col = pc.fill_null(batch.column("text"), "")
            counts = [count(t) for t in col.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.cast(pc.binary_length(col), pa.int64()), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    return (arrow_map(texts(docs), run, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
