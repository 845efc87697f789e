"""A small corpus with every awkward kind of row, and plain versions of the
contracts' rules."""

from __future__ import annotations

import random
import re
import zlib

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size int, key string, node long, "
          "label int, score string, kept string, n_lines long, row_id string")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


def fold(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def prose(rng, n):
    vocab = ["la", "ther", "ing", "zu", "Kei", "ño", "über", "tion", "ea", "sh", "or", "ment", "qui", "est", "ver"]
    out = []
    for i in range(n):
        out.append("".join(rng.choice(vocab) for _ in range(rng.randint(1, 3))))
        if i % 17 == 16:
            out[-1] += ".\n"
    return " ".join(out)


def documents(seed=1, n=40):
    """(doc_id, text, source) rows: prose, near and exact copies, a shared
    passage, repeated rows and ids, nulls, empty, blank and one long text."""
    rng = random.Random(seed)
    rows = [[i, prose(rng, rng.randint(20, 160)), f"src{i % 4}"] for i in range(n)]
    base = prose(rng, 120)
    for k in range(6):
        w = base.split(" ")
        for _ in range(k):
            w[rng.randrange(len(w))] = "edited"
        rows.append([100 + k, " ".join(w), "src0"])
    rows += [[110 + k, base, "src0"] for k in range(3)]
    passage = prose(rng, 70)
    rows += [[120 + k, prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 30), None] for k in range(4)]
    rows += [[130, None, "src1"], [131, "", "src1"], [132, " \n\t ", "é"], [133, "one", "é"], [134, "ONE", ""],
             [135, "four words in all", "src2"], [136, "Four words\tin all", "src2"],
             [None, prose(rng, 40), "src3"], [None, None, None], [137, prose(rng, 4000), "src3"],
             [138, "x" * 3000, "src3"], [139, "ab" * 700, "src3"]]
    rows += [list(rows[3]), list(rows[3]), [5, prose(rng, 50), "src1"]]
    return rows


def frame(spark, rows):
    """With extra columns, named like columns that the operators use."""
    return spark.createDataFrame([(i, t, "xx", s, len(t or ""), 1, "k", 7, 0, "s", "no", 3, "r") for i, t, s in rows],
                                 SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
