"""Removing repeated runs of lines, with DataFrame functions only.

The corpus is a set of line sequences (blank lines left out).  Equal lines
get one rank, in the order of their identifiers; the ranks of two adjoining
stretches of h lines make the ranks of stretches of 2h lines, up to
``min_lines`` and no further: by default one join.  A line lies in a repeated
run of so many lines or more just when it lies in a repeated stretch of
exactly so many, so longer stretches would delete nothing more.  Stretches
whose rank nobody shares leave the table.  No suffix array is built; the
stretches of one rank at depth h are the suffixes with a common prefix of at
least h lines.

A run of lines is repeated if ``min_lines`` or more lines in a row, or a line
that is long enough to stand alone, also occur earlier (by document id, then
line).  Alone stand lines of ``MIN_WORDS`` words, ``MIN_LETTERS`` letters and
digits (for scripts without spaces) or ``MIN_CHARS`` characters; braces and
one-word lines don't.  Of each rank the earliest stretch stays; the lines of
the later ones are deleted.  Stretches of a longer repeated run are ranked too, so the maximal
run goes as a whole.

Every step is a grouping or a join on ranks or positions.  Groups are counted
with map-side combination and joined back on a key of their own, so a line
that makes up a third of the corpus is split by the adaptive planner.

Documents of one id and equal text are alike in all columns of the result;
documents without an id come last in the order.  Null texts have no lines;
empty texts have one blank line, which is never deleted.  Extra columns stay,
whatever their names, but for those named like a result column, which the
result replaces.
Lines are identified by 96 bits of hashes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.frames import keep
from tallyspark.llm.mixing import numbered

MIN_LINES, MIN_CHARS = 2, 100
MIN_WORDS, MIN_LETTERS = 3, 20
#: A suffix is the document (its number in sort order is not needed: id and
#: text hash sort alike everywhere) and the line's place among lines not blank.
_AT = ("nul", "doc_id", "th", "i")


def _text_hash(text):
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def _alone(line):
    """Whether a line is a run by itself."""
    return ((F.regexp_count(line, F.lit(r"[\p{L}\p{N}]+")) >= MIN_WORDS)
            | (F.length(F.regexp_replace(line, r"[^\p{L}\p{N}]+", "")) >= MIN_LETTERS)
            | (F.length(line) >= MIN_CHARS))


def line_table(docs: DataFrame) -> DataFrame:
    """(nul, doc_id, th, i, pos, h1, h2, alone): the lines that are not blank."""
    text = F.col("text").cast("string")
    each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash(text).alias("th"),
                       F.transform(F.split(text, "\n", -1), lambda x, p: F.struct(p.alias("pos"), x.alias("line")))
                       .alias("lines"))
    full = each.select("doc_id", "th", F.posexplode(F.filter("lines", lambda x: F.trim(x["line"]) != "")))
    return full.select(F.col("doc_id").isNull().alias("nul"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "th",
                       F.col("pos").alias("i"), F.col("col.pos").alias("pos"),
                       F.xxhash64("col.line").alias("h1"), F.hash("col.line").alias("h2"),
                       _alone(F.col("col.line")).alias("alone"))


def _repeated(suffixes: DataFrame, *key: str) -> DataFrame:
    """The intervals of more than one suffix: key and earliest suffix."""
    return keep(suffixes.groupBy(*key).agg(F.count("*").alias("members"), F.min(F.struct(*_AT)).alias("earliest"))
                .where("members > 1").drop("members"), "intervals")


def _back(suffixes: DataFrame, found: DataFrame, *key: str) -> DataFrame:
    """Suffixes joined to what was found for their key.  The hashed key gives
    the join an exchange of its own on both sides."""
    k = F.xxhash64(*key)
    return suffixes.withColumn("k", k).join(found.withColumn("k", k), ["k", *key]).drop("k")


def _later(marked: DataFrame, lines: int) -> DataFrame:
    """Positions that the later suffixes of the intervals begin with."""
    return (marked.where(F.struct(*_AT) != F.col("earliest"))
            .select("nul", "doc_id", "th", F.explode(F.sequence("i", F.col("i") + (lines - 1))).alias("i")))


def _depths(goal: int) -> list[int]:
    """Depths of the rounds: doubled, the last one exactly ``goal``."""
    out = [1]
    while out[-1] < goal:
        out.append(min(2 * out[-1], goal))
    return out


def repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """(nul, doc_id, th, pos) of every line to delete."""
    lines = keep(line_table(docs).distinct(), "lines")
    first = _repeated(lines, "h1", "h2")
    ranks = numbered(first, "h1", "h2", name="rank")
    marked = _back(lines, ranks, "h1", "h2")
    level = keep(marked.select(*_AT, "rank", "alone", "earliest"), "ranks")
    gone = [_later(level.where("alone"), 1)]
    depths = _depths(min_lines)
    if len(depths) == 1:
        gone.append(_later(level, 1))
    for h, to in zip(depths, depths[1:], strict=False):
        # The stretch of `to` lines at i is the stretches of h lines at i and at i + to - h.
        tail = level.select("nul", "doc_id", "th", (F.col("i") - (to - h)).alias("i"), F.col("rank").alias("rank2"))
        pairs = keep(level.select(*_AT, F.col("rank").alias("rank1")).join(tail, list(_AT)), "pairs")
        found = _repeated(pairs, "rank1", "rank2")
        if to == min_lines:
            gone.append(_later(_back(pairs, found, "rank1", "rank2"), to))
        else:
            found = numbered(found, "rank1", "rank2", name="rank")
            level = keep(_back(pairs, found, "rank1", "rank2").select(*_AT, "rank"), "ranks")
    deleted = reduce(DataFrame.union, gone).distinct()
    return deleted.join(lines.select(*_AT, "pos"), list(_AT)).select("nul", "doc_id", "th", "pos")


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """``docs`` with the columns n_lines, n_removed, n_runs (stretches of deleted
    lines, whichever runs they come from) and kept_text (null for a null text).  The text itself stays."""
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed", "n_runs", "kept_text")]
    deleted = repeated_lines(docs.select("doc_id", "text"), min_lines)
    in_doc = Window.partitionBy("nul", "doc_id", "th").orderBy("pos")
    runs = (deleted.withColumn("island", F.col("pos") - F.row_number().over(in_doc))
            .groupBy("nul", "doc_id", "th", "island").agg(F.min("pos").alias("begin"), F.max("pos").alias("end"))
            .groupBy("nul", "doc_id", "th")
            .agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("runs")))
    # The user's columns travel in one struct, so their names meet no others.
    text, own_id = F.col("text").cast("string"), F.col("doc_id").cast("long")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), own_id.isNull().alias("nul"),
                        F.coalesce(own_id, F.lit(0)).alias("doc_id"), _text_hash(text).alias("th"), text.alias("text"))
    marked = whole.join(runs, ["nul", "doc_id", "th"], "left")
    text = F.col("text")
    run_list = F.coalesce("runs", F.array().cast("array<struct<begin:int,end:int>>"))
    parts = F.split(text, "\n", -1)
    # The stretches between deleted runs; sentinels stand before and after all lines.
    fences = F.concat(F.array(F.struct(F.lit(-1).alias("begin"), F.lit(-1).alias("end"))), run_list,
                      F.array(F.struct(F.size(parts).alias("begin"), F.size(parts).alias("end"))))
    gaps = F.zip_with(F.slice(fences, 1, F.size(fences) - 1), F.slice(fences, 2, F.size(fences) - 1),
                      lambda a, b: F.slice(parts, a["end"] + 2, b["begin"] - a["end"] - 1))
    removed = F.aggregate(run_list, F.lit(0).cast("long"), lambda s, r: s + (r["end"] - r["begin"] + 1))
    return marked.select(
        *[F.col(f"doc.`{c}`") for c in kept],
        F.when(text.isNull(), F.lit(0)).otherwise(F.size(parts)).cast("long").alias("n_lines"),
        removed.alias("n_removed"), F.size(run_list).cast("long").alias("n_runs"),
        F.when(F.size(run_list) == 0, text).otherwise(F.array_join(F.flatten(gaps), "\n")).alias("kept_text"))


#: The same rule in DuckDB, for two lines, over plain windows.
ORACLE = rf"""
WITH split AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
lines AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM split WHERE trim(line) <> ''),
pairs AS (
  SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS next_line FROM lines),
marked AS (
  SELECT *, (len(regexp_extract_all(line, '[\p{{L}}\p{{N}}]+')) >= {MIN_WORDS}
             OR length(regexp_replace(line, '[^\p{{L}}\p{{N}}]+', '', 'g')) >= {MIN_LETTERS}
             OR length(line) >= {MIN_CHARS}) AND row_number() OVER (PARTITION BY line ORDER BY doc_id, i) > 1 AS alone,
         next_line IS NOT NULL
           AND row_number() OVER (PARTITION BY line, next_line ORDER BY doc_id, i) > 1 AS begins
  FROM pairs),
gone AS (
  SELECT doc_id, pos, alone OR begins
         OR coalesce(lag(begins) OVER (PARTITION BY doc_id ORDER BY pos), false) AS deleted FROM marked),
every AS (
  SELECT s.doc_id, s.pos, s.line, coalesce(g.deleted, false) AS deleted
  FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.pos = g.pos),
edges AS (
  SELECT *, deleted AND NOT coalesce(lag(deleted) OVER (PARTITION BY doc_id ORDER BY pos), false) AS edge FROM every),
sums AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (deleted) AS n_removed, count(*) FILTER (edge) AS n_runs,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT deleted), '') AS kept
  FROM edges GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs,
       CASE WHEN d.text IS NOT NULL THEN sha256(kept) END AS kept_sha256
FROM documents d LEFT JOIN sums s ON d.doc_id = s.doc_id
"""
