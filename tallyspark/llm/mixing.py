"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a random key (the MD5 of its id and its text's MD5),
which orders its source.  The keys are uniform, also where ids are null or
repeat, so their first hex digits cut each source into ranges of equal
expected size, more of them where there are more rows; totals per range give the running sum
before each range, and a window inside the range completes the exact prefix
sum of words.  No task ever holds a source, and the windows hold numbers
only: other columns are joined back by the row.  A source's budget is then cut
exactly: whole epochs first, then every document up to the budget; the one
that crosses it contributes the words that are left.

Targets: the sources, in code-point order with null last, weigh 5, 2, 1,
repeating, and share ``share`` times all words; a target stops at
``max_epochs`` times its source's size, and the excess is reshared by weight
among the others until none is above.  Each round of that is one aggregate
over the table of sources.

Null texts have size 0, null sources are one source, an empty table has an
empty mix.  Rows that tie in key, id and size are interchangeable, so
reruns agree; rows alike in id and text share a key, so a range holds all of
them.  A source without words has target 0.  Only id, text and source are
read; other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.frames import WORD, keep

WEIGHTS = (5, 2, 1)
#: Fewest hex digits of the key that make a range (16^3 ranges in each source), and rows of a range.
RANGE_DIGITS, RANGE_ROWS = 3, 1 << 20


def numbered(df: DataFrame, *order, name: str = "number") -> DataFrame:
    """``df`` with a running number from 0 in the given order, distributed:
    range partitions are sorted and written, their counts summed up, and each
    row adds its place inside its partition."""
    ranged = keep(df.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("part").agg(F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    starts = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy(*order)
    return (ranged.join(starts, "part")
            .withColumn(name, F.col("base") + F.row_number().over(inside) - 1).drop("part", "base"))


def sized(docs: DataFrame, key_seed: str = "", *carried) -> DataFrame:
    """(doc_id, source, size, key): words and random key of each document."""
    return docs.select(
        *carried,
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(key_seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                       F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))).alias("key"))


def source_targets(rows: DataFrame, share: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """(source, source_size, target) of every source."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = numbered(sums, F.col("source").asc_nulls_last(), name="place")
    cycle = F.array(*[F.lit(w) for w in WEIGHTS])
    sources = keep(place.withColumn("weight", F.get(cycle, (F.col("place") % len(WEIGHTS)).cast("int")))
                   .withColumn("most", F.col("source_size") * max_epochs), "sources")
    goal = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:  # the words one unit of weight gets, rising as sources fill up
        full = F.col("most") <= level * F.col("weight")
        done = sources.agg(F.count(F.when(full, 1)).alias("n"),
                           F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0)).alias("words"),
                           F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("weight")).first()
        if done.n == capped or not done.weight:
            break
        capped, level = done.n, (goal - done.words) / done.weight
    return sources.select("source", "source_size",
                          F.least(F.lit(level) * F.col("weight"), F.col("most").cast("double")).alias("target"))


def mix(docs: DataFrame, share: float = 1.5, max_epochs: int = 2, key_seed: str = "",
        keep_columns: bool = False) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) per document.

    With ``keep_columns`` the columns of ``docs`` come first, unchanged, then
    size, source_size, target and taken, which replace columns so named.
    """
    added = ("size", "source_size", "target", "taken")
    kept = [c for c in docs.columns if c not in added] if keep_columns else []
    whole = [F.struct(*[f"`{c}`" for c in kept]).alias("whole")] if kept else []
    rows = keep(sized(docs, key_seed, *whole).withColumn("row", F.monotonically_increasing_id()), "sizes")
    wholes, rows = rows, rows.drop("whole")
    digits = max(RANGE_DIGITS, ((rows.count() // RANGE_ROWS).bit_length() + 3) // 4)
    targets = source_targets(rows, share, max_epochs)
    named = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))  # null and '' differ
    rows = rows.withColumn("named", named).withColumn("range", F.substring("key", 1, digits))
    before = Window.partitionBy("named").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    ranges = (rows.groupBy("named", "range").agg(F.sum("size").alias("words"))
              .withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
              .join(targets.withColumn("named", named).drop("source"), "named")
              .withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size")))
    inside = (Window.partitionBy("named", "range").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    prior = F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - prior))
    taken = (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken")
    out = rows.join(ranges, ["named", "range"]).withColumn("part", part)
    numbers = ["size", "source_size", "target", taken]
    if not kept:
        return out.select("doc_id", "source", *numbers)
    return (wholes.select("row", "whole").join(out.select("row", *numbers), "row")
            .select(*[F.col(f"whole.`{c}`") for c in kept], *added))


_RE = r"[^\x20\x09-\x0D]+"
#: The same in DuckDB, over plain windows.
ORACLE = rf"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_RE}')), 0) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM docs GROUP BY source),
filled AS (
  SELECT *, 1.5::DOUBLE * (SELECT sum(source_size) FROM sources)::DOUBLE
            - coalesce(sum(2 * source_size) OVER w, 0)::DOUBLE AS words_left,
         (SELECT sum(weight) FROM sources) - coalesce(sum(weight) OVER w, 0) AS weight_left
  FROM sources
  WINDOW w AS (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT words_left / weight_left::DOUBLE AS per_weight FROM filled
  WHERE words_left / weight_left::DOUBLE <= 2 * source_size / weight::DOUBLE
  ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size,
         least((SELECT per_weight FROM level) * weight, CAST(2 * source_size AS DOUBLE)) AS target
  FROM sources),
placed AS (
  SELECT doc_id, size, source_size, target,
         CAST(CASE WHEN source_size > 0 THEN floor(floor(target) / source_size) ELSE 0 END AS BIGINT) AS epochs,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - prior))
            AS BIGINT) AS taken
FROM placed
"""
