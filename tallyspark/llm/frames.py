"""Small DataFrame helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tallyspark
from tallyspark.session import shared_path

#: Word separators of the contracts: space, tab, line feed to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) only: other columns, whatever their names, stay out of
    the operator's plan.  The id is a long, the text a string."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))


def _ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that
    Python tasks can import it wherever they run."""
    sc = spark.sparkContext
    home = os.path.dirname(os.path.abspath(tallyspark.__file__))
    if getattr(sc, "_tallyspark_sent", False) or not os.path.isdir(home):
        return
    stem = os.path.join(tempfile.mkdtemp(prefix="tallyspark-send-"), "tallyspark_package")
    sc.addPyFile(shutil.make_archive(stem, "zip", os.path.dirname(home), os.path.basename(home)))
    sc._tallyspark_sent = True


def arrow_map(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with this package at hand in the tasks."""
    _ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back.

    This cuts the lineage at a place that outlives executors; the folder is
    the one named in ``spark.checkpoint.dir``.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def smallest_hashes(ids: DataFrame, size: int) -> DataFrame:
    """The ``size`` rows of (doc_id, ...) with the smallest hash of their id.

    Hashes above a cut that leaves a few rows too many go first, so that the
    final sort holds about ``size`` rows in all, however many there are.
    """
    total = ids.count()
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    if total > size:
        spare = size + 6 * size ** 0.5 + 100
        ids = ids.where(place < int(min(1.0, spare / total) * (1 << 40)))
    return ids.orderBy(place, *ids.columns).limit(size)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def fold_py(doc_id: int, parts: int) -> int:
    """The same on the driver, for tests."""
    return zlib.crc32(str(doc_id).encode()) % parts


def other_key(key: Column) -> Column:
    """An equally distinct long key under which a grouped table is dealt out
    anew.  Joined on it, both sides get a shuffle of their own, which the
    adaptive planner can split where a key is hot; a join on the grouping
    key itself would reuse the grouping's partitions and can't be split."""
    return F.bitwise_not(key)
