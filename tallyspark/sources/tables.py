"""File and table sources and sinks.

Reads always take an explicit schema where the format would otherwise
infer one (CSV, JSON): inference is an extra full pass over the input.
Writes of daily tables use dynamic partition overwrite, so re-running a
day replaces exactly that day's partitions and nothing else.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the data sources.
FORMATS = ("parquet", "delta", "csv", "json", "text", "orc")


def delta_available(spark: SparkSession) -> bool:
    """Whether the Delta data source is on the classpath."""
    try:
        spark._jvm.java.lang.Class.forName("io.delta.sql.DeltaSparkSessionExtension")
        return True
    except Exception:  # noqa: BLE001
        return False


class MissingFormat(RuntimeError):
    """Raised when a table format is asked for whose data source is absent."""


def table_format(spark: SparkSession, fmt: str) -> str:
    """``fmt`` itself, checked: reading or writing a Delta folder as plain
    Parquet would bring removed rows back, so ``delta`` without its data
    source is an error."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}")
    if fmt == "delta" and not delta_available(spark):
        raise MissingFormat("format 'delta' needs the Delta data source on the classpath")
    return fmt


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None, header: bool = True,
               options: dict | None = None) -> DataFrame:
    """Read a table or files: parquet, delta, csv, json, text or orc.  CSV and
    JSON should be given a ``schema``."""
    fmt = table_format(spark, fmt)
    reader = spark.read.format(fmt)
    if schema is not None and fmt != "text":
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", header)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path)


def write_partitions(df: DataFrame, path: str, by: str | list[str] = "date",
                     fmt: str = "parquet", options: dict | None = None) -> None:
    """Idempotent overwrite of the partitions present in ``df``.

    ``partitionOverwriteMode=dynamic`` is set on this writer only (not
    the session): partitions absent from ``df`` are left as they are, so a
    run for one day can be repeated safely.  An empty ``df`` changes
    nothing.  No repartition by the partition column: a daily run holds a
    single date, and hashing on it would send the whole day to one task.
    Each task writes its own file per date it holds (the writer sorts
    locally by the partition columns); ``maxRecordsPerFile`` can cap sizes.
    """
    spark = df.sparkSession
    fmt = table_format(spark, fmt)
    cols = [by] if isinstance(by, str) else list(by)
    writer = (df.write.format(fmt).mode("overwrite")
              .option("partitionOverwriteMode", "dynamic").partitionBy(*cols))
    if fmt == "delta":  # fixed values: table properties
        writer = writer.option("delta.columnMapping.mode", "name") \
            .option("delta.minReaderVersion", "2").option("delta.minWriterVersion", "5")
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save(path)


def drop_partition(spark: SparkSession, path: str, column: str, value, fmt: str = "parquet") -> None:
    """Remove one partition (e.g. a day whose rows were all deleted, which
    ``write_partitions`` with an empty frame would leave in place).  A Delta
    table is changed through its log, never by removing its files."""
    if table_format(spark, fmt) == "delta":
        spark.sql(f"DELETE FROM delta.`{path}` WHERE `{column}` = '{value}'")
        return
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}")
    fs = p.getFileSystem(conf)
    if fs.exists(p):
        fs.delete(p, True)


SNAPSHOT = "snapshot"


def _snapshots(spark: SparkSession, path: str) -> tuple[DataFrame | None, int]:
    """The table of all snapshots and the newest one's number (None, -1 before the first)."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None, -1
        raise
    return table, table.agg(F.max(SNAPSHOT)).first()[0]


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest snapshot of a table that ``write_snapshot`` wrote, or None."""
    table, newest = _snapshots(spark, path)
    return None if table is None else table.where(F.col(SNAPSHOT) == newest).drop(SNAPSHOT)


def write_snapshot(df: DataFrame, path: str, kept: int = 2) -> int:
    """Write ``df`` as the next snapshot of a table that is rebuilt as a whole,
    possibly from itself: a partition of its own, one number above the
    newest, so what is being read is never overwritten, and a partition shows
    only when its write commits.  The last ``kept`` snapshots stay.  Returns
    the number; an empty ``df`` leaves the table as it is."""
    spark = df.sparkSession
    number = _snapshots(spark, path)[1] + 1
    write_partitions(df.withColumn(SNAPSHOT, F.lit(number)), path, SNAPSHOT)
    drop_partition(spark, path, SNAPSHOT, number - kept)
    return number


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, header: bool = True,
                options: dict | None = None) -> None:
    """Plain write (static overwrite, append, …) in any file format."""
    spark = df.sparkSession
    fmt = table_format(spark, fmt)
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", header)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save(path)


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` at an optional location."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                   schema: str | None = None, partitioned_by: list[str] | None = None) -> None:
    """External table over existing files, if it does not exist yet.

    With a partitioned layout the partitions are discovered afterwards
    (``MSCK REPAIR``), so the catalog sees every date folder.
    """
    fmt = table_format(spark, fmt)
    cols = f" ({schema})" if schema else ""
    parts = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by and schema else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name}{cols} USING {fmt}{parts} LOCATION '{path}'")
    if partitioned_by and fmt != "delta":
        spark.sql(f"MSCK REPAIR TABLE {name}")


# Operations of the table log that write rows.
WRITE_OPERATIONS = ("STREAMING UPDATE", "WRITE")


def newest_operations(history: DataFrame, n: int = 5) -> DataFrame:
    """The newest ``n`` operations of a table log, whatever they are."""
    return (history.select("version", "timestamp", "operation", "operationParameters")
            .orderBy(F.col("version").desc()).limit(n))


def last_checkpoint(history: DataFrame) -> DataFrame:
    """The newest batch or streaming write and the checkpoint folder that it
    names (null when it names none): at most one row."""
    return (history.where(F.col("operation").isin(list(WRITE_OPERATIONS)))
            .orderBy(F.col("version").desc()).limit(1)
            .select("version", "operation",
                    F.try_element_at("operationParameters", F.lit("checkpointLocation"))
                    .alias("checkpoint_location")))


def table_history(spark: SparkSession, path: str) -> DataFrame:
    """The log of a Delta table, for ``newest_operations`` and
    ``last_checkpoint``."""
    if not delta_available(spark):
        raise MissingFormat("table history needs the Delta data source")
    return spark.sql(f"DESCRIBE HISTORY delta.`{path}`")


class ResultTooLarge(RuntimeError):
    """Raised instead of pulling an unbounded result into the driver."""


def to_pandas(df: DataFrame, max_rows: int):
    """``toPandas`` for results that are known to be small (online reads,
    previews): at most ``max_rows + 1`` rows are computed and fetched, once,
    and a larger result is an error."""
    out = df.limit(max_rows + 1).toPandas()
    if len(out) > max_rows:
        raise ResultTooLarge(f"result has more than {max_rows} rows; write it to a table instead")
    return out


def from_pandas(spark: SparkSession, pdf, schema=None) -> DataFrame:
    """pandas frame to Spark (Arrow transfer when enabled on the session)."""
    return spark.createDataFrame(pdf, schema=schema)
