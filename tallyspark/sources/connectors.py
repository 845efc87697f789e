"""Message-bus and database connectors: option builders plus the readers
and writers around them.

The Kafka and JDBC data sources need jars that a cluster provides; the
option dictionaries are built (and tested) here independently, and every
downstream operator takes any DataFrame with a ``value`` column, so files
or tables can stand in for a topic.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class TopicConfig:
    bootstrap_servers: str
    topic: str
    starting_offsets: str = "earliest"
    ending_offsets: str | None = None
    starting_timestamp: int | None = None
    max_offsets_per_trigger: int | None = None
    extra: tuple = ()


def kafka_read_options(cfg: TopicConfig, streaming: bool = False) -> dict:
    opts = {
        "kafka.bootstrap.servers": cfg.bootstrap_servers,
        "subscribe": cfg.topic,
        "startingOffsets": cfg.starting_offsets,
    }
    if cfg.starting_timestamp is not None:
        # Start from a time instead of the whole retention (bounded re-reads).
        opts.pop("startingOffsets")
        opts["startingTimestamp"] = str(cfg.starting_timestamp)
    if cfg.ending_offsets and not streaming:
        opts["endingOffsets"] = cfg.ending_offsets
    if cfg.max_offsets_per_trigger and streaming:
        opts["maxOffsetsPerTrigger"] = str(cfg.max_offsets_per_trigger)
    opts.update(dict(cfg.extra))
    return opts


def read_changes(spark: SparkSession, cfg: TopicConfig) -> DataFrame:
    """The topic as a bounded table (``key``, ``value``, ``timestamp``, …)."""
    return spark.read.format("kafka").options(**kafka_read_options(cfg)).load()


def read_messages(spark: SparkSession, source: TopicConfig | str) -> DataFrame:
    """Change messages as a ``value`` column, from a topic or from files with
    one message per line (exported topics, tests)."""
    if isinstance(source, TopicConfig):
        return read_changes(spark, source).select("value")
    return spark.read.text(source)


# Producer settings of the message sink (all replicas
# acknowledge, three retries, gzip batches).
PRODUCER_DEFAULTS = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.compression.type": "gzip",
    "kafka.linger.ms": "10",
    "kafka.batch.size": "16384",
}


def kafka_write_options(cfg: TopicConfig, **overrides) -> dict:
    opts = {"kafka.bootstrap.servers": cfg.bootstrap_servers, "topic": cfg.topic}
    opts.update(PRODUCER_DEFAULTS)
    opts.update({k: str(v) for k, v in overrides.items()})
    return opts


def write_messages(messages: DataFrame, cfg: TopicConfig, **overrides) -> None:
    """Write a ``key``/``value`` frame (see ``records.to_messages``) to a topic."""
    messages.write.format("kafka").options(**kafka_write_options(cfg, **overrides)).save()


@dataclass(frozen=True)
class JdbcConfig:
    url: str
    table: str
    user: str | None = None
    password: str | None = None
    driver: str = "org.postgresql.Driver"
    fetch_size: int = 10000
    batch_size: int = 10000


def jdbc_read_options(cfg: JdbcConfig, partition_column: str | None = None,
                      lower: int | None = None, upper: int | None = None,
                      num_partitions: int | None = None) -> dict:
    """Options for a JDBC read.  With a numeric ``partition_column`` and its
    bounds the table is read by ``num_partitions`` parallel range queries
    instead of one connection."""
    opts = {"url": cfg.url, "dbtable": cfg.table, "driver": cfg.driver,
            "fetchsize": str(cfg.fetch_size)}
    if cfg.user is not None:
        opts["user"] = cfg.user
    if cfg.password is not None:
        opts["password"] = cfg.password
    if partition_column:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("partitioned JDBC reads need lower, upper and num_partitions")
        opts.update({"partitionColumn": partition_column, "lowerBound": str(lower),
                     "upperBound": str(upper), "numPartitions": str(num_partitions)})
    return opts


def read_jdbc(spark: SparkSession, cfg: JdbcConfig, **partitioning) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_read_options(cfg, **partitioning)).load()


def jdbc_write_options(cfg: JdbcConfig, column_types: str | None = None) -> dict:
    opts = {"url": cfg.url, "dbtable": cfg.table, "driver": cfg.driver,
            "batchsize": str(cfg.batch_size)}
    if cfg.user is not None:
        opts["user"] = cfg.user
    if cfg.password is not None:
        opts["password"] = cfg.password
    if column_types:
        opts["createTableColumnTypes"] = column_types
    return opts


def append_jdbc(df: DataFrame, cfg: JdbcConfig, column_types: str | None = None) -> None:
    """Append rows to a database table (created with ``column_types`` if new)."""
    df.write.format("jdbc").mode("append").options(**jdbc_write_options(cfg, column_types)).save()
