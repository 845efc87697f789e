"""JSON records and messages, and price candles.

* ``to_messages``: rows to ``key``/``value`` JSON messages, the shape a
  Kafka sink writes (``df.write.format("kafka")``).
* ``parse_records``: flat JSON records to typed columns.
* ``shape_candles``: 12-element candle arrays to named, typed columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_date


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """One JSON object per row in ``value`` (all columns), ``key`` as text."""
    value = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    key_col = F.col(f"`{key}`").cast("string") if key else F.lit(None).cast("string")
    return df.select(key_col.alias("key"), value.alias("value"))


RECORD_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType(), True),
    T.StructField("date", T.StringType(), True),
    T.StructField("price_daily", T.DoubleType(), True),
    T.StructField("volume_daily", T.DoubleType(), True),
    T.StructField("trades_daily", T.IntegerType(), True),
])


def parse_records(df: DataFrame, schema: T.StructType = RECORD_SCHEMA, value_col: str = "value",
                  date_cols: tuple = ("date",), date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Parse one flat JSON record per message; date text to ``date``
    (unparsable dates become null).  Messages that are not JSON objects, or
    carry none of the fields, are dropped."""
    parsed = df.select(F.inline(F.array(
        F.from_json(F.col(value_col).cast("string"), schema))))
    parsed = parsed.where(F.coalesce(*[F.col(f"`{f.name}`").cast("string")
                                       for f in schema.fields]).isNotNull())
    for c in date_cols:
        parsed = parsed.withColumn(c, parse_date(F.col(c), date_format))
    return parsed


# Positions in an exchange candle array.
CANDLE_OPEN_TIME = 0
CANDLE_HIGH = 2
CANDLE_LOW = 3
CANDLE_CLOSE = 4
CANDLE_CLOSE_TIME = 6
CANDLE_QUOTE_VOLUME = 7
CANDLE_TRADES = 8


def shape_candles(df: DataFrame, candle_col: str = "candle", symbol_col: str = "symbol") -> DataFrame:
    """Candle arrays (strings or numbers) to ``symbols, lastPrice, highPrice,
    lowPrice, quoteVolume, count, date, hour``; date and hour come from the
    close time (epoch milliseconds, session time zone)."""
    c = F.col(candle_col)
    close_time = F.timestamp_millis(c[CANDLE_CLOSE_TIME].cast("bigint"))
    return df.select(
        F.col(symbol_col).alias("symbols"),
        c[CANDLE_CLOSE].cast("double").alias("lastPrice"),
        c[CANDLE_HIGH].cast("double").alias("highPrice"),
        c[CANDLE_LOW].cast("double").alias("lowPrice"),
        c[CANDLE_QUOTE_VOLUME].cast("double").alias("quoteVolume"),
        c[CANDLE_TRADES].cast("int").alias("count"),
        F.date_format(close_time, "yyyy-MM-dd").alias("date"),
        F.hour(close_time).alias("hour"),
    )
