"""Feature views, point-in-time (as-of) joins, online tables, materialization.

Definitions (entity, source, view) are small Python objects; every data
step is a DataFrame plan.

As-of join at scale
-------------------
The textbook plan - union entity and feature rows, then a window per key
carrying the last feature row forward - puts every row of a key in one
task.  A key holding a third of the rows would make one straggler task
sort a third of the data.  ``asof_join`` splits time into buckets
(default: one day) and partitions by (key, bucket):

1. small step: per (key, bucket) the newest feature row (an aggregate,
   combined map-side) and the buckets that hold entity rows; per key,
   ordered by bucket, each entity bucket gets the newest feature row of
   the strictly earlier buckets (rows per key = number of buckets, bounded
   by the time span, not by the key's row count);
2. one shuffle of entity rows, feature rows and those carried-in rows by
   (key, bucket); a ``last(..., ignorenulls)`` window in time order gives
   each entity row its newest feature row at or before its time.

A key may hold much of the table in one bucket.  The heavy groups (the
``SHARES`` largest ones of more than ``HEAVY`` rows; any other holds less than
one in ``SHARES`` of all rows, or few) are cut into parts in time: rows are counted per (key, slot), a slot being a
``SLOTS``-th of a bucket, and a new part begins where a running count passes
the limit.  Parts take the buckets' place in both steps, with the same carry.
The counting is a job of its own when the join is built; at most ``SHARES``
groups are heavy, so the table of their parts is bounded, and without a heavy
group the buckets stay as they are.

No pair of rows within a key is ever formed, nothing is joined back, and
entity rows (including duplicates) pass through untouched.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.dates import as_timestamp
from ..sources.tables import read_snapshot, write_snapshot
from .features import keep_last

# Feature value types a view can declare, and their Spark types.
DTYPES = {
    "Int32": T.IntegerType(),
    "Int64": T.LongType(),
    "Float32": T.FloatType(),
    "Float64": T.DoubleType(),
    "String": T.StringType(),
    "Bool": T.BooleanType(),
    "UnixTimestamp": T.TimestampType(),
}

ENTITY_TS = "event_timestamp"


@dataclass(frozen=True)
class Entity:
    name: str
    join_keys: tuple[str, ...]
    description: str = ""


@dataclass(frozen=True)
class Field:
    name: str
    dtype: str

    @property
    def spark_type(self) -> T.DataType:
        return DTYPES[self.dtype]


@dataclass(frozen=True)
class FeatureSource:
    """Named table + format + the column that timestamps each row."""
    name: str
    path: str | None = None
    fmt: str = "parquet"
    timestamp_field: str | None = None
    options: tuple = ()

    def load(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format(self.fmt)
        for k, v in self.options:
            reader = reader.option(k, v)
        return reader.load(self.path)


@dataclass(frozen=True)
class FeatureView:
    name: str
    entities: tuple[Entity, ...]
    schema: tuple[Field, ...]
    source: FeatureSource | None = None
    ttl: dt.timedelta | None = None
    online: bool = True
    timestamp_field: str | None = field(default=None)
    # A row stamped t is treated as visible from t + availability_delay (a
    # daily feature dated d is computed from data through the end of d).
    availability_delay: dt.timedelta | None = None

    @property
    def join_keys(self) -> list[str]:
        return [k for e in self.entities for k in e.join_keys]

    @property
    def ts_field(self) -> str | None:
        if self.timestamp_field:
            return self.timestamp_field
        return self.source.timestamp_field if self.source else None

    @property
    def feature_names(self) -> list[str]:
        return [f.name for f in self.schema if f.name not in self.join_keys]

    def field(self, name: str) -> Field:
        for f in self.schema:
            if f.name == name:
                return f
        raise KeyError(f"feature {name!r} is not in view {self.name!r}")

    def project(self, df: DataFrame, features: list[str] | None = None) -> DataFrame:
        """Keys, the timestamp column and the declared fields, cast to the
        declared types (Float32 keeps float precision: 60.1 -> 60.0999985)."""
        names = features or self.feature_names
        cols = [F.col(k) for k in self.join_keys]
        if self.ts_field:
            cols.append(F.col(self.ts_field))
        cols += [F.col(n).cast(self.field(n).spark_type).alias(n) for n in names]
        return df.select(*cols)

    def visible(self, df: DataFrame) -> DataFrame:
        """The timestamp column as the time the row became visible."""
        if not self.availability_delay or not self.ts_field:
            return df
        delay_us = int(self.availability_delay.total_seconds() * 1_000_000)
        ts = F.timestamp_micros(F.unix_micros(as_timestamp(F.col(self.ts_field))) + F.lit(delay_us))
        return df.withColumn(self.ts_field, ts)

    def validate(self, df: DataFrame) -> DataFrame:
        """One row per required column: present, actual type, castable."""
        return validate_schema(df, self)


def check_values(df: DataFrame, view: FeatureView) -> DataFrame:
    """One row per declared key and feature that the table has: rows, nulls,
    and values that the declared type cannot hold (they would turn null).
    One pass over the table; needs the columns to be present."""
    fields = [(k, "key", T.StringType()) for k in view.join_keys]
    fields += [(f.name, "feature", f.spark_type) for f in view.schema if f.name not in view.join_keys]
    sums = df.agg(F.count(F.lit(1)).alias("n_rows"), *[
        x for i, (name, _, t) in enumerate(fields) for x in (
            F.count_if(F.col(name).isNull()).alias(f"null_{i}"),
            F.count_if(F.col(name).isNotNull() & F.col(name).try_cast(t).isNull()).alias(f"bad_{i}"))])
    rows = F.array(*[F.struct(F.lit(name).alias("column"), F.lit(role).alias("role"),
                              F.lit(t.simpleString()).alias("expected_type"), F.col("n_rows"),
                              F.col(f"null_{i}").alias("n_null"), F.col(f"bad_{i}").alias("n_uncastable"))
                     for i, (name, role, t) in enumerate(fields)])
    return sums.select(F.inline(rows))


def validate_schema(df: DataFrame, view: FeatureView) -> DataFrame:
    """Check a table against a view (driver-side: reads the schema only).

    Returns rows ``column, role, expected_type, actual_type, present,
    castable`` as a small DataFrame; nothing of the data is read.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    rows = []
    wanted = [(k, "key", None) for k in view.join_keys]
    if view.ts_field:
        wanted.append((view.ts_field, "timestamp", None))
    wanted += [(f.name, "feature", f.spark_type) for f in view.schema
               if f.name not in view.join_keys]
    for name, role, t in wanted:
        a = actual.get(name)
        present = a is not None
        if role == "timestamp":
            ok = present and isinstance(a, (T.DateType, T.TimestampType, T.TimestampNTZType,
                                            T.StringType))
        elif role == "key":
            ok = present and isinstance(a, (T.StringType, T.IntegerType, T.LongType))
        else:
            ok = present and _castable(a, t)
        rows.append((name, role, t.simpleString() if t else None,
                     a.simpleString() if a else None, present, ok))
    schema = ("column string, role string, expected_type string, actual_type string, "
              "present boolean, castable boolean")
    return df.sparkSession.createDataFrame(rows, schema)


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def _castable(a: T.DataType, t: T.DataType) -> bool:
    if isinstance(t, _NUMERIC):
        return isinstance(a, _NUMERIC)
    if isinstance(t, T.StringType):
        return True
    if isinstance(t, T.BooleanType):
        return isinstance(a, (T.BooleanType,) + _NUMERIC)
    return type(a) is type(t)


def resolve(refs: list[str], views: list[FeatureView]) -> list[tuple[FeatureView, str]]:
    """``"view:feature"`` references to (view, feature) in request order."""
    by_name = {v.name: v for v in views}
    out = []
    for r in refs:
        if ":" not in r:
            raise ValueError(f"feature reference {r!r} is not 'view:feature'")
        vname, fname = r.split(":", 1)
        if vname not in by_name:
            raise KeyError(f"unknown feature view {vname!r}")
        view = by_name[vname]
        view.field(fname)
        out.append((view, fname))
    return out


#: Heavy groups of the as-of join: least number of rows, and the greatest number of groups.
HEAVY, SHARES = 100_000, 4096
#: Slots of a bucket in which rows are counted.
SLOTS = 96


def _slot(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000 / SLOTS)).cast("bigint")


def _heavy_parts(rows: DataFrame, kcols: list[str], heavy: int) -> DataFrame:
    """(keys, __day, __starts): the slots where the parts of each heavy
    (key, bucket) begin.  ``rows`` has the keys and ``__slot`` of every row of
    both sides."""
    counts = rows.groupBy(*kcols, "__slot").agg(F.count(F.lit(1)).alias("__n"))
    days = (counts.withColumn("__day", F.floor(F.col("__slot") / SLOTS))
            .groupBy(*kcols, "__day").agg(F.sum("__n").alias("__total"),
                                          F.sort_array(F.collect_list(F.struct("__slot", "__n"))).alias("__slots")))
    # Running count: (slots that begin a part, rows of the part so far); a part ends before it passes the limit.
    begin = F.struct(F.array().cast("array<bigint>").alias("starts"), F.lit(heavy).cast("bigint").alias("rows"))
    step = lambda acc, x: F.when(
        acc["rows"] + x["__n"] > heavy,
        F.struct(F.concat(acc["starts"], F.array(x["__slot"])).alias("starts"), x["__n"].alias("rows"))).otherwise(
        F.struct(acc["starts"].alias("starts"), (acc["rows"] + x["__n"]).alias("rows")))
    return (days.where(F.col("__total") > heavy).orderBy(F.desc("__total")).limit(SHARES)
            .select(*kcols, "__day", F.aggregate("__slots", begin, step)["starts"].alias("__starts")))


def _in_parts(df: DataFrame, parts: DataFrame | None, kcols: list[str]) -> DataFrame:
    """Adds ``__b``: the slot that a row's group begins with, that of its
    bucket or of its part."""
    df = df.withColumn("__day", F.floor(F.col("__slot") / SLOTS))
    start = F.col("__day") * SLOTS
    if parts is not None:
        df = df.join(F.broadcast(parts), [*kcols, "__day"], "left")
        part = F.array_max(F.filter("__starts", lambda x: x <= F.col("__slot")))
        start = F.coalesce(part, start)
    return df.withColumn("__b", start).drop("__slot", "__day", "__starts")


def asof_join(entity: DataFrame, features: DataFrame, keys: list[str], entity_ts: str,
              feature_ts: str, columns: list[str], ttl: dt.timedelta | None = None,
              bucket_seconds: int = 86400, prefix: str = "", heavy: int = HEAVY) -> DataFrame:
    """Left as-of join: every entity row gets the newest feature row of its key
    with ``feature_ts <= entity_ts`` (and ``>= entity_ts - ttl`` when a TTL is
    set), or nulls.  Output: entity columns, then ``columns`` in order.

    Ties at one feature timestamp resolve to the greatest feature values.
    """
    ecols = entity.columns
    kcols = [f"__k{i}" for i in range(len(keys))]
    e = entity.select(*[F.col(f"`{c}`") for c in ecols], *[F.col(k).alias(kc) for k, kc in zip(keys, kcols)],
                      as_timestamp(F.col(entity_ts)).alias("__ts"))
    # Entity rows without a key or a time match nothing: they skip the windows.
    can_match = F.col("__ts").isNotNull()
    for k in kcols:
        can_match = can_match & F.col(k).isNotNull()
    alone = e.where(~can_match)
    e = e.where(can_match).withColumn("__slot", _slot(F.col("__ts"), bucket_seconds))
    # Null keys never match (as in a join): such feature rows are dropped.
    present = F.col(feature_ts).isNotNull()
    for k in keys:
        present = present & F.col(k).isNotNull()
    f = (features.where(present)
         .select(*[F.col(k).alias(kc) for k, kc in zip(keys, kcols)],
                 as_timestamp(F.col(feature_ts)).alias("__fts"), *[F.col(c) for c in columns]))
    f = f.select(*kcols, _slot(F.col("__fts"), bucket_seconds).alias("__slot"),
                 F.struct(F.col("__fts").alias("__fts"), *[F.col(c) for c in columns]).alias("__f"))
    found = _heavy_parts(e.select(*kcols, "__slot").union(f.select(*kcols, "__slot")), kcols, heavy)
    few = found.collect()  # SHARES rows of SLOTS numbers at most
    parts = e.sparkSession.createDataFrame(few, found.schema) if few else None
    e, f = _in_parts(e, parts, kcols), _in_parts(f, parts, kcols)

    ftype = f.schema["__f"].dataType

    # Level 2 first, on small data: per (key, bucket) the newest feature row
    # (combined map-side), and the buckets that hold entity rows.  Per key,
    # ordered by bucket, each entity bucket receives the newest feature row
    # of the strictly earlier buckets (entity markers sort first in a bucket).
    summary = f.groupBy(*kcols, "__b").agg(F.max("__f").alias("__f")) \
        .withColumn("__side", F.lit(1))
    need = (e.select(*kcols, "__b").distinct()
            .withColumn("__side", F.lit(0)).withColumn("__f", F.lit(None).cast(ftype)))
    w2 = (Window.partitionBy(*kcols).orderBy("__b", "__side")
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carry = (need.unionByName(summary)
             .withColumn("__f", F.last("__f", ignorenulls=True).over(w2))
             .where((F.col("__side") == 0) & F.col("__f").isNotNull())
             .select(*kcols, "__b", F.lit(None).cast("timestamp").alias("__ts"),
                     F.lit(0).alias("__side"), "__f"))

    # Level 1: one window per (key, bucket) over the carried-in row (first),
    # the bucket's feature rows and its entity rows in time order; feature
    # rows sort before entity rows at the same instant (feature_ts ==
    # entity_ts is a match).  The last non-null feature row is the answer.
    e1 = e.select(*[F.col(f"`{c}`") for c in ecols], "__ts", "__b", *kcols,
                  F.lit(2).alias("__side"), F.lit(None).cast(ftype).alias("__f"))
    f1 = f.select(*kcols, "__b", F.col("__f.__fts").alias("__ts"), F.lit(1).alias("__side"), "__f")
    u = e1.unionByName(f1, allowMissingColumns=True).unionByName(carry, allowMissingColumns=True)
    w1 = (Window.partitionBy(*kcols, "__b").orderBy(F.col("__ts").asc_nulls_first(), "__side", "__f")
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = (u.withColumn("__hit", F.last("__f", ignorenulls=True).over(w1))
              .where(F.col("__side") == 2))
    best = F.col("__hit")
    if ttl is not None:
        ttl_us = int(ttl.total_seconds() * 1_000_000)
        lo = F.unix_micros(F.col("__ts")) - F.lit(ttl_us)
        best = F.when(F.unix_micros(best["__fts"]) >= lo, best)
    out = joined.withColumn("__best", best).select(
        *[F.col(f"`{c}`") for c in ecols], *[F.col("__best")[c].alias(prefix + c) for c in columns])
    return out.union(alone.select(
        *[F.col(f"`{c}`") for c in ecols],
        *[F.lit(None).cast(features.schema[c].dataType).alias(prefix + c) for c in columns]))


def _as_frame(rows, frames: dict) -> DataFrame:
    """Entity rows as given by callers - a DataFrame, a pandas frame or a
    list of dicts (a handful of keys for an online read) - as a DataFrame."""
    if isinstance(rows, DataFrame):
        return rows
    spark = next((f.sparkSession for f in frames.values()), None) or SparkSession.active()
    if isinstance(rows, list):
        import pandas as pd
        rows = pd.DataFrame(rows)
    return spark.createDataFrame(rows)


def _check_names(plan, entity_columns: list[str], full: bool) -> None:
    """Every output column has one meaning."""
    names = [f"{v.name}__{f}" if full else f for v, f in plan]
    twice = sorted({n for n in names if names.count(n) > 1 or n in entity_columns})
    if twice:
        raise ValueError(f"feature names used twice or taken by entity columns: {twice}; "
                         "ask for full_feature_names")


def get_historical_features(entity_df: DataFrame, refs: list[str],
                            sources: dict[str, DataFrame] | None, views: list[FeatureView],
                            entity_ts: str = ENTITY_TS, full_feature_names: bool = False,
                            bucket_seconds: int = 86400) -> DataFrame:
    """Training rows: entity rows + requested features as of each row's time.

    ``sources`` maps view name -> the view's source DataFrame; a view that is
    not in it is read from its registered source.  Requested features must
    not share a name with one another or with an entity column (use
    ``full_feature_names``).  A string ``event_timestamp`` is cast to timestamp.  Views without a timestamp
    column are joined on the keys alone, one row per key (the greatest when
    the source repeats a key), so entity rows are never multiplied.
    Output: entity columns, then the features in request order.
    """
    plan = resolve(refs, views)
    sources = sources or {}
    entity_df = _as_frame(entity_df, sources)
    _check_names(plan, entity_df.columns, full_feature_names)
    out = entity_df
    if isinstance(entity_df.schema[entity_ts].dataType, T.StringType):
        out = out.withColumn(entity_ts, as_timestamp(F.col(entity_ts)))
    order = []
    by_view: dict[str, list[str]] = {}
    for view, fname in plan:
        by_view.setdefault(view.name, []).append(fname)
        order.append(f"{view.name}__{fname}" if full_feature_names else fname)
    vmap = {v.name: v for v in views}
    for vname, fnames in by_view.items():
        view = vmap[vname]
        table = sources[vname] if vname in sources else view.source.load(out.sparkSession)
        src = view.visible(view.project(table, fnames))
        prefix = f"{vname}__" if full_feature_names else ""
        if view.ts_field:
            out = asof_join(out, src, view.join_keys, entity_ts, view.ts_field, fnames,
                            ttl=view.ttl, bucket_seconds=bucket_seconds, prefix=prefix)
        else:
            # One row per key, so entity rows are never multiplied: a source
            # with several rows for a key contributes its greatest row.
            packed = F.struct(*[F.col(n) for n in fnames])
            right = (src.where(F.col(view.join_keys[0]).isNotNull())
                     .groupBy(*view.join_keys).agg(F.max(packed).alias("__r"))
                     .select(*view.join_keys, *[F.col("__r")[n].alias(prefix + n) for n in fnames]))
            out = out.join(right, on=view.join_keys, how="left")
    base = [c for c in out.columns if c not in order]
    return out.select(*[F.col(f"`{c}`") for c in base], *order)


# --- Online table -----------------------------------------------------------

#: The run that wrote an online row: among rows of one time the later run's wins.
RUN = "materialization_run"


def newest_rows(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Newest row per key by ``ts``, of the latest run where rows carry one;
    ties go to the greatest values."""
    order = [ts, RUN] if RUN in df.columns else [ts]
    return keep_last(df, keys, order + [c for c in df.columns if c not in keys and c not in order])


def online_rows(view: FeatureView, source: DataFrame, end=None, start=None) -> DataFrame:
    """Newest projected row per key with ``start < ts <= end``."""
    ts = view.ts_field
    if ts is None:
        raise ValueError(f"view {view.name!r} has no timestamp column; it cannot be "
                         "materialized (mark it online=False)")
    rows = view.visible(view.project(source))
    if start is not None:
        rows = rows.where(F.col(ts) > F.lit(start))
    if end is not None:
        rows = rows.where(F.col(ts) <= F.lit(end))
    return newest_rows(rows, view.join_keys, ts)


def merge_online(current: DataFrame | None, fresh: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Upsert ``fresh`` into ``current``: per key the newer row wins, so a
    late-arriving older row never replaces a newer one.  At one time the row
    of the later run wins, so a correction replaces what it corrects, whether
    its values are greater or smaller."""
    if current is None:
        return fresh
    return newest_rows(current.unionByName(fresh), keys, ts)


def _runs_path(online_path: str) -> str:
    return f"{online_path}.runs"


def materialization_runs(spark: SparkSession, online_path: str) -> DataFrame:
    """One row per materialization into an online table: run, view, start, end."""
    schema = "run long, view string, start timestamp, end timestamp"
    try:
        return spark.read.schema(schema).parquet(_runs_path(online_path))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stored_end(spark: SparkSession, online_path: str, before: dt.datetime | None = None) -> dt.datetime | None:
    """The greatest end (before a time) that the online table was materialized to."""
    runs = materialization_runs(spark, online_path)
    if before is not None:
        runs = runs.where(F.col("end") < F.lit(before))
    return runs.agg(F.max("end")).first()[0]


def _moment(value) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.fromisoformat(value)


def materialize(spark: SparkSession, view: FeatureView, online_path: str, end,
                source: DataFrame | None = None, start="stored") -> int | None:
    """Materialize a view into its online table.

    Rows with ``start < ts <= end`` are reduced to the newest per key, marked
    with the number of this run, merged with the table and written as its
    next snapshot.  ``start="stored"`` goes on from the greatest end of
    earlier runs that is before this one, so a run for an end that was
    reached already reads its slice again and takes corrections in: a row
    replaces that of an earlier run with the same time, never a newer one.  A
    row that the corrected source no longer has stays online.
    ``start=None`` reads everything up to ``end``.  ``source`` defaults to
    the view's registered source.  Views with ``online=False`` are skipped.
    Returns the run's number (None when skipped).
    """
    if not view.online:
        return None
    end = _moment(end)
    start = stored_end(spark, online_path, before=end) if start == "stored" else start
    runs = materialization_runs(spark, online_path)
    run = (runs.agg(F.max("run")).first()[0] or 0) + 1
    rows = source if source is not None else view.source.load(spark)
    fresh = online_rows(view, rows, end=end, start=start).withColumn(RUN, F.lit(run).cast("long"))
    write_snapshot(merge_online(read_snapshot(spark, online_path), fresh, view.join_keys, view.ts_field), online_path)
    row = [(run, view.name, _moment(start) if start is not None else None, end)]
    spark.createDataFrame(row, runs.schema).write.mode("append").parquet(_runs_path(online_path))
    return run


def materialize_all(spark: SparkSession, views: list[FeatureView], online_root: str, end,
                    sources: dict[str, DataFrame] | None = None, start="stored") -> dict[str, int]:
    """``materialize`` for several views, each into ``<root>/<view name>``."""
    return {v.name: materialize(spark, v, f"{online_root}/{v.name}", end, (sources or {}).get(v.name), start)
            for v in views if v.online}


def read_online(spark: SparkSession, online_path: str) -> DataFrame | None:
    """The online table, one row per key, with the run that wrote it."""
    return read_snapshot(spark, online_path)


def get_online_features(online: dict[str, DataFrame], entity_keys: DataFrame, refs: list[str],
                        views: list[FeatureView], full_feature_names: bool = False) -> DataFrame:
    """Online read: one output row per entity key row, newest values or null.

    The big online table is semi-joined with the key list first (the key
    side is the build side, broadcast when AQE measures it small), and only
    the matched rows are left-joined back to the keys.
    """
    plan = resolve(refs, views)
    entity_keys = _as_frame(entity_keys, online)
    _check_names(plan, entity_keys.columns, full_feature_names)
    out = entity_keys
    vmap = {v.name: v for v in views}
    by_view: dict[str, list[str]] = {}
    order = []
    for view, fname in plan:
        by_view.setdefault(view.name, []).append(fname)
        order.append(f"{view.name}__{fname}" if full_feature_names else fname)
    for vname, fnames in by_view.items():
        view = vmap[vname]
        keys = view.join_keys
        prefix = f"{vname}__" if full_feature_names else ""
        table = online[vname]
        wanted = entity_keys.select(*keys).distinct()
        hits = table.join(wanted, on=keys, how="left_semi") \
            .select(*keys, *[F.col(n).alias(prefix + n) for n in fnames])
        out = out.join(hits, on=keys, how="left")
    base = [c for c in out.columns if c not in order]
    return out.select(*base, *order)
