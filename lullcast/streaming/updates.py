"""Next-day features from a stream of observations, with a versioned table as state.

Every micro-batch writes one table: the series it changed, their state afterwards, and the
features of each new observation. That write is the only one, so a batch has either happened
or not, and a batch that comes again finds its table and changes nothing. The state of a series
is the newest of its rows; every COMPACT_EVERY batches all series are written as a new base,
so that little has to be looked through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lullcast.functions import arrays
from lullcast.functions.names import column
from lullcast.operators.state import StateSpec, interval_columns, window_columns
from lullcast.operators.windows import INTERVAL_ROWS
from lullcast.schema import PanelSchema
from lullcast.workspace import is_complete

COMPACT_EVERY = 16
STATE = "last_ds date, n_obs bigint, n_ignored bigint, hist array<double>, ring array<double>"
STATE_COLUMNS = ["last_ds", "n_obs", "n_ignored", "hist", "ring"]


def feature_names(spec: StateSpec) -> list[str]:
    names = [f"lag_{n}" for n in spec.lags]
    names += [f"roll_{s}_{n}" for n in spec.windows for s in ("mean", "std", "min", "max")]
    if spec.intermittency:
        names += ["days_since_last_sale", "rolling_zero_count_7d", "avg_interdemand_interval"]
    return names


class FeatureTable:
    """Features and state of all series under one path.

    Rows may arrive in any order inside a batch and are applied by date, all of a series at
    once; of several rows of a day the first to be read counts. A row whose date is not after
    the series' last one is ignored and counted, rows without a key or date are dropped.
    """

    def __init__(self, path: str, schema: PanelSchema, spec: StateSpec | None = None):
        self.path, self.schema, self.spec = path.rstrip("/"), schema, spec or StateSpec()

    def start(self, rows: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Feed a stream; by default what there is now."""
        writer = rows.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def apply(self, rows: DataFrame, batch: int) -> None:
        """Apply batch number ``batch``, unless it was applied before. Batches come in order."""
        spark, target = rows.sparkSession, f"{self.path}/changes/batch={batch}"
        if not is_complete(spark, target):
            changed = self._changed(rows, batch)
            changed.write.mode("overwrite").parquet(target)
        if batch % COMPACT_EVERY == COMPACT_EVERY - 1:
            base = f"{self.path}/base/batch={batch}"
            if not is_complete(spark, base):
                self.state(spark, self._types(rows), batch).write.mode("overwrite").parquet(base)

    def _types(self, rows: DataFrame) -> StructType:
        kept = rows.select(*map(column, self.schema.keys)).schema
        return StructType([*kept, *StructType.fromDDL(STATE)])

    def state(self, spark: SparkSession, types: StructType, batch: int) -> DataFrame:
        """The state of every series after ``batch``."""
        base = batch - (batch + 1) % COMPACT_EVERY
        while base >= 0 and not is_complete(spark, f"{self.path}/base/batch={base}"):
            base -= COMPACT_EVERY
        tables = [f"{self.path}/changes/batch={b}" for b in range(max(base + 1, 0), batch + 1)]
        if base >= 0:
            tables.append(f"{self.path}/base/batch={base}")
        if not tables:
            return spark.createDataFrame([], types)
        found = spark.read.schema(types).parquet(*tables)
        found = found.withColumn("_batch", F.regexp_extract("_metadata.file_path", r"batch=(\d+)", 1).cast("bigint"))
        if len(tables) == 1:
            return found.select(types.names)
        newest = Window.partitionBy(*map(column, self.schema.keys)).orderBy(F.desc("_batch"))
        return found.withColumn("_k", F.row_number().over(newest)).where("_k = 1").select(types.names)

    def features(self, spark: SparkSession) -> DataFrame:
        """For each observation the features of the following row: keys, ``ds``, ``n_obs``,
        ``n_ignored`` and the features."""
        changes = spark.read.parquet(f"{self.path}/changes")
        return changes.select(*map(column, self.schema.keys), F.inline("rows"))

    def _changed(self, rows: DataFrame, batch: int) -> DataFrame:
        """One row per series of the batch: state afterwards and ``rows``, its features."""
        keys, types = [column(k) for k in self.schema.keys], self._types(rows)
        joined = self._by_series(rows).join(
            self.state(rows.sparkSession, types, batch - 1), self.schema.keys, "left"
        )
        hist, ring = (F.coalesce(c, F.array().cast("array<double>")) for c in ("hist", "ring"))
        known = joined.select(
            *keys,
            "last_ds",
            F.filter("days", lambda r: F.col("last_ds").isNull() | (r["ds"] > F.col("last_ds"))).alias("fresh"),
            F.size("days").alias("n_days"),
            "n_rows",
            F.coalesce("n_obs", F.lit(0).cast("bigint")).alias("n_obs"),
            F.coalesce("n_ignored", F.lit(0).cast("bigint")).alias("n_ignored"),
            hist.alias("hist"),
            ring.alias("ring"),
        )
        # the days left out are the first ones, as days are in order
        dropped = F.col("n_days") - F.size("fresh")
        before = F.coalesce(arrays.from_end(F.col("ring"), 1), F.lit(0.0))

        def since(r: Column, i: Column) -> Column:
            sale = r["sale"] - dropped
            return F.when(sale > 0, i + 1 - sale).otherwise(before + i + 1).cast("double")

        moved = known.select(
            *keys, "fresh", F.col("n_obs").alias("n_before"), "last_ds",
            (F.col("n_ignored") + F.col("n_rows") - F.size("fresh")).alias("n_ignored"),
            F.concat("hist", F.transform("fresh", lambda r: r["y"])).alias("values"),
            F.concat("ring", F.transform("fresh", since)).alias("rings"),
        )
        return moved.select(
            *keys,
            F.coalesce(arrays.from_end(F.col("fresh.ds"), 1), F.col("last_ds")).alias("last_ds"),
            (F.col("n_before") + F.size("fresh")).alias("n_obs"),
            "n_ignored",
            arrays.last_n(F.col("values"), self.spec.tail_rows).alias("hist"),
            arrays.last_n(F.col("rings"), INTERVAL_ROWS).alias("ring"),
            F.transform("fresh", self._row).alias("rows"),
        )

    def _by_series(self, rows: DataFrame) -> DataFrame:
        """One row per series: its days in order, with the place of the last sale so far, and
        how many rows it had. Rows of a day are combined before any shuffle."""
        keys = [column(k) for k in self.schema.keys]
        read = rows.select(
            *keys,
            column(self.schema.date).cast("date").alias("ds"),
            column(self.schema.target).cast("double").alias("y"),
            F.monotonically_increasing_id().alias("_at"),
        )
        for name in ("ds", *self.schema.keys):
            read = read.where(column(name).isNotNull())
        days = read.groupBy(*keys, "ds").agg(F.min_by("y", "_at").alias("y"), F.count("*").alias("n"))
        by_date = Window.partitionBy(*keys).orderBy("ds")
        placed = days.withColumn("place", F.row_number().over(by_date))
        sold = F.max(F.when(F.col("y") > 0, F.col("place"))).over(by_date)
        day = F.struct("ds", "y", F.coalesce("sale", F.lit(0)).alias("sale"))
        return placed.withColumn("sale", sold).groupBy(*keys).agg(
            F.array_sort(F.collect_list(day)).alias("days"), F.sum("n").alias("n_rows")
        )

    def _row(self, day: Column, i: Column) -> Column:
        """The features after the observation at place ``i`` of the fresh ones."""
        spec = self.spec
        end = F.size("values") - F.size("fresh") + i + 1
        ring_end = F.size("rings") - F.size("fresh") + i + 1
        recent, ring = _ending(F.col("values"), end, spec.window_rows), _ending(F.col("rings"), ring_end, INTERVAL_ROWS)

        def features(bound: Column) -> Column:
            known = window_columns(bound["recent"], spec.windows)
            if spec.intermittency:
                known |= interval_columns(bound["recent"], bound["ring"])
            for n in spec.lags:
                place = end - (n - 1)
                value = F.when(place >= 1, F.element_at("values", F.greatest(place, F.lit(1))))
                known[f"lag_{n}"] = F.coalesce(value, F.lit(0.0))
            fixed = [day["ds"].alias("ds"), (F.col("n_before") + i + 1).alias("n_obs"), F.col("n_ignored").alias("n_ignored")]
            return F.struct(*fixed, *(known[n].alias(n) for n in feature_names(spec)))

        # a list of one, so that the slices are made once for all features
        bound = F.array(F.struct(recent.alias("recent"), ring.alias("ring")))
        return F.transform(bound, features)[0]


def _ending(values: Column, end: Column, n: int) -> Column:
    """The ``n`` values that end at place ``end``, fewer if there are not so many."""
    return F.slice(values, F.greatest(end - (n - 1), F.lit(1)), F.least(end, F.lit(n)))
