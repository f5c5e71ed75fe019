"""The history kept up from a stream: daily partials, rolled up for any target day (A8, section 2.11).

A micro-batch is reduced to partials by (user, item, category, behaviour, day,
hour) and written to its own folder, named by the batch's number, so a batch that
is run again overwrites what it wrote. Sums and minima of partials are those of
all rows: feature tables and scores for a target day come from the partials.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.scalars import day, days_before, hour, hours_gap
from skein.operators import history

KEYS = ("user_id", "item_id", "item_category", "behavior_type", "date", "hour")


def partials(log: DataFrame) -> DataFrame:
    rows = log.select(
        "user_id", "item_id", "item_category", F.col("behavior_type").cast("int").alias("behavior_type"),
        day(F.col("time")).alias("date"), hour(F.col("time")).alias("hour"),
    )
    return rows.groupBy(*KEYS).agg(F.count("*").alias("n"))


def maintain(stream: DataFrame, path: str, checkpoint: str):
    """A running query that keeps partials below ``path``; ends when what is there now has been read."""

    def write(batch: DataFrame, number: int) -> None:
        partials(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch")


def history_of(kept: DataFrame, target: str, lookback: int = 14) -> DataFrame:
    """Partials before a target day with ``days``, ``gap`` and ``n``; feed to ``features_of_daily``."""
    day_of = F.lit(target).cast("date")
    inside = kept.where((F.col("date") >= F.date_format(F.date_sub(day_of, lookback), "yyyy-MM-dd")) & (F.col("date") < target))
    days = days_before(F.col("date"), target)
    return inside.withColumn("days", days).withColumn("gap", hours_gap(days, F.col("hour")))


scores_of = history.scores_of_daily


def windowed_counts(stream: DataFrame, watermark: str = "1 day", window: str = "1 day") -> DataFrame:
    """Behaviours by event-time window with late rows bounded by a watermark; ``stream`` has ``ts`` and ``event_type``."""
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    return timed.groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"))


def first_of_each(stream: DataFrame, keys: list[str], watermark: str = "1 day") -> DataFrame:
    """Streaming dedup within a watermark."""
    return stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark).dropDuplicatesWithinWatermark(keys)
