"""Reading behaviour logs and item sets (S1-S6), and the adapter from the ``events`` fixture."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.schema import ITEMS, LOG


@dataclass(frozen=True)
class DataFiles:
    """The files of a data folder."""

    logs: tuple[str, ...]
    items: str

    @staticmethod
    def in_folder(folder: str, logs: tuple[str, ...] = ("behavior_a.txt", "behavior_b.txt"), items: str = "items.txt") -> DataFiles:
        return DataFiles(tuple(f"{folder}/{x}" for x in logs), f"{folder}/{items}")


def require(spark: SparkSession, *paths: str) -> None:
    """Raises ``FileNotFoundError`` with all missing paths, on whatever file system they are."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        if not path.getFileSystem(conf).exists(path):
            missing.append(p)
    if missing:
        raise FileNotFoundError(", ".join(missing))


def _tsv(spark: SparkSession, schema, paths) -> DataFrame:
    # an empty field is read as missing; the text NA stays text
    return spark.read.schema(schema).csv(list(paths), sep="\t", header=False, nullValue="", quote="")


def read_log(spark: SparkSession, paths, rows_per_file: int | None = None) -> DataFrame:
    """The log files as one table; S4: ``rows_per_file`` caps each file, for trials."""
    require(spark, *paths)
    if rows_per_file is None:
        return _tsv(spark, LOG, paths)
    return reduce(DataFrame.unionByName, (_tsv(spark, LOG, [p]).limit(rows_per_file) for p in paths))


def sample_chunks(log: DataFrame, chunks: int, chunk_rows: int) -> DataFrame:
    """The first rows, for trials."""
    return log.limit(chunks * chunk_rows)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    require(spark, path)
    return _tsv(spark, ITEMS, [path])


def item_ids(items: DataFrame) -> DataFrame:
    """The distinct ids of the item subset."""
    return items.select("item_id").where("item_id IS NOT NULL").distinct()


#: Which event is which behaviour.
EVENT_BEHAVIOR = {"view": 1, "click": 2, "signup": 3, "purchase": 4}


def events_log(events: DataFrame) -> DataFrame:
    """The ``events`` fixture as a behaviour log, with its event_id."""
    kind = reduce(lambda c, x: c.when(F.col("event_type") == x[0], F.lit(x[1])), EVENT_BEHAVIOR.items(), F)
    return (
        events.where(F.col("event_type").isin(*EVENT_BEHAVIOR))
        .select(
            "event_id", "user_id", F.get_json_object("props", "$.k").cast("long").alias("item_id"), kind.cast("byte").alias("behavior_type"),
            F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.lit("g")).alias("user_geohash"),
            F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd HH").alias("time"),
        )
        .withColumn("item_category", (F.col("item_id") % 10).cast("int"))
    )


def events_items(log: DataFrame) -> DataFrame:
    """The item subset of the fixture: ids that 5 does not divide."""
    return log.select("item_id", F.lit(None).cast("string").alias("item_geohash"), "item_category").where("item_id % 5 <> 0").distinct()
