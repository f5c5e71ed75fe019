"""Schemas and fixed values of the behaviour log."""

from __future__ import annotations

from pyspark.sql import types as T

#: Behaviours, their weights, and the trailing windows in days.
CLICK, FAVOURITE, CART, PURCHASE = 1, 2, 3, 4
WEIGHTS = {CLICK: 1.0, FAVOURITE: 3.0, CART: 6.0, PURCHASE: 10.0}
WINDOWS = (1, 3, 7, 14)
NO_GAP = 99999
NO_CATEGORY = -1

LOG = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("item_id", T.LongType()), T.StructField("behavior_type", T.ByteType()),
    T.StructField("user_geohash", T.StringType()), T.StructField("item_category", T.IntegerType()), T.StructField("time", T.StringType()),
])
ITEMS = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("item_geohash", T.StringType()), T.StructField("item_category", T.IntegerType()),
])

#: The counts of a feature table, windows outside, behaviours inside: b1_1d, b2_1d, ...
COUNTS = tuple((f"b{b}_{w}d", b, w) for w in WINDOWS for b in WEIGHTS)
