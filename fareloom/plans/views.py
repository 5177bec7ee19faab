"""Trips, zones and news views derived from the star-schema tables and the event table.

Everything is a join or a projection; nothing here shuffles by a key that the
tables do not already join on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Unique row key of ``trips`` and the weights that split and fold rows by it.
TRIP_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
SPLIT_WEIGHTS = {"l_orderkey": 31, "l_partkey": 17, "l_linenumber": 1}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _divides(column: str, divisor: int) -> Column:
    return F.col(column) % divisor == 0


def trips(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """One trip per order line.

    Orders and customers are joined first, so the large line table is
    shuffled by order and never by customer. Once suppliers are too many to be
    sent to all tasks, it is shuffled by supplier as well.

    With ``parts`` trips lie in that many partitions by hash of ``l_orderkey``: the join
    with orders comes last and shuffles into them. Spark raises a join's partitions to
    the session's number, so fewer take a shuffle of their own.
    """
    few = parts and parts < int(spark.conf.get("spark.sql.shuffle.partitions"))
    riders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    of_order, of_supplier = (
        F.col("l_orderkey") == F.col("o_orderkey"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    lines, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    if parts and not few:
        lines = lines.join(supplier, of_supplier).repartition(parts, "l_orderkey")
        lines = lines.join(riders.repartition(parts, "o_orderkey"), of_order)
    else:
        lines = lines.join(riders, of_order).join(supplier, of_supplier)
    second_of_day = (
        F.col("l_orderkey") * 7919 + F.col("l_partkey") * 104729 + F.col("l_linenumber") * 1009
    ) % 86400
    ride_seconds = (
        F.col("l_partkey") * 31 + F.col("l_suppkey") * 17 + F.col("l_linenumber") * 101
    ) % 5400 - 60
    tolled = _divides("l_suppkey", 10)
    incomplete = _divides("l_orderkey", 20)
    timed = lines.withColumn(
        "tpep_pickup_datetime", F.timestamp_add("SECOND", second_of_day, F.col("o_orderdate"))
    )
    made = timed.select(
        *TRIP_KEY,
        "tpep_pickup_datetime",
        F.timestamp_add("SECOND", ride_seconds, F.col("tpep_pickup_datetime")).alias(
            "tpep_dropoff_datetime"
        ),
        F.when(_divides("l_orderkey", 97), 264)
        .otherwise(F.col("c_nationkey"))
        .cast("int")
        .alias("PULocationID"),
        F.when(_divides("l_partkey", 89), 265)
        .otherwise(F.col("s_nationkey"))
        .cast("int")
        .alias("DOLocationID"),
        F.when(~incomplete, F.col("l_linenumber")).alias("passenger_count"),
        (F.col("l_suppkey") % 2 + 1).cast("int").alias("VendorID"),
        (F.col("l_partkey") % 5).cast("int").alias("payment_type"),
        F.when(_divides("l_partkey", 53), 0.0)
        .otherwise(F.col("l_quantity") * 0.4)
        .alias("trip_distance"),
        (3.0 + F.col("l_quantity")).alias("fare_amount"),
        (F.col("l_discount") * 50.0).alias("tip_amount"),
        (F.col("l_tax") * 10.0).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.when(tolled, 6.0).otherwise(0.0).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        F.lit(2.5).alias("congestion_surcharge"),
        F.when(~incomplete, F.when(tolled, 1.75).otherwise(0.0)).alias("airport_fee"),
        (
            3.0
            + F.col("l_quantity")
            + F.col("l_discount") * 50.0
            + F.col("l_tax") * 10.0
            + 4.0
            + F.when(tolled, 7.75).otherwise(0.0)
        ).alias("total_amount"),
    )
    return made.repartition(parts, "l_orderkey") if few else made


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations 264 and 265 are absent, so some trips have an unknown zone."""
    return (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").alias("LocationID"),
            F.col("r_name").alias("Borough"),
            F.col("n_name").alias("Zone"),
        )
    )


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News views, about 167 a minute, their time rebuilt from the event number."""
    number = F.col("event_id")
    kind = F.col("event_type")
    device = F.array(F.lit("mobile"), F.lit("desktop"), F.lit("tablet"))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        number,
        F.when(number % 7 == 0, "bot_user_0")
        .when(number % 8 == 1, "bot_user_1")
        .otherwise(F.concat(F.lit("user_"), F.col("user_id")))
        .alias("user_id"),
        F.when(number % 6 == 0, "article_hot")
        .otherwise(F.concat(F.lit("article_"), number % 83))
        .alias("article_id"),
        F.timestamp_add("SECOND", F.floor(number * 36.0 / 100.0), start).alias("timestamp"),
        F.when(kind == "purchase", "finance")
        .when(kind == "view", "sports")
        .when(kind == "click", "politics")
        .when(kind == "signup", "culture")
        .otherwise("science")
        .alias("category"),
        F.concat(F.lit("country_"), F.col("user_id") % 11).alias("location"),
        F.get(device, (number % 3).cast("int")).alias("device_type"),
        F.concat(
            F.lit("s_"), F.col("user_id"), F.lit("_"), F.floor(number / 500.0).cast("long")
        ).alias("session_id"),
    )
