"""The raw tables, derived by Spark from the generic test tables.

``events`` stands for the heart-rate stream, ``customer`` and ``nation`` for the
users, the kinds of event for the activities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Kind of event, activity id, activity name.
ACTIVITIES = [
    ("click", 20470, "Sit"),
    ("error", 20683, "Run"),
    ("purchase", 20820, "Walk"),
    ("signup", 20596, "Sleep"),
    ("view", 20334, "HIIT"),
]
ACTIVITY_UPDATE = "2024-10-28T12:08:02Z"
USER_UPDATE = "2024-01-01T00:00:00Z"

# Accepted codes.
BLOOD_TYPES = ["A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-"]
RACES = ["W", "B", "A", "H", "O"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by_kind(position: int) -> Column:
    kind = F.col("event_type")
    result = F.when(kind == ACTIVITIES[0][0], ACTIVITIES[0][position])
    for row in ACTIVITIES[1:]:
        result = result.when(kind == row[0], row[position])
    return result


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def raw_heart_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    meta = F.to_json(F.struct(
        _by_kind(1).cast("bigint").alias("activity_id"),
        F.struct((k - 45).cast("double").alias("latitude"),
                 (k * 2 - 90).cast("double").alias("longitude")).alias("location")))
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id",
        (F.floor("value") % 166 + 40).cast("bigint").alias("heart_rate"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        meta.alias("meta"))


def raw_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "events").select("event_type").distinct()
            .select(_by_kind(1).cast("bigint").alias("activity_id"),
                    _by_kind(2).alias("activity_name"),
                    F.lit(ACTIVITY_UPDATE).alias("last_update")))


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    dob = (key % 65 + 1940) * 10000 + (key % 12 + 1) * 100 + (key % 28 + 1)
    code = F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))
    return (table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                key.alias("userid"),
                F.split_part("c_name", F.lit("#"), F.lit(1)).alias("fname"),
                F.split_part("c_name", F.lit("#"), F.lit(2)).alias("lname"),
                dob.cast("bigint").alias("dob"),
                F.when(key % 2 == 0, "F").otherwise("M").alias("sex"),
                (key % 50 + 150).cast("bigint").alias("height"),
                (key % 60 + 45).cast("bigint").alias("weight"),
                _pick(BLOOD_TYPES, key).alias("blood_type"),
                _pick(RACES, key).alias("race"),
                code.alias("origin_country_code"),
                F.col("n_name").alias("origin_country_name"),
                F.concat(F.col("c_name"), F.lit(", "), F.col("n_name")).alias("address"),
                code.alias("address_country_code"),
                F.col("n_name").alias("address_country_name"),
                F.lit(USER_UPDATE).alias("last_update")))


def user_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order of a customer counts as an update of that user's record."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("address"),
        F.col("o_orderstatus").alias("blood_type"),
        F.col("o_orderdate").cast("timestamp").alias("last_update"),
        F.to_date("o_orderdate").alias("update_day"),
        F.col("o_orderkey").alias("version"))


def user_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw user records as successive files bring them: each order is an update of its customer's
    address, on one of thirty days that the readings span; ``delivery`` is the file, 0 to 2, so that
    later files hold older updates too."""
    update = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 30).cast("int"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("userid"), F.col("o_orderpriority").alias("address"),
        F.date_format(update, "yyyy-MM-dd'T'00:00:00'Z'").alias("last_update"),
        (F.floor(F.col("o_orderkey") / 7) % 3).cast("int").alias("delivery"))
    people = raw_users(spark, sf_dir).drop("address", "last_update")
    return orders.join(people, "userid").select(*raw_users(spark, sf_dir).columns, "delivery")
