"""The driver's star schema in the role of the housing tables.

Orders play the dated listings, lineitem gives the price and market columns,
customers the zip code and city, suppliers the location lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..operators.lookup import lookup_join

SETTINGS = Settings().with_(
    split={"eval_start": "1999-01-01", "holdout_start": "2001-01-01"},
    clean={
        "outlier_limit": 100_000.0,
        "city_mapping": {"NATION_3—EUROPE": "nation_8-europe", "nation_5-africa": "Nation_0–Africa"},
    },
)


# Column types of the driver's tables, so that no job infers them.
TYPES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TYPES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price and market columns per order. Money is summed exactly: price and
    discount have two decimals, their product is a whole number of 1/100 cents."""
    line = table(spark, sf_dir, "lineitem")
    paid = F.rint(F.col("l_extendedprice") * 100) * (100 - F.rint(F.col("l_discount") * 100))
    money = F.sum(paid.cast("bigint").cast("decimal(18,0)"))
    return line.groupBy("l_orderkey").agg(
        (money.cast("double") / 10000).alias("price"),
        F.max("l_extendedprice").alias("median_list_price"),
        F.min("l_extendedprice").alias("median_sale_price"),
        F.sum("l_quantity").alias("homes_sold"),
        F.count("*").cast("double").alias("inventory"),
    )


def listings_from_orders(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """Listings for a table or stream of orders.

    Names are dirty on purpose. Orders of unspecified priority have no list
    price. Pending orders are listed again 31 days later, equal in all but date
    and year. Orders without lines have no price.
    """
    customer = table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    place = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    columns = ["c_mktsegment", "n_name", "r_name"]
    rows = (
        lookup_join(orders, place, "o_custkey", "c_custkey", columns, SETTINGS.broadcast)
        .join(_order_lines(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .withColumn(
            "copy",
            F.explode(F.when(F.col("o_orderstatus") == "P", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
        )
        .withColumn("date", F.col("o_orderdate") + F.make_dt_interval(F.col("copy") * 31))
    )
    return rows.select(
        (F.col("o_orderkey") * 2 + F.col("copy")).alias("row_id"),
        "date",
        F.year("date").alias("year"),
        F.col("o_custkey").alias("zipcode"),
        F.col("c_mktsegment").alias("city"),
        F.concat(F.lit("  "), "n_name", F.lit("—"), "r_name", F.lit(" ")).alias("city_full"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("median_list_price")).alias(
            "median_list_price"
        ),
        "median_sale_price",
        "homes_sold",
        "inventory",
        "price",
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings_from_orders(spark, sf_dir, table(spark, sf_dir, "orders"))


def metros(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location lookup, one row per supplier, several per place; row order is the
    supplier key. The places of one region are left out."""
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    named = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return named.where(F.col("r_name") != "ASIA").select(
        F.col("s_suppkey").alias("row_id"),
        F.concat("n_name", F.lit("–"), "r_name", F.lit(", XX")).alias("metro_full"),
        (F.col("s_acctbal") / 100).alias("lat"),
        F.col("s_suppkey").cast("double").alias("lng"),
    )
