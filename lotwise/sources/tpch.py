"""A ``listings`` view over the order-line test tables, in the raw listing layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.params import Params

# Shipping years run from 1995 to 2001. The forest is small on these tables, for all queries
# alike: their prices do not depend on the predictors, so more or deeper trees show nothing
# more and only make a run of every query longer.
TPCH_PARAMS = Params(
    min_year=1995,
    age_year=2002,
    order_buckets=10_007,
    rf_trees=20,
    rf_depth=8,
    rf_grid_trees=(5, 10, 15),
    rf_grid_subsets=("2", "3", "4", "5"),
)


def listings(spark: SparkSession, sf_dir: str, spread_out: bool = False) -> DataFrame:
    """``spread_out``: a caller's choice for tables in fewer files than there are cores; where
    the files give every core a task, their rows are not moved."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").drop("l_discount", "l_tax")
    if spread_out and lineitem.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        lineitem = lineitem.repartition("l_orderkey", "l_linenumber")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        "p_partkey", "p_brand", "p_type", "p_size"
    )
    c = F.col
    cents = F.round(c("l_extendedprice") * 100).cast("bigint")
    ship_year = F.year("l_shipdate")
    slot = c("l_orderkey") * 7 + c("l_linenumber")
    km = (2002 - ship_year) * 12000 + c("l_quantity").cast("bigint") * 997
    row_id = F.concat_ws(
        "-",
        *[c(k).cast("string") for k in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
        cents.cast("string"),
    )
    return lineitem.join(part, c("l_partkey") == c("p_partkey")).select(
        row_id.alias("id"),
        F.concat(F.lit("/listing/"), row_id).alias("link"),
        (slot * 1000003 + c("l_partkey") * 1009 + c("l_suppkey") + cents * 31).alias("id_num"),
        c("p_brand").alias("make"),
        c("p_type").alias("model"),
        F.concat(F.lit("T"), (c("p_size") % 3).cast("string")).alias("trim"),
        (4 + 2 * (c("p_size") % 2)).alias("cylinder"),
        c("l_returnflag").alias("gear_type"),
        c("l_linestatus").alias("personal"),
        ship_year.alias("year"),
        (slot % 23).alias("likes"),
        F.when((c("l_linenumber") == 7) & (c("l_orderkey") % 50 == 0), "call")
        .otherwise(F.format_number(F.floor(c("l_extendedprice") * 4), 0))
        .alias("price_raw"),
        F.when(c("l_quantity") == 50, None)
        .when(c("l_quantity") == 49, "0 Km")
        .otherwise(F.concat(F.format_number(km, 0), F.lit(" Km")))
        .alias("mileage_raw"),
        F.when(c("l_linenumber") % 4 == 0, F.date_format("l_shipdate", "dd/MM/yyyy"))
        .when(c("l_linenumber") % 4 == 1, F.concat((c("l_orderkey") % 23 + 1).cast("string"), F.lit(" hours ago")))
        .when(c("l_linenumber") % 4 == 2, F.concat((c("l_orderkey") % 59 + 1).cast("string"), F.lit(" minutes ago")))
        .otherwise("yesterday")
        .alias("time"),
    )


def order_bucket() -> Column:
    """Order key of the split on these tables: plain integer arithmetic on the row id."""
    return (F.col("id_num") * 7919 + 123) % 10007
