"""The match table, derived from the order tables.

One row per order: the first line of the order plays the home side, the second the away side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
               "l_shipdate")

# The derivation of every column, as SQL text over one order
# (o_*, c_name, n_name) and its two lines (h_*, a_*).
_PLAYED = "o_orderstatus <> 'O'"
_PRICED = "o_orderkey % 9 < 7"
COLUMN_SQL = {
    "match_id": "o_orderkey",
    "date": "cast(cast(o_orderdate as date) as string)",
    "league": "n_name",
    "home_team": "h_s_name",
    "away_team": "a_s_name",
    "home_goals": "cast(floor((coalesce(h_l_quantity, 20) + o_orderkey * 7919 % 50) / 24) as double)",
    "away_goals": "cast(floor((coalesce(a_l_quantity, 20) + o_orderkey * 104729 % 40) / 24) as double)",
    "ht_home_goals": "CASE WHEN o_orderkey % 6 <> 0 THEN cast(o_orderkey % 2 as double) END",
    "ht_away_goals": "CASE WHEN o_orderkey % 6 <> 0 THEN cast(o_custkey % 2 as double) END",
    "referee": "CASE WHEN o_orderpriority = '1-URGENT' THEN c_name END",
    "odds_home": "CASE WHEN o_orderkey % 997 = 0 THEN 0.0e0 "
                 f"WHEN {_PRICED} THEN 1.05e0 + floor(h_l_extendedprice % 400) / 100e0 END",
    "odds_draw": f"CASE WHEN {_PRICED} THEN 2.1e0 + floor(o_totalprice % 300) / 100e0 END",
    "odds_away": f"CASE WHEN {_PRICED} THEN 1.05e0 + floor(a_l_extendedprice % 600) / 100e0 END",
    "odds_over_25": "CASE WHEN o_orderkey % 4 = 0 THEN 1.3e0 + floor(o_totalprice % 150) / 100e0 END",
    "odds_under_25": "CASE WHEN o_orderkey % 4 = 0 THEN 1.3e0 + floor(o_totalprice % 170) / 100e0 END",
    "home_shots": f"CASE WHEN {_PLAYED} THEN cast(h_l_quantity as double) END",
    "away_shots": f"CASE WHEN {_PLAYED} THEN cast(a_l_quantity as double) END",
    "home_shots_target": f"CASE WHEN {_PLAYED} THEN "
                         "cast(floor(h_l_quantity * (0.3e0 + 2 * h_l_discount)) as double) END",
    "away_shots_target": f"CASE WHEN {_PLAYED} THEN "
                         "cast(floor(a_l_quantity * (0.3e0 + 2 * a_l_discount)) as double) END",
    "home_corners": f"CASE WHEN {_PLAYED} THEN cast(floor(h_l_tax * 100) as double) END",
    "away_corners": f"CASE WHEN {_PLAYED} THEN cast(floor(a_l_tax * 100) as double) END",
    "home_fouls": f"CASE WHEN {_PLAYED} AND o_orderkey % 50 <> 0 THEN cast(h_p_size as double) END",
    "away_fouls": f"CASE WHEN {_PLAYED} AND o_orderkey % 50 <> 0 THEN cast(a_p_size as double) END",
    "home_yellow": f"CASE WHEN {_PLAYED} THEN cast(h_l_linenumber - 1 as double) END",
    "away_yellow": f"CASE WHEN {_PLAYED} THEN cast(a_l_linenumber - 1 as double) END",
    "home_red": f"CASE WHEN {_PLAYED} THEN cast(CASE WHEN h_l_partkey % 10 = 0 THEN 1 "
                "WHEN h_l_partkey IS NOT NULL THEN 0 END as double) END",
    "away_red": f"CASE WHEN {_PLAYED} THEN cast(CASE WHEN a_l_partkey % 10 = 0 THEN 1 "
                "WHEN a_l_partkey IS NOT NULL THEN 0 END as double) END",
    "season": "cast(year(o_orderdate) as string)",
    "source": "o_orderstatus",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 28-column match table plus its key ``match_id``.

    ``lineitem`` is cut to two rows per order before anything is joined to it. The rank filter
    also runs on the map side, so an order with very many lines ships at most two per task.
    The lookups carry no hint: Spark broadcasts them only below its own size threshold.
    """
    line_rank = F.row_number().over(
        Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
    lines = (table(spark, sf_dir, "lineitem")
             .select("l_orderkey", "l_discount", "l_tax", *LINE_ORDER)
             .withColumn("side", line_rank)
             .filter("side <= 2")
             .join(table(spark, sf_dir, "part").selectExpr("p_partkey AS l_partkey", "p_size"),
                   "l_partkey", "left")
             .join(table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS l_suppkey", "s_name"),
                   "l_suppkey", "left"))
    sides = lines.groupBy("l_orderkey").agg(*[
        F.max(F.when(F.col("side") == rank, F.col(c))).alias(f"{side}_{c}")
        for rank, side in ((1, "h"), (2, "a"))
        for c in ("s_name", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                  "l_linenumber", "l_partkey", "p_size")])
    orders = (table(spark, sf_dir, "orders")
              .join(table(spark, sf_dir, "customer").selectExpr(
                  "c_custkey AS o_custkey", "c_name", "c_nationkey"), "o_custkey")
              .join(table(spark, sf_dir, "nation").selectExpr(
                  "n_nationkey AS c_nationkey", "n_name"), "c_nationkey"))
    return (orders.join(sides, orders.o_orderkey == sides.l_orderkey, "left")
            .selectExpr(*[f"{sql} AS `{name}`" for name, sql in COLUMN_SQL.items()]))
