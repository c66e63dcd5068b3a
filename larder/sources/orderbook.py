"""Supply-chain views over an order-book star schema.

The supplied tables (``lineitem orders part supplier nation region``) hold the same
business facts under other names. Each method maps them, lazily, to one table of
the supply-chain model. Dimension tables grow with the data, so no join here is
hinted: the size-checked automatic broadcast and AQE choose the strategy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import exact_sum

_DAY = "date"


# Prices have two decimals and discounts are whole percents, so the product is a whole
# number of ten-thousandths; dividing once gives the double nearest the exact amount.
_LINE_REVENUE = "rint(l_extendedprice * 100) * (100 - rint(l_discount * 100)) / 10000D"
_LINE_DEMAND = """CAST(l_quantity AS BIGINT)
    + CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END"""


class OrderBook:
    """The supply-chain tables, derived from the files in one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- facts ---------------------------------------------------------------

    def sales_line(self) -> DataFrame:
        """One row per order line; no shuffle."""
        return self.table("lineitem").selectExpr(
            f"CAST(l_shipdate AS DATE) AS {_DAY}",
            "l_suppkey AS store_id",
            "l_partkey AS sku",
            "CAST(l_quantity AS BIGINT) AS units_sold",
            f"{_LINE_DEMAND} AS demand",
            f"{_LINE_REVENUE} AS revenue",
            "l_discount >= 0.09D AS is_promo",
            "l_returnflag = 'R' AS stockout_flag",
        )

    def sales_daily(self) -> DataFrame:
        """Daily grain: unique on (sku, store_id, ds).

        Lines are summed per product, supplier and day before the dimensions are joined,
        so however many lines one product has, a join sees a row per supplier and day.
        """
        lines = self.table("lineitem").selectExpr(
            "l_partkey",
            "l_suppkey",
            "CAST(l_shipdate AS DATE) AS ds",
            "CAST(l_quantity AS BIGINT) AS units_sold",
            f"{_LINE_DEMAND} AS demand",
            f"{_LINE_REVENUE} AS revenue",
            "l_discount >= 0.09D AS is_promo",
        )
        summed = lines.groupBy("l_partkey", "l_suppkey", "ds").agg(*self._daily_sums())
        brand = self.table("part").selectExpr("p_partkey AS l_partkey", "p_brand AS sku")
        nation = self.table("supplier").selectExpr(
            "s_suppkey AS l_suppkey", "s_nationkey AS store_id"
        )
        return (
            summed.join(brand, "l_partkey")
            .join(nation, "l_suppkey")
            .groupBy("sku", "store_id", "ds")
            .agg(*self._daily_sums())
            .withColumn("stockout_flag", F.col("demand") > F.col("units_sold"))
        )

    @staticmethod
    def _daily_sums() -> list[Column]:
        return [
            F.sum("units_sold").alias("units_sold"),
            F.sum("demand").alias("demand"),
            exact_sum("revenue").alias("revenue"),
            F.max("is_promo").alias("is_promo"),
        ]

    def purchase_orders(self) -> DataFrame:
        lines = self.table("lineitem").selectExpr(
            "l_orderkey",
            "l_linenumber",
            "l_suppkey AS supplier_id",
            "l_partkey AS sku",
            "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS order_qty",
            "l_extendedprice / l_quantity AS unit_cost",
            "CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS actual_date",
            "CAST(l_shipdate AS DATE) AS ship_date",
        )
        headers = self.table("orders").selectExpr(
            "o_orderkey AS l_orderkey",
            "CAST(o_orderdate AS DATE) AS order_date",
            "date_add(CAST(o_orderdate AS DATE), 30) AS expected_date",
        )
        return lines.join(headers, "l_orderkey").selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber) AS po_id",
            "supplier_id",
            "sku",
            "order_qty",
            "unit_cost",
            "order_date",
            "expected_date",
            "actual_date",
            "ship_date",
        )

    def inventory(self) -> DataFrame:
        """Stock positions, with missing counts on every seventh line."""
        return self.table("lineitem").selectExpr(
            "CAST(date_trunc('week', l_shipdate) AS DATE) AS snapshot_date",
            "l_suppkey AS location_id",
            "l_partkey AS sku",
            """CASE WHEN l_linenumber = 7 THEN NULL
               ELSE (CAST(l_quantity AS BIGINT) - 1) * 2 END AS on_hand_qty""",
            "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber * 5 END AS in_transit_qty",
            "CASE WHEN l_tax >= 0.07D THEN NULL ELSE l_linenumber - 1 END AS backorder_qty",
            "l_extendedprice AS inventory_value",
        )

    def shipments(self) -> DataFrame:
        """Flows from the supplier's nation to the customer's nation.

        Orders meet their customers before the lines, so lines are moved for one join only.
        """
        lines = self.table("lineitem").selectExpr(
            "l_orderkey",
            "l_suppkey",
            "l_partkey AS sku",
            "CAST(l_quantity AS BIGINT) AS qty",
            "CAST(l_shipdate AS DATE) AS actual_ship_date",
        )
        headers = self.table("orders").selectExpr(
            "o_orderkey AS l_orderkey", "o_custkey", "CAST(o_orderdate AS DATE) AS planned_ship_date"
        )
        origin = self.table("supplier").selectExpr(
            "s_suppkey AS l_suppkey", "s_nationkey AS origin"
        )
        target = self.table("customer").selectExpr(
            "c_custkey AS o_custkey", "c_nationkey AS destination"
        )
        addressed = headers.join(target, "o_custkey")
        return (
            lines.join(addressed, "l_orderkey")
            .join(origin, "l_suppkey")
            .select("origin", "destination", "sku", "qty", "planned_ship_date", "actual_ship_date")
        )

    # -- dimensions ----------------------------------------------------------

    def products(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS sku",
            "p_name AS product_name",
            "p_type AS category",
            "p_retailprice * (50 + p_size % 40) / 100.0D AS unit_cost",
            "p_size * 0.1D AS unit_weight_kg",
            "CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size * 7 END AS shelf_life_days",
            "p_size > 45 AS is_hazardous",
            "CASE WHEN p_size <= 10 THEN 'A' WHEN p_size <= 25 THEN 'B' ELSE 'C' END AS abc_class",
            "p_retailprice AS unit_price",
            "3 + p_size % 12 AS safety_stock_days",
        )

    def suppliers(self) -> DataFrame:
        nation = self.table("nation").selectExpr(
            "n_nationkey AS s_nationkey", "n_regionkey AS r_regionkey"
        )
        region = self.table("region")
        return (
            self.table("supplier")
            .join(nation, "s_nationkey")
            .join(region, "r_regionkey")
            .selectExpr(
                "s_suppkey AS supplier_id",
                "s_name AS supplier_name",
                "r_name AS region",
                "5 + s_suppkey % 25 AS lead_time_days",
                "1 + s_suppkey % 5 AS lead_time_std",
                """CASE WHEN s_suppkey % 17 = 0 THEN NULL
                   ELSE (60 + s_suppkey % 40) / 100.0D END AS reliability_score""",
                "1 + (s_suppkey % 10) / 10.0D AS unit_cost_multiplier",
                "10 * (1 + s_suppkey % 10) AS min_order_qty",
                "CASE WHEN s_acctbal < 0 THEN 15 ELSE 30 END AS payment_terms_days",
            )
        )

    def locations(self) -> DataFrame:
        region = self.table("region").selectExpr("r_regionkey AS n_regionkey", "r_name AS region")
        return (
            self.table("nation")
            .join(region, "n_regionkey")
            .selectExpr(
                "n_nationkey AS location_id",
                """CASE n_nationkey % 5 WHEN 0 THEN 'PLANT' WHEN 1 THEN 'DC'
                   ELSE 'STORE' END AS location_type""",
                "n_name AS location_name",
                "region",
                "1000 + 100 * n_nationkey AS capacity_units_per_day",
            )
        )

    def supplier_product_map(self) -> DataFrame:
        """Which supplier serves which product; the lowest key is the primary one."""
        pairs = (
            self.table("lineitem")
            .select(F.col("l_partkey").alias("sku"), F.col("l_suppkey").alias("supplier_id"))
            .distinct()
        )
        primary = pairs.groupBy("sku").agg(F.min("supplier_id").alias("primary_id"))
        return pairs.join(primary, "sku").select(
            "sku",
            "supplier_id",
            (F.col("supplier_id") == F.col("primary_id")).alias("is_primary"),
            F.concat_ws("_", "supplier_id", "sku").alias("supplier_sku"),
        )
