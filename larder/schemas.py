"""Declared schemas of the raw supply-chain tables, and a check against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column lists of the raw tables, as DDL. Fixed by the data model.
RAW_TABLES = {
    "suppliers": """supplier_id string, supplier_name string, region string,
        lead_time_days bigint, lead_time_std bigint, reliability_score double,
        unit_cost_multiplier double, min_order_qty bigint, payment_terms_days bigint""",
    "products": """sku string, product_name string, category string, unit_cost double,
        unit_weight_kg double, shelf_life_days bigint, is_hazardous boolean,
        abc_class string, unit_price double, safety_stock_days bigint""",
    "locations": """location_id string, location_type string, location_name string,
        region string, capacity_units_per_day bigint, operating_cost_per_day bigint""",
    "carriers": """carrier_id string, carrier_name string, mode string,
        cost_per_kg_km double, avg_transit_days bigint, on_time_rate double""",
    "supplier_product_map": """sku string, supplier_id string, is_primary boolean,
        supplier_sku string""",
    "sales": """date timestamp, store_id string, sku string, units_sold bigint,
        demand bigint, revenue double, is_promo boolean, stockout_flag boolean""",
    "demand_forecasts": """forecast_date timestamp, store_id string, sku string,
        forecast_qty bigint, actual_qty bigint""",
    "purchase_orders": """po_id string, supplier_id string, sku string, order_qty bigint,
        unit_cost double, order_date timestamp, expected_date timestamp,
        actual_date timestamp, status string, delay_days bigint""",
    "inventory": """snapshot_date timestamp, location_id string, sku string,
        on_hand_qty bigint, in_transit_qty bigint, backorder_qty bigint,
        inventory_value double""",
    "shipments": """shipment_id string, origin string, destination string,
        carrier_id string, sku string, qty bigint, weight_kg double,
        planned_ship_date timestamp, actual_ship_date timestamp,
        planned_delivery_date timestamp, actual_delivery_date timestamp,
        freight_cost double, status string""",
    "production_orders": """production_order_id string, plant_id string, sku string,
        planned_qty bigint, actual_qty bigint, planned_date timestamp,
        completion_date timestamp, yield_rate double, status string""",
}

# Columns that hold dates and may arrive as text.
DATE_COLUMNS = {
    "sales": ("date",),
    "demand_forecasts": ("forecast_date",),
    "purchase_orders": ("order_date", "expected_date", "actual_date"),
    "inventory": ("snapshot_date",),
    "shipments": (
        "planned_ship_date",
        "actual_ship_date",
        "planned_delivery_date",
        "actual_delivery_date",
    ),
    "production_orders": ("planned_date", "completion_date"),
}


def raw_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(RAW_TABLES[table])


def missing_columns(df: DataFrame, table: str) -> list[str]:
    """Declared columns that ``df`` lacks (metadata only, no job)."""
    return [f.name for f in raw_schema(table) if f.name not in df.columns]


def conform(df: DataFrame, table: str, strict: bool = True) -> DataFrame:
    """Cast to the declared types; extra columns pass through untouched.

    Text that cannot be read as the declared type becomes NULL, which the quality
    rules then count. Columns that are absent are an error only when ``strict``.
    """
    absent = missing_columns(df, table)
    if absent and strict:
        raise ValueError(f"{table} lacks {', '.join(absent)}")
    declared = {f.name: f.dataType for f in raw_schema(table)}
    return df.select(
        *(
            F.col(c).try_cast(declared[c]).alias(c) if c in declared else F.col(c)
            for c in df.columns
        )
    )
