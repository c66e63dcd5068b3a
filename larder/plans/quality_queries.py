"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions import round_to
from larder.operators import quality, staging
from larder.plans.registry import isum, pct, query, r
from larder.session import stage
from larder.sources.layers import path_exists

# The raw tables that the order book provides; carriers have no counterpart there.
RAW_NAMES = ("suppliers", "products", "locations", "sales", "inventory")
RAW_VIEWS = dict(zip(RAW_NAMES, ("suppliers", "products", "locations", "sales_line", "inventory")))


def raw_tables(w) -> dict:
    """The raw tables that are there, and None for those the storage does not have.

    A derived table is there if the files it is made from are; carriers have a file of their own.
    """
    sources = {
        "suppliers": (w.suppliers, ("supplier", "nation", "region")),
        "products": (w.products, ("part",)),
        "locations": (w.locations, ("nation", "region")),
        "sales": (w.sales_line, ("lineitem",)),
        "inventory": (w.inventory, ("lineitem",)),
        "carriers": (lambda: w.table("carriers"), ("carriers",)),
    }
    return {
        name: build() if all(path_exists(w.spark, f"{w.folder}/{f}.parquet") for f in files) else None
        for name, (build, files) in sources.items()
    }


def staged_tables(w) -> dict:
    return {
        "stg_products": w.stg_products,
        "stg_suppliers": staging.stage_suppliers(w.suppliers()),
        "stg_sales": w.stg_sales,
        "stg_inventory": w.stg_inventory,
    }


def rule_sql(rule: quality.Rule, source: str, parent: str | None = None) -> str:
    """One result row for a rule, written as its own statement."""
    c, total = rule.column, "COUNT(*)"
    if rule.kind == "min_rows":
        bad, passed = "0", f"{total} >= {int(rule.limit)}"
    elif rule.kind == "nulls":
        bad = f"COUNT(*) FILTER (WHERE {c} IS NULL)"
        passed = f"{bad} <= {total} * {rule.limit}"
    elif rule.kind == "unique":
        bad = f"{total} - COUNT(DISTINCT {c})"
        passed = f"{bad} = 0"
    elif rule.kind == "range":
        sides = [f"{c} < {rule.low}"] if rule.low is not None else []
        sides += [f"{c} > {rule.high}"] if rule.high is not None else []
        bad = f"COUNT(*) FILTER (WHERE {' OR '.join(sides)})"
        passed = f"{bad} = 0"
    elif rule.kind == "accepted":
        allowed = ", ".join(f"'{v}'" for v in rule.values)
        bad = f"COUNT(*) FILTER (WHERE {c} NOT IN ({allowed}))"
        passed = f"{bad} = 0"
    elif rule.kind == "expression":
        bad = f"COUNT(*) FILTER (WHERE NOT ({rule.expression}))"
        passed = f"{bad} = 0"
    else:
        bad = f"""COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN
          (SELECT {rule.parent_column} FROM {parent} WHERE {rule.parent_column} IS NOT NULL))"""
        passed = f"{bad} = 0"
    return f"""SELECT '{rule.table}' AS "table", '{rule.check}' AS "check", {passed} AS passed,
      CAST({bad} AS BIGINT) AS bad_rows, {total} AS total_rows FROM {source}"""


def suite_sql(rules, sources: dict[str, str], absent=()) -> str:
    exists = [
        f"""SELECT '{t}' AS "table", 'exists' AS "check", {t not in absent} AS passed,
          CAST(NULL AS BIGINT) AS bad_rows, CAST(NULL AS BIGINT) AS total_rows"""
        for t in (*sources, *absent)
    ]
    checks = [
        rule_sql(rule, sources[rule.table], sources.get(rule.parent))
        for rule in rules
        if rule.table in sources
    ]
    return " UNION ALL ".join(exists + checks)


STAGED_VIEWS = {
    "stg_products": "stg_products",
    "stg_suppliers": "suppliers",
    "stg_sales": "stg_sales",
    "stg_inventory": "stg_inventory",
}


@query(
    "raw_rule_suite",
    "Q1 Q2 Q3 Q4 Q5 Q6 Q7 Q9",
    suite_sql(quality.RAW_RULES, RAW_VIEWS, absent=("carriers",)),
)
def _(w):
    return quality.run_rules(raw_tables(w), quality.RAW_RULES)


@query("staged_rule_suite", "Q8", suite_sql(quality.STAGED_RULES, STAGED_VIEWS))
def _(w):
    return quality.run_rules(staged_tables(w), quality.STAGED_RULES)


@query(
    "rule_summary",
    "Q9",
    f"""SELECT {isum("CASE WHEN passed THEN 1 ELSE 0 END")} AS passed,
      {isum("CASE WHEN passed THEN 0 ELSE 1 END")} AS failed,
      SUM(CASE WHEN passed THEN 0 ELSE 1 END) = 0 AS all_passed
    FROM ({suite_sql(quality.RAW_RULES, RAW_VIEWS, absent=("carriers",))})""",
)
def _(w):
    return quality.rule_summary(quality.run_rules(raw_tables(w), quality.RAW_RULES))


INVENTORY = {
    "snapshot_date": "date",
    "location_id": "bigint",
    "sku": "bigint",
    "on_hand_qty": "bigint",
    "in_transit_qty": "int",
    "backorder_qty": "int",
    "inventory_value": "double",
}


@query(
    "column_profile",
    "Q10 IO15",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS type, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count,
          {pct(f"COUNT(*) FILTER (WHERE {c} IS NULL)", "COUNT(*)")} AS null_pct,
          COUNT(DISTINCT {c}) AS unique_count FROM inventory"""
        for c, t in INVENTORY.items()
    ),
)
def _(w):
    return quality.profile(w.inventory())


@query(
    "null_pattern",
    "Q11",
    f"""SELECT location_id, COUNT(*) AS total, COUNT(*) FILTER (WHERE on_hand_qty IS NULL) AS nulls,
      {pct("COUNT(*) FILTER (WHERE on_hand_qty IS NULL)", "COUNT(*)")} AS null_pct
    FROM inventory GROUP BY location_id ORDER BY null_pct DESC, location_id LIMIT 15""",
)
def _(w):
    return quality.null_pattern(w.inventory(), "on_hand_qty", "location_id")


@query(
    "null_samples",
    "Q12",
    """SELECT snapshot_date, location_id, sku, on_hand_qty, in_transit_qty FROM inventory
    WHERE on_hand_qty IS NULL ORDER BY snapshot_date, location_id, sku, in_transit_qty NULLS FIRST
    LIMIT 10""",
)
def _(w):
    rows = w.inventory().select(
        "snapshot_date", "location_id", "sku", "on_hand_qty", "in_transit_qty"
    )
    order = ["snapshot_date", "location_id", "sku", "in_transit_qty"]
    return quality.null_samples(rows, "on_hand_qty", order)


def issue_sql(table: str, view: str, column: str) -> str:
    nulls = f"COUNT(*) FILTER (WHERE {column} IS NULL)"
    share = pct(nulls, "COUNT(*)")
    return f"""SELECT '{table}' AS "table", '{column}' AS "column", {nulls} AS null_count,
      {share} AS null_pct,
      CASE WHEN {share} > 10 THEN 'HIGH' WHEN {share} > 5 THEN 'MEDIUM' ELSE 'LOW' END AS severity
    FROM {view} HAVING {nulls} > 0"""


@query(
    "issue_summary",
    "Q13 P16",
    " UNION ALL ".join(
        issue_sql(t, v, c)
        for t, v, c in (
            *(("inventory", "inventory", c) for c in INVENTORY),
            ("products", "products", "shelf_life_days"),
            ("suppliers", "suppliers", "reliability_score"),
            ("purchase_orders", "purchase_orders", "order_qty"),
            ("purchase_orders", "purchase_orders", "actual_date"),
        )
    ),
)
def _(w):
    return quality.issue_summary(
        {
            "inventory": w.inventory(),
            "products": w.products(),
            "suppliers": w.suppliers(),
            "purchase_orders": w.purchase_orders(),
        }
    )


@query(
    "completeness",
    "Q14",
    "SELECT "
    + r(
        "1 - CAST("
        + " + ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL)" for c in INVENTORY)
        + f" AS DOUBLE) / (COUNT(*) * {len(INVENTORY)})",
        6,
    )
    + " AS completeness FROM inventory",
)
def _(w):
    found = quality.completeness(w.inventory())
    return found.select(round_to("completeness", 6).alias("completeness"))


DUPLICATE_KEYS = "snapshot_date, location_id, sku"


@query(
    "duplicated_rows",
    "W12",
    f"""SELECT snapshot_date, location_id, sku, on_hand_qty FROM inventory
    WHERE ({DUPLICATE_KEYS}) IN (SELECT ({DUPLICATE_KEYS}) FROM inventory GROUP BY {DUPLICATE_KEYS}
      HAVING COUNT(*) > 1)""",
)
def _(w):
    rows = w.inventory().select("snapshot_date", "location_id", "sku", "on_hand_qty")
    return quality.duplicated_rows(rows, DUPLICATE_KEYS.split(", "))


@query(
    "duplicate_share",
    "Q15",
    f"""SELECT CAST(SUM(n) AS BIGINT) AS total_rows, CAST(SUM(n - 1) AS BIGINT) AS surplus_rows,
      {r("SUM(n - 1) / CAST(SUM(n) AS DOUBLE)", 6)} AS share,
      SUM(n - 1) / CAST(SUM(n) AS DOUBLE) <= 0.02 AS within_limit
    FROM (SELECT COUNT(*) AS n FROM inventory GROUP BY location_id, sku)""",
)
def _(w):
    found = quality.duplicate_share(w.inventory(), ["location_id", "sku"])
    return found.withColumn("share", round_to("share", 6))


@query(
    "deduplicated",
    "Q16",
    """SELECT location_id, sku, snapshot_date, on_hand_qty FROM (
      SELECT location_id, sku, snapshot_date, on_hand_qty, ROW_NUMBER() OVER (
        PARTITION BY location_id, sku ORDER BY snapshot_date, on_hand_qty NULLS FIRST) AS rn
      FROM inventory) WHERE rn = 1""",
)
def _(w):
    rows = w.inventory().select("location_id", "sku", "snapshot_date", "on_hand_qty")
    return quality.deduplicate(rows, ["location_id", "sku"], prefer=["snapshot_date"])


CONSISTENCY = (
    quality.satisfies("features", "revenue_with_units", "units_sold <= 0 OR revenue > 0"),
    quality.satisfies(
        "features",
        "no_leakage",
        "units_sold_lag_7 BETWEEN units_sold_roll_min_7 AND units_sold_roll_max_7",
    ),
)


@query(
    "consistency_rules",
    "Q17",
    suite_sql(CONSISTENCY, {"features": "features"}),
)
def _(w):
    return quality.run_rules({"features": w.features}, CONSISTENCY)
