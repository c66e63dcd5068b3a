"""Data-quality rules as data, evaluated with one aggregate per table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import percent
from larder.operators.staging import severity

RESULT = ("table", "check", "passed", "bad_rows", "total_rows")


@dataclass(frozen=True)
class Rule:
    """One expectation about a table. ``kind`` selects the meaning of the rest."""

    table: str
    kind: str  # min_rows | nulls | unique | range | accepted | expression | foreign_key
    column: str | None = None
    limit: float = 0.0
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    expression: str | None = None
    parent: str | None = None
    parent_column: str | None = None

    @property
    def check(self) -> str:
        return self.kind if self.column is None else f"{self.kind}:{self.column}"


def min_rows(table: str, n: int) -> Rule:
    return Rule(table, "min_rows", limit=n)


def nulls(table: str, column: str, max_share: float = 0.0) -> Rule:
    return Rule(table, "nulls", column, limit=max_share)


def unique(table: str, column: str) -> Rule:
    return Rule(table, "unique", column)


def in_range(table: str, column: str, low: float | None = None, high: float | None = None) -> Rule:
    return Rule(table, "range", column, low=low, high=high)


def accepted(table: str, column: str, values: Iterable) -> Rule:
    return Rule(table, "accepted", column, values=tuple(values))


def satisfies(table: str, name: str, expression: str) -> Rule:
    """Every row must satisfy a SQL predicate; NULL counts as satisfied."""
    return Rule(table, "expression", name, expression=expression)


def references(table: str, column: str, parent: str, parent_column: str) -> Rule:
    return Rule(table, "foreign_key", column, parent=parent, parent_column=parent_column)


# The default expectations on the raw tables. Thresholds fixed by the data model.
RAW_RULES = (
    min_rows("suppliers", 20),
    min_rows("products", 100),
    min_rows("sales", 1_000_000),
    min_rows("inventory", 100_000),
    unique("suppliers", "supplier_id"),
    unique("products", "sku"),
    unique("locations", "location_id"),
    unique("carriers", "carrier_id"),
    nulls("products", "sku"),
    nulls("products", "unit_cost"),
    nulls("sales", "revenue", 0.05),
    nulls("inventory", "on_hand_qty", 0.10),
    references("sales", "sku", "products", "sku"),
    references("sales", "store_id", "locations", "location_id"),
    references("inventory", "sku", "products", "sku"),
    in_range("products", "unit_cost", low=0),
    in_range("products", "unit_price", low=0),
    in_range("sales", "units_sold", low=0),
    in_range("inventory", "on_hand_qty", low=0),
    accepted("products", "abc_class", ("A", "B", "C")),
    accepted("locations", "location_type", ("PLANT", "DC", "STORE")),
)

# The default expectations on the staged tables.
STAGED_RULES = (
    unique("stg_products", "sku"),
    nulls("stg_products", "sku"),
    nulls("stg_products", "unit_cost"),
    nulls("stg_products", "unit_price"),
    nulls("stg_products", "abc_class"),
    accepted("stg_products", "abc_class", ("A", "B", "C")),
    unique("stg_suppliers", "supplier_id"),
    nulls("stg_suppliers", "supplier_id"),
    nulls("stg_suppliers", "reliability_score"),
    *(nulls("stg_sales", c) for c in ("date", "store_id", "sku", "units_sold")),
    *(nulls("stg_inventory", c) for c in ("snapshot_date", "location_id", "sku")),
)


def _bad(rule: Rule) -> Column:
    """Aggregate that counts the rows (or values) breaking a rule."""
    value = F.col(rule.column) if rule.kind not in ("min_rows", "expression") else None
    if rule.kind == "min_rows":
        return F.lit(0).cast("bigint")
    if rule.kind == "nulls":
        return F.count_if(value.isNull())
    if rule.kind == "unique":
        return F.count(F.lit(1)) - F.count_distinct(value)
    if rule.kind == "range":
        sides = []
        if rule.low is not None:
            sides.append(value < rule.low)
        if rule.high is not None:
            sides.append(value > rule.high)
        return F.count_if(reduce(Column.__or__, sides)) if sides else F.lit(0).cast("bigint")
    if rule.kind == "accepted":
        return F.count_if(~value.isin(*rule.values))
    if rule.kind == "expression":
        return F.count_if(~F.expr(rule.expression))
    raise ValueError(f"unknown rule kind {rule.kind}")


def _passed(rule: Rule, bad: Column, total: Column) -> Column:
    if rule.kind == "min_rows":
        return total >= int(rule.limit)
    if rule.kind == "nulls":
        return bad <= total * F.lit(float(rule.limit))
    return bad == 0


def _table_results(name: str, df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All row-level rules of one table from one aggregate row."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *(_bad(rule).alias(f"bad_{i}") for i, rule in enumerate(rules)),
    )
    total = F.col("total_rows")
    results = F.array(
        *(
            F.struct(
                F.lit(name).alias("table"),
                F.lit(rule.check).alias("check"),
                _passed(rule, F.col(f"bad_{i}"), total).alias("passed"),
                F.col(f"bad_{i}").alias("bad_rows"),
                total.alias("total_rows"),
            )
            for i, rule in enumerate(rules)
        )
    )
    return counted.select(F.inline(results))


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """(key, rows) for child keys without a parent; NULL keys are not orphans.

    The child is reduced to one row per key first, so a key that holds a large share
    of the rows is compared once.
    """
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return keys.join(parent.select(F.col(parent_column).alias("key")), "key", "left_anti")


def _reference_results(child: DataFrame, rules: list[Rule], tables) -> DataFrame:
    """One result row per reference rule of a table, from one scan of it.

    Rows are counted per value of each key column, NULLs among them; the counts of a key
    add up to the rows of the table, and the parents are joined to the few values.
    """
    keys = F.array(
        *(
            F.struct(F.lit(i).alias("rule"), F.col(r.column).cast("string").alias("key"))
            for i, r in enumerate(rules)
        )
    )
    counted = (
        child.select(F.inline(keys)).groupBy("rule", "key").agg(F.count(F.lit(1)).alias("rows"))
    )
    parents = reduce(
        DataFrame.union,
        (
            tables[r.parent].select(
                F.lit(i).alias("rule"), F.col(r.parent_column).cast("string").alias("key")
            )
            for i, r in enumerate(rules)
        ),
    ).distinct()
    found = counted.join(parents.withColumn("known", F.lit(True)), ["rule", "key"], "left")
    bad = F.sum(F.when(F.col("key").isNotNull() & F.col("known").isNull(), F.col("rows")).otherwise(0))
    summed = found.groupBy("rule").agg(bad.alias("bad_rows"), F.sum("rows").alias("total_rows"))
    names = reduce(
        DataFrame.union,
        (
            child.sparkSession.range(1).select(
                F.lit(i).alias("rule"), F.lit(r.table).alias("table"), F.lit(r.check).alias("check")
            )
            for i, r in enumerate(rules)
        ),
    )
    none = F.lit(0).cast("bigint")
    return names.join(summed, "rule", "left").select(
        "table",
        "check",
        (F.coalesce("bad_rows", none) == 0).alias("passed"),
        F.coalesce("bad_rows", none).alias("bad_rows"),
        F.coalesce("total_rows", none).alias("total_rows"),
    )


def _existence(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """One row per expected table, without reading any of them."""
    spark = next(df.sparkSession for df in tables.values() if df is not None)
    rows = F.array(
        *(
            F.struct(
                F.lit(name).alias("table"),
                F.lit("exists").alias("check"),
                F.lit(df is not None).alias("passed"),
                F.lit(None).cast("bigint").alias("bad_rows"),
                F.lit(None).cast("bigint").alias("total_rows"),
            )
            for name, df in tables.items()
        )
    )
    return spark.range(1).select(F.inline(rows))


def run_rules(
    tables: Mapping[str, DataFrame | None], rules: Sequence[Rule] = RAW_RULES
) -> DataFrame:
    """Evaluate the rules: one result row each, plus one existence row per table.

    Rules on an absent table (None) are reported through its existence row only.
    """
    present = {name: df for name, df in tables.items() if df is not None}
    parts = [_existence(tables)]
    for name, df in present.items():
        own = [r for r in rules if r.table == name and r.kind != "foreign_key"]
        if own:
            parts.append(_table_results(name, df, own))
        linked = [
            r for r in rules if r.table == name and r.kind == "foreign_key" and r.parent in present
        ]
        if linked:
            parts.append(_reference_results(df, linked, present))
    return reduce(DataFrame.unionByName, parts)


def rule_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed")
    ).withColumn("all_passed", F.col("failed") == 0)


# -- profiling ---------------------------------------------------------------


def profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per column: type, nulls, null share and distinct values.

    Exact counts read one column at a time and shuffle each of its values once per map
    task, in its own type; ``exact=False`` keeps one sketch per column and does not
    shuffle rows at all.
    """
    types = dict(df.dtypes)
    if not exact:
        counted = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *(F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in types),
            *(F.approx_count_distinct(c).alias(f"d_{c}") for c in types),
        )
        rows = F.array(
            *(
                F.struct(
                    F.lit(c).alias("column"),
                    F.lit(types[c]).alias("type"),
                    F.col(f"n_{c}").alias("null_count"),
                    percent(f"n_{c}", "_rows").alias("null_pct"),
                    F.col(f"d_{c}").alias("unique_count"),
                )
                for c in types
            )
        )
        return counted.select(F.inline(rows))

    def one(c: str) -> DataFrame:
        values = df.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        counted = values.agg(
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.sum("n").alias("rows"),
            F.count("value").alias("unique_count"),
        )
        return counted.where(F.col("rows") > 0).select(
            F.lit(c).alias("column"),
            F.lit(types[c]).alias("type"),
            F.col("nulls").alias("null_count"),
            percent("nulls", "rows").alias("null_pct"),
            "unique_count",
        )

    return reduce(DataFrame.unionByName, map(one, types))


def null_counts(df: DataFrame, table: str) -> DataFrame:
    """(table, column, null_count, null_pct, severity) for columns with nulls."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns),
    )
    rows = F.array(
        *(
            F.struct(F.lit(c).alias("column"), F.col(c).alias("null_count"))
            for c in df.columns
        )
    )
    return (
        counted.select("_rows", F.inline(rows))
        .where(F.col("null_count") > 0)
        .select(
            F.lit(table).alias("table"),
            "column",
            "null_count",
            percent("null_count", "_rows").alias("null_pct"),
        )
        .withColumn("severity", severity(F.col("null_pct")))
    )


def issue_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns with missing values in any table; one scan per table."""
    return reduce(DataFrame.unionByName, (null_counts(df, n) for n, df in tables.items()))


def null_pattern(df: DataFrame, column: str, by: str, limit: int = 15) -> DataFrame:
    counted = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col(column).isNull()).alias("nulls")
    )
    return (
        counted.withColumn("null_pct", percent("nulls", "total"))
        .orderBy(F.desc("null_pct"), by)
        .limit(limit)
    )


def null_samples(df: DataFrame, column: str, order_by: Sequence[str], n: int = 10) -> DataFrame:
    return df.where(F.col(column).isNull()).orderBy(*order_by).limit(n)


def completeness(df: DataFrame) -> DataFrame:
    """Share of cells that hold a value."""
    empty = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    cells = F.count(F.lit(1)) * len(df.columns)
    return df.agg((1 - F.try_divide(empty.cast("double"), cells)).alias("completeness"))


# -- duplicates --------------------------------------------------------------


def duplicated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once.

    Counting with map-side partial sums and semi-joining back keeps a huge group of
    copies out of any single task; a window over the key would not.
    """
    repeated = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1").select(*keys)
    )
    return df.join(repeated, list(keys), "left_semi")


def duplicate_share(df: DataFrame, keys: Sequence[str], limit: float = 0.02) -> DataFrame:
    """Surplus copies as a share of all rows, against a limit."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    totals = counts.agg(
        F.sum("copies").alias("total_rows"), F.sum(F.col("copies") - 1).alias("surplus_rows")
    )
    share = F.col("surplus_rows") / F.col("total_rows")
    return totals.withColumns({"share": share, "within_limit": share <= limit})


def deduplicate(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``prefer``, then by the other columns.

    A minimum over a struct is decided per map task before the shuffle, so a group of
    copies of any size sends one candidate per task, and the choice is repeatable.
    """
    rest = [c for c in df.columns if c not in keys and c not in prefer]
    order = [*prefer, *rest]
    if not order:
        return df.dropDuplicates(list(keys))
    kept = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_row"))
    return kept.select(*(F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns))
