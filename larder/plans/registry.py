"""Registry of named queries.

A query is a function from a ``Workspace`` to a DataFrame. Beside it stands the SQL
that another engine can run on the same files to check the result, unless the result
is not expressible in SQL (trained models, sampled forests).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators import (
    anomalies,
    features,
    gold,
    isolation,
    metrics,
    models,
    segments,
    staging,
)
from larder.session import stage
from larder.sources.orderbook import OrderBook


class Workspace(OrderBook):
    """Source views plus the derived tables that queries share."""

    @cached_property
    def line(self) -> DataFrame:
        return self.sales_line()

    @cached_property
    def daily(self) -> DataFrame:
        return self.sales_daily()

    @cached_property
    def stg_sales(self) -> DataFrame:
        return staging.stage_sales(self.line)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stage_products(self.products())

    @cached_property
    def stg_inventory(self) -> DataFrame:
        return staging.stage_inventory(self.inventory())

    @cached_property
    def monthly(self) -> DataFrame:
        return gold.monthly_sales(self.stg_sales)

    @cached_property
    def features(self) -> DataFrame:
        return features.demand_features(self.daily)

    def stored(self, *columns: str) -> DataFrame:
        """Some feature columns, written once for queries that read them repeatedly.

        Only the named columns are computed: windows and shuffles behind the others
        are pruned before the write.
        """
        if columns not in self._stored:
            self._stored[columns] = stage(self.features.select(*columns), "features")
        return self._stored[columns]

    @cached_property
    def _stored(self) -> dict[tuple[str, ...], DataFrame]:
        return {}

    @cached_property
    def sold(self) -> DataFrame:
        """Feature rows reduced to what segmentation and period reports read."""
        return self.stored(*features.SERIES, "ds", "units_sold", "revenue")

    @cached_property
    def anomaly_inputs(self) -> DataFrame:
        return self.stored(*anomalies.KEYS, *anomalies.INPUTS)

    @cached_property
    def anomalies(self) -> DataFrame:
        """Flags from global statistics; the isolation-forest flag stays 0 here."""
        stats = anomalies.global_stats(self.anomaly_inputs)
        return anomalies.flag_anomalies(self.anomaly_inputs, stats)

    @cached_property
    def forest_table(self) -> DataFrame:
        """The anomaly table with all eight flags, the isolation forest among them.

        The score is a function of the row, so it is stored beside the inputs and the
        flag is set in the same projection as the others.
        """
        table = self.anomaly_inputs
        scored = stage(isolation.fit_isolation_forest(table).score(table), "scored")
        flagged = isolation.isolation_flags(scored).drop("isolation_score")
        return anomalies.flag_anomalies(flagged, anomalies.global_stats(scored))

    @cached_property
    def candidates(self) -> DataFrame:
        return self.stored(*features.SERIES, "ds", "units_sold", *CANDIDATES.values())

    @cached_property
    def test_rows(self) -> DataFrame:
        """Predictions of every candidate on the last fifth of the calendar."""
        marked = models.mark_test_rows(self.candidates)
        return metrics.as_predictions(marked.where("is_test"), CANDIDATES)

    @cached_property
    def sku_segments(self) -> DataFrame:
        return segments.segment_products(self.candidates)


class ForestWorkspace(Workspace):
    """The same views for reports on all eight flags."""

    @cached_property
    def anomalies(self) -> DataFrame:
        return self.forest_table


# Naive forecasts: each model is a column of the feature table.
CANDIDATES = {
    "lag_7": "units_sold_lag_7",
    "mean_7": "units_sold_roll_mean_7",
    "mean_30": "units_sold_roll_mean_30",
}
KINDS = {"lag_7": "ML", "mean_7": "ML", "mean_30": "TimeSeries"}


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Callable[[Workspace], DataFrame]
    sql: str | None
    workspace: type[Workspace] = Workspace

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return plain_numbers(self.build(self.workspace(spark, folder)))


def plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals become doubles at the edge; inside, sums stay exact."""
    decimals = {f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)}
    if not decimals:
        return df
    return df.select(
        *(F.col(c).cast("double").alias(c) if c in decimals else F.col(c) for c in df.columns)
    )


QUERIES: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a query under a name, with the inventory items it covers."""

    def register(build: Callable[[Workspace], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is defined twice")
        QUERIES[name] = Query(name, tuple(covers.split()), build, with_views(sql))
        return build

    return register


# Reports on the anomaly table. Each also runs over the table with the isolation forest,
# whose sampled trees SQL cannot grow: those have no SQL counterpart.
ANOMALY_REPORTS = (
    "anomaly_summary",
    "flag_counts",
    "top_anomalies",
    "anomalies_by_sku",
    "anomalies_by_store",
    "anomalies_by_date",
    "anomaly_rate",
    "anomaly_context",
    "period_anomalies",
    "stores_by_anomaly_rate",
    "history_near_anomalies",
)


def add_forest_reports() -> None:
    for name in ANOMALY_REPORTS:
        plain = QUERIES[name]
        full = f"{name}_with_forest"
        QUERIES[full] = Query(full, plain.covers, plain.build, None, ForestWorkspace)


# -- SQL side ----------------------------------------------------------------

VIEWS: dict[str, str] = {}


def view(name: str, text: str) -> None:
    """Define a named subquery for the SQL side."""
    VIEWS[name] = text


def with_views(text: str | None) -> str | None:
    """Prefix a statement with the WITH clauses of every view it mentions."""
    if text is None:
        return None
    ordered: list[str] = []

    def visit(body: str) -> None:
        for word in re.findall(r"[a-z_0-9]+", body):
            if word in VIEWS and word not in ordered and VIEWS[word] is not body:
                visit(VIEWS[word])
                if word not in ordered:
                    ordered.append(word)

    visit(text)
    if not ordered:
        return text
    clauses = ",\n".join(f"{name} AS MATERIALIZED ({VIEWS[name]})" for name in ordered)
    return f"WITH {clauses}\n{text}"


def r(expression: str, places: int) -> str:
    """Rounding of a double as the engine does it: snapped, then half up."""
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(38,6)), {places}) AS DOUBLE)"


def pct(part: str, whole: str, places: int = 2) -> str:
    return r(f"CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0) * 100", places)


def isum(expression: str) -> str:
    return f"CAST(SUM({expression}) AS BIGINT)"


def msum(expression: str) -> str:
    return f"CAST(SUM(CAST({expression} AS DECIMAL(18,4))) AS DOUBLE)"
