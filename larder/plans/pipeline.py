"""The layered pipeline: raw -> bronze -> silver -> gold -> features -> anomalies, and on
from there to report files, predictions and drift.

Each stage reads the tables the stage before it wrote, so a stage can be rerun alone
and a failure loses only the stage it happened in. All stages share one session.

    spark-submit --py-files larder.zip larder/plans/pipeline.py \\
        --raw s3a://bucket/raw --lake s3a://bucket/lake [--skip-bronze | --silver-only | --gold-only] \\
        [--all] [--resume]
"""

from __future__ import annotations

import argparse
from collections.abc import Iterable, Mapping
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators import (
    anomalies,
    boosting,
    drift,
    features,
    gold,
    isolation,
    models,
    quality,
    staging,
)
from larder.plans.ledger import Ledger, Stage
from larder.schemas import RAW_TABLES
from larder.session import clear_stages, shuffles_removed, side_by_side, stage
from larder.sources.layers import Layer, ingest, write_csv, write_json

STAGES = ("bronze", "check", "silver", "gold", "features", "anomalies")
# What follows on the anomaly table: files of the report, scored rows, and drift.
LATER_STAGES = ("reports", "predictions", "drift")
# Sales of a task that groups them by product and store.
TASK_ROWS = 1_000_000
# What the staged sales hold of a sale; the rest of their columns follows from these.
SALES_COLUMNS = (
    "date", "store_id", "sku", "units_sold", "demand", "revenue", "is_promo", "stockout_flag"
)
REPORTS = ("anomalies_flagged", "anomalies_summary", "anomalies_by_date")


class Pipeline:
    def __init__(
        self,
        spark: SparkSession,
        lake: str,
        raw: str | None = None,
        booster: boosting.Settings = boosting.Settings(),
        strict: bool = True,
    ):
        """``strict``: a failed quality rule ends the run; otherwise it is only recorded."""
        root = lake.rstrip("/")
        self.spark = spark
        self.lake, self.reports, self.booster = root, f"{root}/reports", booster
        self.strict = strict
        self.raw = Layer(spark, raw) if raw else None
        self.layers = {name: Layer(spark, f"{root}/{name}") for name in ("bronze", "silver", "gold")}
        self.written: dict[str, int | None] = {}
        self._by_series: DataFrame | None = None

    @property
    def bronze_layer(self) -> Layer:
        return self.layers["bronze"]

    def _save(self, layer: str, table: str, df: DataFrame) -> None:
        self._save_all(layer, {table: df})

    def _save_all(self, layer: str, frames: Mapping[str, DataFrame]) -> None:
        """Write tables that do not need each other side by side."""
        writes = [
            partial(self.layers[layer].write, table, df.withColumn("_loaded_at", F.current_timestamp()))
            for table, df in frames.items()
        ]
        counts = side_by_side(self.spark, writes)
        self.written.update({f"{layer}.{table}": n for table, n in zip(frames, counts)})

    def load(self, frames: Mapping[str, DataFrame]) -> None:
        """Bronze from frames instead of raw files."""
        for table, df in frames.items():
            self.written[f"bronze.{table}"] = self.bronze_layer.write(table, df)

    def bronze(self) -> None:
        if self.raw is None:
            raise ValueError("the bronze stage needs a raw folder")
        counts = ingest(self.raw, self.bronze_layer)
        self.written.update({f"bronze.{t}": n for t, n in counts.items()})

    def bronze_tables(self) -> dict[str, DataFrame | None]:
        return {
            t: self.bronze_layer.read(t) if self.bronze_layer.exists(t) else None
            for t in RAW_TABLES
        }

    def check_results(self, rules=quality.RAW_RULES) -> DataFrame:
        return quality.run_rules(self.bronze_tables(), rules)

    def check(self, rules=quality.RAW_RULES) -> None:
        """Store the rule results and, if strict, stop the run if a rule fails."""
        self.written["bronze._quality"] = self.bronze_layer.write("_quality", self.check_results(rules))
        failed = self.bronze_layer.read("_quality").where("NOT passed").count()
        if failed and self.strict:
            raise RuntimeError(f"{failed} quality rules failed, see bronze/_quality")

    def silver(self) -> None:
        steps = {
            "products": staging.stage_products,
            "suppliers": staging.stage_suppliers,
            "sales": staging.stage_sales,
            "inventory": staging.stage_inventory,
        }
        self.release()
        staged = {
            f"stg_{table}": step(self.bronze_layer.read(table))
            for table, step in steps.items()
            if self.bronze_layer.exists(table)
        }
        self._save_all("silver", staged)

    def sales_by_series(self) -> DataFrame:
        """Staged sales with all rows of a product in a store in one task, kept on disk.

        Most groups of the gold tables and features hold few rows, so sums taken before a
        shuffle are as many as the rows and wider. Rows are moved once, for all tables that are
        grouped by product and store among others.
        """
        if self._by_series is None:
            sales = self.layers["silver"].read("stg_sales").select(*SALES_COLUMNS)
            # Counted from file footers; beyond the session's partitions, a task has a bounded share.
            tasks = sales.count() // TASK_ROWS
            enough = tasks <= int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            spread = sales.repartition(*([] if enough else [tasks]), *features.SERIES)
            self._by_series = spread.persist(StorageLevel.DISK_ONLY)
        return self._by_series

    def release(self) -> None:
        """Drop the sales kept by ``sales_by_series``."""
        if self._by_series is not None:
            self._by_series.unpersist()
            self._by_series = None

    def gold(self) -> None:
        silver, target = self.layers["silver"], self.layers["gold"]
        sales = staging.stage_sales(self.sales_by_series())
        self._save_all(
            "gold",
            {
                "fct_weekly_sales": gold.weekly_sales(sales),
                "fct_monthly_sales": gold.monthly_sales(sales),
            },
        )
        self._save(
            "gold",
            "dim_product_performance",
            gold.product_performance(
                silver.read("stg_products"),
                target.read("fct_monthly_sales"),
                silver.read("stg_inventory"),
            ),
        )

    def features(self) -> None:
        daily = features.daily_grain(self.sales_by_series())
        self._save("gold", "demand_features", features.demand_features(daily))

    def anomalies(self) -> None:
        target = self.layers["gold"]
        table = target.read("demand_features").drop("_loaded_at")
        forest = isolation.fit_isolation_forest(table)
        keys = [*anomalies.KEYS, "isolation_score"]
        self._save("gold", "isolation_scores", forest.score(table).select(*keys))
        scores = target.read("isolation_scores").drop("_loaded_at")
        self._save(
            "gold",
            "anomalies",
            anomalies.flag_anomalies(
                table, anomalies.global_stats(table), isolation.isolation_flags(scores)
            ),
        )

    def predictions(self) -> None:
        """Fit on the older days, keep the model, score every complete feature row."""
        target = self.layers["gold"]
        table = target.read("demand_features").drop("_loaded_at")
        rows = boosted(table)
        train = models.mark_test_rows(rows).where("NOT is_test").drop("is_test")
        booster = boosting.fit_booster(train, settings=self.booster)
        scored = boosting.score(booster, rows, "histogram_boosting", clip=True)
        self._save("gold", "predictions", scored)

    def drift(self, cutoff: str | None = None) -> None:
        """Drift of the last fifth of the days against the days before, as a table and a summary."""
        table = self.layers["gold"].read("demand_features").drop("_loaded_at")
        if cutoff is None:
            marked = models.mark_test_rows(table.select("ds"))
            cutoff = str(marked.where("is_test").agg(F.min("ds")).first()[0])
        report = stage(drift.drift_report(drift.periods(table, cutoff)), "drift")
        self._save("gold", "drift", report)
        summary = drift.drift_summary(report, drift.period_counts(drift.periods(table, cutoff)), cutoff)
        write_json(summary, self.report_path("drift_summary"))

    def report_path(self, name: str) -> str:
        return f"{self.reports}/{name}"

    def reports_stage(self) -> None:
        """The anomaly report as CSV files: flagged rows in order of days, summary, counts by day."""
        table = self.layers["gold"].read("anomalies").drop("_loaded_at")
        write_reports(table, self.reports)

    def plan(self, stages: Iterable[str] = STAGES) -> list[Stage]:
        """The stages with the folders they read and write, for the ledger."""
        folder = {name: layer.root for name, layer in self.layers.items()}
        bronze = [f"{folder['bronze']}/{t}" for t in RAW_TABLES]
        gold = folder["gold"]
        known = {
            "bronze": ([self.raw.root] if self.raw else [], bronze),
            "check": (bronze, [f"{folder['bronze']}/_quality"]),
            "silver": (bronze, [folder["silver"]]),
            "gold": (
                [folder["silver"]],
                [f"{gold}/{t}" for t in ("fct_weekly_sales", "fct_monthly_sales", "dim_product_performance")],
            ),
            "features": ([f"{folder['silver']}/stg_sales"], [f"{gold}/demand_features"]),
            "anomalies": (
                [f"{gold}/demand_features"], [f"{gold}/isolation_scores", f"{gold}/anomalies"]
            ),
            "reports": ([f"{gold}/anomalies"], [self.report_path(n) for n in REPORTS]),
            "predictions": ([f"{gold}/demand_features"], [f"{gold}/predictions"]),
            "drift": ([f"{gold}/demand_features"], [f"{gold}/drift", self.report_path("drift_summary")]),
        }
        return [Stage(name, self._work(name), *known[name]) for name in stages]

    def _work(self, stage: str):
        return self.reports_stage if stage == "reports" else getattr(self, stage)

    def run(self, stages: Iterable[str] = STAGES) -> dict[str, int | None]:
        """Run stages in order; the first failure ends the run."""
        try:
            with shuffles_removed(self.spark):
                for name in stages:
                    self._work(name)()
        finally:
            self.release()
        return self.written

    def resume(self, stages: Iterable[str] = STAGES) -> dict[str, str]:
        """Run stages by the ledger: what is done and unchanged is skipped, a failed run goes on."""
        try:
            with shuffles_removed(self.spark):
                return self.ledger.run(self.plan(stages))
        finally:
            self.release()

    @property
    def ledger(self) -> Ledger:
        return Ledger(self.spark, f"{self.lake}/_ledger")

    def summary(self) -> DataFrame:
        """(table, row_count) of everything written by this run."""
        rows = [(t, n) for t, n in self.written.items() if n is not None]
        return self.spark.createDataFrame(rows, "table string, row_count bigint")


def write_reports(table: DataFrame, folder: str) -> None:
    """The three files of the anomaly report, each a folder of CSV parts."""
    flagged = table.where("is_anomaly = 1")
    write_csv(flagged.repartitionByRange("ds").sortWithinPartitions(*anomalies.KEYS), f"{folder}/anomalies_flagged")
    write_csv(anomalies.anomaly_summary(table), f"{folder}/anomalies_summary")
    write_csv(anomalies.anomalies_by_date(table), f"{folder}/anomalies_by_date")


def boosted(table: DataFrame) -> DataFrame:
    """Feature rows that a booster can score: every input known, as numbers."""
    return models.model_rows(table)


def chosen_stages(args: argparse.Namespace) -> tuple[str, ...]:
    if args.silver_only:
        return ("silver",)
    if args.gold_only:
        return ("gold",)
    later = LATER_STAGES if getattr(args, "all", False) else ()
    return (*(STAGES[2:] if args.skip_bronze else STAGES), *later)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--raw", help="folder of raw parquet tables")
    parser.add_argument("--lake", required=True, help="folder of the layered tables")
    parser.add_argument("--skip-bronze", action="store_true")
    parser.add_argument("--silver-only", action="store_true")
    parser.add_argument("--gold-only", action="store_true")
    parser.add_argument("--all", action="store_true", help="reports, predictions and drift as well")
    parser.add_argument("--resume", action="store_true", help="skip stages that are done and unchanged")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("larder-pipeline").getOrCreate()
    try:
        pipeline = Pipeline(spark, args.lake, args.raw)
        stages = chosen_stages(args)
        if args.resume:
            pipeline.resume(stages)
        else:
            pipeline.run(stages)
    finally:
        clear_stages(spark)


if __name__ == "__main__":
    main()
