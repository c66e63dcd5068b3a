"""Whole rows under a stable key, so that a row can be found again after a shuffle."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import stage


def _file_based(df: DataFrame) -> bool:
    """Whether every row comes straight from one file that numbers its rows."""
    if "_metadata" in df.columns or not df.inputFiles():
        return False
    plan = df._jdf.queryExecution().analyzed()
    return plan.children().isEmpty()


def keyed(df: DataFrame) -> DataFrame:
    """(row, row_key): all columns of ``df`` packed in a struct, and a key unique per row.

    Packing keeps column names of the input from clashing with the operators' own. For a
    freshly read Parquet table the key is the row's place (file, row number), which costs
    nothing and does not change when a task is run again. Any other frame is written to
    the shared folder once, because a number handed out while a query runs could differ
    in a second run. Unused columns of the struct are pruned at the scan.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
    if _file_based(df):
        place = F.concat_ws("#", "_metadata.file_path", "_metadata.row_index")
        try:
            return df.select(row, place.alias("row_key"))
        except AnalysisException:  # a format that does not number its rows
            pass
    number = F.monotonically_increasing_id().cast("string")
    return stage(df.select(row, number.alias("row_key")), "rows")


def rows_in(table: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of a keyed table whose key is in ``keys`` (unique), with their own columns."""
    return table.join(keys, "row_key", "left_semi").select("row.*")
