"""Compare every named query with its SQL counterpart on one data folder.

    python tools/check_queries.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from larder.plans.catalog import QUERIES  # noqa: E402
from larder.session import clear_stages, local_session  # noqa: E402


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        raise TypeError("decimal in a result")
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (bool, int, str, type(None))):
        return value
    if isinstance(value, datetime.date):
        return value.isoformat()
    return str(value)


def sort_key(row):
    return tuple(
        (v is None, f"{v:.4f}" if isinstance(v, float) else str(v)) for v in row
    )


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or abs(a - b) <= 1e-9 * max(abs(a), abs(b), 1e-3)
    return type(a) is type(b) and a == b


def compare(left, right) -> str:
    (lcols, lrows), (rcols, rrows) = left, right
    if sorted(lcols) != sorted(rcols):
        return f"columns differ: {sorted(set(lcols) ^ set(rcols))}"
    order_l = sorted(range(len(lcols)), key=lambda i: lcols[i])
    order_r = sorted(range(len(rcols)), key=lambda i: rcols[i])
    a = sorted(([plain(r[i]) for i in order_l] for r in lrows), key=sort_key)
    b = sorted(([plain(r[i]) for i in order_r] for r in rrows), key=sort_key)
    if len(a) != len(b):
        return f"rows differ: {len(a)} vs {len(b)}"
    names = sorted(lcols)
    cells = [(names[i], x[i], y[i]) for x, y in zip(a, b) for i in range(len(names))]
    bad = [c for c in cells if not same(c[1], c[2])]
    return f"{len(bad)} values differ, e.g. {bad[:3]}" if bad else "ok"


def last_digit_differences(left, right) -> list:
    """Columns whose floats agree within tolerance but not to the last bit."""
    (lcols, lrows), (rcols, rrows) = left, right
    inexact = []
    for name in sorted(set(lcols) & set(rcols)):
        a = sorted(str(plain(r[lcols.index(name)])) for r in lrows)
        b = sorted(str(plain(r[rcols.index(name)])) for r in rrows)
        if a != b:
            inexact.append(name)
    return inexact


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = local_session("check", **{"spark.ui.showConsoleProgress": "false"})
    duck = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    failures = 0
    for name in names:
        query = QUERIES[name]
        started = time.time()
        try:
            df = query.run(spark, folder)
            rows = [tuple(row) for row in df.collect()]
            spent = time.time() - started
            if query.sql is None:
                verdict = f"rows only ({len(rows)})"
            else:
                cursor = duck.execute(query.sql)
                columns = [d[0] for d in cursor.description]
                expected = cursor.fetchall()
                verdict = compare((df.columns, rows), (columns, expected))
                if verdict == "ok":
                    inexact = last_digit_differences((df.columns, rows), (columns, expected))
                    verdict = f"ok {len(rows)}" + (f", last digits differ: {inexact}" if inexact else "")
        except Exception as error:
            spent = time.time() - started
            verdict = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        clear_stages(spark)  # rows are collected, nothing reads the files any more
        failures += not verdict.startswith(("ok", "rows only"))
        print(f"{name:28s} {spent:6.2f}s {verdict}", flush=True)
    print(f"{len(names)} queries, {failures} failures")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
