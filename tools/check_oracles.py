"""Compare registered queries with their reference SQL: columns, row count, every value.

Usage: python tools/check_oracles.py SF_DIR [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from medallion.session import build_session  # noqa: E402
from queries.oracles import ORACLES  # noqa: E402
from queries.registry import QUERIES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _row(values) -> tuple:
    return tuple("NaN" if isinstance(v, float) and math.isnan(v) else repr(v) for v in values)


def compare(spark, con, name: str, sf_dir: str) -> tuple[str, int]:
    """Empty text when both sides agree, else what differs; and the number of rows."""
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    if name not in ORACLES:
        return ("" if ours else "no rows"), len(ours)
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}", len(ours)
    order = [names.index(c) for c in columns]
    theirs = [tuple(r[i] for i in order) for r in result.fetchall()]
    left, right = Counter(map(_row, ours)), Counter(map(_row, theirs))
    if left == right:
        return "", len(ours)
    extra, missing = list((left - right).items())[:2], list((right - left).items())[:2]
    return f"{columns} rows {len(ours)} against {len(theirs)}; only ours {extra}; only reference {missing}", len(ours)


def main() -> None:
    sf_dir, *names = sys.argv[1:]
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g", spark__driver__maxResultSize="4g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem, rows = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", -1
        failed += bool(problem)
        kind = "oracle" if name in ORACLES else "rows"
        print(f"{'FAIL' if problem else 'ok':4} {name:28} {kind:6} {rows:8} rows {time.time() - start:6.2f}s {problem}", flush=True)
    print("failed:", failed)
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
