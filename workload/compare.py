"""Run every registered query against its SQL.

    python -m workload.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from skylattice.session import build_session
from workload.oracle import ORACLE_SQL
from workload.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


_KINDS = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
          "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def difference(spark, con, sf_dir: str, name: str) -> str | None:
    """What differs between the two engines, or None."""
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rel = con.sql(ORACLE_SQL[name])
    if sorted(rel.columns) != columns:
        return f"columns {sorted(set(rel.columns) ^ set(columns))}"
    ours = {f.name: _KINDS.get(f.dataType.simpleString(), f.dataType.simpleString())
            for f in df.schema}
    theirs = {c: str(k) for c, k in zip(rel.columns, rel.types)}
    if ours != theirs:
        return f"types {[(c, ours[c], theirs[c]) for c in columns if ours[c] != theirs[c]]}"
    quoted = ", ".join(f'"{c}"' for c in columns)
    rows = Counter(map(tuple, df.select(*[f"`{c}`" for c in columns]).collect()))
    expected = Counter(con.sql(f"SELECT {quoted} FROM ({ORACLE_SQL[name]})").fetchall())
    if rows == expected:
        return None
    missing, extra = expected - rows, rows - expected
    return (
        f"{rows.total()} rows against {expected.total()}; columns {columns}; "
        f"missing {list(missing)[:2]}; extra {list(extra)[:2]}"
    )


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session(master="local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            found = difference(spark, con, sf_dir, name)
        except Exception as error:  # report and go on to the next query
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += found is not None
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - start:.1f}s {found or ''}",
              flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
