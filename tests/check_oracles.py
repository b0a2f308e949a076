"""Compare registered queries with their SQL: python tests/check_oracles.py SF_DIR [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return db


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan") if math.isnan(value) else (2, repr(value))
    if isinstance(value, bool):
        return (3, str(value))
    return (4, str(value))


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = sorted(tuple(_cell(r[i]) for i in order) for r in rows)
    return [columns[i] for i in order], body


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def differences(df, db, sql: str) -> str | None:
    """None when names, types and values agree."""
    result = db.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    theirs = canonical([d[0] for d in result.description], result.fetchall())
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    wrong = {c: (t, types[c]) for c, t in df.dtypes if SPARK_TO_DUCK.get(t) != types[c]}
    if wrong:
        return f"types {wrong}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} != {len(theirs[1])}"
    bad = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    if bad:
        return f"{len(bad)} rows differ in {ours[0]}, first {bad[0]}"
    return None


def main() -> int:
    import __spark_entry__ as contract
    from helioframe.session import local_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = local_session()
    db = connect(sf_dir)
    oracles = contract.oracle_sql()
    failed = 0
    for name, query in contract.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            problem = differences(df, db, oracles[name]) if name in oracles else None
            note = "" if name in oracles else f"rows={df.count()}"
        except Exception as exc:  # noqa: BLE001
            problem, note = f"{type(exc).__name__}: {str(exc)[:600]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:32s} {time.time() - start:6.2f}s {problem or note}", flush=True)
    print("failed:", failed)
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main())
