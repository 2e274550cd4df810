"""Compare every query with its SQL on DuckDB. Usage: python tests/compare.py SF_DIR [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = sorted(tuple(plain(r[i]) for i in order) for r in rows)
    return [columns[i] for i in order], body


def differences(spark, con, folder: str, name: str, run, sql: str) -> str | None:
    df = run(spark, folder)
    ours = normalised(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = normalised(names, cur.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} / {len(theirs[1])}"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            bad = sum(x != y for x, y in zip(ours[1], theirs[1]))
            return f"{bad} rows differ, first {a} / {b}"
    types = {d[0]: str(d[1]) for d in cur.description}
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    same = {
        "int": {"INTEGER"}, "bigint": {"BIGINT"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
        "boolean": {"BOOLEAN"}, "timestamp_ntz": {"TIMESTAMP"}, "date": {"DATE"},
    }
    odd = {n: (kinds[n], types[n]) for n in kinds if types[n] not in same.get(kinds[n], set())}
    return f"types {odd}" if odd else None


def main() -> None:
    import __spark_entry__ as entry
    from trafficlens.session import build_session

    folder, wanted = sys.argv[1], set(sys.argv[2:])
    spark = build_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        begun = time.time()
        sql = entry.oracle_sql().get(name)
        try:
            if sql is None:
                df = run(spark, folder)
                result = f"rows only: {df.count()}"
            else:
                result = differences(spark, con, folder, name, run, sql)
        except Exception as error:  # report and go on
            result = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        ok = result is None or result.startswith("rows only")
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - begun:.2f}s {result or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
