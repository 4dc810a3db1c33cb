"""Run registered queries next to their SQL: ``python -m workload.compare [--sf DIR] [names…]``."""

from __future__ import annotations

import argparse
import time
import traceback

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def sql_rows(sf: str, statement: str) -> tuple[list[str], list[tuple]]:
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    cursor = con.execute(statement)
    columns = [d[0] for d in cursor.description]
    return columns, cursor.fetchall()


def ordered(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Columns by name and rows by value."""
    place = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(row[i] for i in place) for row in rows]
    return [columns[i] for i in place], sorted(cells, key=repr)


def difference(spark_side: tuple, sql_side: tuple) -> str | None:
    """Why two ordered results differ; None when they are equal."""
    (names, rows), (other_names, other_rows) = spark_side, sql_side
    if names != other_names:
        return f"columns {names} against {other_names}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} rows against {len(other_rows)}"
    for a, b in zip(rows, other_rows):
        if repr(a) != repr(b):
            return f"{a!r:.600}\n      against\n      {b!r:.600}"
    return None


def compare(spark, name: str, sf: str) -> tuple[bool, str]:
    from workload import ORACLES, QUERIES

    df = QUERIES[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        return True, f"{len(rows)} rows, no SQL"
    problem = difference(ordered(df.columns, rows), ordered(*sql_rows(sf, ORACLES[name])))
    return problem is None, problem or f"{len(rows)} rows equal"


def main() -> int:
    from stackroom.runtime import local_session
    from workload import QUERIES

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session(8)
    failed = []
    for name in args.names or QUERIES:
        started = time.time()
        try:
            good, note = compare(spark, name, args.sf)
        except Exception as exc:  # noqa: BLE001
            good, note = False, "".join(traceback.format_exception_only(exc))[:1500]
        print(f"{'ok  ' if good else 'FAIL'} {name} ({time.time() - started:.1f}s): {note}", flush=True)
        if not good:
            failed.append(name)
    print(f"{len(failed)} failed: {' '.join(failed)}")
    return bool(failed)


if __name__ == "__main__":
    raise SystemExit(main())
