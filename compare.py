"""Run the registered queries beside their SQL checks and report differences.

    python compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0  # -0.0 becomes 0.0; nothing is rounded
    return value


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in records), key=repr)


def differences(frame, connection, sql: str) -> str | None:
    """What is different between a frame and the result of a SQL text, or None."""
    result = connection.execute(sql)
    names, records = [d[0] for d in result.description], result.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    ours = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    theirs = _rows(names, records)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for one, two in zip(ours, theirs):
        if one != two or [type(v) for v in one] != [type(v) for v in two]:
            return f"{str(one)[:400]} against {str(two)[:400]}"
    return None if ours else "no rows"


def main() -> None:
    import registry
    from temperament.session import local_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    registry.load_all()
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(folder)
    failed = 0
    for name, function in registry.QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        started = time.time()
        try:
            frame = function(spark, folder)
            if name in registry.ORACLES:
                problem = differences(frame, connection, registry.ORACLES[name])
            else:
                problem = None if frame.count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = str(error)[:900]
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - started:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
