"""Run queries next to their check SQL: python tests/compare.py SF_DIR [name ...]"""

import decimal
import math
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    base = duckdb.connect()
    base.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return base


def plain(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(repr(plain(row[i])) for i in order) for row in rows))


def compare(name, spark, base, sf_dir, queries, oracles):
    """None if equal, else what differs."""
    frame = queries[name](spark, sf_dir)
    rows = frame.collect()
    if name not in oracles:
        return None if rows else "no rows"
    result = base.execute(oracles[name])
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    ours, theirs = rows_of(frame.columns, rows), rows_of(columns, result.fetchall())
    if ours == theirs:
        return None if ours else "equal, but empty"
    extra = [r for r in ours if r not in set(theirs)][:2]
    lost = [r for r in theirs if r not in set(ours)][:2]
    return f"{len(ours)} rows != {len(theirs)}; only ours {extra}; only SQL {lost}"


def main(sf_dir, names):
    from __spark_entry__ import oracle_sql, queries

    from ledgerloom.session import build_session

    spark = build_session(
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    base, failed = connect(sf_dir), 0
    for name in names or queries():
        start = time.time()
        try:
            problem = compare(name, spark, base, sf_dir, queries(), oracle_sql())
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{time.time() - start:6.1f}s {name}: {problem or 'ok'}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
