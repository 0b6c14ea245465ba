"""Compare catalog queries with their SQL in DuckDB, value by value.

    python tests/parity.py [sf_dir] [query ...]
"""

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if hasattr(value, "isoformat"):
        return (1, pd.Timestamp(value).isoformat())
    if isinstance(value, (int, float)) or hasattr(value, "dtype"):
        return (1, repr(float(value)))
    return (1, str(value))


def rows_of(frame):
    names = sorted(frame.columns)
    records = frame[names].astype(object).itertuples(index=False, name=None)
    return names, sorted(tuple(plain(v) for v in row) for row in records)


def differences(spark_frame, sql_frame):
    names, got = rows_of(spark_frame)
    wanted_names, wanted = rows_of(sql_frame)
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if len(got) != len(wanted):
        return f"rows {len(got)} != {len(wanted)}"
    for a, b in zip(got, wanted):
        if a != b:
            different = sum(x != y for x, y in zip(got, wanted))
            return f"{different} of {len(got)} rows differ, first:\n  {dict(zip(names, a))}\n  {dict(zip(names, b))}"
    return None


def types_of(spark_schema, relation):
    known = {
        "integer": "INTEGER", "long": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
        "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
    }
    found = dict(zip(relation.columns, map(str, relation.types)))
    return {
        f.name: (f.dataType.typeName(), found.get(f.name))
        for f in spark_schema.fields
        if known.get(f.dataType.typeName()) != found.get(f.name)
    }


def main(sf_dir, wanted):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), entry.oracle_sql()
    bad = []
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            frame = df.toPandas()
            spent = time.time() - start
            if name not in sql:
                print(f"{name}: {len(frame)} rows, no SQL, {spent:.1f}s", flush=True)
                continue
            relation = con.sql(sql[name])
            types = types_of(df.schema, relation)
            problem = differences(frame, relation.df())
        except Exception as error:  # noqa: BLE001
            problem, types, spent, frame = f"{type(error).__name__}: {str(error)[:1500]}", {}, time.time() - start, []
        print(f"{name}: {'ok' if problem is None else 'BAD ' + problem} {len(frame)} rows {spent:.1f}s {types or ''}", flush=True)
        if problem is not None or types:
            bad.append(name)
    print("not matching:", bad or "none")
    return bad


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(bool(main(folder, set(sys.argv[2:]))))
