"""Run registered queries on Spark and their SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def spark_rows(df):
    names = sorted(df.columns)
    rows = df.select(*names).collect()
    return names, Counter(tuple(plain(v) for v in r) for r in rows)


SAME = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "SMALLINT": "smallint", "FLOAT": "float",
}


def type_mismatches(df, con, sql):
    cursor = con.execute(sql)
    wanted = {d[0]: SAME.get(str(d[1]), str(d[1])) for d in cursor.description}
    return {n: (t, wanted[n]) for n, t in df.dtypes if wanted.get(n) != t}


def oracle_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = cursor.fetchall()
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, build, sql, sf_dir):
    """'' when both agree, else what differs."""
    df = build(spark, sf_dir)
    names, got = spark_rows(df)
    wanted_names, wanted = oracle_rows(con, sql)
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if got != wanted:
        extra, lacking = got - wanted, wanted - got
        return (f"{sum(got.values())} rows against {sum(wanted.values())}; "
                f"only Spark {list(extra.items())[:2]}; only SQL {list(lacking.items())[:2]}")
    wrong = type_mismatches(df, con, sql)
    return f"types {wrong}" if wrong else ""


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from __spark_entry__ import oracle_sql, queries
    from reviewlake.session import get_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = get_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.sql.ui.retainedExecutions": "1"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), oracle_sql(), 0
    for name, build in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        begin = time.time()
        try:
            if name in sqls:
                verdict = compare(spark, con, build, sqls[name], sf_dir) or "ok"
            else:
                verdict = f"rows {build(spark, sf_dir).count()}"
        except Exception as error:  # noqa: BLE001
            verdict = "ERROR " + str(error).replace("\n", " ")[:600]
        bad += not verdict.startswith(("ok", "rows"))
        print(f"{name:38s} {time.time() - begin:6.2f}s {verdict}", flush=True)
    print("failed:", bad)
