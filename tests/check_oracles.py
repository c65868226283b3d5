"""Compare every registered query with its SQL: python -m tests.check_oracles [folder] [names]."""

import os
import sys
import time

import duckdb

import __spark_entry__ as entry
from gatewright.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
         "double": "DOUBLE"}


def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        path += "/*.parquet" if os.path.isdir(path) else ""
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(row):
    return tuple(round(v, 9) if isinstance(v, float) else v for v in row)


def compare(spark, con, folder, name):
    """None when equal, else a short text."""
    df = entry.queries()[name](spark, folder)
    columns = sorted(df.columns)
    mine = sorted((normal(r) for r in df.select(*columns).collect()), key=repr)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if mine else "no rows"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    if [names[i] for i in order] != columns:
        return f"columns {columns} / {sorted(names)}"
    types = dict(r[:2] for r in con.execute(f"DESCRIBE {sql}").fetchall())
    result = con.execute(sql)
    for field in df.schema:
        if TYPES.get(field.dataType.simpleString()) != types[field.name]:
            return f"type of {field.name}: {field.dataType.simpleString()} / {types[field.name]}"
    theirs = sorted((normal(tuple(r[i] for i in order)) for r in result.fetchall()), key=repr)
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            cells = [(c, x, y) for c, x, y in zip(columns, a, b) if x != y]
            return "values " + repr(cells)[:600]
    return None


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = local_session(8), duck(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{name:30s} {time.time() - start:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print("problems:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main()))
