"""Compare a Spark query with its DuckDB oracle (row count, columns, values).

Usable from pytest and as a script:
``python -m tests.oracle /root/testdata/sf0.01 [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


# Spark and DuckDB spellings of the same value types.
_FAMILY = {"bigint": "int64", "BIGINT": "int64", "int": "int32", "INTEGER": "int32",
           "string": "text", "VARCHAR": "text", "double": "float64", "DOUBLE": "float64",
           "timestamp_ntz": "timestamp", "TIMESTAMP": "timestamp", "boolean": "bool",
           "BOOLEAN": "bool"}


def _family(name: str) -> str:
    return _FAMILY.get(name, name)


def _canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    data = [tuple(_norm(r[i]) for i in order) for r in rows]
    data.sort(key=lambda t: tuple((x is None, str(x)) for x in t))
    return names, data


def compare(spark, con, name, build, sql, sf_dir):
    t0 = time.time()
    sdf = build(spark, sf_dir)
    spark_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.execute(sql)
    duck_cols = [d[0] for d in rel.description]
    duck_rows = rel.fetchall()
    s_names, s_data = _canon(sdf.columns, spark_rows)
    d_names, d_data = _canon(duck_cols, duck_rows)
    s_types = {c: _family(t) for c, t in sdf.dtypes}
    d_types = {d[0]: _family(str(d[1])) for d in rel.description}
    result = {
        "name": name, "spark_rows": len(s_data), "oracle_rows": len(d_data),
        "columns_match": s_names == d_names, "types_match": s_types == d_types,
        "values_match": s_data == d_data, "spark_sec": round(t1 - t0, 2),
    }
    if not result["values_match"] and s_names == d_names:
        sset, dset = set(s_data), set(d_data)
        result["only_spark"] = list(sset - dset)[:3]
        result["only_oracle"] = list(dset - sset)[:3]
    elif s_names != d_names:
        result["spark_columns"], result["oracle_columns"] = s_names, d_names
    return result


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from snapweave.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    spark = local_session(cpus=8, shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, build in qs.items():
        if wanted and name not in wanted:
            continue
        if name not in sqls:
            print(name, "no oracle")
            continue
        r = compare(spark, con, name, build, sqls[name], sf_dir)
        ok = (r["columns_match"] and r["types_match"] and r["values_match"]
              and r["spark_rows"] == r["oracle_rows"])
        bad += not ok
        print(("OK  " if ok else "FAIL"), r)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv))
