"""Run every registered query in Spark and its oracle SQL in DuckDB; compare like the driver does
(row count, column names, order-insensitive values with doubles rounded to 6 places).

    python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    import numpy as np
    if v is None:
        return None
    if isinstance(v, float) or isinstance(v, np.floating):
        if math.isnan(v):
            return None
        return round(float(v), 6)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (np.bool_,)):
        return bool(v)
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return cols, sorted(out, key=repr)


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from tandem.session import build_session
    spark = build_session(shuffle_partitions=8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or list(qs):
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir)
            stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
            sp = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: spark error {str(e)[:400]}")
            bad += 1
            continue
        t1 = time.time()
        if k not in sqls:
            print(f"ROWS {k}: {len(sp)} rows (no oracle) {t1 - t0:.1f}s")
            continue
        try:
            rel = con.sql(sqls[k])
            dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
            dd = rel.df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        m = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "float": "FLOAT"}
        tdiff = {c: (t, dtypes.get(c)) for c, t in stypes.items() if m.get(t, t) != dtypes.get(c)}
        if tdiff:
            print(f"TYPE {k}: {tdiff}")
        sc, sr = rows_of(sp)
        dc, dr = rows_of(dd)
        if sc != dc:
            print(f"FAIL {k}: columns {sc} vs {dc}")
            bad += 1
        elif len(sr) != len(dr):
            print(f"FAIL {k}: rows {len(sr)} vs {len(dr)}")
            bad += 1
        elif sr != dr:
            diff = [(a, b) for a, b in zip(sr, dr) if a != b][:2]
            print(f"FAIL {k}: values differ, e.g. {str(diff)[:600]}")
            bad += 1
        else:
            print(f"OK   {k}: {len(sr)} rows {t1 - t0:.1f}s")
    print(f"{bad} failures")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
