"""Compare every registered query with its DuckDB oracle (row count, columns,
order-insensitive value hash), like the driver's correctness gate.

usage: python tests/check_oracle.py [sf_dir] [name ...]
"""
import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from panelkit.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
            "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "float": "FLOAT"}


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in oracle:
            print(f"rows-only {name}: {len(srows)} rows ({ts:.1f}s)")
            continue
        try:
            res = con.execute(oracle[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:600]}")
            bad += 1
            continue
        stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        otypes = {d[0]: str(d[1]) for d in res.description}
        tdiff = {c: (stypes.get(c), otypes.get(c)) for c in stypes
                 if TYPE_MAP.get(stypes.get(c), stypes.get(c)) != TYPE_MAP.get(otypes.get(c), otypes.get(c))}
        if tdiff and os.environ.get("CHECK_TYPES"):
            print(f"   types differ in {name}: {tdiff}")
        hs, ls = digest(scols, srows)
        ho, lo = digest(ocols, orows)
        ok = sorted(scols) == sorted(ocols) and len(srows) == len(orows) and hs == ho
        print(f"{'ok  ' if ok else 'FAIL'} {name}: rows {len(srows)}/{len(orows)} ({ts:.1f}s)")
        if not ok:
            bad += 1
            if sorted(scols) != sorted(ocols):
                print("   cols spark :", sorted(scols))
                print("   cols oracle:", sorted(ocols))
            else:
                so, oo = set(ls), set(lo)
                print("   cols:", sorted(scols))
                for x in sorted(so - oo)[:3]:
                    print("   spark :", x[:400])
                for x in sorted(oo - so)[:3]:
                    print("   oracle:", x[:400])
    print(f"{bad} failing")
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
