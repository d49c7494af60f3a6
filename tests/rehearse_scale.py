"""Scale rehearsal: k key-shifted copies of the supplied orders, then the
Spark-vs-DuckDB comparison on them.

    python tests/rehearse_scale.py /root/testdata/sf0.1 10 [query ...]

The copies keep customer and nation as they are and shift order keys by
multiples of 10**7 (street numbers stay, ages and sizes move), so addresses
repeat across copies and the dedup sees many duplicates per address. The
data goes to a fresh local temp folder (a local rehearsal tool, not a
cluster job); nothing here is a registered query.
"""

from __future__ import annotations

import json
import sys
import tempfile
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def build(src: str, copies: int) -> str:
    out = Path(tempfile.mkdtemp(prefix="abode-rehearsal-")) / f"sf_x{copies}"
    out.mkdir()
    con = duckdb.connect()
    con.execute(
        f"""COPY (SELECT o_orderkey + i * 10000000 AS o_orderkey, o_custkey, o_orderstatus,
                         o_totalprice + i AS o_totalprice, o_orderdate, o_orderpriority
                  FROM read_parquet('{src}/orders.parquet'), range({copies}) t(i))
            TO '{out}/orders.parquet' (FORMAT PARQUET, ROW_GROUP_SIZE 100000)"""
    )
    for t in ("customer", "nation", "region"):
        con.execute(f"COPY (SELECT * FROM read_parquet('{src}/{t}.parquet')) TO '{out}/{t}.parquet' (FORMAT PARQUET)")
    return str(out)


if __name__ == "__main__":
    from abode.session import build_session
    from tests.oracle_compare import compare

    src = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    k = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    names = sys.argv[3:] or None
    data = build(src, k)
    spark = build_session("local[8]", shuffle_partitions=8)
    result = compare(spark, data, names)
    for name, rec in result.items():
        print(name, json.dumps(rec))
    print("MISMATCH:", [n for n, r in result.items() if not r.get("match", True)])
