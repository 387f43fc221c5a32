"""Write a skewed copy of the tables: hot keys with a third of the rows, orphans and nulls.

Usage: python scripts/make_skewed.py source_folder target_folder
"""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb

# One row in three gets the hot key; some rows get a key no dimension has, or null.
CHANGED = {
    "lineitem": """
SELECT CASE WHEN h % 3 = 0 THEN 1 ELSE l_orderkey END AS l_orderkey,
       CASE WHEN h % 3 = 0 THEN 2 WHEN h % 41 = 0 THEN -5 ELSE l_partkey END AS l_partkey,
       CASE WHEN h % 3 = 0 THEN 3 ELSE l_suppkey END AS l_suppkey, l_linenumber, l_quantity,
       l_extendedprice, l_discount, CASE WHEN h % 29 = 0 THEN NULL ELSE l_tax END AS l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey) AS h
      FROM src_lineitem)""",
    "orders": """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN 7 WHEN o_orderkey % 31 = 0 THEN NULL
         WHEN o_orderkey % 37 = 0 THEN -1 ELSE o_custkey END AS o_custkey,
       o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM src_orders""",
    "events": """
SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN 3 ELSE user_id END AS user_id, event_type,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS value,
       CASE WHEN event_id % 3 = 0 THEN '{"k": 4}' WHEN event_id % 23 = 0 THEN '{}' ELSE props END
         AS props
FROM src_events""",
    "documents": """
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN (SELECT text FROM src_documents WHERE doc_id = 1)
         ELSE text END AS text,
       CASE WHEN doc_id % 3 = 0 THEN 'en' ELSE lang END AS lang,
       CASE WHEN doc_id % 3 = 0 THEN 'src0' ELSE source END AS source, n_chars
FROM src_documents""",
}


def make_skewed(source: str, target: str) -> None:
    Path(target).mkdir(parents=True, exist_ok=True)
    con = duckdb.connect()
    for path in sorted(Path(source).glob("*.parquet")):
        con.execute(f"CREATE VIEW src_{path.stem} AS SELECT * FROM '{path}'")
        sql = CHANGED.get(path.stem, f"SELECT * FROM src_{path.stem}")
        con.execute(f"COPY ({sql}) TO '{target}/{path.stem}.parquet' (FORMAT parquet)")


if __name__ == "__main__":
    make_skewed(sys.argv[1], sys.argv[2])
