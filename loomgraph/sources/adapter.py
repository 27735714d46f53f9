"""The driver's tables as occurrences of typed nodes and edges.

One order is one chunk of text. The SQL uses only what Spark and other engines have in common, so that oracles can
build on the same occurrences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

_CHUNK = "'ch_' || lpad(CAST({k} AS STRING), 12, '0')"
_OF_ORDER = "6e-1 + (o.o_orderkey % 40) / 1e2"
_OF_LINE = "1e0 - 4e0 * l.l_discount"
_LINES = "{lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey"
_CHUNK_O, _CHUNK_L = _CHUNK.replace("{k}", "o.o_orderkey"), _CHUNK.replace("{k}", "l.l_orderkey")

#: chunk_id, pos (order of reading), id, type, name, confidence
NODES = f"""
SELECT {_CHUNK_O} AS chunk_id, o.o_orderkey * 100 AS pos, 'ev_' || CAST(o.o_orderkey AS STRING) AS id, 'Event' AS type, 'Order ' || CAST(o.o_orderkey AS STRING) AS name, {_OF_ORDER} AS confidence FROM {{orders}} o
UNION ALL SELECT {_CHUNK_O}, o.o_orderkey * 100 + 10, 'cu_' || CAST(c.c_custkey AS STRING), 'Person', c.c_name, {_OF_ORDER} FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey
UNION ALL SELECT {_CHUNK_O}, o.o_orderkey * 100 + 11, 'na_' || CAST(n.n_nationkey AS STRING), 'Place', n.n_name, {_OF_ORDER} FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey
UNION ALL SELECT {_CHUNK_O}, o.o_orderkey * 100 + 12, 'ph_' || lower(substring(o.o_orderpriority, 1, 1)), 'Phase', o.o_orderpriority, {_OF_ORDER} FROM {{orders}} o
UNION ALL SELECT {_CHUNK_O}, o.o_orderkey * 100 + 13, 'er_' || CAST(year(o.o_orderdate) % 4 AS STRING), 'Era', 'Era ' || CAST(year(o.o_orderdate) % 4 AS STRING), {_OF_ORDER} FROM {{orders}} o
UNION ALL SELECT {_CHUNK_L}, l.l_orderkey * 100 + 20 + l.l_linenumber, 'su_' || CAST(s.s_suppkey AS STRING), 'Person', s.s_name, {_OF_LINE} FROM {{lineitem}} l JOIN {{supplier}} s ON l.l_suppkey = s.s_suppkey
UNION ALL SELECT {_CHUNK_L}, l.l_orderkey * 100 + 30 + l.l_linenumber, 'pt_' || CAST(p.p_partkey AS STRING), 'Work', p.p_name, {_OF_LINE} FROM {_LINES}
UNION ALL SELECT {_CHUNK_L}, l.l_orderkey * 100 + 40 + l.l_linenumber, 'br_' || p.p_brand, CASE WHEN p.p_size % 2 = 1 THEN 'Work' ELSE 'Theme' END, p.p_brand, {_OF_LINE} FROM {_LINES}
UNION ALL SELECT {_CHUNK_L}, l.l_orderkey * 100 + 50 + l.l_linenumber, 'th_' || p.p_type, 'Theme', p.p_type, {_OF_LINE} FROM {_LINES}
"""

_NEXT = "(SELECT o_orderkey, o_totalprice, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_key, lead(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_price FROM {orders})"

#: chunk_id, pos, source_id, target_id, type, role, confidence
EDGES = f"""
SELECT {_CHUNK_L} AS chunk_id, l.l_orderkey * 100 + 20 + l.l_linenumber AS pos, 'ev_' || CAST(l.l_orderkey AS STRING) AS source_id, 'su_' || CAST(l.l_suppkey AS STRING) AS target_id, 'INVOLVES' AS type,
  CASE l.l_returnflag WHEN 'R' THEN 'protagonist' WHEN 'A' THEN 'participant' ELSE 'mentioned' END AS role, {_OF_LINE} AS confidence FROM {{lineitem}} l
UNION ALL SELECT {_CHUNK_O}, o.o_orderkey * 100 + 11, 'ev_' || CAST(o.o_orderkey AS STRING), 'na_' || CAST(c.c_nationkey AS STRING), 'LOCATED_AT', NULL, {_OF_ORDER} FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey WHERE o.o_orderkey % 10 < 8
UNION ALL SELECT {_CHUNK_O}, o.o_orderkey * 100 + 12, 'ev_' || CAST(o.o_orderkey AS STRING), 'ph_' || lower(substring(o.o_orderpriority, 1, 1)), 'DURING', NULL, {_OF_ORDER} FROM {{orders}} o
UNION ALL SELECT {_CHUNK_O}, o.o_orderkey * 100 + 13, 'ev_' || CAST(o.o_orderkey AS STRING), 'er_' || CAST(year(o.o_orderdate) % 4 AS STRING), 'DURING', NULL, {_OF_ORDER} FROM {{orders}} o WHERE o.o_orderkey % 10 < 7
UNION ALL SELECT {_CHUNK_O}, o.o_orderkey * 100 + 14, 'ph_' || lower(substring(o.o_orderpriority, 1, 1)), 'er_' || CAST(year(o.o_orderdate) % 4 AS STRING), 'OCCURS_IN', NULL, {_OF_ORDER} FROM {{orders}} o WHERE o.o_orderkey % 50 = 1
UNION ALL SELECT {_CHUNK_L}, l.l_orderkey * 100 + 50 + l.l_linenumber, 'ev_' || CAST(l.l_orderkey AS STRING), 'th_' || p.p_type, 'EMBODIES', NULL, {_OF_LINE} FROM {_LINES} WHERE l.l_linenumber <= 3
UNION ALL SELECT {_CHUNK_L}, l.l_orderkey * 100 + 60 + l.l_linenumber, 'ev_' || CAST(l.l_orderkey AS STRING), 'br_' || p.p_brand, 'EMBODIES', NULL, {_OF_LINE} FROM {_LINES} WHERE l.l_linenumber = 1
UNION ALL SELECT {_CHUNK_L}, l.l_orderkey * 100 + 30 + l.l_linenumber, 'su_' || CAST(l.l_suppkey AS STRING), 'pt_' || CAST(l.l_partkey AS STRING), 'CREATED', NULL, {_OF_LINE} FROM {{lineitem}} l WHERE l.l_linenumber <= 2
UNION ALL SELECT {_CHUNK.replace("{k}", "f.o_orderkey")}, f.o_orderkey * 100 + 15, 'ev_' || CAST(f.o_orderkey AS STRING), 'ev_' || CAST(f.next_key AS STRING), CASE WHEN f.next_price > f.o_totalprice THEN 'CAUSED' ELSE 'FOLLOWS' END, NULL, 8e-1 FROM {_NEXT} f WHERE f.next_key IS NOT NULL
"""




def _line(names: str, pos: int, *values: str) -> str:
    """A struct of the columns names of a row that stands at pos in its line."""
    whole = [_CHUNK_L, f"l.l_orderkey * 100 + {pos} + l.l_linenumber", *values, _OF_LINE]
    return "struct(" + ", ".join(f"{v} AS {c}" for v, c in zip(whole, names.split(), strict=True)) + ")"


_node, _arc = (lambda *a: _line("chunk_id pos id type name confidence", *a)), (lambda pos, target: _line("chunk_id pos source_id target_id type role confidence", pos, "'ev_' || CAST(l.l_orderkey AS STRING)", target, "'EMBODIES'", "CAST(NULL AS STRING)"))
_WORK, _BRAND, _THEME = _node(30, "'pt_' || CAST(p.p_partkey AS STRING)", "'Work'", "p.p_name"), _node(40, "'br_' || p.p_brand", "CASE WHEN p.p_size % 2 = 1 THEN 'Work' ELSE 'Theme' END", "p.p_brand"), _node(50, "'th_' || p.p_type", "'Theme'", "p.p_type")
_TO_THEME, _TO_BRAND = _arc(50, "'th_' || p.p_type"), _arc(60, "'br_' || p.p_brand")


def _once(sql: str, joined: str) -> str:
    """sql with one join of line items and parts instead of a branch for each kind of row that comes of it."""
    return "\nUNION ALL ".join([b.strip() for b in sql.split("UNION ALL ") if "{part}" not in b] + [f"SELECT inline({joined}) FROM {_LINES}"])


#: The rows of NODES and EDGES as Spark makes them.
NODES_ONCE = _once(NODES, f"array({_WORK}, {_BRAND}, {_THEME})")
EDGES_ONCE = _once(EDGES, f"CASE WHEN l.l_linenumber = 1 THEN array({_TO_THEME}, {_TO_BRAND}) ELSE array({_TO_THEME}) END") + " WHERE l.l_linenumber <= 3"

#: Tables of a fixed size; the others are never broadcast, as a file of a few MB may hold a million rows.
FIXED = ["region", "nation"]


def occurrences(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **{t: df if t in FIXED else df.hint("merge") for t, df in used.items()})


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occurrences(spark, sf_dir, NODES_ONCE)


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occurrences(spark, sf_dir, EDGES_ONCE)


def with_occurrences(sql: str) -> str:
    """Oracle SQL over node_occ and edge_occ."""
    names = {t: t for t in TABLES}
    recursive = "RECURSIVE " if "WITH RECURSIVE" in sql else ""
    head = f"WITH {recursive}node_occ AS MATERIALIZED ({NODES.format(**names)}), edge_occ AS MATERIALIZED ({EDGES.format(**names)})"
    body = sql.strip().removeprefix("WITH ").removeprefix("RECURSIVE ")
    return f"{head}, {body}" if sql.strip().startswith("WITH ") else f"{head} {sql}"
