"""Canonical column lists of the eight source tables (TPC-H layout).

The column order is the landing order of the bronze layer.  The type is the
canonical type used when a column is missing from a delivered file (it is
then added as a typed NULL); columns present in the file keep their
delivered type and are cast by the silver layer.
"""

from __future__ import annotations

from pyspark.sql.types import (DateType, DecimalType, IntegerType, LongType,
                               StringType, StructField, StructType)

_S, _L, _I, _D = StringType(), LongType(), IntegerType(), DateType()
_M = DecimalType(12, 2)

# TPC-H source columns, in landing order, with canonical types.
SOURCE_COLUMNS: dict[str, list[tuple[str, object]]] = {
    "customer": [("c_custkey", _L), ("c_name", _S), ("c_address", _S), ("c_nationkey", _L),
                 ("c_phone", _S), ("c_acctbal", _M), ("c_mktsegment", _S), ("c_comment", _S)],
    "orders": [("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_totalprice", _M),
               ("o_orderdate", _D), ("o_orderpriority", _S), ("o_clerk", _S),
               ("o_shippriority", _I), ("o_comment", _S)],
    "lineitem": [("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_linenumber", _I),
                 ("l_quantity", DecimalType(10, 2)), ("l_extendedprice", _M),
                 ("l_discount", DecimalType(5, 4)), ("l_tax", DecimalType(5, 4)),
                 ("l_returnflag", _S), ("l_linestatus", _S), ("l_shipdate", _D),
                 ("l_commitdate", _D), ("l_receiptdate", _D), ("l_shipinstruct", _S),
                 ("l_shipmode", _S), ("l_comment", _S)],
    "part": [("p_partkey", _L), ("p_name", _S), ("p_mfgr", _S), ("p_brand", _S), ("p_type", _S),
             ("p_size", _I), ("p_container", _S), ("p_retailprice", _M), ("p_comment", _S)],
    "supplier": [("s_suppkey", _L), ("s_name", _S), ("s_address", _S), ("s_nationkey", _L),
                 ("s_phone", _S), ("s_acctbal", _M), ("s_comment", _S)],
    "partsupp": [("ps_partkey", _L), ("ps_suppkey", _L), ("ps_availqty", _I),
                 ("ps_supplycost", _M), ("ps_comment", _S)],
    "nation": [("n_nationkey", _L), ("n_name", _S), ("n_regionkey", _L), ("n_comment", _S)],
    "region": [("r_regionkey", _L), ("r_name", _S), ("r_comment", _S)],
}

SOURCE_TABLES = tuple(SOURCE_COLUMNS)


def source_schema(name: str) -> StructType:
    return StructType([StructField(c, t, True) for c, t in SOURCE_COLUMNS[name]])
