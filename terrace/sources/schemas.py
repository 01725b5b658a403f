"""Schema registry: explicit, all-nullable schemas by entity."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(),
    "string": T.StringType(), "boolean": T.BooleanType(), "binary": T.BinaryType(),
    "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
}


def schema(**fields: str) -> T.StructType:
    """``schema(id="long", name="string")`` as a nullable struct type."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields.items()])


SCHEMAS: dict[str, T.StructType] = {
    "region": schema(r_regionkey="int", r_name="string"),
    "nation": schema(n_nationkey="int", n_name="string", n_regionkey="int"),
    "customer": schema(
        c_custkey="long", c_name="string", c_nationkey="int", c_acctbal="double",
        c_mktsegment="string"),
    "supplier": schema(s_suppkey="long", s_name="string", s_nationkey="int", s_acctbal="double"),
    "part": schema(
        p_partkey="long", p_name="string", p_brand="string", p_type="string", p_size="int",
        p_retailprice="double"),
    "orders": schema(
        o_orderkey="long", o_custkey="long", o_orderstatus="string", o_totalprice="double",
        o_orderdate="timestamp_ntz", o_orderpriority="string"),
    "lineitem": schema(
        l_orderkey="long", l_partkey="long", l_suppkey="long", l_linenumber="int",
        l_quantity="double", l_extendedprice="double", l_discount="double", l_tax="double",
        l_returnflag="string", l_linestatus="string", l_shipdate="timestamp_ntz"),
}
