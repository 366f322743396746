"""Loading the driver-provided Parquet tables (pruned to the columns a query needs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Declared schemas of the driver tables the warehouse reads: a declared schema skips the
# footer-reading inference job that every schemaless Parquet read launches.
_L, _I, _S, _D, _TS = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.TimestampNTZType()
SCHEMAS: dict[str, T.StructType] = {
    "customer": T.StructType(
        [T.StructField(n, t) for n, t in [("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I), ("c_acctbal", _D), ("c_mktsegment", _S)]]
    ),
    "nation": T.StructType([T.StructField(n, t) for n, t in [("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)]]),
    "part": T.StructType(
        [
            T.StructField(n, t)
            for n, t in [("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S), ("p_size", _I), ("p_retailprice", _D)]
        ]
    ),
    "orders": T.StructType(
        [
            T.StructField(n, t)
            for n, t in [
                ("o_orderkey", _L),
                ("o_custkey", _L),
                ("o_orderstatus", _S),
                ("o_totalprice", _D),
                ("o_orderdate", _TS),
                ("o_orderpriority", _S),
            ]
        ]
    ),
    "lineitem": T.StructType(
        [
            T.StructField(n, t)
            for n, t in [
                ("l_orderkey", _L),
                ("l_partkey", _L),
                ("l_suppkey", _L),
                ("l_linenumber", _I),
                ("l_quantity", _D),
                ("l_extendedprice", _D),
                ("l_discount", _D),
                ("l_tax", _D),
                ("l_returnflag", _S),
                ("l_linestatus", _S),
                ("l_shipdate", _TS),
            ]
        ]
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table. Parquet gives column pruning and filter pushdown for free."""
    if name not in TABLE_NAMES:
        raise ValueError(f"unknown table {name!r}")
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            if name not in self._frames:
                self._frames[name] = table(self.spark, self.sf_dir, name)
            return self._frames[name]
        raise AttributeError(name)
