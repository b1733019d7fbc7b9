"""The input tables with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class Tables:
    """Attribute access to the tables of one directory: ``Tables(spark, d).lineitem``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._held: list[DataFrame] = []

    def file(self, name: str) -> str:
        return f"{self.path}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.file(name))

    def hold(self, df: DataFrame) -> DataFrame:
        """Keep a table that several fits read, until the query function returns."""
        self._held.append(df.persist())
        return df

    def release(self) -> None:
        while self._held:
            self._held.pop().unpersist()

    def spread(self, name: str) -> DataFrame:
        """The table for work that is heavy per row.

        A small file arrives as one split and would keep one core busy; it is dealt out to
        all of them. An input that already has enough splits is left as it is.
        """
        df = getattr(self, name)
        cores = self.spark.sparkContext.defaultParallelism
        return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
