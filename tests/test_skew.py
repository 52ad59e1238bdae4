"""Results stay exact when one host holds a third of all rows and AQE splits skewed partitions."""
import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tools.oracle_check import digest

SF0001 = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture()
def skewed_dir(spark, scratch):
    out = f"{scratch}/skewed"
    for t in TABLES:
        df = spark.read.parquet(f"{SF0001}/{t}.parquet")
        if t == "orders":  # a third of all orders (and their line items) move to customer 0
            df = df.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(0).cast("bigint"))
                               .otherwise(F.col("o_custkey")))
        df.coalesce(1).write.parquet(f"{out}/{t}.parquet")
    return out


def test_marts_exact_under_hot_host(spark, skewed_dir):
    saved = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{skewed_dir}/{t}.parquet/*.parquet')")
        hot = con.execute("SELECT max(c) * 4 >= sum(c) FROM (SELECT count(*) c FROM lineitem l "
                          "JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY o.o_custkey)").fetchone()[0]
        assert hot
        qs, sqls = entry.queries(), entry.oracle_sql()
        for name in ["dm_property_type", "dm_listing_neighbourhood", "dm_host_neighbourhood", "host_snapshot",
                     "fact_host_as_of"]:
            df = qs[name](spark, skewed_dir)
            res = con.execute(sqls[name])
            dcols = [d[0] for d in res.description]
            assert digest([tuple(r) for r in df.collect()], df.columns)[0] == digest(res.fetchall(), dcols)[0], name
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
