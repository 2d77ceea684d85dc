"""Golden counts of the driver tables through the adapter (FIXTURES.md 2)."""
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sessionkit.operators import sessions as S
from sessionkit.sources.adapter import load_events

SF_SMALL = "/root/testdata/sf0.001"


def test_entry_counts(spark):
    df = entry.entry(spark)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum("is_abandoned").alias("ab"),
                 F.count_if(F.col("brands_viewed") == 0).alias("zb"),
                 F.sum("is_returning_user").alias("ret"),
                 F.count_if(F.col("duration_seconds") == 0).alias("zd")).first()
    assert (row.n, row.ab, row.zb, row.ret, row.zd) == (366, 105, 14, 351, 120)


def test_adapter_counts(spark):
    ev = load_events(spark, SF_SMALL)
    assert ev.count() == 1000
    assert S.valid_events(ev).count() == 799


def test_every_key_has_a_callable_and_most_have_sql():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60
