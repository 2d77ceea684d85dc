from datetime import datetime

from pyspark.sql import functions as F

from sessionkit.session import scratch_path
from sessionkit.sources import io as IO
from sessionkit.streaming.ingest import ingest_csv, reject_counts


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, 100000, 6.55, 1e300), (-5, 3, 1.25, 2.0)],
                               "a long, b long, c double, d double")
    out, dec = IO.narrow_types(df)
    assert {c: n for c, _, n in dec} == {"a": "tinyint", "b": "int", "c": "float", "d": "double"}
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["tinyint", "int", "float", "double"]


def test_low_cardinality(spark):
    df = spark.createDataFrame([("x", f"u{i}") for i in range(10)], "t string, u string")
    r = {x.column_name: x.is_low_cardinality for x in IO.low_cardinality(df).collect()}
    assert r == {"t": True, "u": False}


def test_csv_roundtrip_and_stream_ingest_idempotent(spark, fixture_events):
    src = scratch_path(spark, "t-csv")
    IO.write_csv(fixture_events, src)
    back = IO.read_events_csv(spark, src)
    assert back.count() == fixture_events.count()
    t = back.filter(F.col("event_id") == 1).first().event_time
    assert t == datetime(2024, 1, 1, 10, 0, 0)
    table, ckpt = scratch_path(spark, "t-tab"), scratch_path(spark, "t-ckpt")
    ingest_csv(spark, src, table, ckpt)
    ingest_csv(spark, src, table, ckpt)          # nothing new: no duplicates
    assert spark.read.parquet(table).count() == fixture_events.count()


def test_monthly_partition_pruning(spark, fixture_events):
    path = scratch_path(spark, "t-month")
    IO.write_parquet(fixture_events, path, ["source_month"])
    df = IO.read_parquet(spark, path, months=["B"])
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "source_month" in plan


def test_monthly_csv_layout(spark, tmp_path):
    f = tmp_path / "2019-Oct.csv"
    f.write_text("event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
                 "2019-10-01 00:00:00 UTC,view,44600062,2103807459595387724,,shiseido,35.79,541312140,72d76fde\n"
                 "2019-10-01 00:00:05 UTC,cart,3900821,2053013552326770905,appliances.water_heater,aqua,33.20,554748717,9333dfbd\n")
    df = IO.read_monthly_csv(spark, str(f), "2019-10")
    rows = df.orderBy("event_time").collect()
    assert [r.event_type for r in rows] == ["view", "cart"]
    assert rows[1].event_time == datetime(2019, 10, 1, 0, 0, 5)
    assert rows[0].category_code is None and rows[1].price == 33.2
    assert rows[0].source_month == "2019-10" and df.columns[0] == "source_month"
    ids = [r.event_id for r in rows]
    assert ids == sorted(ids) and len(set(ids)) == 2


def test_stream_ingest_monthly_layout(spark, tmp_path):
    src = tmp_path / "drop"
    src.mkdir()
    head = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
    (src / "2019-Oct.csv").write_text(head + "2019-10-31 23:59:00 UTC,cart,1,9,,b,5.0,7,s1\n")
    (src / "2019-Nov.csv").write_text(head + "2019-11-01 00:01:00 UTC,purchase,1,9,,b,5.0,7,s1\n")
    table, ckpt = scratch_path(spark, "t-mtab"), scratch_path(spark, "t-mckpt")
    ingest_csv(spark, str(src), table, ckpt, monthly_layout=True)
    got = sorted((r.source_month, r.event_type) for r in spark.read.parquet(table).collect())
    assert got == [("2019-Nov", "purchase"), ("2019-Oct", "cart")]


def test_stream_ingest_is_incremental(spark, tmp_path):
    src = tmp_path / "drops"
    src.mkdir()
    head = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
    (src / "2019-Oct.csv").write_text(head + "2019-10-02 10:00:00 UTC,view,1,9,,b,5.0,7,s1\n")
    table, ckpt = scratch_path(spark, "t-inc"), scratch_path(spark, "t-inc-ckpt")
    ingest_csv(spark, str(src), table, ckpt, monthly_layout=True)
    assert spark.read.parquet(table).count() == 1
    (src / "2019-Nov.csv").write_text(head + "2019-11-02 10:00:00 UTC,cart,1,9,,b,5.0,7,s2\n"
                                      "2019-11-02 10:01:00 UTC,purchase,1,9,,b,5.0,7,s2\n")
    ingest_csv(spark, str(src), table, ckpt, monthly_layout=True)
    got = {r.source_month: r["count"] for r in spark.read.parquet(table).groupBy("source_month").count().collect()}
    assert got == {"2019-Oct": 1, "2019-Nov": 2}


def test_rows_that_do_not_parse_are_set_aside(spark, tmp_path):
    head = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
    good = "2019-10-01 00:00:0{} UTC,view,1,2,,b,1.5,7,s{}\n"
    src = tmp_path / "src"
    src.mkdir()
    (src / "2019-Oct.csv").write_text(head + good.format(1, 1) + "not a time,view,x1,2,,b,1.5,7,s2\n"
                                      + "2019-10-01 00:00:03 UTC,view,1\n" + good.format(4, 4))
    table, rejects, ckpt = (str(tmp_path / n) for n in ("t", "r", "c"))
    args = dict(monthly_layout=True, rejects_dir=rejects)
    ingest_csv(spark, str(src), table, ckpt, **args)
    ingest_csv(spark, str(src), table, ckpt, **args)  # nothing new
    assert {r.user_session for r in spark.read.parquet(table).collect()} == {"s1", "s4"}
    bad = {r.line: r for r in spark.read.parquet(rejects).collect()}
    assert len(bad) == 2 and all(r.file.endswith("2019-Oct.csv") for r in bad.values())
    assert {r.reason for r in bad.values()} == {"event_time,product_id", "fields"}
    # a second file is the next batch; kept + rejected = read, batch by batch
    (src / "2019-Nov.csv").write_text(head + good.format(5, 5) + "2019-11-01 00:00:03 UTC,view,1,2,,b,?,7,s6\n")
    ingest_csv(spark, str(src), table, ckpt, **args)
    counts = {(r.ingest_batch, r.reason): r["rows"] for r in reject_counts(spark, table, rejects).collect()}
    assert counts == {(0, None): 2, (0, "event_time,product_id"): 1, (0, "fields"): 1,
                      (1, None): 1, (1, "price"): 1}
    months = {r.source_month for r in spark.read.parquet(table).select("source_month").collect()}
    assert months == {"2019-Oct", "2019-Nov"}
