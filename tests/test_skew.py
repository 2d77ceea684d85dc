"""A hot session / hot user holding a third of all rows: results must equal a
brute-force computation, and the default plans must aggregate before any
shuffle and use no per-group window."""
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from sessionkit.operators import sessions as S
from sessionkit.sources.schema import EVENT_SCHEMA

T0 = datetime(2024, 1, 1)


def _skewed(spark):
    rows, eid = [], 0
    types = ["view", "view", "cart", "view", "purchase"]
    for i in range(3000):                      # the hot session: a third of all rows
        rows.append(("A", eid, T0 + timedelta(seconds=i), types[i % 5], i % 97,
                     f"c{i % 11}", None if i % 13 == 0 else f"b{i % 17}",
                     1.0 + (i % 50), 1, "hot"))
        eid += 1
    for s in range(3000):                      # 3000 small sessions, user 1 owns a third
        for j in range(2):
            rows.append(("A" if s % 2 else "B", eid, T0 + timedelta(hours=1 + s, seconds=j),
                         "cart" if j else "view", s % 50, None, f"b{s % 5}", 2.0 + j,
                         1 if s < 1000 else 2 + s, f"s{s}"))
            eid += 1
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def test_hot_session_roll_up_matches_brute_force(spark):
    ev = _skewed(spark)
    got = S.segment_sessions(S.valid_events(ev)).filter(F.col("user_session") == "hot").first()
    pdf = ev.filter(F.col("user_session") == "hot").toPandas()
    assert got.total_events == len(pdf) == 3000
    assert got.unique_products == pdf.product_id.nunique()
    assert got.unique_brands == pdf.brand.nunique()
    assert got.unique_categories == pdf.category_code.nunique()
    assert abs(got.avg_price - pdf.price.mean()) < 1e-9
    assert got.view_count == int((pdf.event_type == "view").sum())
    assert got.is_abandoned == 0


def test_hot_user_returning_flag(spark):
    ev = _skewed(spark)
    sess = S.enriched_sessions(S.valid_events(ev))
    got = {r.user_session: r.is_returning_user for r in S.returning_users(sess).collect()}
    # user 1: the hot session starts first, every other session of user 1 returns
    assert got["hot"] == 0 and got["s0"] == 1 and got["s999"] == 1
    assert got["s1000"] == 0
    pdf = sess.toPandas()
    first = pdf.groupby("user_id").session_start.transform("min")
    want = dict(zip(pdf.user_session, (pdf.session_start > first).astype(int)))
    assert got == want


def test_default_plans_are_skew_safe(spark):
    ev = _skewed(spark)
    plan = S.labeled_events(ev)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "HashAggregate" in plan
    sess = S.enriched_sessions(S.valid_events(ev))
    plan = S.returning_users(sess)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    agg_plan = sess._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in agg_plan                # map-side partial aggregation
    assert "collect_set" not in agg_plan and "collect_list" not in agg_plan
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_only_events_of_abandoned_sessions_are_shuffled(spark):
    ev = _skewed(spark)
    abandoned = S.abandoned_sessions(ev)
    want = {f"s{s}" for s in range(3000)}        # the hot session has purchases
    assert {r.user_session for r in abandoned.collect()} == want
    few = abandoned.filter("user_session < 's2'")  # s0, s1, s10 ... s1999
    keys = [r.user_session for r in few.collect()]
    tested = S.maybe_abandoned(ev, few).groupBy("user_session", "_maybe").count().collect()
    passed = {r["user_session"] for r in tested if r["_maybe"]}
    assert passed >= set(keys) and len(passed) <= len(keys) * 1.05
    assert sum(r["count"] for r in tested) == ev.count()


def test_labels_by_filter_equal_the_window_form(spark):
    ev = _skewed(spark)
    want = sorted((r.event_id, r.is_abandoned) for r in S.labeled_events(ev, "window").collect())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the keys were too many
    try:
        for words in (S.FILTER_WORDS, 64, 1, 0):  # down to a filter that all events pass
            out = S.labeled_events(ev, filter_words=words)
            assert sorted((r.event_id, r.is_abandoned) for r in out.collect()) == want
        plan = S.labeled_events(ev)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the shuffled branch is filtered below its exchange; the other has no shuffle of events
    shuffled, settled = plan.split("SortMergeJoin", 1)[1], plan.rsplit("Project", 1)[1]
    assert plan.count("SortMergeJoin") == 1 and "_bits" in shuffled.split("Exchange hashpartitioning")[1]
    assert "SortMergeJoin" not in settled


def test_roll_ups_in_parts_equal_the_plain_ones(spark, fixture_events):
    for ev in (S.valid_events(_skewed(spark)), S.valid_events(fixture_events),
               S.valid_events(fixture_events).drop("brand", "category_code")):
        for roll_up in (S.segment_sessions, S.enriched_sessions,
                        lambda e, **kw: S.enriched_sessions(e, by_month=False, keep_times=False, **kw)):
            plain, parts = roll_up(ev), roll_up(ev, partitions=7)
            assert [(f.name, f.dataType) for f in parts.schema] == [(f.name, f.dataType) for f in plain.schema]
            rounded = [[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in d.dtypes]
                       for d in (plain, parts)]
            want, got = (sorted(map(str, d.select(*c).collect())) for d, c in zip((plain, parts), rounded))
            assert got == want and len(got)


def test_roll_ups_take_as_many_tasks_as_asked_and_spread_a_hot_session(spark):
    ev = S.valid_events(_skewed(spark))
    sessions = S.segment_sessions(ev, partitions=23)
    assert sessions.rdd.getNumPartitions() == 23     # more than spark.sql.shuffle.partitions
    by_value = ev.filter("user_session = 'hot'").withColumn("product_id", F.lit(1)) \
        .withColumn("brand", F.lit("b")).withColumn("category_code", F.lit("c"))
    combined = S._by_value(by_value, [S.SESSION], S.SEGMENT_COUNT_NAMES, False, 23)
    assert combined.count() == S.TIME_SHARES         # spread over the times where it has one value
    plan = S.segment_sessions(ev, partitions=23)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == plan.count("Exchange") == 2
