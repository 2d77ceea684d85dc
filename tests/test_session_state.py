from datetime import timedelta

from pyspark.sql import functions as F

from conftest import T
from sessionkit.operators import sessions as S
from sessionkit.operators.session_state import SessionState
from sessionkit.session import scratch_path
from sessionkit.sources.schema import EVENT_SCHEMA


def rows_of(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def test_months_merge_to_the_sessions_of_all_events(spark, fixture_events):
    events = S.valid_events(fixture_events)
    state = SessionState(spark, scratch_path(spark, "state"))
    for month in ("A", "B"):
        state.add(events.filter(F.col("source_month") == month), month)
    want = rows_of(S.segment_sessions(events))
    assert rows_of(state.sessions()) == want
    spanning = state.sessions().filter("user_session = 's8'").first()
    assert (spanning.total_events, spanning.is_abandoned) == (2, 0)
    # a batch written again replaces itself; a compacted copy holds the same
    state.add(events.filter("source_month = 'B'"), "B")
    assert state.has("B") and not state.has("C")
    assert rows_of(state.sessions()) == want
    merged = state.compacted(scratch_path(spark, "state-merged"))
    assert rows_of(merged.sessions()) == want
    merged.add(events.limit(0), "C")
    assert rows_of(merged.sessions()) == want


def test_session_cut_anywhere_and_hot_session(spark):
    """A session with a third of all rows, dealt over four batches out of time order."""
    rows = [("A", i, T("2024-01-01 10:00:00") + timedelta(seconds=i * 37 % 1000),
             ("view", "cart", "view", "signup")[i % 4], i % 97, None if i % 5 == 0 else f"c{i % 7}",
             f"b{i % 11}", 1.0 + i % 13, None if i < 40 else i % 3,
             "hot" if i % 3 == 0 else f"s{i % 50}") for i in range(1200)]
    events = spark.createDataFrame(rows, EVENT_SCHEMA)
    state = SessionState(spark, scratch_path(spark, "state"))
    for b in range(4):
        state.add(events.filter(F.col("event_id") * 7 % 4 == b), f"b{b}")
    assert rows_of(state.sessions()) == rows_of(S.segment_sessions(events))
    hot = state.sessions().filter("user_session = 'hot'").first()
    assert hot.total_events == 400 and hot.unique_products == 97 and hot.user_id == 0


def test_empty_batches_give_no_sessions(spark, fixture_events):
    state = SessionState(spark, scratch_path(spark, "state"))
    state.add(fixture_events.limit(0), "A")
    assert state.sessions().count() == 0
