"""Sessions stored by user: equal to the join form, without an exchange."""
from datetime import datetime, timedelta

from sessionkit.operators import sessions as S
from sessionkit.operators.user_store import FIRST, hot_users, store_by_user

SCHEMA = "source_month string, user_session string, user_id bigint, session_start timestamp_ntz"
T0 = datetime(2024, 1, 1)


def _sessions(spark):
    """User 1 holds a third; ties, null users and a user without any time."""
    rows = [("A", f"h{i}", 1, T0 + timedelta(minutes=(i * 7) % 500)) for i in range(500)]
    rows += [("A", f"s{i}", 10 + i % 300, T0 + timedelta(minutes=i // 300)) for i in range(900)]
    rows += [("B", f"n{i}", None, T0 + timedelta(minutes=i)) for i in range(99)]
    rows += [("B", "t1", 5, T0), ("B", "t2", 5, T0), ("B", "no time", 6, None)]
    return spark.createDataFrame(rows, SCHEMA)


def _flags(df):
    return sorted((r.user_session, str(r.user_id), str(r[FIRST]), r.is_returning_user)
                  for r in df.collect())


def test_equals_the_join_form(spark):
    sessions = _sessions(spark)
    stored = store_by_user(sessions, buckets=4, counters=100)
    assert [r.user_id for r in stored.hot.collect()] == [1]
    got = stored.returning()
    assert got.count() == sessions.count()
    assert _flags(got) == _flags(S.returning_users(sessions))
    first = {(r.user_id, r[FIRST]) for r in S.user_first_session(sessions).collect()}
    assert {(r.user_id, r[FIRST]) for r in stored.first_sessions().collect()} == first
    stored.drop()


def test_bucketed_scans_need_no_exchange(spark):
    """Whole plans, as run: no shuffle at all, and no hot user in a bucket."""
    stored = store_by_user(_sessions(spark), buckets=4, counters=100)
    for df in (stored.returning(), stored.first_sessions()):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "Window" not in plan
        assert "Bucketed: true" in plan
    assert stored.bucketed.filter("user_id = 1 or user_id is null").isEmpty()
    stored.drop()


def test_many_equal_users_are_not_hot(spark):
    sessions = spark.range(1000).selectExpr("id AS user_id", "timestamp_ntz'2024-01-01' AS session_start")
    assert hot_users(sessions, 100).count() == 0


def test_empty_sessions(spark):
    stored = store_by_user(_sessions(spark).limit(0), buckets=2)
    assert stored.returning().count() == 0 and stored.first_sessions().count() == 0
    stored.drop()
