from pyspark.sql import functions as F

from sessionkit.operators import sessions as S
from sessionkit.operators import segments as SG


def by_key(df, key="user_session"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_valid_events_drops_bad_prices_and_null_keys(fixture_events):
    v = S.valid_events(fixture_events)
    ids = {r.event_id for r in v.collect()}
    assert not ids & {8, 9, 10, 11, 12, 13}
    assert len(ids) == 24 - 6


def test_model_path_sessions(fixture_events):
    enriched = by_key(S.enriched_sessions(S.valid_events(fixture_events), by_month=True)
                      .filter(F.col("source_month") == "A"))
    assert enriched["s1"]["is_abandoned"] == 0
    assert enriched["s2"]["is_abandoned"] == 1
    s3 = enriched["s3"]
    assert (s3["is_abandoned"], s3["duration_seconds"]) == (0, 0.0)
    assert enriched["s4"]["is_abandoned"] == 1          # zero-price purchase filtered first
    assert "s5" not in enriched and None not in enriched
    assert (enriched["s6"]["brands_viewed"], enriched["s6"]["categories_viewed"]) == (0, 0)
    assert enriched["s7"]["num_views"] == 1
    assert enriched["s10"]["num_views"] == 1            # null time does not count (pivot on time)
    assert enriched["s1"]["duration_seconds"] == 120.0


def test_spanning_session_two_rows_on_model_path(fixture_events):
    rows = (S.enriched_sessions(S.valid_events(fixture_events), by_month=True)
            .filter(F.col("user_session") == "s8").collect())
    got = sorted((r.source_month, r.is_abandoned) for r in rows)
    assert got == [("A", 1), ("B", 0)]


def test_segment_path_one_row(fixture_events):
    seg = by_key(S.segment_sessions(S.valid_events(fixture_events)))
    assert seg["s8"]["is_abandoned"] == 0
    assert seg["s7"]["total_events"] == 2 and seg["s7"]["view_count"] == 1
    assert seg["s10"]["view_count"] == 2                # segment path counts rows
    assert seg["s4"]["is_abandoned"] == 1


def test_returning_user_strict_and_null_users(fixture_events):
    sess = S.enriched_sessions(S.valid_events(fixture_events), by_month=True)
    for method in ("join", "window"):
        r = by_key(S.returning_users(sess, method=method))
        assert r["t1"]["is_returning_user"] == 0 and r["t2"]["is_returning_user"] == 0
        assert r["s9"]["is_returning_user"] == 0


def test_labels_join_equals_window(fixture_events):
    v = S.valid_events(fixture_events)
    a = sorted((r.event_id, r.is_abandoned) for r in S.labeled_events(v, "join").collect())
    b = sorted((r.event_id, r.is_abandoned) for r in S.labeled_events(v, "window").collect())
    assert a == b


def test_segment_features_zero_duration(fixture_events):
    f = by_key(SG.segment_features(S.segment_sessions(S.valid_events(fixture_events))))
    assert f["s3"]["events_per_minute"] == 0.0
    assert f["s1"]["events_per_minute"] == 3 / 2.0
    assert f["s2"]["cart_to_view_ratio"] == 1 / 2.0


def test_union_months_by_name(fixture_events):
    v = S.valid_events(fixture_events)
    a = S.enriched_sessions(v.filter("source_month = 'A'"))
    b = S.enriched_sessions(v.filter("source_month = 'B'"))
    assert S.union_months(a, b).count() == S.enriched_sessions(v).count()
