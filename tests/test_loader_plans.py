"""The event loader reads only what a key needs; clean-up leaves nothing."""
import os
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from sessionkit.operators import profile as P
from sessionkit.operators import sessions as S
from sessionkit.plans import catalog as C
from sessionkit.session import delete_scratch, ensure_checkpoint_dir, folder_state, materialize
from sessionkit.sources.adapter import load_events

SF_SMALL = "/root/testdata/sf0.001"
NO_PART = ["clean_counts", "zero_price_by_type", "event_share", "event_funnel", "event_type_pivot",
           "basic_sessions", "labeled_events", "union_months", "means_by_outcome",
           "segment_features", "log_features", "price_histogram", "price_kde"]


@pytest.mark.parametrize("key", NO_PART)
def test_keys_without_brand_or_category_do_not_read_part(spark, key):
    plan = C.QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "p_partkey" not in plan


def test_columns_and_partitions_of_the_loader(spark):
    ev = load_events(spark, SF_SMALL, columns=["event_id", "brand"], partitions=3)
    assert ev.columns == ["event_id", "brand"] and ev.count() == 1000
    assert ev.filter("brand is null").count() > 0
    assert load_events(spark, SF_SMALL, partitions=3, columns=["event_id"]).rdd.getNumPartitions() == 3


def test_price_views_keep_events_without_a_session(spark, fixture_events):
    kept = S.valid_events(fixture_events, require_session=False)
    with_session = S.valid_events(fixture_events)
    assert kept.count() == with_session.count() + 1
    assert P.histogram(kept, "price", 5).agg(F.sum("count")).first()[0] == kept.count()


def test_density_in_one_aggregate_matches_its_counts_form(spark, fixture_events):
    kept = S.valid_events(fixture_events)
    one = {r.point: r.density for r in P.kde(kept, "price", 20).collect()}
    row = kept.agg(F.count("price"), F.min("price"), F.max("price")).first()
    scaled = {r.point: r.density for r in P.kde(kept, "price", 20, bins=10).collect()}
    for i, d in one.items():
        assert abs(scaled[i] - d * row[0] * (row[2] - row[1]) / 10) < 1e-9


def test_first_label_only_when_missing_and_existing_columns(spark, fixture_events):
    made = S.ensure_label(fixture_events)
    assert S.LABEL in made.columns
    assert S.ensure_label(made) is made
    assert S.select_existing(fixture_events, ["price", "nope", "brand"]).columns == ["price", "brand"]


def test_returning_users_window_equals_join(spark, fixture_events):
    sessions = S.enriched_sessions(S.valid_events(fixture_events))
    rows = [sorted((r.user_session, r.is_returning_user) for r in
                   S.returning_users(sessions, method=m).collect()) for m in ("window", "join")]
    assert rows[0] == rows[1]


def test_scratch_is_deleted_and_state_follows_files(spark):
    path = urlparse(materialize(spark.range(5), "gone").inputFiles()[0]).path
    assert os.path.exists(path)
    folder = os.path.dirname(path)
    before = folder_state(spark, folder)
    spark.range(3).write.mode("append").parquet(folder)
    assert folder_state(spark, folder) != before
    assert delete_scratch(spark) > 0 and not os.path.exists(path)
    C.release(spark)
    assert os.path.isdir(urlparse(ensure_checkpoint_dir(spark)).path)
