import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sessionkit.session import build_session  # noqa: E402
from sessionkit.sources.schema import EVENT_SCHEMA  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


def T(s):
    return datetime.fromisoformat(s)


@pytest.fixture(scope="session")
def fixture_events(spark):
    """Hand-made event rows for the edge cases of FIXTURES.md section 3.

    Columns: source_month, event_id, event_time, event_type, product_id,
    category_code, brand, price, user_id, user_session.
    """
    nan = float("nan")
    rows = [
        # bought: view, cart, purchase
        ("A", 1, T("2024-01-01 10:00:00"), "view", 1, "c1", "b1", 10.0, 1, "s1"),
        ("A", 2, T("2024-01-01 10:01:00"), "cart", 1, "c1", "b1", 10.0, 1, "s1"),
        ("A", 3, T("2024-01-01 10:02:00"), "purchase", 1, "c1", "b1", 10.0, 1, "s1"),
        # abandoned: view, cart
        ("A", 4, T("2024-01-01 11:00:00"), "view", 2, "c2", "b2", 20.0, 2, "s2"),
        ("A", 5, T("2024-01-01 11:00:30"), "cart", 2, "c2", "b2", 20.0, 2, "s2"),
        # window shopper: one view
        ("A", 6, T("2024-01-01 12:00:00"), "view", 3, "c3", "b3", 30.0, 3, "s3"),
        # free purchase: cart 5.00, purchase 0.00 (filtered) -> abandoned
        ("A", 7, T("2024-01-01 13:00:00"), "cart", 4, "c4", "b4", 5.0, 4, "s4"),
        ("A", 8, T("2024-01-01 13:01:00"), "purchase", 4, "c4", "b4", 0.0, 4, "s4"),
        # bad prices only: no session row
        ("A", 9, T("2024-01-01 14:00:00"), "view", 5, "c5", "b5", None, 5, "s5"),
        ("A", 10, T("2024-01-01 14:01:00"), "view", 5, "c5", "b5", nan, 5, "s5"),
        ("A", 11, T("2024-01-01 14:02:00"), "view", 5, "c5", "b5", -1.0, 5, "s5"),
        ("A", 12, T("2024-01-01 14:03:00"), "view", 5, "c5", "b5", 0.0, 5, "s5"),
        # null session key: no row
        ("A", 13, T("2024-01-01 15:00:00"), "view", 6, "c6", "b6", 6.0, 6, None),
        # null brand / category
        ("A", 14, T("2024-01-01 16:00:00"), "view", 7, None, None, 7.0, 7, "s6"),
        ("A", 15, T("2024-01-01 16:05:00"), "view", 8, None, None, 8.0, 7, "s6"),
        # other type: view + signup
        ("A", 16, T("2024-01-01 17:00:00"), "view", 9, "c9", "b9", 9.0, 8, "s7"),
        ("A", 17, T("2024-01-01 17:00:10"), "signup", 9, "c9", "b9", 9.0, 8, "s7"),
        # spanning months: cart in A, purchase in B
        ("A", 18, T("2024-01-15 23:59:00"), "cart", 10, "c10", "b10", 11.0, 9, "s8"),
        ("B", 19, T("2024-01-16 00:01:00"), "purchase", 10, "c10", "b10", 11.0, 9, "s8"),
        # tie: one user, two sessions with the same start
        ("A", 20, T("2024-01-02 09:00:00"), "view", 11, "c11", "b11", 1.0, 10, "t1"),
        ("A", 21, T("2024-01-02 09:00:00"), "view", 12, "c12", "b12", 2.0, 10, "t2"),
        # null user
        ("A", 22, T("2024-01-03 09:00:00"), "view", 13, "c13", "b13", 3.0, None, "s9"),
        # null time: one view without time, one with
        ("A", 23, None, "view", 14, "c14", "b14", 4.0, 11, "s10"),
        ("A", 24, T("2024-01-04 09:00:00"), "view", 15, "c15", "b15", 4.0, 11, "s10"),
    ]
    return spark.createDataFrame(rows, EVENT_SCHEMA)
