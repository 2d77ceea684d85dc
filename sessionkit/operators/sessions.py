"""Event -> session operators.

Every roll-up is ONE hash aggregate keyed by the session (partial aggregation
on the map side, so a session holding a third of all events still reduces to
one partial row per task before the shuffle).  The reference builds the same
tables as three aggregates glued by joins; here the counts are ``count_if``
columns of the same aggregate, so no join is needed.

Distinct counts use ``count(DISTINCT)`` (Catalyst's Expand rewrite: rows are
first de-duplicated per (session, value), then counted) rather than
``size(collect_set(...))``, which would hold all values of a hot session in
one task.

With ``partitions`` the events are first combined per (session, product, brand,
category) in that many tasks, and the sessions made of these rows in as many: a
task's memory then follows the events per partition, not those per input file
and per ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import flag, seconds_between, valid_price

SESSION = "user_session"

# Event types with their own count column, and output names.
PROC_COUNT_NAMES = {"view": "num_views", "cart": "num_carts", "purchase": "num_purchases"}
SEGMENT_COUNT_NAMES = {"view": "view_count", "cart": "cart_count", "purchase": "purchase_count"}

# Model-ready columns, label last (PROC order).
MODEL_READY_FEATURES = [
    "duration_seconds", "products_viewed", "avg_price", "max_price",
    "brands_viewed", "categories_viewed", "num_carts", "num_views",
    "is_returning_user",
]
LABEL = "is_abandoned"


# --------------------------------------------------------------------------- F
def valid_events(events: DataFrame, require_session: bool = True) -> DataFrame:
    """keep events with a valid positive price (M1); optionally drop rows
    whose session key is null, which pandas' group-by drops (M4)."""
    cond = valid_price("price")
    if require_session:
        cond = cond & F.col(SESSION).isNotNull()
    return events.filter(cond)


def select_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    """keep only the listed columns that exist, in the listed order."""
    return df.select([c for c in cols if c in df.columns])


def _order_key(events: DataFrame) -> Column:
    """Stand-in for file order when taking a group's "first" value (M6):
    the event id where there is one, else the event time."""
    if "event_id" in events.columns:
        return F.struct(F.col("event_id").isNull().alias("no_id"), F.col("event_id"),
                        F.col("event_time"))
    return F.col("event_time")


def _first_non_null(events: DataFrame, c: str) -> Column:
    """pandas ``first``: first non-null value in file order (M6)."""
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), _order_key(events)))


def _distinct(c: str, mode: str) -> Column:
    """Distinct non-null count: ``expand`` = exact ``count(DISTINCT)``
    (Catalyst's Expand: de-duplicate per (group, value), then count);
    ``sets`` = ``size(collect_set)``, one pass without the Expand but holding
    a group's distinct values in one task (bounded by distinct values, not
    rows)."""
    if mode == "sets":
        return F.size(F.collect_set(c))
    return F.count_distinct(c)


def _type_counts(names: dict[str, str], require_time: bool) -> list[Column]:
    """One ``count_if`` per listed type; absent types give 0."""
    out = []
    for etype, name in names.items():
        cond = F.col("event_type") == F.lit(etype)
        if require_time:
            cond = cond & F.col("event_time").isNotNull()
        out.append(F.count_if(cond).alias(name))
    return out


def _abandoned(events_has_cart: Column, events_has_purchase: Column) -> Column:
    """M3: has a cart and no purchase."""
    return flag(events_has_cart & ~events_has_purchase)


def abandoned_flag_agg() -> Column:
    return _abandoned(F.max(F.col("event_type") == "cart"),
                      F.coalesce(F.max(F.col("event_type") == "purchase"), F.lit(False)))


# --------------------------------------------------------------------------- W1
def session_labels(events: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per session with its abandoned flag (the group part of W1)."""
    keys = keys or [SESSION]
    return events.groupBy(*keys).agg(abandoned_flag_agg().alias(LABEL))


#: 64-bit words of the session filter: 16 MB broadcast, about 16 bits for each
#: of four million abandoned sessions.
FILTER_WORDS = 1 << 20


def abandoned_sessions(events: DataFrame) -> DataFrame:
    """The keys of sessions with a cart and no purchase; only events of these
    two types are read (the type filter reaches the scan)."""
    told = events.filter(F.col("event_type").isin("cart", "purchase") & F.col(SESSION).isNotNull())
    return told.groupBy(SESSION).agg(abandoned_flag_agg().alias("flag")).filter("flag = 1") \
        .select(SESSION)


def _filter_place(words: int) -> tuple[Column, Column]:
    """Word of a session in a filter of ``words`` words, and its three bits."""
    h = F.xxhash64(SESSION, F.lit(1))
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"),
                            F.shiftright(h, k).bitwiseAND(F.lit(63)).cast("int")) for k in (0, 6, 12)]
    return (F.pmod(F.xxhash64(SESSION), F.lit(words)).alias("_word"),
            bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).alias("_mask"))


def maybe_abandoned(events: DataFrame, abandoned: DataFrame, words: int = FILTER_WORDS) -> DataFrame:
    """``events`` with a flag ``_maybe``: false only where the session is not
    among ``abandoned``.  The test is a blocked Bloom filter, a broadcast table
    (word, bits) of at most ``words`` rows."""
    bits = abandoned.select(*_filter_place(words)).groupBy("_word").agg(
        F.bit_or("_mask").alias("_bits"))
    return (events.select("*", *_filter_place(words)).join(F.broadcast(bits), "_word", "left")
            .withColumn("_maybe", F.coalesce(
                F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"), F.lit(False)))
            .drop("_word", "_mask", "_bits"))


def labeled_events(events: DataFrame, method: str = "join", as_bool: bool = True,
                   filter_words: int = FILTER_WORDS) -> DataFrame:
    """Send each session's abandoned flag back to its events
    (pandas ``groupby.transform``).

    ``method="join"`` (default) aggregates only cart and purchase events per
    session and joins the keys of abandoned sessions back.  A Bloom filter of
    these keys, of bounded size, labels the events of all other sessions where
    they are read, so only events that pass it are shuffled (AQE's skew join
    splits a hot session).  With far more abandoned sessions than the filter
    is made for, most events pass and the labels stay exact;
    ``filter_words=0`` then saves the second read of the events.
    ``method="window"`` is the single-shuffle
    ``max() OVER (PARTITION BY user_session)`` form, bound to one task per
    session.
    """
    ev = events.filter(F.col(SESSION).isNotNull())
    if method == "window":
        w = Window.partitionBy(SESSION)
        lab = _abandoned(F.max(F.col("event_type") == "cart").over(w),
                         F.coalesce(F.max(F.col("event_type") == "purchase").over(w),
                                    F.lit(False)))
        out = ev.withColumn(LABEL, lab)
    else:
        abandoned = abandoned_sessions(ev)
        flags = abandoned.withColumn(LABEL, F.lit(1))
        if filter_words:
            tested = maybe_abandoned(ev, abandoned, filter_words)
            out = (tested.filter("_maybe").drop("_maybe").join(flags, SESSION, "left")
                   .unionByName(tested.filter("not _maybe").drop("_maybe")
                                .withColumn(LABEL, F.lit(0))))
        else:
            out = ev.join(flags, SESSION, "left")
        out = out.fillna(0, subset=[LABEL])
    if as_bool:
        out = out.withColumn(LABEL, F.col(LABEL).cast("boolean"))
    return out


def ensure_label(events: DataFrame, method: str = "join") -> DataFrame:
    """create the label only when it is missing."""
    if LABEL in events.columns:
        return events
    return labeled_events(events, method=method)


# --------------------------------------------------------------------------- A2
def event_type_pivot(events: DataFrame, keys: list[str] | None = None,
                     names: dict[str, str] | None = None,
                     require_time: bool = True) -> DataFrame:
    """A2: per-session counts of the listed event types (pivot + rename)."""
    keys = keys or [SESSION]
    ev = events.filter(F.col(SESSION).isNotNull())
    return ev.groupBy(*keys).agg(*_type_counts(names or PROC_COUNT_NAMES, require_time))


# --------------------------------------------------------------------------- A1
def basic_sessions(events: DataFrame) -> DataFrame:
    """A1 (T4): event_count, products_viewed, is_abandoned, duration_seconds."""
    ev = events.filter(F.col(SESSION).isNotNull())
    return (ev.groupBy(SESSION)
            .agg(F.count("event_type").alias("event_count"),
                 F.count_distinct("product_id").alias("products_viewed"),
                 abandoned_flag_agg().alias(LABEL),
                 seconds_between(F.min("event_time"), F.max("event_time"))
                 .alias("duration_seconds")))


# ------------------------------------------------------------- events by value
VALUES = ["product_id", "brand", "category_code"]
#: Shares of the events of one session and value, by their time, so that no
#: task gets all events of a hot session that has few values.
TIME_SHARES = 16


def _by_value(events: DataFrame, keys: list[str], names: dict[str, str], require_time: bool,
              partitions: int) -> DataFrame:
    """Events combined per session, values and share of the times, in
    ``partitions`` tasks; then dealt out by session, with a flag for the first
    row of a session with each product, brand and category (a distinct count as
    a sum of flags needs no further exchange, unlike the Expand rewrite)."""
    place = _order_key(events)
    events = events.withColumn("_share", F.pmod(F.xxhash64("event_time"), F.lit(TIME_SHARES)))
    values = [c for c in VALUES if c in events.columns]
    group = [*keys, *values, "_share"]
    known = F.col("user_id").isNotNull() & place.isNotNull()
    combined = events.repartition(partitions, *group).groupBy(*group).agg(
        F.min("event_time").alias("session_start"), F.max("event_time").alias("session_end"),
        F.sum("price").alias("_price"), F.count("price").alias("_prices"), F.max("price").alias("max_price"),
        F.min(F.when(known, F.struct(place.alias("place"), F.col("user_id")))).alias("_first"),
        F.count(F.lit(1)).alias("total_events"), *_type_counts(names, require_time),
        F.max(F.col("event_type") == "cart").alias("_cart"),
        F.max(F.col("event_type") == "purchase").alias("_purchase"),
    ).repartition(partitions, *keys)
    for c in values:
        first = F.row_number().over(Window.partitionBy(*keys, c).orderBy("_share")) == 1
        combined = combined.withColumn(f"_new_{c}", (first & F.col(c).isNotNull()).cast("int"))
    return combined


def _of_values(names: dict[str, str]) -> dict[str, Column]:
    """The aggregates of a session over the rows of ``_by_value``."""
    return {
        "session_start": F.min("session_start"), "session_end": F.max("session_end"),
        "user_id": F.min("_first")["user_id"], "total_events": F.sum("total_events"),
        "avg_price": F.try_divide(F.sum("_price"), F.sum("_prices")),
        "max_price": F.max("max_price"), "total_price": F.sum("_price"),
        LABEL: _abandoned(F.max("_cart"), F.coalesce(F.max("_purchase"), F.lit(False))),
        **{n: F.sum(n) for n in names.values()},
    }


# --------------------------------------------------------------------------- A3/A4
def enriched_sessions(events: DataFrame, by_month: bool = True,
                      keep_times: bool = True, distinct_mode: str = "expand",
                      partitions: int | None = None) -> DataFrame:
    """A3 (T5/T6): one row per (month, session) -- or per session for the
    notebook form A4 -- with times, distinct counts, price stats, type
    counts, first user and label, in a single aggregate (the reference's
    separate pivot + aggregate + join, J1, fused).  Events without the brand
    or category column give sessions without their counts.
    """
    keys = (["source_month", SESSION] if by_month else [SESSION])
    ev = events.filter(F.col(SESSION).isNotNull())
    counted = {n: c for c, n in zip(
        VALUES, ("products_viewed", "brands_viewed", "categories_viewed")) if c in ev.columns}
    if partitions:
        ev = _by_value(ev, keys, PROC_COUNT_NAMES, True, partitions)
        of = {**_of_values(PROC_COUNT_NAMES), **{n: F.sum(f"_new_{c}") for n, c in counted.items()}}
    else:
        of = {**{n: _distinct(c, distinct_mode) for n, c in counted.items()},
              "session_start": F.min("event_time"), "session_end": F.max("event_time"),
              "avg_price": F.avg("price"), "max_price": F.max("price"), LABEL: abandoned_flag_agg(),
              "user_id": _first_non_null(ev, "user_id"),
              **dict(zip(PROC_COUNT_NAMES.values(), _type_counts(PROC_COUNT_NAMES, require_time=True)))}
    order = ["session_start", "session_end", "products_viewed", "avg_price", "max_price",
             "brands_viewed", "categories_viewed", LABEL, "user_id", *PROC_COUNT_NAMES.values()]
    aggs = [of[c].alias(c) for c in order if c in of]
    out = (ev.groupBy(*keys).agg(*aggs)
           .withColumn("duration_seconds", seconds_between("session_start", "session_end")))
    if not keep_times:
        out = out.drop("session_start", "session_end")
    return out


# --------------------------------------------------------------------------- A5
def segment_sessions(events: DataFrame, distinct_mode: str = "expand",
                     partitions: int | None = None) -> DataFrame:
    """A5-A7 (T8): sessions over both months for segmentation.

    The reference aggregates 5M-row chunks and re-aggregates the partial rows,
    which over-counts sessions cut by a chunk edge (M11); Spark's partial /
    final aggregation gives the exact result with the same memory bound.
    Type counts count rows (``size``), not non-null times (M19).
    """
    ev = events.filter(F.col(SESSION).isNotNull())
    counted = {n: c for c, n in zip(
        VALUES, ("unique_products", "unique_brands", "unique_categories")) if c in ev.columns}
    if partitions:
        of = _of_values(SEGMENT_COUNT_NAMES)
        out = _by_value(ev, [SESSION], SEGMENT_COUNT_NAMES, False, partitions).groupBy(SESSION).agg(
            *[of[c].alias(c) for c in ("session_start", "session_end", "user_id", "total_events",
                                       *SEGMENT_COUNT_NAMES.values())],
            *[F.sum(f"_new_{c}").alias(n) for n, c in counted.items()],
            *[of[c].alias(c) for c in ("avg_price", "max_price", "total_price")])
    else:
        out = ev.groupBy(SESSION).agg(
            F.min("event_time").alias("session_start"),
            F.max("event_time").alias("session_end"),
            _first_non_null(ev, "user_id").alias("user_id"),
            F.count(F.lit(1)).alias("total_events"),
            *_type_counts(SEGMENT_COUNT_NAMES, require_time=False),
            *[_distinct(c, distinct_mode).alias(n) for n, c in counted.items()],
            F.avg("price").alias("avg_price"),
            F.max("price").alias("max_price"),
            F.sum("price").alias("total_price"),
        )
    return out.withColumn(LABEL, flag((F.col("cart_count") > 0) & (F.col("purchase_count") == 0)))


# --------------------------------------------------------------------------- A8/W2/J3
def user_first_session(sessions: DataFrame) -> DataFrame:
    """Each user's earliest session start (null users are not a user)."""
    return (sessions.filter(F.col("user_id").isNotNull())
            .groupBy("user_id")
            .agg(F.min("session_start").alias("user_first_session_time")))


def returning_users(sessions: DataFrame, method: str = "join") -> DataFrame:
    """``is_returning_user`` = session starts strictly after the
    user's first session (M10: ties and null users give 0).

    ``method="join"`` (default): aggregate per user (partial aggregation) and
    equi-join back -- AQE turns it into a broadcast when the user table is
    small at run time and splits a hot user with its skew join.
    ``method="window"``: ``min() OVER (PARTITION BY user_id)``, one shuffle,
    but a hot user lands in one task.
    """
    if method == "window":
        first = F.min("session_start").over(Window.partitionBy("user_id"))
        known = sessions.filter(F.col("user_id").isNotNull())
        # null users are no user: they never meet in one window
        out = known.withColumn("user_first_session_time", first).unionByName(
            sessions.filter(F.col("user_id").isNull())
            .withColumn("user_first_session_time", F.lit(None).cast(
                sessions.schema["session_start"].dataType)))
    else:
        out = sessions.join(user_first_session(sessions), "user_id", "left")
    return out.withColumn(
        "is_returning_user",
        flag(F.col("session_start") > F.col("user_first_session_time")))


# --------------------------------------------------------------------------- J1/U1
def join_counts(session_aggs: DataFrame, counts: DataFrame,
                keys: list[str] | None = None) -> DataFrame:
    """Left join of type counts onto session aggregates; missing -> 0."""
    keys = keys or [SESSION]
    out = session_aggs.join(counts, keys, "left")
    fill = [c for c in counts.columns if c not in keys]
    return out.fillna(0, subset=fill)


def union_months(*months: DataFrame) -> DataFrame:
    """Concatenate monthly tables by column name (UNION ALL)."""
    out = months[0]
    for m in months[1:]:
        out = out.unionByName(m, allowMissingColumns=True)
    return out


# --------------------------------------------------------------------------- F3
def model_ready(sessions: DataFrame, index: bool = True) -> DataFrame:
    """F3 (T7): the 9 stored features, label last, plus the session index."""
    keys = ["source_month", SESSION] if index else []
    return select_existing(sessions, [*keys, *MODEL_READY_FEATURES, LABEL])


def build_model_ready(events: DataFrame, returning_method: str = "join",
                      cut: bool = True, partitions: int | None = None) -> DataFrame:
    """Path 1 (PROC main): clean -> per-month sessions -> union -> returning
    flag -> model-ready projection.

    Both months are processed in one aggregate keyed by ``source_month`` (M9),
    which is the same as running the month files one by one and unioning.
    With ``cut`` the session table is written to the shared checkpoint folder
    first: the per-user minimum and the join then read that (much smaller)
    table instead of scanning and aggregating the events a second time.
    """
    sessions = enriched_sessions(valid_events(events), by_month=True, partitions=partitions)
    if cut:
        from ..session import materialize
        sessions = materialize(sessions)
    return model_ready(returning_users(sessions, method=returning_method))
