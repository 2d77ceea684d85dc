"""Sessions stored by user, for per-user work without a shuffle.

``store_by_user`` writes the sessions bucketed by ``user_id``.  Each user's first
session and the join back to the sessions then read matching buckets: neither
needs an exchange, however often they run.

A user with very many sessions (a bot) would make one bucket as large as all
their sessions.  Such users are found first: a Misra-Gries summary (Spark's
``freqItems``) names every user with more than 1/``counters`` of the sessions,
exact counts confirm them, and their first sessions, at most ``counters`` rows,
are broadcast.  Their sessions, and those without a user, stay in the
unbucketed table, spread over all tasks.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import flag
from ..session import materialize, scratch_path

FIRST = "user_first_session_time"


@dataclass(frozen=True)
class UserSessions:
    """``bucketed`` (table ``name``), ``hot`` (user_id, first session) and all
    ``sessions`` as written before the split."""

    name: str
    bucketed: DataFrame
    hot: DataFrame
    sessions: DataFrame

    def first_sessions(self) -> DataFrame:
        """Each user's earliest session start; no exchange."""
        return self._bucketed_first().unionByName(self.hot)

    def returning(self) -> DataFrame:
        """Every session with ``is_returning_user`` (strictly after
        the user's first session; null users give 0); no exchange but the
        broadcast of ``hot``."""
        calm = self.bucketed.join(self._bucketed_first().hint("merge"), "user_id")
        hot = self.sessions.join(F.broadcast(self.hot), "user_id")
        nobody = self.sessions.filter(F.col("user_id").isNull()).withColumn(
            FIRST, F.lit(None).cast(self.hot.schema[FIRST].dataType))
        return calm.unionByName(hot).unionByName(nobody).withColumn(
            "is_returning_user", flag(F.col("session_start") > F.col(FIRST)))

    def drop(self) -> None:
        """Forget the table (its files go with the scratch folder)."""
        self.sessions.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")

    def _bucketed_first(self) -> DataFrame:
        return self.bucketed.groupBy("user_id").agg(F.min("session_start").alias(FIRST))


def hot_users(sessions: DataFrame, counters: int) -> DataFrame:
    """(user_id, first session) of users with more than 1/``counters`` of the
    rows; fewer than ``counters`` rows."""
    spark = sessions.sparkSession
    named = sessions.select("user_id").stat.freqItems(["user_id"], 1.0 / counters).first()[0] or []
    named = spark.createDataFrame([(u,) for u in named if u is not None],
                                  sessions.select("user_id").schema)
    most = sessions.count() / counters
    return materialize(
        sessions.join(F.broadcast(named), "user_id").groupBy("user_id")
        .agg(F.min("session_start").alias(FIRST), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > most).drop("n"), "hot-users")


def store_by_user(sessions: DataFrame, buckets: int | None = None,
                  counters: int = 1000) -> UserSessions:
    """Write ``sessions`` (with ``user_id``, ``session_start``) for per-user
    work; ``buckets`` defaults to ``spark.sql.shuffle.partitions``.  An empty
    table gives empty results."""
    spark = sessions.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sessions = materialize(sessions, "sessions")
    hot = hot_users(sessions, counters)
    name = f"sessions_by_user_{uuid.uuid4().hex[:12]}"
    (sessions.filter(F.col("user_id").isNotNull())
     .join(F.broadcast(hot.select("user_id")), "user_id", "left_anti")
     .repartition(buckets, "user_id")
     .write.bucketBy(buckets, "user_id").sortBy("user_id")
     .option("path", scratch_path(spark, "sessions-by-user")).format("parquet").saveAsTable(name))
    return UserSessions(name, spark.table(name), hot, sessions)
