"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from itertools import filterfalse
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder it was imported
    from, for sessions started elsewhere.  Where it is installed on the
    executors this changes nothing."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Just the named columns, under this module's own names, so that extra
    columns of the caller's table can never clash with working columns."""
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in columns.items()])


class WordCache:
    """Word -> value map of a Python worker with a bound on its entries.

    ``lookup`` is handed the word lists of one small group of texts.  Words seen
    before come from the map; the others are computed in one ``compute`` call
    (a list of words in, a list of values out).  The map has two generations
    of at most ``limit`` words each; words longer than ``max_len`` characters
    are never kept.  Only speed depends on it, never a result.
    """

    def __init__(self, compute, limit: int = 500_000, max_len: int = 64):
        self.compute, self.limit, self.max_len = compute, limit, max_len
        self.new: dict = {}
        self.old: dict = {}

    def lookup(self, texts: list):
        """A getter for every word of ``texts`` (each a list of words)."""
        if len(self.new) > self.limit:
            self.old, self.new = self.new, {}
        new, old, unseen, missing = self.new, self.old, set(), []
        for words in texts:
            unseen.update(filterfalse(new.__contains__, words))
        for w in unseen:
            v = old.get(w)
            if v is None:
                missing.append(w)
            else:
                new[w] = v
        if not missing:
            return new.__getitem__
        made = dict(zip(missing, self.compute(missing)))
        long = {w: v for w, v in made.items() if len(w) > self.max_len}
        for w in long:
            del made[w]
        new.update(made)
        if not long:
            return new.__getitem__
        return lambda w: long[w] if w in long else new[w]


def text_groups(texts: list, chars: int = 2_000_000):
    """Consecutive (start, end) runs of ``texts`` of about ``chars`` characters."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= chars:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def keep_rows(docs: DataFrame, winners: DataFrame, key, id_col: str = "doc_id") -> DataFrame:
    """One row of ``docs`` for each (id, text hash) in ``winners``.

    ``winners`` has ``doc_id`` (null equals null) and ``text_key``, the value of
    ``key``.  Of rows alike in both, one stays.  The columns of ``docs`` may
    have any names.
    """
    names = docs.columns
    cols = [f"c{i}" for i in range(len(names))]
    numbered = docs.select(*[F.col(f"`{c}`").alias(x) for c, x in zip(names, cols)],
                           F.col(f"`{id_col}`").alias("id"), key.alias("key"))
    chosen = winners.select(F.col("doc_id").alias("wid"), F.col("text_key").alias("wkey"))
    same = F.col("id").eqNullSafe(F.col("wid")) & (F.col("key") == F.col("wkey"))
    alike = materialize(numbered.groupBy("id", "key").count().filter("count > 1").select(
        F.col("id").alias("wid"), F.col("key").alias("wkey")), "alike")
    kept = numbered.join(chosen.distinct(), same, "left_semi")
    if not alike.isEmpty():
        first = kept.join(alike, same, "left_semi").groupBy("id", "key").agg(
            F.first(F.struct(*cols)).alias("row")).select("row.*")
        kept = kept.join(alike, same, "left_anti").select(*cols).unionByName(first)
    return kept.select(*[F.col(x).alias(c) for c, x in zip(names, cols)])
