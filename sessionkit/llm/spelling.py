"""Spelling variants by a dictionary of trie-node pairs.

*Words.*  Runs of letters are counted by Spark functions alone, combined map-side.

*Numbers.*  The distinct words are range-sorted.  A node of their forward trie
is numbered by the rank of the first word under it, next to its depth; in a
sorted shard one stack of ranks gives the nodes of all prefixes of a word.  A
prefix may begin in an earlier shard: each shard reports its first and last
word, and folding these few rows in order gives the ranks that a shard
inherits.  The reversed words give the nodes of the reversed trie, the
suffixes, in the same way.

*Pairs.*  A word of n code points has, for each position, the pair (prefix
node, suffix node) around a skipped code point, and around a place where one
can be inserted.  Two words of equal length that differ in one place share
the pair that skips it, and no other.  A word that is another one less a code
point has an insert pair equal to a skip pair of the other; of a run of equal
code points only the first skip counts here, so that each pair of words
meets exactly once.  So all words that share an integer pair are near each
other, and none is missed.

*Groups.*  One shuffle on the pair brings them together.  A group holds at
most one word per letter of the alphabet and one that inserts, and is never
written out as pairs: its size and its two greatest words settle what it
adds to each member's count and best neighbour.

*Roots* follow the forms by pointer doubling; a form has at least ``ratio``
times the occurrences, so chains are of logarithmic length.

Null texts have no words, a null id counts as an empty text in the hash that
plants a lost letter; repeated rows count each; extra columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import only

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DEPTH_BITS = 24


def count_words(docs: DataFrame, letters: str = "[A-Za-zÀ-ÿ]+", least_length: int = 6,
                least_count: int = 5, drop_every: int | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(word, n): the lower-cased runs of ``letters`` of enough code points and
    occurrences.  With ``drop_every``, a run loses one code point where this
    number divides the hash of its document's id and itself."""
    runs = only(docs, id=id_col, text=text_col).select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate("text", UPPER, UPPER.lower()), F.lit(letters),
                                       F.lit(0))).alias("w"))
    if drop_every:
        h = F.crc32(F.concat("id", F.lit(":"), "w").cast("binary"))
        at = (F.col("h") % F.char_length("w")).cast("int")
        runs = runs.filter(F.char_length("w") >= least_length).select(h.alias("h"), "w").select(
            F.when(F.col("h") % drop_every == 0, F.concat(
                F.substring("w", F.lit(1), at), F.substring("w", at + 2, F.char_length("w"))))
            .otherwise(F.col("w")).alias("w"))
    return runs.filter(F.char_length("w") >= least_length).groupBy(F.col("w").alias("word")).agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def _shared(a: str, b: str) -> int:
    """Code points that two words have in common at their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] is shared, a[:hi] is not
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[:mid] == b[:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def _shard_nodes(batches):
    """Sorted rows (key, word) -> key, word, shard, place in the shard, and per
    depth the place of the shard's first word with that prefix."""
    shard, place, before, first = TaskContext.get().partitionId(), 0, "", []
    for b in batches:
        keys, places, firsts = b.column(0).to_pylist(), [], []
        for w in keys:
            keep = (_shared(before, w) if place else -1) + 1
            first = first[:keep] + [place] * (len(w) + 1 - keep)
            before = w
            places.append(place)
            firsts.append(first)
            place += 1
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array([shard] * len(keys), pa.int32()),
             pa.array(places, pa.int64()), pa.array(firsts, pa.list_(pa.int64()))],
            names=["key", "word", "shard", "place", "first"])


def inherited(ends: list) -> list:
    """(shard, base, ranks): the rank of a shard's first word, and for each
    prefix that this word shares with earlier shards the rank of the first word
    there.  ``ends`` has (shard, rows, first word, last word, the places of the last
    word's prefixes) in shard order."""
    out, base, last, ranks = [], 0, None, []
    for shard, rows, head, tail, places in ends:
        own = ranks[:_shared(last, head) + 1] if last is not None else []
        out.append((shard, base, own))
        ranks = [base + p if p or d >= len(own) else own[d] for d, p in enumerate(places)]
        last, base = tail, base + rows
    return out


def trie_nodes(words: DataFrame, key, name: str) -> DataFrame:
    """(word, rank, nodes): the rank of ``key`` (an expression of the word) among
    all, and the numbers of its prefixes' nodes, from the empty one on."""
    spark = words.sparkSession
    table = materialize(
        words.select(key.alias("key"), "word").repartitionByRange("key")
        .sortWithinPartitions("key")
        .mapInArrow(_shard_nodes, "key string, word string, shard int, place bigint, "
                                  "first array<bigint>"), name)
    ends = table.groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"), F.min("key").alias("head"),
        F.max_by(F.struct("key", "first"), "place").alias("tail")).collect()  # a row per shard
    borders = spark.createDataFrame(
        inherited([(r["shard"], r["rows"], r["head"], r["tail"]["key"], r["tail"]["first"])
                   for r in sorted(ends, key=lambda r: r["shard"])]),
        "shard int, base bigint, ranks array<bigint>")
    number = F.transform("first", lambda p, d: F.shiftleft(
        F.when((p > 0) | (d >= F.size("ranks")), F.col("base") + p)
        .otherwise(F.get("ranks", d)), DEPTH_BITS) + d)
    return table.join(borders, "shard").select(
        "word", (F.col("base") + F.col("place")).alias("rank"), number.alias("nodes"))


def near_words(words: DataFrame) -> DataFrame:
    """``words`` (word, n) -> (word, n, rank, n_near, best): the number of words
    at one insertion, deletion or replacement, and (n, -rank) of the one of
    largest n, in code-point order at a tie."""
    ahead = trie_nodes(words, F.col("word"), "prefix-nodes")
    back = trie_nodes(words, F.reverse("word"), "suffix-nodes")
    # per code point: 2 where it begins a run of equal ones, else 1
    letters = F.split("word", "")
    kinds = F.slice(F.zip_with(letters, F.concat(F.array(F.lit(None).cast("string")), letters),
                               lambda c, before: F.when(c == before, 1).otherwise(2)),
                    F.lit(1), F.char_length("word"))
    table = materialize(
        words.join(ahead.withColumnRenamed("nodes", "p"), "word")
        .join(back.select("word", F.col("nodes").alias("s")), "word")
        .withColumn("kinds", kinds), "word-nodes")
    # kind 0: insert at i; 1: skip i; 2: skip i, the first of its run
    insert = F.transform("p", lambda p, i: F.struct(
        p.alias("p"), F.get("s", F.size("p") - 1 - i).alias("s"), F.lit(0).alias("kind")))
    skip = F.transform("kinds", lambda kind, i: F.struct(
        F.get("p", i).alias("p"), F.get("s", F.size("p") - 2 - i).alias("s"), kind.alias("kind")))
    pairs = table.select("rank", "n", F.inline(F.concat(insert, skip)))
    met = pairs.groupBy("p", "s").agg(F.collect_list(F.struct(
        F.struct("n", (-F.col("rank")).alias("place")).alias("who"), "kind")).alias("members")) \
        .filter("size(members) > 1")
    # who may meet whom: skips all skips, inserts the first skips
    skips = F.sort_array(F.transform(F.filter("members", lambda m: m["kind"] > 0),
                                     lambda m: m["who"]), asc=False)
    firsts = F.sort_array(F.transform(F.filter("members", lambda m: m["kind"] == 2),
                                      lambda m: m["who"]), asc=False)
    inserts = F.transform(F.filter("members", lambda m: m["kind"] == 0), lambda m: m["who"])
    met = met.select("members", skips.alias("skips"), firsts.alias("firsts"),
                     inserts.alias("inserts"))
    gain = met.select(F.inline("members"), "skips", "firsts", "inserts").select(
        F.col("who.place").alias("place"),
        F.when(F.col("kind") == 0, F.size("firsts")).otherwise(
            F.size("skips") - 1 + F.when(F.col("kind") == 2, F.size("inserts")).otherwise(0))
        .alias("near"),
        F.when(F.col("kind") == 0, F.get("firsts", F.lit(0))).otherwise(F.greatest(
            F.when(F.get("skips", F.lit(0)) == F.col("who"), F.get("skips", F.lit(1)))
            .otherwise(F.get("skips", F.lit(0))),
            F.when(F.col("kind") == 2, F.get("inserts", F.lit(0))))).alias("best"))
    found = gain.filter("near > 0").groupBy((-F.col("place")).alias("rank")).agg(
        F.sum("near").alias("n_near"), F.max("best").alias("best"))
    return table.select("word", "n", "rank").join(found, "rank", "left").select(
        "word", "n", "rank", F.coalesce("n_near", F.lit(0)).alias("n_near"), "best")


def group_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """``words`` (word, n) -> word, form, root, n, n_near, form_n."""
    near = materialize(near_words(words).withColumn(
        "form", F.when(F.col("best.n") >= ratio * F.col("n"), -F.col("best.place"))), "near-words")
    # pointer doubling: whoever points on, until no pointer moves
    links = near.filter("form is not null").select("rank", F.col("form").alias("to"))
    while True:
        step = links.join(links.select(F.col("rank").alias("to"), F.col("to").alias("next")), "to",
                          "left")
        doubled = materialize(step.select(
            "rank", F.coalesce("next", "to").alias("to"),
            F.col("next").isNotNull().alias("moved")), "roots")
        links = doubled.select("rank", "to")
        if doubled.filter("moved").isEmpty():
            break
    name = near.select(F.col("rank").alias("to"), F.col("word").alias("name"), F.col("n").alias("size"))
    forms = name.select(F.col("to").alias("form"), F.col("name").alias("form_word"),
                        F.col("size").alias("form_n"))
    roots = links.join(name, "to").select("rank", F.col("name").alias("root"))
    return near.join(forms, "form", "left").join(roots, "rank", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root", "word").alias("root"), "n",
        "n_near", "form_n")


def spelling_variants(docs: DataFrame, least_length: int = 6, least_count: int = 5, ratio: int = 5,
                      drop_every: int | None = None, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The words of whole texts, their near words, forms and roots."""
    words = materialize(count_words(docs, least_length=least_length, least_count=least_count,
                                    drop_every=drop_every, id_col=id_col, text_col=text_col), "words")
    return group_variants(words, ratio)
