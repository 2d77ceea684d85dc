"""URL allow and block lists behind a blocked Bloom filter, in DataFrame
functions only.

A listed entry is a canonical URL prefix: a lower-case host and a path.  It
fits its host and all subdomains where the url's path begins with its path,
and the longest entry wins (then the longest host; then ``block``).  So a url
is on the list if one of its keys is: a suffix of its host (whole labels)
joined to a prefix of its path, for the label counts and path lengths listed.

1. Distinct (host, path) targets are expanded into keys.
2. A blocked Bloom filter of the list (one 64-bit word per block, ``HASHES``
   bits set in the one word an entry hashes to) drops nearly all other keys.
   It is a table of blocks joined on the block number, broadcast while it has
   at most ``max_broadcast`` blocks and shuffled beyond.
3. The keys left meet the list in an exact hash join, which removes false
   positives; the longest hit of each target is its verdict.

A url that no entry fits has the verdict ``default`` and a null rule.  Null
urls and urls without ``://`` have an empty host and path.  Repeated rows and
clashing extra columns are kept apart; an empty list gives all the default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only

BITS_PER_ENTRY = 16
HASHES = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url):
    """(host, path) columns of a url column."""
    rest = F.coalesce(F.expr(f"if(instr({url}, '://') > 0, substring({url}, instr({url}, '://') + 3), '')"),
                      F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _place(key, blocks: int):
    """Block number and word of an entry's key."""
    word = F.lit(0).cast("bigint")
    for k in range(HASHES):
        bit = F.shiftrightunsigned(F.xxhash64(F.lit("bits"), key), 6 * k).bitwiseAND(F.lit(63))
        word = word.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.cast("int")))
    return F.pmod(F.xxhash64(key), F.lit(blocks)), word


def bloom_blocks(entries: DataFrame, blocks: int) -> DataFrame:
    """(block, word) of the filter over ``key``; blocks without entries are left out."""
    block, word = _place(F.col("key"), blocks)
    return entries.select(block.alias("block"), word.alias("bits")) \
        .groupBy("block").agg(F.bit_or("bits").alias("word"))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow",
                max_broadcast: int = 1 << 20, id_col: str = "page_id",
                url_col: str = "url") -> DataFrame:
    """``rules`` (host, path, verdict).  Per page: page_id, host, path, rule, verdict."""
    entries = rules.select(
        F.translate("host", UPPER, LOWER).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"),
        "verdict").filter("rule_host is not null and verdict is not null") \
        .withColumn("key", F.concat("rule_host", "rule_path"))
    shape = entries.agg(
        F.count(F.lit(1)).alias("n"),
        F.collect_set(F.size(F.split("rule_host", "\\."))).alias("labels"),
        F.collect_set(F.length("rule_path")).alias("lengths")).first()
    blocks = max(1, -(-shape["n"] * BITS_PER_ENTRY // 64))
    small = shape["n"] <= max_broadcast

    host, path = url_parts("url")
    parts = only(pages, page_id=id_col, url=url_col).select(
        "page_id", host.alias("host"), path.alias("path"))
    targets = parts.select("host", "path").filter("host <> ''").distinct()
    labels = F.split("host", "\\.")
    keys = [F.when((F.size(labels) >= k) & (F.length("path") >= m),
                   F.concat(F.array_join(F.slice(labels, -k, k), "."), F.substring("path", 1, m)))
            for k in sorted(shape["labels"]) for m in sorted(shape["lengths"])]
    if not keys:
        return parts.select("*", F.lit(None).cast("string").alias("rule"),
                            F.lit(default).alias("verdict"))
    keyed = targets.select("host", "path", F.explode(F.array_compact(F.array(*keys))).alias("key"))
    block, bits = _place(F.col("key"), blocks)
    keyed = keyed.withColumn("block", block).withColumn("bits", bits)
    bloom, exact = bloom_blocks(entries, blocks), entries
    if small:
        bloom, exact = F.broadcast(bloom), F.broadcast(exact)
    else:
        exact = exact.hint("shuffle_hash")
    possible = keyed.join(bloom, "block") \
        .filter(F.col("word").bitwiseAND(F.col("bits")) == F.col("bits")) \
        .select("host", "path", "key")
    best = possible.join(exact, "key").groupBy("host", "path").agg(F.max(F.struct(
        F.length("key").alias("size"), F.length("rule_host").alias("host_size"),
        F.col("key").alias("rule"), F.col("verdict"))).alias("best"))
    return parts.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
