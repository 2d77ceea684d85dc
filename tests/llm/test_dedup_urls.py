"""SimHash components, exact duplicates and url lists against brute force."""
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sessionkit.llm import queries as Q
from sessionkit.llm import simhash as S
from sessionkit.llm.components import connected_components
from sessionkit.llm.exact_dedup import exact_duplicates
from sessionkit.llm.url_filter import filter_urls

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")


def slow_print(text, width=3, seed=42):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, prints, radius):
    least = list(ids)
    changed = True
    links = [(i, j) for i in range(len(ids)) for j in range(i)
             if bin(prints[i] ^ prints[j]).count("1") <= radius]
    while changed:
        changed = False
        for i, j in links:
            both = [x for x in (least[i], least[j]) if x is not None]
            m = min(both) if both else None
            if least[i] != m or least[j] != m:
                least[i] = least[j] = m
                changed = True
    return least


def test_fingerprints_equal_the_definition():
    texts = ["", " ", "One", "a b", "The CAT sat\u00a0on the\tmat É", "x " * 900,
             "lots of words " * 300, "\x1c a \x85 b", "Ä Ö ü ÀB"]
    got = S.fingerprints([t.encode() for t in texts] + [None])
    assert got.tolist() == [slow_print(t) for t in texts] + [0]


@pytest.mark.parametrize("tile", [2048, 7])
def test_links_equal_all_pairs(spark, tile):
    r = random.Random(tile)
    base = [r.getrandbits(64) for _ in range(25)] + [0]
    prints = set(base)
    for b in base[:12]:
        for _ in range(14):
            x = b
            for bit in r.sample(range(64), r.randrange(1, 7)):
                x ^= 1 << bit
            prints.add(x)
    prints = sorted(prints)
    nodes = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints], "fp bigint")
    links = S.near_links(nodes, 3, tile=tile)
    roots = {r.node: r.root for r in connected_components(links).collect()}
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    assert [roots.get(x, x) for x in signed] == slow_components(signed, prints, 3)


def test_bit_sliced_pairs_in_long_and_short_buckets():
    rng = np.random.default_rng(5)
    sizes = [1, 2, 200, 65, 64, 3, 130]
    fp = np.repeat(rng.integers(0, 2**63, len(sizes), dtype=np.uint64), sizes)
    fp ^= np.uint64(1) << rng.integers(0, 64, len(fp), dtype=np.uint64)
    fp ^= np.uint64(1) << rng.integers(0, 64, len(fp), dtype=np.uint64)
    bucket = np.repeat(np.arange(len(sizes)), sizes)
    rest = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(fp)) - 1
    side = np.where(bucket == 2, np.arange(len(fp)) % 2 + 1, 0).astype(np.int8)
    for radius in (0, 1, 2, 3, 5):
        got = {(int(a), int(b)) for i, j in S.linked_pairs(fp, rest, side, radius)
               for a, b in zip(i, j)}
        want = {(i, j) for j in range(len(fp)) for i in range(j) if bucket[i] == bucket[j]
                and (side[i] == 0 or side[i] != side[j])
                and bin(int(fp[i]) ^ int(fp[j])).count("1") <= radius}
        assert got == want


def odd_docs(spark):
    long = " ".join(f"w{i % 977}" for i in range(4000))
    rows = [(5, "a b c d"), (3, None), (4, ""), (9, " \n"), (2, long), (8, long + " tail"),
            (7, "A b C d"), (7, "A b C d"), (None, "a b c d"), (None, "only null here x"),
            (1, "something else entirely")]
    return spark.createDataFrame(rows, "doc_id bigint, text string") \
        .withColumn("fp", F.lit("x")).withColumn("component", F.lit(1))


def test_near_duplicates_odd_rows(spark):
    docs = odd_docs(spark)
    got = S.near_duplicates(docs).collect()
    data = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [slow_print(t) for _, t in data]
    want = slow_components([d for d, _ in data], prints, 3)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got], key=key) == sorted(
        [(d, f"{p:016x}", c) for (d, _), p, c in zip(data, prints, want)], key=key)
    assert S.near_duplicates(docs.limit(0)).count() == 0


def test_op1_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    prints = [slow_print(t) for _, t in docs]
    want = slow_components([d for d, _ in docs], prints, 3)
    got = Q.QUERIES["op1_simhash_near_dedup"](spark, SF).collect()
    assert sorted(tuple(r) for r in got) == sorted(
        (d, f"{p:016x}", c) for (d, _), p, c in zip(docs, prints, want))
    assert len(set(want)) < len(want)


@pytest.mark.parametrize("counters", [2, 1000])
def test_exact_duplicates_odd_rows(spark, counters):
    docs = odd_docs(spark).withColumn("sha", F.lit("x")).withColumn("row", F.lit(0))
    got = exact_duplicates(docs, counters).collect()
    assert len(got) == docs.count()
    groups = {}
    for r in docs.collect():
        groups.setdefault(r.text or "", []).append(r.doc_id)
    for text, ids in groups.items():
        rows = [r for r in got if r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()]
        known = [i for i in ids if i is not None]
        best = max(known) if known else None
        assert sorted(str(r.doc_id) for r in rows) == sorted(map(str, ids))
        assert {(r.keep_id, r.group_size) for r in rows} == {(best, len(ids))}
        assert [r.doc_id for r in rows if r.kept] == [best]
    assert exact_duplicates(docs.limit(0), counters).count() == 0


def oracle(key, sf=SF):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con.execute(Q.ORACLE[key]).df()


@pytest.mark.parametrize("key", ["op6_exact_dedup", "op8_url_filter"])
def test_queries_equal_sql(spark, key):
    got, want = Q.QUERIES[key](spark, SF).toPandas(), oracle(key)
    assert sorted(got.columns) == sorted(want.columns)
    rows = [sorted(map(str, d[sorted(d.columns)].astype(object).where(d.notna(), None)
                       .itertuples(index=False, name=None))) for d in (got, want)]
    assert rows[0] == rows[1]


URLS = [None, "", "no scheme", "http://", "http://ORG/", "https://a.Org/x?y=://z", "http://xorg/",
        "http://example.org/es/1", "http://m.example.org/es", "http://example.org/en/123#a",
        "http://x.com/fr/a", "http://x.com/de/", "http://x.com/DE/", "http://x.com?u=/de/",
        "http://com/de/" + "y" * 5000, "http://a.example.org.com/de/x", "x://org", "://org/",
        "http://org:80/", "http://ünï.org/", "http://ÀB.ORG/"]


def slow_verdict(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[2], max(fits)[3]) if fits else (host, path, None, default)


@pytest.mark.parametrize("max_broadcast", [0, 1 << 20])
def test_url_filter_odd_rows(spark, max_broadcast):
    rules = Q.URL_RULES + [("block", "m.example.org", "/es"), ("block", "spare.net", ""),
                           ("allow", "spare.net", "")] + [
        ("block", f"h{i}.net", "/p") for i in range(200)]
    urls = URLS + URLS[5:8] + ["http://h7.net/path", "http://www.spare.net", "http://h7.net/q"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string") \
        .withColumn("host", F.lit("x")).withColumn("rule", F.lit("x"))
    listed = spark.createDataFrame(rules, "verdict string, host string, path string")
    got = {r.page_id: tuple(r)[1:] for r in
           filter_urls(pages, listed, max_broadcast=max_broadcast).collect()}
    assert got == {i: slow_verdict(u, rules) for i, u in enumerate(urls)}
    assert filter_urls(pages.limit(0), listed).count() == 0
    none = filter_urls(pages, listed.limit(0), default="block").collect()
    assert {(r.rule, r.verdict) for r in none} == {(None, "block")} and len(none) == len(urls)
