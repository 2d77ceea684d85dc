"""Spelling variants against brute force."""
import random
import re
import zlib
from collections import Counter

import pytest

from sessionkit.llm import queries as Q
from sessionkit.llm import spelling as SP

SF = "/root/testdata/sf0.001"


def slow_words(rows, least_length=6, least_count=5, drop_every=199):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % drop_every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= least_length and k >= least_count}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def slow_variants(n, ratio=5):
    near = {w: [v for v in n if v != w and one_apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = slow_variants(slow_words(rows))
    assert got(Q.QUERIES["op11_spelling_variants"](spark, SF)) == want
    assert sum(r[4] for r in want) > 20 and any(r[1] for r in want)


@pytest.mark.parametrize("seed", range(3))
def test_dense_words_equal_brute_force(spark, seed):
    """Few letters: runs of equal letters, many neighbours, chains, ties, prefixes
    of other words and shards that share long prefixes."""
    r = random.Random(seed)
    words = {"".join(r.choice("abß") for _ in range(r.randint(1, 7))) for _ in range(400)}
    n = {w: r.choice([1, 1, 2, 5, 25, 130]) for w in words}
    df = spark.createDataFrame(list(n.items()), "word string, n bigint").repartition(5)
    assert got(SP.group_variants(df)) == slow_variants(n)


def test_inherited_ranks_cross_several_shards():
    words = sorted(["ab", "abc", "abca", "abcb", "abd", "b", "ba", "bab"])
    prefix_rank = lambda p: next(i for i, w in enumerate(words) if w.startswith(p))
    for cuts in ([1, 2, 3], [3], [2, 6], [1, 4, 7], list(range(1, 8))):
        shards = [words[a:b] for a, b in zip([0, *cuts], [*cuts, len(words)])]
        ends = []
        for s, part in enumerate(shards):
            place = lambda p: next(i for i, w in enumerate(part) if w.startswith(p))
            ends.append((s, len(part), part[0], part[-1], [place(part[-1][:d]) for d in range(len(part[-1]) + 1)]))
        for (s, base, ranks), part in zip(SP.inherited(ends), shards):
            assert base == words.index(part[0])
            assert ranks == [prefix_rank(part[0][:d]) for d in range(len(ranks))]
            if base:
                assert len(ranks) == SP._shared(words[base - 1], part[0]) + 1


def test_odd_rows(spark):
    long_word = "ab" * 15_000
    rows = [(1, None, "x"), (2, "", "x"), (None, "letter LETTER Letter", "y"), (3, "letters " * 3, "y"),
            (3, "letters " * 3, "y"), (4, "ÀÉletter 123 l×tter ß" * 6, "z"),
            (5, f"{long_word} " * 5 + f"{long_word}c " * 30, "z"), (6, "letter letter letter", "q")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, word string")
    want = slow_variants(slow_words([x[:2] for x in rows]))
    assert got(SP.spelling_variants(df, drop_every=199)) == want
    assert any(r[0] == long_word and r[1] == long_word + "c" for r in want)
    assert got(SP.spelling_variants(df.limit(0), drop_every=199)) == []
    assert got(SP.spelling_variants(df.filter("text is null"))) == []
