"""Personal data: patterns against plain regular expressions, the tagger's
gradients and decoding, held-out spans, reconciling, odd rows."""
import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from sessionkit.llm import personal_data as P
from sessionkit.llm import queries as Q
from sessionkit.llm.common import share_package
from sessionkit.llm.tagger import Tagger

SF = "/root/testdata/sf0.001"


def slow_base(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 13 <= len(digits(m)) <= 19 and P.luhn(digits(m))]
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(digits(m)) <= 15]
    return out


def test_patterns_equal_plain_expressions():
    r = random.Random(1)
    bits = ["1", "2", "5", "0", "255", "256", "4111111111111111", "@", ".", "+", "-", " ", "a", "b.c",
            "(", ")", "%", "é", "007"]
    for _ in range(20_000):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 30)))
        assert P.base_spans(text) == slow_base(text), text
    assert P.base_spans("5555 5555 5555 4444") == [(2, 0, 19)]


def test_long_runs_take_linear_time():
    for text in ("1" * 1_000_000, "a" * 1_000_000 + "@", "1." * 500_000, "+1" + "(" * 1_000_000, "a@" * 500_000):
        P.base_spans(text)


def test_gradients_equal_differences():
    tagger, r = Tagger(12, 2, width=3, units=4, seed=3), np.random.default_rng(0)
    x = r.integers(0, 12, (3, 7))
    y = np.array([[0, 1, 2, 2, 0, 3, 4], [1, 1, 2, 0, 0, 0, 3], [0, 0, 0, 3, 4, 4, 0]])
    _, grad = tagger.loss(x, y)
    for name, p in tagger.params.items():
        for _ in range(8):
            at = tuple(r.integers(0, n) for n in p.shape)
            old, sides = p[at], []
            for step in (1e-5, -1e-5):
                p[at] = old + step
                sides.append(tagger.loss(x, y)[0])
            p[at] = old
            assert abs((sides[0] - sides[1]) / 2e-5 - grad[name][at]) < 1e-7, name


def test_decoding_equals_all_sequences():
    tagger, r = Tagger(9, 1, width=3, units=4, seed=5), np.random.default_rng(2)
    tagger.params["pair"] = r.normal(0, 1, (3, 3))
    x = r.integers(0, 9, (6, 5))
    e, pairs, got = tagger.emissions(x), tagger.params["pair"] + tagger.barred, tagger.decode(x)
    for n in range(6):
        score = lambda s: tagger.params["start"][s[0]] + sum(e[n, i, t] for i, t in enumerate(s)) \
            + sum(pairs[a, b] for a, b in zip(s, s[1:]))  # noqa: E731, B023
        assert tuple(got[n]) == max(itertools.product(range(3), repeat=5), key=score)


def test_windows_cover_every_mark():
    r = random.Random(4)
    for _ in range(300):
        n = r.choice([0, 1, 100, 128, 129, 500, 1000])
        text = "".join("1" if r.random() < 0.01 else "x" for _ in range(n))
        got = P.window_starts(text)
        last = max(0, -(-(n - P.WINDOW) // P.STEP))
        want = [w * P.STEP for w in range(last + 1) if "1" in text[w * P.STEP:w * P.STEP + P.WINDOW]]
        assert got == want


def test_reconciling_takes_whole_spans_and_joins_cut_ones():
    phone = "(743) 555-3824"
    text = "x" * 55 + " " + phone + " " + "y" * 200
    a = 56
    # cut by the first window's edge only in a window that begins inside the span
    assert P.reconcile(text, [(0, [(3, a, a + 14)]), (64, [(3, 0, 6)])], []) == [(3, a, a + 14)]
    # a card that no window holds is joined from its pieces
    card = "4  " * 0 + " / ".join(["4111111111111111"])
    assert P.reconcile(card, [(0, [(2, 0, 16)])], []) == [(2, 0, 16)]
    assert P.reconcile(card, [(0, [(2, 0, 16)])], [(1, 3, 9)]) == []       # touches a base span
    assert P.reconcile("a" + card, [(0, [(2, 1, 17)])], []) == []          # a letter goes on
    assert P.reconcile("4111111111111112", [(0, [(2, 0, 16)])], []) == []  # fails its check
    mail = "a" * 90 + "." + "b" * 90 + " [at] c.org"
    pieces = [(0, [(0, 0, 128)]), (64, [(0, 0, 128)])]
    assert P.reconcile(mail, pieces, []) == [(0, 0, len(mail))]


def test_query_equals_patterns_and_adds_only_checked_spans(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = Q.QUERIES["op12_personal_data"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        base = slow_base(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(
            sum(s[0] == k for s in base) for k in range(4))
        flat = ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(flat.encode()).hexdigest()
        spans = [tuple(x.split(":")) for x in r.spans.split(",") if x]
        spans = [(P.KINDS.index(k), int(a), int(b)) for k, a, b in spans]
        assert spans == sorted(spans) and set(base) <= set(spans)
        assert all(P.passes(texts[r.doc_id], *s) for s in set(spans) - set(base))


@pytest.fixture(scope="module")
def trained(spark):
    share_package(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    params = P.fit(docs.filter("doc_id % 3 <> 0"))
    return Tagger(P.CLASSES, 4, params=params).narrowed(), docs.filter("doc_id % 3 = 0")


def test_held_out_spans_are_found(trained):
    """The tagger alone, on documents it has not seen."""
    tagger, docs = trained
    texts = [r.text for r in docs.select("text").distinct().collect()]
    base = [set(P.base_spans(t)) for t in texts]
    found = [set(P.added_spans([t], [[]], tagger)[0]) for t in texts]
    want = sum(map(len, base))
    assert want >= 15
    assert sum(len(a & b) for a, b in zip(base, found)) >= 0.7 * want
    assert sum(len(b - a) for a, b in zip(base, found)) <= 0.2 * want


def test_rewritten_spans_are_added(trained):
    tagger, docs = trained
    total = hits = 0
    for r in docs.select("text").distinct().collect():
        for kind, a, b in P.base_spans(r.text):
            if kind in (P.PHONE, P.CARD):
                other = P.variant(kind, r.text[a:b], a)
                text = r.text[:a] + other + r.text[b:]
                spans = P.added_spans([text], [P.base_spans(text)], tagger)[0]
                total, hits = total + 1, hits + ((kind, a, a + len(other)) in spans)
    assert total >= 5 and hits >= 0.5 * total


def test_odd_rows(spark):
    share_package(spark)
    rows = [(1, None, "x", 1), (None, "", "y", 2), (2, "mail a.b@c.de, +1 (743) 555-3824", "z", 3),
            (2, "mail a.b@c.de, +1 (743) 555-3824", "z", 3), (3, "é 10.0.0.1\n" * 3, "q", 4),
            (4, "1" * 300_000 + "@", "w", 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans string, kind int")
    for params in (None, P.fit(df, steps=3)):
        out = P.find_personal_data(df, params).collect()
        got = {(r.doc_id, tuple((s.kind, s.start, s.stop) for s in r.spans if s.base)) for r in out}
        assert len(out) == len(rows)
        assert got == {(i, tuple(slow_base(t or ""))) for i, t, _, _ in rows if i != 4} | {(4, ())}
    assert P.fit(df.limit(0)) is None and P.find_personal_data(df.limit(0), None).count() == 0
    assert P.digests(P.find_personal_data(df.limit(0), None)).columns == [
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
