"""Byte-pair encoding, packing and token files against the libraries and brute force."""
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sessionkit.llm import queries as Q
from sessionkit.llm.bpe import encode_texts, load_ranks, round_trip
from sessionkit.llm.packing import Plan, pack, place
from sessionkit.llm.tokenfile import BLOCK, decode, encode, read_digests, write_token_files
from sessionkit.llm.tokens import byte_encoder, word_encoder
from sessionkit.session import scratch_path

SF = "/root/testdata/sf0.001"
ALPHABET = ["a", "b", "the", " ", "  ", "\n", "\n\n", "'s", "é", "ß", "\xa0", "1", "23", "!!", "#$",
            "日本", "\x1c", "\x85", "\0", "\t", "ing", "tion", "😀", "\r\n", "　", "'", "ll", "é"]


def random_texts(n=600):
    r = random.Random(3)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randrange(60))) for _ in range(n)] + [
        "", " ", "a" * 5000, "ab" * 2000 + " " * 2000, "x<|endoftext|> y"]


def odd_docs(spark):
    """Nulls, empties, repeats, a very long text and a clashing extra column."""
    rows = [(1, "the cat"), (2, None), (3, ""), (4, "word " * 3000), (5, "the cat"), (5, "the cat"),
            (None, "null id"), (7, "\n \n")]
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit("x"))


def tik(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_segment_tree_equals_tiktoken():
    codec = load_ranks(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    texts, enc = random_texts(), tik(codec.ranks)
    for t, raw in zip(texts, codec.encode(texts)):
        ids = np.frombuffer(raw, dtype="<u4").tolist()
        assert ids == enc.encode_ordinary(t)
        assert codec.decode(ids) == t.encode()


@pytest.mark.parametrize("name,make", [("byte_bpe_50k.json", byte_encoder),
                                       ("word_bpe_49k.json", word_encoder)])
def test_cut_texts_encode_like_whole_texts(name, make):
    tok = Tokenizer.from_file(P.path(name))
    tok.encode_special_tokens = True
    texts = random_texts()
    for t, raw in zip(texts, make(P.path(name)).encode(texts)):
        assert np.frombuffer(raw, dtype="<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_text_of_irregular_spacing_is_cut_at_its_regular_spots():
    from sessionkit.llm.tokens import split_spaced
    text = "one two  three\nfour\n\nfive " + "six " * 1000
    pieces = split_spaced(text)
    assert "".join(pieces) == text and len(pieces) > 1000
    assert pieces[:5] == ["one", " two", "  three", "\n", "four"]


def test_bpe_odd_rows(spark):
    got = round_trip(odd_docs(spark), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    assert len(got) == 8
    empty = hashlib.sha256(b"").hexdigest()
    assert {(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got if r.doc_id in (2, 3)} \
        == {(0, empty, empty)}
    ids = {r.doc_id: r.ids for r in encode_texts(
        odd_docs(spark), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()}
    assert len(ids[4]) == 3001 and ids[3] == []
    none = odd_docs(spark).limit(0)
    assert round_trip(none, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_op3_equals_the_library(spark):
    codec = load_ranks(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    enc = tik(codec.ranks)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = Q.QUERIES["op3_byte_bpe"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = enc.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fit = [i for i, r in enumerate(rooms) if r >= x]
        if fit:
            rooms[min(fit, key=rooms.__getitem__)] -= x
        else:
            rooms.append(capacity - x)
    return len(rooms)


def least_bins(lengths, capacity):
    """Exact minimum by search (small instances)."""
    best = [len(lengths)]
    todo = sorted(lengths, reverse=True)

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(todo):
            best[0] = len(rooms)
            return
        tried = set()
        for k, r in enumerate(rooms):
            if r >= todo[i] and r not in tried:
                tried.add(r)
                go(i + 1, rooms[:k] + [r - todo[i]] + rooms[k + 1:])
        go(i + 1, rooms + [capacity - todo[i]])
    go(0, [])
    return best[0]


def test_plan_places_every_piece_and_never_beats_or_loses_badly():
    rng = np.random.default_rng(0)
    for _ in range(150):
        cap, n = int(rng.integers(5, 60)), int(rng.integers(0, 70))
        lengths = rng.integers(1, cap + 1, n)
        plan = Plan({int(a): int(b) for a, b in zip(*np.unique(lengths, return_counts=True))}, cap)
        seg, ranks, bins = plan.segments(), {}, {}
        for x in lengths.tolist():
            r = ranks.get(x, 0)
            ranks[x] = r + 1
            b, o = place(seg, np.array([x]), np.array([r]))
            bins.setdefault(int(b[0]), []).append((int(o[0]), x))
        for items in bins.values():
            at = 0
            for o, x in sorted(items):
                assert o == at
                at += x
            assert at <= cap
        assert len(bins) == plan.bins <= best_fit_decreasing(lengths.tolist(), cap)


def test_reduction_keeps_the_optimum():
    """The bins fixed by dominance plus an optimal rest are optimal."""
    rng = np.random.default_rng(1)
    fixed = 0
    for _ in range(120):
        cap, n = int(rng.integers(8, 30)), int(rng.integers(1, 10))
        lengths = rng.integers(1, cap + 1, n).tolist()
        hist = {x: lengths.count(x) for x in lengths}
        plan = Plan.__new__(Plan)
        plan.capacity, plan.left, plan.classes = cap, dict(hist), []
        plan._reduce()
        fixed += sum(b for _, b in plan.classes)
        rest = [x for x, k in plan.left.items() for _ in range(k)]
        assert sum(b for _, b in plan.classes) + least_bins(rest, cap) == least_bins(lengths, cap)
    assert fixed > 100


def check_packed(rows, texts, cap):
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = []
    for doc, text in texts:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        want += [(doc, k // cap, k, len(ids[k:k + cap]), zlib.crc32(ids[k:k + cap].tobytes()))
                 for k in range(0, len(ids), cap)]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([tuple(r)[:5] for r in rows], key=key) == sorted(want, key=key)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for o, n in sorted(items):
            assert o == at
            at += n
        assert at <= cap
    return len(bins)


def test_op2_against_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = Q.QUERIES["op2_best_fit_packing"](spark, SF).collect()
    bins = check_packed(rows, [(r.doc_id, r.text) for r in docs.collect()], 2048)
    assert bins <= -(-sum(r.length for r in rows) // 2048) + 2


def test_packing_odd_rows(spark):
    docs = odd_docs(spark)
    rows = pack(docs, P.path("word_bpe_49k.json"), 64).collect()
    check_packed(rows, [(r.doc_id, r.text) for r in docs.collect()], 64)
    assert pack(docs.limit(0), P.path("word_bpe_49k.json"), 64).count() == 0


def test_simple8b_round_trip():
    rng = np.random.default_rng(2)
    tops = [2, 2**5, 2**16, 2**32, 2**60, 2**63]
    for trial in range(200):
        lens = rng.integers(0, [3, 300, 9000][trial % 3], int(rng.integers(1, 6)))
        v = rng.integers(0, tops[trial % 6], int(lens.sum()), dtype=np.uint64)
        if trial % 5 == 0:
            v[rng.random(len(v)) < .9] = 0
        if trial % 7 == 0 and len(v):
            v[0] = 2**64 - 1
        w, rw, e, re_, bw, nb = encode(v, lens)
        assert (decode(w, rw, e, re_) == v).all()
        parts = [np.split(a, np.cumsum(n)[:-1]) for a, n in ((w, rw), (e, re_), (bw, nb), (v, lens))]
        for words, escapes, first, ids in zip(*parts):
            for k, a in enumerate(first):  # each block on its own
                x = words[a:first[k + 1] if k + 1 < len(first) else len(words)]
                got = decode(x, np.array([len(x)]), escapes, np.array([len(escapes)]))
                assert (got == ids[k * BLOCK:(k + 1) * BLOCK]).all()


def check_files(rows, texts):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    start, want = 0, []
    for doc, text in sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((tuple(r) for r in rows), key=lambda r: r[1]) == want


def test_op5_against_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    check_files(Q.QUERIES["op5_token_files"](spark, SF).collect(),
                [(r.doc_id, r.text) for r in docs])


def test_token_files_odd_rows(spark):
    docs = odd_docs(spark)
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    for df in (docs, docs.limit(0)):
        path = scratch_path(spark, "odd-files")
        write_token_files(df, path, P.path("byte_bpe_50k.json"))
        check_files(read_digests(spark, path).collect(), [(r.doc_id, r.text) for r in df.collect()])
