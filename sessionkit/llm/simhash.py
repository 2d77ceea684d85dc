"""SimHash near-duplicates by bit-sliced comparison.

*Fingerprints.*  A text's words (A-Z lower-cased, split at ASCII white space)
make shingles; a bit of the fingerprint is set if it is set in over half of
the shingles' XXH64 hashes.

*Candidates.*  64 bits are cut into ``radius + 3`` blocks.  Two fingerprints
within ``radius`` bits agree on at least three whole blocks, so every link
shows in one of the tables that key the fingerprints by three blocks (20
tables for a radius of 3, keys of 31 to 33 bits).  Only distinct fingerprints
take part.  A bucket of more than ``tile`` fingerprints is dealt into chunks
and every pair of chunks is a bucket of its own, so no task ever holds more
than two chunks of a hot bucket and no pair is lost.

*Comparison.*  A task holds its fingerprints as 64 vertical bit planes, in
bucket order.  Row i meets row i+s by xor-ing each plane with itself shifted by
s lanes; carry-save counters add up the differing bits of 64 pairs per word,
started so that they overflow beyond the radius.  Words (blocks of 64 pairs)
whose lanes have all overflown are abandoned, and s only runs over words whose
buckets are that long.

*Groups.*  A task unites the linked rows of what it holds and only emits one
edge per row to the least fingerprint of its local group; components of these
edges are found by star contraction.

Null and empty texts have no words: fingerprint zero, linked like any other.
Rows that repeat share a component.  A null doc_id never becomes a
component_id unless the whole component has none (then it is null).  Extra
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import only, text_groups
from .components import connected_components

BITS = 64
ROWS_AT_ONCE = 1 << 17


def shingle_hashes(text: bytes, width: int, seed: int) -> list:
    """Big-endian XXH64 digests of the shingles, repeats included."""
    from xxhash import xxh64_digest
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    joined = b" ".join(words)
    if len(words) <= width:
        return [xxh64_digest(joined, seed)] if words else []
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:len(words) - width + 1].tolist()
    return [xxh64_digest(joined[a:b], seed) for a, b in zip(starts, ends[width - 1:].tolist())]


def fingerprints(texts: list, width: int = 3, seed: int = 42) -> np.ndarray:
    """Unsigned 64-bit SimHash of each text (bytes; None counts as empty)."""
    out = np.zeros(len(texts), dtype=np.uint64)
    texts = [t or b"" for t in texts]
    for a, b in text_groups(texts):
        hashes = [shingle_hashes(t, width, seed) for t in texts[a:b]]
        n = np.array([len(h) for h in hashes])
        has = np.flatnonzero(n)
        if not len(has):
            continue
        bits = np.unpackbits(np.frombuffer(b"".join(x for h in hashes for x in h), dtype=np.uint8))
        lanes = bits.view(np.uint64).reshape(-1, 8)  # a byte per bit, 8 bits a word
        end = np.cumsum(n[has])
        cuts, first = [], []  # runs of at most 255 rows, so that no byte overflows
        for e, k in zip(end.tolist(), n[has].tolist()):
            first.append(len(cuts))
            cuts += range(e - k, e, 255)
        sums = np.add.reduceat(lanes, cuts, axis=0).view(np.uint8).reshape(-1, BITS)
        set_ = np.add.reduceat(sums.astype(np.int64), first, axis=0)
        over = np.packbits(2 * set_ > n[has][:, None], axis=1)
        out[a + has] = over.view(">u8").reshape(-1).astype(np.uint64)
    return out


def fingerprint_table(docs: DataFrame, width: int = 3, seed: int = 42, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(doc_id, fp, text_key): fp as signed 64-bit, text_key Spark's hash of the text."""
    def run(batches):
        for b in batches:
            fp = fingerprints(b.column("text").cast(pa.binary()).to_pylist(), width, seed)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(fp.view(np.int64)), b.column("text_key")],
                names=["doc_id", "fp", "text_key"])
    return only(docs, doc_id=id_col, text=text_col).withColumn("text_key", F.xxhash64("text")) \
        .mapInArrow(run, "doc_id bigint, fp bigint, text_key bigint")


def block_masks(radius: int) -> list:
    """Masks of the tables: every choice of three of radius + 3 blocks."""
    n = radius + 3
    edges = [BITS * i // n for i in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [x | y | z for x, y, z in combinations(blocks, 3)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def linked_pairs(fp: np.ndarray, rest: np.ndarray, side: np.ndarray, radius: int):
    """Yield (i, j) index arrays of pairs within ``radius`` bits: rows of one
    bucket lie together, ``rest`` is the number of bucket rows after a row, and
    rows with sides 1 and 2 only meet the other side (side 0: all)."""
    n = len(fp)
    top = int(rest.max(initial=0))
    n_words = -(-n // 64)
    pad = np.zeros((n_words + 1) * 64 + top, dtype=np.uint64)
    pad[:n] = fp
    pad = pad[:len(pad) // 64 * 64]
    bits = np.unpackbits(pad.astype(">u8").view(np.uint8)).reshape(-1, BITS)
    planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")
    planes = np.concatenate([planes, np.zeros((BITS, 2 + top // 64), dtype=np.uint64)], axis=1)
    rest_at = np.zeros(n_words * 64, dtype=np.int64)
    rest_at[:n] = rest
    rest_at = rest_at.reshape(-1, 64)
    longest = rest_at.max(axis=1, initial=0)
    sides = np.zeros(n_words * 64 + top + 64, dtype=np.int8)
    sides[:n] = side
    crossing = bool(sides.any())
    k = radius.bit_length()
    spare = (1 << k) - 1 - radius  # counters start here and overflow beyond the radius
    for s in range(1, top + 1):
        at = np.flatnonzero(longest >= s)
        lanes = rest_at[at] >= s
        if crossing:
            i = at[:, None] * 64 + np.arange(64)
            lanes &= (sides[i] == 0) | (sides[i] != sides[i + s])
        live = np.packbits(lanes, axis=1, bitorder="little").view("<u8").reshape(-1)
        q, r = divmod(s, 64)
        low, high = np.uint64(r), np.uint64(64 - r)
        count = [np.full(len(at), 0xFFFFFFFFFFFFFFFF if spare >> b & 1 else 0, dtype=np.uint64)
                 for b in range(k)]
        for p in range(BITS):
            plane = planes[p]
            other = plane[at + q]
            if r:
                other = (other >> low) | (plane[at + q + 1] << high)
            carry = plane[at] ^ other
            for b in range(k):
                count[b], carry = count[b] ^ carry, count[b] & carry
            live &= ~carry
            if p % 4 == 3:
                keep = live != 0
                if not keep.all():  # abandon blocks of 64 pairs with none left
                    at, live = at[keep], live[keep]
                    count = [c[keep] for c in count]
                    if not len(at):
                        break
        if len(at):
            word, lane = np.nonzero(np.unpackbits(
                live.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            i = at[word] * 64 + lane
            yield i, i + s


def local_roots(n: int, pairs) -> np.ndarray:
    """Index of the least row each row is linked to, over all of ``pairs``."""
    root = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = root[i], root[j]
            open_ = a != b
            if not open_.any():
                break
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root


def _edges_of(group, side, fp, radius):
    """(node, least node of its local group) for rows of whole buckets."""
    begin = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[begin, len(group)])
    keep = np.repeat(size > 1, size)
    fp, side, size = fp[keep], side[keep], size[size > 1]
    if not len(fp):
        return None
    rest = np.repeat(np.cumsum(size), size) - np.arange(len(fp)) - 1
    root = local_roots(len(fp), linked_pairs(fp.view(np.uint64), rest, side, radius))
    linked = np.flatnonzero(root != np.arange(len(fp)))
    return fp[linked], fp[root[linked]]


def near_links(nodes: DataFrame, radius: int, tile: int = 2048) -> DataFrame:
    """Edges (u, v) that connect all fingerprints within ``radius`` bits.
    ``nodes`` has one row per distinct ``fp``."""
    tables = F.array(*[F.struct(F.lit(t).cast("byte").alias("table"),
                                F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                       for t, m in enumerate(block_masks(radius))])
    keyed = nodes.select("fp", F.inline(tables))
    hot = materialize(
        keyed.groupBy("table", "key").count().filter(F.col("count") > tile)
        .select("table", "key", F.ceil(F.col("count") / tile).cast("int").alias("chunks")), "hot")
    dealt = keyed.join(hot, ["table", "key"], "left") \
        .withColumn("chunk", F.expr("cast(pmod(xxhash64(fp), chunks) as int)")) \
        .withColumn("other", F.explode(F.expr(
            "if(chunks is null, array(-1), sequence(0, chunks - 1))")))
    tiles = dealt.select(
        "table", "key", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"),
        F.expr("cast(case when chunks is null or chunk = other then 0 when chunk < other then 1 "
               "else 2 end as byte)").alias("side"), "fp")
    # A chunk paired with itself is a bucket; two chunks only meet across.
    ordered = tiles.repartition("table", "key", "a", "b") \
        .sortWithinPartitions("table", "key", "a", "b") \
        .select("table", "key",
                F.coalesce("a", F.lit(-1)).alias("a"), F.coalesce("b", F.lit(-1)).alias("b"),
                "side", "fp")

    def run(batches):
        held: list = []
        rows = 0

        def flush(last: bool):
            nonlocal held, rows
            cols = [np.concatenate(c) for c in zip(*held)]
            group = np.cumsum(np.r_[False, np.any(
                [c[1:] != c[:-1] for c in cols[:4]], axis=0)])
            done = len(group) if last else int(np.searchsorted(group, group[-1]))
            held = [[c[done:] for c in cols]]
            rows = len(group) - done
            return _edges_of(group[:done], cols[4][:done], cols[5][:done], radius) if done else None

        def batch(found):
            return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])],
                                              names=["u", "v"])
        for b in batches:
            if not b.num_rows:
                continue
            held.append([b.column(c).to_numpy(zero_copy_only=False)
                         for c in ("table", "key", "a", "b", "side", "fp")])
            rows += b.num_rows
            if rows >= ROWS_AT_ONCE and (found := flush(False)) is not None:
                yield batch(found)
        if rows and (found := flush(True)) is not None:
            yield batch(found)
    return ordered.mapInArrow(run, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, radius: int = 3, width: int = 3, seed: int = 42,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (the least
    doc_id reachable over links of at most ``radius`` bits), text_key and group
    (the component's least fingerprint, also where it has no doc_id)."""
    prints = materialize(fingerprint_table(docs, width, seed, id_col, text_col), "fingerprints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = materialize(connected_components(near_links(nodes.select("fp"), radius)), "roots")
    members = nodes.join(roots, nodes.fp == roots.node).select("fp", "root", "least")
    least = members.groupBy("root").agg(F.min("least").alias("component"))
    labels = materialize(roots.join(least, "root").select("node", "root", "component"), "labels")
    named = materialize(nodes.join(labels, nodes.fp == labels.node, "left").select(
        "fp", F.coalesce("component", "least").alias("component_id"),
        F.coalesce("root", "fp").alias("group")), "named")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        "text_key", "group")
