"""Byte-level BPE encoding and decoding with a segment tree.

The bytes of a word are the leaves of a segment tree.  Leaf p holds the rank
of the pair made of the live part at p and the next live part (no pair:
``NONE``) together with p, so that the root is the leftmost pair of least
rank.  Each merge replaces the part at p, unlinks its right neighbour and
updates three leaves (p, the neighbour, the part before) up to the root, in
logarithmic time.  Many words are merged at once, each in its own row of the
same arrays, grouped by the power of two that holds their length.

Null texts count as empty: no ids, and the digests of the empty string.  Rows
that repeat are encoded alike, one output row per input row; extra columns are
not read.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import WordCache, only, text_groups
from .tokens import split_spaced

NONE = np.int64(1) << 20  # above every rank
SHIFT = 21


class SegmentTreeBPE:
    """Encoder and decoder for a rank file (one base64 token and rank a line)."""

    def __init__(self, ranks: dict, pattern: str):
        import regex
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.text_of = {r: str(r) for r in self.bytes_of}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {(ranks[t[:i]] << SHIFT) | ranks[t[i:]]: r for t, r in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        keys = np.fromiter(pairs, dtype=np.int64, count=len(pairs))
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(
            np.fromiter(pairs.values(), dtype=np.int64, count=len(pairs))[order], NONE)
        self.words = WordCache(self._word_ids)
        self.pieces = WordCache(self._piece_ids)

    def _rank(self, left, right):
        """Rank of the pair (left, right); ``NONE`` where right is missing (-1)."""
        key = (left << SHIFT) | np.maximum(right, 0)
        at = np.searchsorted(self.pair_keys, key)
        hit = (self.pair_keys[at] == key) & (right >= 0)
        return np.where(hit, self.pair_ranks[at], NONE)

    def _merge(self, words: list, size: int) -> list:
        """Ids of byte strings of 2 to ``size`` bytes; ``size`` a power of two."""
        n = len(words)
        ids = np.full((n, size + 1), -1, dtype=np.int64)
        lengths = np.array([len(w) for w in words])
        ids[:, :size][np.arange(size) < lengths[:, None]] = \
            self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        nxt = np.tile(np.arange(1, size + 2), (n, 1))
        nxt[:, size] = size
        nxt = np.minimum(nxt, size)
        prv = np.tile(np.arange(-1, size), (n, 1))
        place = np.arange(size, dtype=np.int64)
        tree = np.full((n, 2 * size), NONE * size, dtype=np.int64)
        tree[:, size:] = np.where(ids[:, :size] >= 0,
                                  self._rank(ids[:, :size], ids[:, 1:]), NONE) * size + place
        half = size
        while half > 1:
            half //= 2
            level = tree[:, 2 * half:4 * half]
            tree[:, half:2 * half] = np.minimum(level[:, ::2], level[:, 1::2])
        rows = np.arange(n)
        while True:
            root = tree[rows, 1]
            live = root < NONE * size
            if not live.all():
                rows, root = rows[live], root[live]
            if not len(rows):
                break
            pos, rank = root % size, root // size
            gone = nxt[rows, pos]
            after = nxt[rows, gone]
            before = prv[rows, pos]
            ids[rows, pos], ids[rows, gone] = rank, -1  # a token's id is its rank
            nxt[rows, pos], prv[rows, after] = after, pos
            tree[rows, size + pos] = self._rank(rank, ids[rows, after]) * size + pos
            tree[rows, size + gone] = NONE * size + gone
            has = before >= 0
            r, b = rows[has], before[has]
            tree[r, size + b] = self._rank(ids[r, b], rank[has]) * size + b
            for rr, leaf in ((rows, pos), (rows, gone), (r, b)):
                node = (size + leaf) >> 1
                while node.size and node[0] >= 1:
                    tree[rr, node] = np.minimum(tree[rr, 2 * node], tree[rr, 2 * node + 1])
                    node >>= 1
        kept = ids[:, :size] >= 0
        flat = ids[:, :size][kept].astype("<u4").tobytes()
        ends = np.cumsum(kept.sum(1)) * 4
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def _piece_ids(self, pieces: list) -> list:
        """Ids (as little-endian 32-bit bytes) of matches of the pattern."""
        out: list = [b""] * len(pieces)
        by_size: dict[int, list] = {}
        for i, p in enumerate(pieces):
            raw = p.encode("utf-8")
            whole = self.ranks.get(raw)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif raw:
                by_size.setdefault(1 << (len(raw) - 1).bit_length(), []).append((i, raw))
        for size, group in by_size.items():
            step = max(1, (1 << 21) // size)  # arrays of at most about 2 million leaves
            for a in range(0, len(group), step):
                part = group[a:a + step]
                for (i, _), ids in zip(part, self._merge([raw for _, raw in part], size)):
                    out[i] = ids
        return out

    def _word_ids(self, words: list) -> list:
        found = [self.find(w) for w in words]
        get = self.pieces.lookup(found)
        return [b"".join(map(get, f)) for f in found]

    def encode(self, texts: list):
        """Id bytes of each text (None counts as empty), lazily, in order."""
        texts = [t or "" for t in texts]
        for a, b in text_groups(texts):
            cut = [split_spaced(t) for t in texts[a:b]]
            get = self.words.lookup(cut)
            for words in cut:
                yield b"".join(map(get, words))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=4)
def load_ranks(path: str, pattern: str) -> SegmentTreeBPE:
    """This worker's codec for a rank file."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return SegmentTreeBPE(ranks, pattern)


ROUND_TRIP_SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode_texts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of each whole text, ids as array<int>."""
    def run(batches):
        codec = load_ranks(path, pattern)
        for b in batches:
            ids = [np.frombuffer(x, dtype="<u4").astype(np.int32)
                   for x in codec.encode(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])
    return only(docs, doc_id=id_col, text=text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode every whole text, decode the ids again, and return per row
    ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    def run(batches):
        codec = load_ranks(path, pattern)
        for b in batches:
            n, hashes, decoded = [], [], []
            for raw in codec.encode(b.column(1).to_pylist()):
                ids = np.frombuffer(raw, dtype="<u4").tolist()
                n.append(len(ids))
                hashes.append(hashlib.sha256(
                    " ".join(map(codec.text_of.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(hashes), pa.array(decoded)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return only(docs, doc_id=id_col, text=text_col).mapInArrow(run, ROUND_TRIP_SCHEMA)
