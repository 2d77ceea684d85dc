"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Every document becomes its token ids and an end id; only documents above the
capacity are cut, into pieces of exactly the capacity and one shorter rest.

A packing only depends on how many pieces there are of each length, and there
are at most ``capacity`` lengths.  So the plan is made on that histogram (at
most ``capacity`` counts reach the driver, whatever the size of the table):

1. *Reduction.*  For a length s, a set {s, ...} that provably dominates every
   other set holding an s is fixed, as often as its members last:
   nothing fits beside s; one length fills s exactly; at most one more piece
   fits (take the largest that does); at most two more fit and either the
   largest single partner weighs as much as any pair, or the pair of the
   largest partner and the largest piece beside it dominates every pair.
   Passes repeat until none fixes anything more.
2. *Best fit* of the rest, longest first, each piece into the fullest bin
   that still takes it.

Bins with the same contents are kept as one class with a count, so the work
follows the number of lengths, not of pieces.  Every piece then finds its
place from its rank among the pieces of its length: its rank within its task
(counted while the task streams) plus the counts of the tasks before.

Null texts count as empty (one piece holding the end id); repeated rows are
packed each on its own; an empty table gives no rows; extra columns are not
read.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .common import only
from .tokens import word_encoder

PIECE_SCHEMA = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
                "task int, task_rank bigint")
PACKED_SCHEMA = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
                 "sequence_id bigint, offset bigint")


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece, with its rank among its task's pieces of that length."""
    def run(batches):
        encoder, task = word_encoder(path), TaskContext.get().partitionId()
        seen: dict = defaultdict(int)
        end = np.uint32(end_id).astype("<u4").tobytes()
        width = 4 * capacity
        for b in batches:
            out = []
            for doc, raw in zip(b.column(0).to_pylist(), encoder.encode(b.column(1).to_pylist())):
                raw += end
                for k in range(0, len(raw), width):
                    part = raw[k:k + width]
                    n = len(part) // 4
                    out.append((doc, k // width, k // 4, n, zlib.crc32(part), task, seen[n]))
                    seen[n] += 1
            cols = list(zip(*out)) or [()] * 7
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(),
                     pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "task_rank"])
    return only(docs, doc_id=id_col, text=text_col).mapInArrow(run, PIECE_SCHEMA)


class Plan:
    """Bins as classes: a tuple of (length, run) parts and how many such bins."""

    def __init__(self, histogram: dict, capacity: int):
        self.capacity = capacity
        self.left = {s: n for s, n in histogram.items() if n}
        self.classes: list = []
        self._reduce()
        self.fixed = len(self.classes)
        self._best_fit()

    # -- reduction
    def _fix(self, members: tuple) -> bool:
        need = Counter(members)
        times = min(self.left.get(s, 0) // k for s, k in need.items())
        if times == 0:
            return False
        for s, k in need.items():
            self.left[s] -= k * times
            if not self.left[s]:
                del self.left[s]
        self.classes.append((tuple(sorted(need.items(), reverse=True)), times))
        return True

    def _dominating(self, s: int):
        """A set that dominates every other set with an s, or None."""
        room = self.capacity - s
        others = dict(self.left)
        others[s] -= 1
        fits = sorted(x for x, n in others.items() if n and x <= room)
        if not fits:
            return (s,)
        if fits[-1] == room:
            return (s, room)
        small: list = []  # the three least pieces beside s
        for x in fits:
            small += [x] * min(others[x], 3 - len(small))
            if len(small) == 3:
                break
        single = fits[-1]
        if len(small) < 2 or small[0] + small[1] > room:
            return (s, single)
        if len(small) == 3 and sum(small) <= room:
            return None  # three more pieces fit: no rule for that
        best_pair = best_second = 0
        hi = len(fits) - 1
        for lo, y in enumerate(fits):  # y the smaller of the pair
            while hi >= 0 and fits[hi] + y > room:
                hi -= 1
            if hi < lo or (hi == lo and others[y] < 2):
                break
            best_pair, best_second = max(best_pair, fits[hi] + y), y
        if single >= best_pair:
            return (s, single)
        others[single] -= 1
        beside = [x for x in fits if others[x] and x <= room - single]
        if beside and best_second <= beside[-1]:
            return (s, single, beside[-1])
        return None

    def _reduce(self):
        changed = True
        while changed:
            changed = False
            for s in sorted(self.left, reverse=True):
                while s in self.left:
                    found = self._dominating(s)
                    if not found or not self._fix(found):
                        break
                    changed = True

    # -- best fit
    def _best_fit(self):
        rooms: list = []  # sorted room left of the open classes
        open_: dict = defaultdict(list)  # room -> [[parts, bins], ...]

        def put(parts, bins, room):
            if not open_[room]:
                bisect.insort(rooms, room)
            open_[room].append([parts, bins])

        for s in sorted(self.left, reverse=True):
            n = self.left[s]
            while n:
                at = bisect.bisect_left(rooms, s)
                if at < len(rooms):
                    room = rooms[at]
                    parts, bins = open_[room].pop()
                    if not open_[room]:
                        rooms.pop(at)
                else:  # as many empty bins as needed
                    room, parts, bins = self.capacity, (), n
                run = min(room // s, n)  # a bin takes its run before the next one gets any
                used = min(bins, n // run)
                put((*parts, (s, run)), used, room - run * s)
                if bins > used and parts:
                    put(parts, bins - used, room)
                n -= used * run
        for room in rooms:
            self.classes += [(parts, bins) for parts, bins in open_[room]]
        self.left = {}

    # -- places
    @property
    def bins(self) -> int:
        return sum(b for _, b in self.classes)

    def segments(self) -> dict:
        """Sorted arrays: the pieces of ``length`` ranked from ``rank`` on fill
        the bins from ``first`` on, ``run`` a bin, from ``offset`` on."""
        rows, rank, first = [], defaultdict(int), 0
        for parts, bins in self.classes:
            offset = 0
            for s, run in parts:
                rows.append((s, rank[s], first, run, offset))
                rank[s] += bins * run
                offset += s * run
            first += bins
        rows.sort()
        names = ("length", "rank", "first", "run", "offset")
        a = np.array(rows, dtype=np.int64).reshape(-1, 5)
        return {n: a[:, i] for i, n in enumerate(names)}


def place(seg: dict, length: np.ndarray, rank: np.ndarray):
    """(bin, offset) of the pieces with these lengths and ranks."""
    key = (seg["length"] << 44) + seg["rank"]
    at = np.searchsorted(key, (length << 44) + rank, side="right") - 1
    i = rank - seg["rank"][at]
    run = seg["run"][at]
    return seg["first"][at] + i // run, seg["offset"][at] + (i % run) * length


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack the token pieces of all documents; columns of ``PACKED_SCHEMA``."""
    pieces = materialize(token_pieces(docs, path, capacity, end_id, id_col, text_col), "pieces")
    counts = pieces.groupBy("task", "length").count()
    before = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = materialize(counts.select(
        "task", "length", "count",
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")), "piece-bases")
    histogram = {r["length"]: r["n"] for r in
                 bases.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    seg = Plan(histogram, capacity).segments()  # at most capacity lengths in

    def run(batches):
        for b in batches:
            length = b.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = b.column("rank").to_numpy(zero_copy_only=False).astype(np.int64)
            bin_, offset = place(seg, length, rank)
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(5)] + [pa.array(bin_, pa.int64()),
                                                   pa.array(offset, pa.int64())],
                names=[x.split()[0] for x in PACKED_SCHEMA.split(", ")])
    # grows with tasks and lengths, and packs small in files: never broadcast
    ranked = pieces.join(bases.drop("count").hint("merge"), ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("base") + F.col("task_rank")).alias("rank"))
    return ranked.mapInArrow(run, PACKED_SCHEMA)
