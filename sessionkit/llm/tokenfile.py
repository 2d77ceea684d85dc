"""Token-id files in Simple-8b word-aligned coding.

A file row holds one document: its ids as 64-bit words, little endian.  The
top 4 bits of a word select how many ids it packs and how wide each is; the
other 60 bits hold them, the first id lowest.  Selector 0 is the escape: an id
of more than 60 bits lies in the row's ``escapes`` and the word holds its
index.  No word crosses a block of ``BLOCK`` ids, and ``block_words`` gives the
word at which each block begins, so blocks decode on their own, all words of a
selector at once.

Files are range-partitioned by document and sorted inside, in ascending
doc_id order (equal doc_ids: by a hash of the text; nulls first).  Spark's
Parquet writer commits them, so a lost task leaves nothing behind.  ``start``
(ids of all documents before) is the total of the shards before plus the
position inside the shard, which the writing task counts as it goes.

Null texts count as empty (only the end id); repeated rows are written each;
extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .common import only
from .tokens import byte_encoder, text_groups

BLOCK = 4096
#: Ids a word packs, by selector (0 is the escape); each is 60 // count bits wide, 0 bits for 120.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
WIDTHS = np.where(COUNTS == 120, 0, 60 // COUNTS)
_SELECTOR = {int(c): s for s, c in enumerate(COUNTS) if s}
_HALVES = [(2, 1), (3, 2), (4, 2), (5, 4), (6, 3), (7, 4), (8, 4), (10, 5), (12, 6), (15, 8),
           (20, 10), (30, 15), (60, 30), (120, 60)]  # a window of n as a window of k and its rest


_SMALL_BITS = np.array([x.bit_length() for x in range(1 << 16)], dtype=np.uint8)


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits of each value, as bytes."""
    if not len(values) or values.max() < len(_SMALL_BITS):
        return _SMALL_BITS[values.astype(np.uint16)]
    bits = np.zeros(len(values), dtype=np.uint8)
    rest = values.copy()
    for k in (32, 16, 8, 4, 2, 1):
        big = rest >= np.uint64(1 << k)
        bits[big] += k
        rest[big] >>= np.uint64(k)
    return bits + (rest > 0)


def encode(values: np.ndarray, lengths: np.ndarray):
    """Words of the concatenated ``values`` of rows of ``lengths`` ids.

    Returns (words, words per row, escapes, escapes per row, first words of
    the blocks within their row, blocks per row)."""
    values = values.astype(np.uint64)
    n = len(values)
    row_end = np.cumsum(lengths)
    row_start = row_end - lengths
    n_blocks = -(-lengths // BLOCK)
    row_of_block = np.repeat(np.arange(len(lengths)), n_blocks)
    in_row = np.arange(len(row_of_block)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    block_start = row_start[row_of_block] + in_row * BLOCK
    block_end = np.minimum(block_start + BLOCK, row_end[row_of_block])
    room = np.full(n, 255, dtype=np.uint8)  # ids left in the block, as far as a word can ask
    for k in range(1, int(COUNTS.max())):
        at = block_end - k
        room[at[at >= block_start]] = k
    bits = _bit_lengths(values)
    take = np.ones(n, dtype=np.uint8)
    window = {1: bits}
    for count, k in _HALVES:
        if n < count:
            break
        a, b = window[k], window[count - k]
        w = np.maximum(a[:n - count + 1], b[k:k + n - count + 1])
        window[count] = w
        fit = w <= (0 if count == 120 else 60 // count)
        if not fit.any():
            break
        fit &= room[:n - count + 1] >= count
        take[:n - count + 1][fit] = count
    step = take.tobytes()
    first, i = [], 0
    while i < n:
        first.append(i)
        i += step[i]
    first = np.array(first, dtype=np.int64)
    taken = take[first]
    words = np.zeros(len(first), dtype=np.uint64)
    for count, selector in _SELECTOR.items():
        at = np.flatnonzero(taken == count)
        if not len(at):
            continue
        word = np.full(len(at), selector << 60, dtype=np.uint64)
        if WIDTHS[selector]:
            for j in range(count):
                word |= values[first[at] + j] << np.uint64(j * WIDTHS[selector])
        words[at] = word
    row_words = np.searchsorted(first, row_end) - np.searchsorted(first, row_start)
    over = np.flatnonzero((taken == 1) & (bits[first] > 60)) if n else np.zeros(0, np.int64)
    row_of = np.searchsorted(row_end, first[over], side="right")
    escapes_per_row = np.bincount(row_of, minlength=len(lengths))
    words[over] = np.arange(len(over)) - (np.cumsum(escapes_per_row) - escapes_per_row)[row_of]
    block_word = np.searchsorted(first, block_start) \
        - (np.cumsum(row_words) - row_words)[row_of_block]
    return words, row_words, values[first[over]], escapes_per_row, block_word, n_blocks


def decode(words: np.ndarray, row_words: np.ndarray, escapes: np.ndarray,
           escapes_per_row: np.ndarray) -> np.ndarray:
    """The concatenated ids of rows coded by ``encode``."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    count = COUNTS[selector]
    end = np.cumsum(count)
    out = np.zeros(int(end[-1]) if len(end) else 0, dtype=np.uint64)
    begin = end - count
    for s in np.unique(selector):
        at = np.flatnonzero(selector == s)
        if s == 0:
            row = np.searchsorted(np.cumsum(row_words), at, side="right")
            base = np.cumsum(escapes_per_row) - escapes_per_row
            out[begin[at]] = escapes[base[row] + words[at].astype(np.int64)]
        elif WIDTHS[s]:
            mask = np.uint64((1 << int(WIDTHS[s])) - 1)
            for j in range(COUNTS[s]):
                out[begin[at] + j] = (words[at] >> np.uint64(j * WIDTHS[s])) & mask
    return out


FILE_SCHEMA = ("shard int, start bigint, doc_id bigint, n_tokens bigint, words binary, "
               "escapes binary, block_words array<int>")
_NAMES = [x.split()[0] for x in FILE_SCHEMA.split(", ")]


def write_token_files(docs: DataFrame, out_path: str, tokenizer: str, end_id: int = 0,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id`` and write the files."""
    def run(batches):
        encoder, shard, start = byte_encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.uint32(end_id).astype("<u4").tobytes()
        for b in batches:
            doc_ids, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            for lo, hi in text_groups(texts):
                raw = [x + end for x in encoder.encode(texts[lo:hi])]
                n = np.array([len(x) // 4 for x in raw], dtype=np.int64)
                words, row_words, escapes, row_escapes, block_word, n_blocks = encode(
                    np.frombuffer(b"".join(raw), dtype="<u4"), n)
                starts = start + np.cumsum(n) - n
                start += int(n.sum())
                cut = [np.cumsum(x)[:-1] for x in (row_words, row_escapes, n_blocks)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(n), shard), pa.int32()), pa.array(starts, pa.int64()),
                    pa.array(doc_ids[lo:hi], pa.int64()), pa.array(n, pa.int64()),
                    pa.array([x.astype("<u8").tobytes() for x in np.split(words, cut[0])],
                             pa.binary()),
                    pa.array([x.astype("<u8").tobytes() for x in np.split(escapes, cut[1])],
                             pa.binary()),
                    pa.array(np.split(block_word.astype(np.int32), cut[2]),
                             pa.list_(pa.int32()))], names=_NAMES)
    ordered = (only(docs, doc_id=id_col, text=text_col)
               .withColumn("tie", F.xxhash64("text"))
               .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
               .select("doc_id", "text"))
    ordered.mapInArrow(run, FILE_SCHEMA).write.mode("overwrite") \
        .option("compression", "none").parquet(out_path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The file rows with ``start`` counted over all files."""
    rows = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = rows.groupBy("shard").agg(F.max(F.col("start") + F.col("n_tokens")).alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(totals.select(  # one row per shard, of known size
        "shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")), "shard-bases")
    return rows.join(bases, "shard").withColumn("start", F.col("base") + F.col("start")) \
        .select(*_NAMES)


DIGEST_SCHEMA = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Decode every document of the files: ``doc_id, start, n_tokens, ids_crc32``."""
    def run(batches):
        for b in batches:
            words = [np.frombuffer(x, dtype="<u8") for x in b.column("words").to_pylist()]
            escapes = [np.frombuffer(x, dtype="<u8") for x in b.column("escapes").to_pylist()]
            if not words:
                continue
            ids = decode(np.concatenate(words), np.array([len(x) for x in words]),
                         np.concatenate(escapes), np.array([len(x) for x in escapes]))
            raw = memoryview(ids.astype("<u4").tobytes())
            ends = np.cumsum(b.column("n_tokens").to_numpy()) * 4
            crc = [zlib.crc32(raw[a:z]) for a, z in zip([0, *ends[:-1].tolist()], ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("start"), b.column("n_tokens"),
                 pa.array(crc, pa.int64())], names=[x.split()[0] for x in DIGEST_SCHEMA.split(", ")])
    return read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", "words", "escapes").mapInArrow(run, DIGEST_SCHEMA)
