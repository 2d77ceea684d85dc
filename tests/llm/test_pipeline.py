"""The corpus pipeline, stage by stage, against brute force."""
import importlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as C
from sessionkit.llm import language_id as L
from sessionkit.llm import quality
from sessionkit.llm.common import keep_rows
from sessionkit.llm.queries import vocabulary
from sessionkit.llm.simhash import fingerprints

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.orderBy("doc_id").limit(20)
    odd = spark.createDataFrame(
        [(90001, None, "en", "s", 0), (90002, "", "en", "s", 0), (90003, "12 34", "en", "s", 5),
         (None, "the and of the and. " * 9, None, None, None)], docs.schema)
    return docs.unionByName(odd).unionByName(
        first.withColumn("doc_id", F.col("doc_id") + 50000)).cache()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_language_stage(spark, documents):
    got = C.identify_language(spark, documents, SF)
    assert got.columns == documents.columns
    model = L.fit(documents.filter(~L.held_out("doc_id")), vocabulary("piece_bpe_32k.model"))
    lattices = L.Lattices(L.vocabulary(model.path))
    want = []
    for r in documents.collect():
        words = (r.text or "").split()
        if not any(c.isalpha() for c in r.text or ""):
            continue
        logs = sum(lattices.log_probs([L.WORD_MARK + w], model.probs)[0] for w in words)
        if 1 / np.exp(logs - logs.max()).sum() >= C.MIN_LANGUAGE_SCORE:
            want.append(tuple(r))
    assert rows(got) == sorted(want, key=str)
    assert len(want) >= documents.count() - 4


def test_language_stage_rejects_what_is_in_no_learned_language(spark, documents):
    strange = [(80001, "Жили были старик со старухой у самого синего моря. " * 5, None, "s", 1),
               (80002, "xq7#zz kvvw99 {}[]|| wqxz//zzq ~~pfxk 0x7fq " * 20, None, "s", 1),
               (80003, "nyt kuinka hyvää päivää jäänyt mökillä yötä vyöhykkeeltä " * 10, None, "s", 1)]
    mixed = documents.unionByName(spark.createDataFrame(strange, documents.schema))
    kept = {r.doc_id for r in C.identify_language(spark, mixed, SF).collect()}
    assert kept & {80001, 80002, 80003} <= {80003}
    assert kept >= {r.doc_id for r in documents.filter("doc_id < 80000").collect()}


def test_quality_stage(spark, documents):
    got = C.classify_quality(spark, documents, SF)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert got.columns == documents.columns
    kept = {r.doc_id for r in got.collect()}
    clean = [i for i, q in labels.items() if q == 1]
    assert np.mean([i in kept for i in clean]) >= 0.97
    assert np.mean([i not in kept for i, q in labels.items() if q == 0]) >= 0.8
    every = quality.score(documents, quality.fit(documents, spark.read.parquet(f"{SF}/labels.parquet")))
    assert sorted(str(r.doc_id) for r in every.collect() if r.accepted) \
        == sorted(str(r.doc_id) for r in got.collect())


def test_exact_stage(spark, documents):
    got = C.drop_exact_copies(spark, documents.unionByName(documents.filter("doc_id < 4")), SF)
    best = {}
    for r in documents.collect():
        key = r.text or ""
        if key not in best or (r.doc_id is not None and (best[key] is None or r.doc_id > best[key])):
            best[key] = r.doc_id
    assert sorted((str(r.doc_id), r.text or "") for r in got.collect()) \
        == sorted((str(i), t) for t, i in best.items())


def test_near_stage(spark, documents):
    docs = C.materialize(documents.dropDuplicates(["text"]))
    twice = docs.filter("doc_id is null or doc_id in (3, 90001)")
    got = C.drop_near_copies(spark, docs.unionByName(twice), SF)
    data = docs.collect()
    prints = fingerprints([(r.text or "").encode() for r in data]).tolist()
    group = list(range(len(data)))
    for _ in data:
        before = list(group)
        for i in range(len(data)):
            for j in range(i):
                if bin(prints[i] ^ prints[j]).count("1") <= 3:
                    group[i] = group[j] = min(group[i], group[j])
        if group == before:
            break
    best = {}
    for g, r in zip(group, data):
        if g not in best or (r.doc_id is not None and (best[g] is None or r.doc_id < best[g])):
            best[g] = r.doc_id
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(map(str, best.values()))


def test_near_copies_without_any_id(spark, documents):
    """Linked copies of different fingerprints, all without an id: one stays."""
    text = " ".join(f"word{i}" for i in range(299))
    base, near = fingerprints([text.encode()])[0], None
    for i in range(1, 400):  # a copy with one more word, within the radius but not equal
        cand = text + f" extra{i}"
        if 0 < bin(int(base) ^ int(fingerprints([cand.encode()])[0])).count("1") <= 3:
            near = cand
            break
    assert near
    docs = spark.createDataFrame([(None, text, "en", "s", 1), (None, near, "en", "s", 1),
                                  (None, near, "en", "s", 1), (None, "quite another text", "en", "s", 1)],
                                 documents.schema)
    got = [r.text for r in C.drop_near_copies(spark, docs, SF).collect()]
    assert len(got) == 2 and "quite another text" in got


def test_run_packs_what_the_stages_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in C.STAGES[:-1]:
        docs = C.materialize(stage(spark, docs, SF), name)
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = []
    for r in docs.collect():
        ids = np.array(tok.encode(r.text, add_special_tokens=False).ids + [0], dtype="<u4")
        want += [(r.doc_id, k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(ids[k:k + 2048].tobytes()))
                 for k in range(0, len(ids), 2048)]
    got = entry.queries()["pipeline"](spark, SF).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    for s in {r.sequence_id for r in got}:
        at = 0
        for o, n in sorted((r.offset, r.length) for r in got if r.sequence_id == s):
            assert o == at
            at += n
        assert at <= 2048


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in C.STAGES:
        docs = C.materialize(stage(spark, docs, SF), name)
        assert docs.count() == 0


def test_keep_rows_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a", 5), (1, "a", 5), (2, "b", 6), (None, "c", 7)],
                                 "doc_id bigint, text string, key int").withColumnRenamed("key", "wid")
    winners = docs.select("doc_id", F.xxhash64("text").alias("text_key")).filter(
        "doc_id is null or doc_id = 1")
    got = keep_rows(docs, winners, F.xxhash64("text"))
    assert got.columns == docs.columns and rows(got) == sorted([(1, "a", 5), (None, "c", 7)], key=str)


def test_entry_lists_the_queries():
    assert importlib.import_module("corpus_pipeline").run is entry.queries()["pipeline"]
    names = [q for q in entry.queries() if q.startswith("op")]
    assert sorted({int(q[2:].split("_")[0]) for q in names}) == list(range(1, 14))
