"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
A word's probability in a language is the sum, over all ways to cut it into
pieces, of the product of its pieces' probabilities (the forward algorithm);
a text's is the product over its words, as no piece crosses white space.  A
character that the vocabulary lacks is the piece ``unknown``.

*Learning* runs expectation-maximisation on the labelled rows given: expected
piece counts come from forward and backward sums in Spark tasks over the words
counted per language, are added up in Spark, and at most (languages x
vocabulary) numbers reach the driver.  Each language is learned from a sample
of about ``docs_per_language`` of its rows (rows are taken by a hash of their
id at the rate that gives this number), a documented bound.

*Prediction*: the language of greatest posterior under equal priors, and that
posterior as score.  Null texts and texts without a letter are ``und`` with
score 0; so is everything if nothing was learned.  The posterior only compares
the learned languages; whether a text is in its language at all is told by its
log-probability per character, held against the labelled rows (``with_floors``).
Whole texts are read;
repeated rows are predicted alike; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import WordCache, only, text_groups

WORD_MARK = "▁"
SMOOTHING = 0.05
DOCS_PER_LANGUAGE = 1000
ROUNDS = 3
UNDETERMINED = "und"
CACHED_WORDS = 100_000
ALLOWANCE = 30.0  # log-probability that a text may lose whatever its length: a few rare words
SLICE = 256  # texts that a worker holds as strings at once
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # odd, so that hashing keeps order apart


@lru_cache(maxsize=2)
def vocabulary(path: str) -> dict:
    """Piece -> number of the ordinary pieces of a sentencepiece model."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return {p: i for i, p in enumerate(dict.fromkeys(pieces))}


class Lattices:
    """Forward and backward sums of words over all their segmentations."""

    def __init__(self, pieces: dict):
        self.pieces = pieces
        self.unknown = len(pieces)
        self.none = len(pieces) + 1  # a column of probability 0
        self.longest = max(map(len, pieces), default=1)
        # pieces of each length as sorted 64-bit hashes, for whole arrays of spans at once
        self.tables: dict = {}
        for k in range(1, self.longest + 1):
            own = [p for p in pieces if len(p) == k]
            hashes = np.zeros(len(own), dtype=np.uint64)
            codes = self._codes(own, k)
            for j in range(k):
                hashes = hashes * MULTIPLIER + codes[:, j]
            order = np.argsort(hashes)
            assert len(np.unique(hashes)) == len(own)
            self.tables[k] = (np.append(hashes[order], np.uint64(0)), np.append(
                np.array([pieces[p] for p in own], dtype=np.int32)[order], np.int32(self.none)))

    @staticmethod
    def _codes(words: list, n: int) -> np.ndarray:
        """(word, position): the words' code points, plus one."""
        return np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(
            len(words), n).astype(np.uint64) + np.uint64(1)

    def spans(self, words: list, n: int) -> np.ndarray:
        """(word, end, k): the piece of k + 1 characters that ends there."""
        width = min(self.longest, n)
        out = np.full((len(words), n, width), self.none, dtype=np.int32)
        codes = self._codes(words, n)
        rolling = np.zeros_like(codes)  # of the span that begins there
        for k in range(1, width + 1):
            rolling = rolling[:, :n - k + 1] * MULTIPLIER + codes[:, k - 1:]
            hashes, ids = self.tables[k]
            at = np.searchsorted(hashes[:-1], rolling)
            found = np.where(hashes[at] == rolling, ids[at], self.none)
            out[:, k - 1:, k - 1] = found
        one = out[:, :, 0]
        one[one == self.none] = self.unknown
        return out

    def forward(self, spans: np.ndarray, probs: np.ndarray):
        """Scaled sums (word, position, language) and the log scale of each
        position; ``probs`` is (piece, language) with ``none`` at 0."""
        words, n, width = spans.shape
        alpha = np.zeros((words, n + 1, probs.shape[1]))
        scale = np.zeros((words, n + 1, probs.shape[1]))
        alpha[:, 0] = 1.0
        for end in range(1, n + 1):
            before = scale[:, end - 1]
            for k in range(1, min(width, end) + 1):
                part = alpha[:, end - k] * probs[spans[:, end - 1, k - 1]]
                if n > width:
                    part *= np.exp(scale[:, end - k] - before)
                alpha[:, end] += part
            if n > width:  # long words: every position is rescaled to 1
                scale[:, end] = before + np.log(alpha[:, end])
                alpha[:, end] = 1.0
        return alpha, scale

    def log_probs(self, words: list, probs: np.ndarray) -> np.ndarray:
        """(word, language) log-probabilities of marked words."""
        out = np.zeros((len(words), probs.shape[1]))
        by_length = defaultdict(list)
        for i, w in enumerate(words):
            by_length[len(w)].append(i)
        for n, at in by_length.items():
            step = max(1, 400_000 // (n * min(n, self.longest)))
            for a in range(0, len(at), step):
                part = at[a:a + step]
                alpha, scale = self.forward(self.spans([words[i] for i in part], n), probs)
                out[part] = np.log(alpha[:, -1]) + scale[:, -1]
        return out

    def expected(self, words: list, counts: np.ndarray, probs: np.ndarray, out: np.ndarray):
        """Add the expected piece counts of ``words`` of one language to ``out``."""
        by_length = defaultdict(list)
        for i, w in enumerate(words):
            by_length[len(w)].append(i)
        probs = probs[:, None]
        for n, at in by_length.items():
            step = max(1, 400_000 // (n * min(n, self.longest)))
            for a in range(0, len(at), step):
                part = at[a:a + step]
                spans = self.spans([words[i] for i in part], n)
                width = spans.shape[2]
                alpha, scale = self.forward(spans, probs)
                front = np.log(alpha[:, :, 0]) + scale[:, :, 0]
                back = np.full((len(part), n + 1), -np.inf)
                back[:, n] = 0.0
                logs = np.log(np.maximum(probs[:, 0], 1e-300))
                logs[self.none] = -np.inf
                for p in range(n - 1, -1, -1):
                    reach = range(1, min(width, n - p) + 1)
                    back[:, p] = np.logaddexp.reduce(
                        [logs[spans[:, p + k - 1, k - 1]] + back[:, p + k] for k in reach], axis=0)
                for p in range(n):
                    for k in range(1, min(width, n - p) + 1):
                        ids = spans[:, p + k - 1, k - 1]
                        share = np.exp(front[:, p] + logs[ids] + back[:, p + k] - front[:, n])
                        np.add.at(out, ids, share * counts[part])


class Model:
    """Languages, their piece probabilities, (piece, language), and the least
    fit of a text of each (none: any fit will do)."""

    def __init__(self, path: str, languages: list, probs: np.ndarray, floors: dict | None = None):
        self.path, self.languages, self.probs = path, languages, probs
        self.floors = floors or {}

    def parts(self):
        return self.path, self.languages, self.probs, self.floors

    def scorer(self):
        lattices = Lattices(vocabulary(self.path))
        return WordCache(lambda words: [
            row.tobytes() for row in lattices.log_probs([WORD_MARK + w for w in words], self.probs)],
            limit=CACHED_WORDS)

    def predict(self, texts: list, scorer):
        """(language, posterior, fit) of each text, in order; the fit is the
        log-probability per character, ``ALLOWANCE`` added."""
        n = len(self.languages)
        texts = [t or "" for t in texts]
        for a, b in text_groups(texts):
            words = [t.split() for t in texts[a:b]]
            get = scorer.lookup(words)
            for t, w in zip(texts[a:b], words):
                if not n or not any(map(str.isalpha, t)):
                    yield UNDETERMINED, 0.0, 0.0
                    continue
                total = np.frombuffer(b"".join(map(get, w))).reshape(-1, n).sum(axis=0)
                best = int(total.argmax())
                fit = (float(total[best]) + ALLOWANCE) / (sum(map(len, w)) + len(w))
                yield self.languages[best], float(1.0 / np.exp(total - total[best]).sum()), fit

    def accepts(self, lang: str, score: float, fit: float, min_score: float) -> bool:
        return lang != UNDETERMINED and score >= min_score and fit >= self.floors.get(lang, -np.inf)


def _word_counts(rows: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            counts = defaultdict(Counter)
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                counts[lang].update((text or "").split())
            flat = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in flat], t) for i, t in
                 enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "word", "n"])
    return rows.mapInArrow(run, "lang string, word string, n bigint") \
        .groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _labelled(rows: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """The rows with a language and a text."""
    return only(rows, doc_id=id_col, text=text_col, lang=lang_col) \
        .filter("lang is not null and text is not null")


def _sample(rows: DataFrame, docs_per_language: int):
    """The languages of labelled rows and the (lang, text) sample of each."""
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return [], rows.select("lang", "text")
    rate = F.create_map(*[F.lit(x) for lang in sorted(sizes)
                          for x in (lang, min(1.0, docs_per_language / sizes[lang]))])
    place = F.pmod(F.xxhash64(F.lit("language sample"), "doc_id"), F.lit(1_000_000)) / 1_000_000
    return sorted(sizes), rows.filter(place < F.element_at(rate, F.col("lang"))).select("lang", "text")


def fit(rows: DataFrame, path: str, docs_per_language: int = DOCS_PER_LANGUAGE,
        rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Model:
    """Learn from rows with a non-null language and text."""
    languages, sample = _sample(_labelled(rows, id_col, text_col, lang_col), docs_per_language)
    size = len(vocabulary(path)) + 2
    if not languages:
        return Model(path, [], np.zeros((size, 0)))
    counts = materialize(_word_counts(sample), "language-words")
    column = {lang: i for i, lang in enumerate(languages)}
    probs = np.full((size, len(languages)), 1.0 / (size - 1))
    probs[-1] = 0.0
    for _ in range(rounds):
        found = np.zeros_like(probs)
        for r in _expected_counts(counts, path, column, probs).collect():
            found[r["piece"], column[r["lang"]]] = r["n"]
        probs = (found + SMOOTHING) / (found.sum(axis=0) + SMOOTHING * (size - 1))
        probs[-1] = 0.0
    return Model(path, languages, probs)


def with_floors(model: Model, rows: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang") -> Model:
    """The model with a least fit per language: as far below the median of all
    labelled rows as twice the way to their worst row.  Only rows predicted as
    labelled count; a language without any has no floor."""
    labelled = _labelled(rows, id_col, text_col, lang_col).select("lang", "text")
    shared = rows.sparkSession.sparkContext.broadcast(model.parts())

    def run(batches):
        model = Model(*shared.value)
        scorer = model.scorer()
        for b in batches:
            for a in range(0, b.num_rows, SLICE):
                part = b.slice(a, SLICE)
                found = list(model.predict(part.column(1).to_pylist(), scorer))
                right = [(x[0], x[2]) for x, lang in zip(found, part.column(0).to_pylist())
                         if x[0] == lang]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in right], pa.string()),
                     pa.array([x[1] for x in right], pa.float64())], names=["lang", "fit"])
    if not model.languages:
        return model
    seen = labelled.mapInArrow(run, "lang string, fit double").groupBy("lang").agg(
        F.min("fit").alias("worst"), F.percentile_approx("fit", 0.5).alias("middle")).collect()
    return Model(model.path, model.languages, model.probs,
                 {r["lang"]: 2 * r["worst"] - r["middle"] for r in seen})


def _expected_counts(counts: DataFrame, path: str, column: dict, probs: np.ndarray) -> DataFrame:
    def run(batches):
        lattices = Lattices(vocabulary(path))
        sums: dict = {}
        for b in batches:
            langs = np.array(b.column(0).to_pylist(), dtype=object)
            words = b.column(1).to_pylist()
            n = b.column(2).to_numpy(zero_copy_only=False).astype(float)
            for lang in set(langs.tolist()):
                at = np.flatnonzero(langs == lang)
                out = sums.setdefault(lang, np.zeros(len(probs)))
                lattices.expected([WORD_MARK + words[i] for i in at], n[at],
                                  probs[:, column[lang]], out)
        for lang, out in sums.items():
            ids = np.flatnonzero(out[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(ids), pa.string()), pa.array(ids, pa.int32()),
                 pa.array(out[ids])], names=["lang", "piece", "n"])
    return counts.mapInArrow(run, "lang string, piece int, n double") \
        .groupBy("lang", "piece").agg(F.sum("n").alias("n"))


PREDICTED_SCHEMA = "doc_id bigint, lang_pred string, score double"


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model.parts())

    def run(batches):
        own = Model(*shared.value)
        scorer = own.scorer()
        for b in batches:
            texts = b.column("text")
            found = [x for a in range(0, len(texts), SLICE)
                     for x in own.predict(texts.slice(a, SLICE).to_pylist(), scorer)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([x[0] for x in found], pa.string()),
                 pa.array([x[1] for x in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"])
    return only(docs, doc_id=id_col, text=text_col).mapInArrow(run, PREDICTED_SCHEMA)


def identified(docs: DataFrame, model: Model, min_score: float = 0.0,
               text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a determined language, at least that score and
    at least the fit the model asks for, unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model.parts())

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(*shared.value)
        scorer = own.scorer()
        for texts in batches:
            keep: list = []
            for a in range(0, len(texts), SLICE):
                keep += [own.accepts(*found, min_score) for found in
                         own.predict(texts.slice(a, SLICE).to_pylist(), scorer)]
            yield pa.array(keep, pa.bool_())
    # only texts go to the Python workers, and one flag a row comes back
    return docs.filter(F.arrow_udf(run, "boolean")(F.col(f"`{text_col}`")))


def held_out(doc_id):
    """The rows never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
