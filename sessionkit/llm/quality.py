"""Quality classifier by co-training two views of a page.

*Views.*  The text view sees measures of the whole text (``TEXT_FEATURES``).
The metadata view sees what the table says about the page: source, language
and stated length.  Neither sees the other's.

*Co-training.*  Both classifiers (logistic regressions) start from the
labelled rows.  In each round either one scores all rows whose label it has not
learned from (without one, or beyond the labelled sample) and hands those it is
most confident about to the other as pseudo-labels: the ``share`` of them with
the greatest odds of either class, split as the labels are, as far as its
calibrated odds make them ``lift`` times less likely to be wrong than that class
is as a mere guess; so a view that knows nothing hands over nothing.  Both are then fitted
again.  The labelled sample has about ``max_labelled`` rows, taken by a hash of
the id (a documented bound); the pool is the whole rest and grows with it.
``exchanged`` of the model tells how many of either class each view handed over.

*Combination.*  A fifth of the labelled rows is never used for fitting; on it
each view's log-odds are calibrated (Platt scaling) before every exchange and
at the end, and the combined log-odds
of a row are the sum of both calibrated views' less the log-odds of the base
rate, which both contain.

The measures of all rows are written as narrow tables (a few numbers a row) for
the fits; texts are read once more in the final scoring.  Null texts count as empty and score like any
other; null metadata counts as absent.  Labels of either class missing: every
row gets the base rate of the labels there are (0.5 without any), and views
equal to it.  Repeated rows score alike; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import FeatureHasher
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import only

TEXT_FEATURES = [
    "log_words", "mean_word", "word_spread", "distinct_share", "top_share", "repeat_share",
    "letters", "digits", "stops", "symbols", "non_ascii", "upper", "char_runs", "symbol_runs",
    "short_share", "line_words", "line_repeats", "stop_rate"]
MAX_LABELLED = 20_000
ROUNDS = 2
SHARE = 0.05  # of the pool, handed over per view and round
LIFT = 5.0  # a pseudo-label is wrong this many times less often than its class as a guess
SCALE = 1_000_000
SLICE = 256  # texts that a worker holds as strings at once

_CLASS = np.zeros((256, 8))  # letters, digits, stops, symbols, non-ascii, upper, white, other
for _c in range(256):
    _ch = chr(_c)
    _CLASS[_c, 4 if _c >= 128 else 0 if _ch.isalpha() else 1 if _ch.isdigit() else
           2 if _ch in ".,;:!?'\"()-" else 6 if _ch.isspace() else 3 if 32 < _c < 127 else 7] = 1
    if "A" <= _ch <= "Z":
        _CLASS[_c, 5] = 1
_SYMBOL = _CLASS[:, 3] > 0


def text_features(text: str | None) -> list:
    """The measures of a whole text, in the order of ``TEXT_FEATURES``."""
    text = text or ""
    words = text.split()
    raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    n, size = len(words), max(len(raw), 1)
    lengths = np.fromiter(map(len, words), dtype=np.int32, count=n) if n else np.zeros(1)
    counts = Counter(words)
    shares = np.bincount(raw, minlength=256) @ _CLASS / size
    same = raw[1:] == raw[:-1]
    lines = [x for x in text.split("\n") if x]
    ends = counts_of_ends(text, n)
    return [
        float(np.log1p(n)), min(float(lengths.mean()), 50.0), min(float(lengths.std()), 50.0),
        len(counts) / max(n, 1), max(counts.values(), default=0) / max(n, 1),
        sum(map(str.__eq__, words, words[1:])) / max(n, 1),
        shares[0], shares[1], shares[2], shares[3], shares[4], shares[5],
        float(same.sum()) / size, float((same & _SYMBOL[raw[1:]]).sum()) / size,
        float((lengths <= 2).mean()) if n else 0.0, float(np.log1p(n / max(len(lines), 1))),
        1.0 - len(set(lines)) / max(len(lines), 1), ends]


def counts_of_ends(text: str, words: int) -> float:
    """Sentence ends per word."""
    return (text.count(". ") + text.count(".\n") + text.endswith(".")) / max(words, 1)


def with_features(rows: DataFrame) -> DataFrame:
    """``rows`` (with a ``text`` column) and their ``text_view`` in its place.
    Only texts go to the Python workers, a few at a time, and only numbers come
    back."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        n = len(TEXT_FEATURES)
        for texts in batches:
            features = np.empty((len(texts), n), dtype=np.float32)
            for a in range(0, len(texts), SLICE):
                for i, t in enumerate(texts.slice(a, SLICE).to_pylist(), a):
                    features[i] = text_features(t)
            yield pa.ListArray.from_arrays(
                pa.array(np.arange(0, features.size + 1, n), pa.int32()), pa.array(features.ravel()))
    view = F.arrow_udf(run, "array<float>")
    return rows.withColumn("text_view", view("text")).drop("text")


def view_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 source_col: str = "source", lang_col: str = "lang",
                 length_col: str = "n_chars", carry: bool = False) -> DataFrame:
    """doc_id, source, lang, log_chars and text; ``carry`` adds all columns of
    ``docs`` as c0, c1, ..."""
    col = lambda c: F.col(f"`{c}`")
    return docs.select(
        col(id_col).alias("doc_id"), col(source_col).cast("string").alias("source"),
        col(lang_col).cast("string").alias("lang"),
        F.coalesce(F.log1p(F.greatest(col(length_col).cast("double"), F.lit(0.0))),
                   F.lit(0.0)).alias("log_chars"), col(text_col).alias("text"),
        *[col(c).alias(f"c{i}") for i, c in enumerate(docs.columns) if carry])


def _with_views(rows: DataFrame) -> DataFrame:
    hashed = FeatureHasher(inputCols=["source", "lang", "log_chars"], outputCol="meta",
                           numFeatures=256).transform(rows)
    return hashed.withColumn("content", array_to_vector(F.col("text_view").cast("array<double>")))


def _fit(rows: DataFrame, view: str):
    return LogisticRegression(featuresCol=view, labelCol="label", regParam=0.001, maxIter=30,
                              probabilityCol="p", rawPredictionCol="raw",
                              predictionCol="hard").fit(rows)


def _odds(rows: DataFrame, model, name: str) -> DataFrame:
    out = model.transform(rows)
    return out.withColumn(name, vector_to_array("raw")[1]).drop("raw", "p", "hard")


def _platt(rows: DataFrame, name: str):
    """(slope, intercept) of the label's log-odds on ``name``."""
    model = LogisticRegression(featuresCol="x", labelCol="label", maxIter=30, regParam=1e-6).fit(
        rows.select("label", array_to_vector(F.array(name)).alias("x")))
    return float(model.coefficients[0]), float(model.intercept)


def _hash(name: str):
    return F.pmod(F.xxhash64(F.lit(name), "doc_id"), F.lit(SCALE))


class CoTrained:
    """Both views' classifiers with their calibration, or only a base rate."""

    def __init__(self, base, content=None, meta=None, content_scale=None, meta_scale=None,
                 exchanged=()):
        self.base, self.content, self.meta, self.exchanged = base, content, meta, exchanged
        self.content_scale, self.meta_scale = content_scale, meta_scale

    def apply(self, rows: DataFrame) -> DataFrame:
        """``rows`` with text_score, meta_score, score and accepted in place of
        the columns of the views."""
        kept = [c for c in rows.columns if c not in ("source", "lang", "log_chars", "text")]
        if self.content is None:
            return rows.select(*kept, *[F.lit(self.base).alias(c)
                                        for c in ("text_score", "meta_score", "score")],
                               F.lit(self.base >= 0.5).alias("accepted"))
        odds = _odds(_odds(_with_views(with_features(rows)), self.content, "content_odds"),
                     self.meta, "meta_odds")
        x = F.col("content_odds") * self.content_scale[0] + self.content_scale[1]
        y = F.col("meta_odds") * self.meta_scale[0] + self.meta_scale[1]
        both = x + y - float(np.log(self.base / (1 - self.base)))
        chance = lambda z: 1.0 / (1.0 + F.exp(-z))
        return odds.select(*kept, chance(x).alias("text_score"), chance(y).alias("meta_score"),
                           chance(both).alias("score")) \
            .withColumn("accepted", F.col("score") >= 0.5)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality",
        max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS, share: float = SHARE,
        lift: float = LIFT, **columns) -> CoTrained:
    """``labels`` has doc_id and a 0/1 label; of repeated labels of a document
    the largest counts."""
    rows = view_columns(docs, **columns)
    marked = only(labels, doc_id="doc_id", label=label_col) \
        .filter("doc_id is not null and label in (0, 1)")
    rate = min(1.0, max_labelled / max(marked.count(), 1)) * SCALE
    chosen = marked.filter(_hash("quality labels") < rate).groupBy("doc_id") \
        .agg(F.max("label").cast("double").alias("label"))  # about max_labelled rows
    known = materialize(with_features(rows.join(F.broadcast(chosen), "doc_id")),
                        "quality-labelled")
    classes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(classes) < 2:
        return CoTrained(float(next(iter(classes), 0.5)))
    known = _with_views(known).select("doc_id", "label", "content", "meta")
    held = _hash("quality calibration") % 5 == 0
    both = [{r["label"] for r in known.filter(c).select("label").distinct().collect()}
            for c in (held, ~held)]
    if all(len(x) == 2 for x in both):
        train, check = known.filter(~held), known.filter(held)
    else:  # too few labels to spare any
        train = check = known
    others = rows.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_anti")
    pool = _with_views(materialize(with_features(others), "quality-pool")).select("content", "meta")
    content, meta = _fit(train, "content"), _fit(train, "meta")
    own = train.select("label", "content", "meta")
    good, exchanged = classes[1.0] / (classes[0.0] + classes[1.0]), []
    up, down = (float(np.log(sure / (1 - sure))) * sign for sure, sign in
                ((1 - (1 - good) / lift, 1), (1 - good / lift, -1)))
    def checked():
        """Both views' calibrations, (slope, intercept), on the rows kept for that."""
        odds = materialize(_odds(_odds(check, content, "content_odds"), meta, "meta_odds").select(
            "label", "content_odds", "meta_odds"), "quality-check")
        return {name: _platt(odds, name) for name in ("content_odds", "meta_odds")}

    for turn in range(rounds):
        scales = checked()
        judged = _odds(_odds(pool, content, "content_odds"), meta, "meta_odds")
        for name, (slope, shift) in scales.items():  # a view's own certainty is not taken on trust
            judged = judged.withColumn(name, F.col(name) * max(slope, 0.0) + shift)
        judged = materialize(judged, "judged")
        sure = {}
        for name in ("content_odds", "meta_odds"):
            low, high = judged.approxQuantile(
                name, [share * (1 - good), 1 - share * good], 0.001) or (0.0, 0.0)
            odds = F.col(name)
            sure[name] = judged.filter((odds >= max(high, up)) | (odds <= min(low, down))).select(
                (odds > 0).cast("double").alias("label"), "content", "meta")
            exchanged.append((turn, name, {int(r["label"]): r["count"] for r in
                                           sure[name].groupBy("label").count().collect()}))
        content, meta = (_fit(own.unionByName(sure["meta_odds"]), "content"),
                         _fit(own.unionByName(sure["content_odds"]), "meta"))
    scales = checked()
    return CoTrained(good, content, meta, scales["content_odds"], scales["meta_odds"], exchanged)


def score(docs: DataFrame, model: CoTrained, **columns) -> DataFrame:
    """Per row: doc_id, text_score, meta_score, score and accepted (score at
    least 0.5)."""
    return model.apply(view_columns(docs, **columns))


def accepted(docs: DataFrame, model: CoTrained, **columns) -> DataFrame:
    """The rows of ``docs`` that the model accepts, unchanged."""
    judged = model.apply(view_columns(docs, carry=True, **columns)).filter("accepted")
    return judged.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
