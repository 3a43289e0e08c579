"""Toxicity as an expected severity grade, by cumulative-link ordinal regression.

A document has one of the grades 0 (clean) to `GRADES`. One weight for each text feature is shared by
all thresholds: P(grade > k) is the logistic of the document's score less threshold k, and thresholds
rise. The expected severity is the sum of these probabilities.

Features are words and their beginnings. Of the labelled documents at most `SAMPLE` are used, those
with the smallest hash of their id; tasks count in how many toxic and clean ones a feature occurs,
and features that speak for toxicity beyond doubt are kept, all of them: each is in `LEAST_DOCUMENTS`
toxic documents of the sample or more, so the sample bounds them. Labels only say
toxic or not: a toxic document's grade is the third of toxic training documents, ordered by how many
of its words have such features, that it falls in. Fitting is on the driver, over the kept features of
the sample. All documents are scored, whole, by a table of weights that is sent to the tasks.

Defined results: null counts as the empty text, which has only the score 0; labels of documents that
do not exist and labels without a grade are not used; without a toxic or without a clean label
nothing is learnt, and all documents have score 0 and severity 0; where no feature is kept all
documents have score 0; every row, repeated or not, is scored by itself; an empty table of documents
gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: grades above clean
GRADES = 3
#: labelled documents that are used for fitting
SAMPLE = 20_000
#: thresholds of a model without labels of both kinds: no score passes them
NOTHING_LEARNT = (float("inf"),)
#: a feature is kept from so many toxic documents, so many standard deviations of their number above
#: what chance gives, and such odds
LEAST_DOCUMENTS, LEAST_ERRORS, LEAST_LOG_ODDS = 4, 6.0, 2.0
BEGINNINGS = range(4, 9)
#: words a task remembers
CACHED_WORDS = 500_000
_WORD = re.compile(r"[^\W\d_]+")
_PIECE = 1 << 20


def word_counts(text: str) -> Counter[str]:
    """Lower-case words; a text is read piece by piece, parted at white space."""
    counts: Counter[str] = Counter()
    start = 0
    while start < len(text):
        end = start + _PIECE
        while end < len(text) and not text[end].isspace():
            end += 1
        counts.update(_WORD.findall(text[start:end].lower()))
        start = end
    return counts


def word_features(word: str) -> list[str]:
    """The word, marked by its end, and its beginnings."""
    return [word + "$", *(word[:n] for n in BEGINNINGS if n <= len(word))]


@dataclass(frozen=True)
class Severity:
    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def score(self, text: str | None, known: dict[str, tuple[str, ...]] | None = None) -> float:
        """`known` remembers the words' weighted features from call to call."""
        known = {} if known is None else known
        total = 0.0
        tally: Counter[str] = Counter()
        for word, n in word_counts(text or "").items():
            own = known.get(word)
            if own is None:
                own = known[word] = tuple(f for f in word_features(word) if f in self.weights)
            for feature in own:
                tally[feature] += n
        for feature, n in tally.items():
            total += self.weights[feature] * np.log1p(n)
        return total

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score and threshold."""
        return 1 / (1 + np.exp(np.array(self.thresholds)[None, :] - scores[:, None]))


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """_id, text and toxic (0 or 1) of the sample, whatever other columns there are."""
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text"))
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
    marked = known.where(F.col("_label").isNotNull() & F.col("_id").isNotNull()).groupBy("_id")
    sample = marked.agg(F.max((F.col("_label") > 0).cast("int")).alias("toxic")).orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE)
    # at most SAMPLE rows
    return texts.join(F.broadcast(sample), F.col("_doc") == F.col("_id")).select("_id", "text", "toxic")


def _feature_counts(sample: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                counts[toxic].update({f for w in word_counts(text.as_py() or "") for f in word_features(w)})
        # only features of toxic documents can be kept, but clean ones of other tasks count against them
        for toxic in (0, 1):
            names = list(counts[toxic])
            columns = [pa.array(names, pa.string()), pa.array([toxic] * len(names), pa.int32()), pa.array([counts[toxic][n] for n in names], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["feature", "toxic", "n"])

    parts = sample.select("text", "toxic").mapInArrow(run, "feature string, toxic int, n bigint")
    return parts.groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean"),
    )


def kept_features(sample: DataFrame, toxic: int, clean: int) -> list[str]:
    odds = F.log((F.col("toxic") + 0.5) / (toxic - F.col("toxic") + 0.5)) - F.log((F.col("clean") + 0.5) / (clean - F.col("clean") + 0.5))
    rate = toxic / (toxic + clean)
    by_chance = (F.col("toxic") + F.col("clean")) * rate
    errors = (F.col("toxic") - by_chance) / F.sqrt(by_chance * (1 - rate))
    counted = _feature_counts(sample).where(F.col("toxic") >= LEAST_DOCUMENTS)
    told = counted.select("feature", odds.alias("odds"), errors.alias("errors"))
    told = told.where((F.col("odds") >= LEAST_LOG_ODDS) & (F.col("errors") >= LEAST_ERRORS))
    return [r["feature"] for r in told.orderBy(F.col("errors").desc(), "feature").collect()]


def fitted(x: list[dict[int, float]], grade: np.ndarray, features: int, steps: int = 400, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by gradient steps of adaptive size over the whole sample."""
    row = np.repeat(np.arange(len(x)), [len(d) for d in x])
    col = np.array([c for d in x for c in d], np.int64)
    value = np.array([v for d in x for v in d.values()], float)
    top = int(grade.max())
    # thresholds are a first one and the logarithms of the steps between them
    p = np.concatenate([np.zeros(features), [1.0], np.zeros(top - 1)])
    m, v = np.zeros_like(p), np.zeros_like(p)
    over = (grade[:, None] > np.arange(top)[None, :]).astype(float)
    for step in range(1, steps + 1):
        w, first, gaps = p[:features], p[features], np.exp(p[features + 1 :])
        theta = first + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(row, w[col] * value, minlength=len(x))
        edge = np.clip(score[:, None] - theta[None, :], -30, 30)
        above = 1 / (1 + np.exp(-edge))
        bounded = np.concatenate([np.ones((len(x), 1)), above, np.zeros((len(x), 1))], axis=1)
        at = np.arange(len(x))
        lower, upper = bounded[at, grade], bounded[at, grade + 1]
        chance = np.maximum(lower - upper, 1e-9)
        slope = bounded * (1 - bounded)
        # d log chance / d score and / d thresholds
        by_lower, by_upper = slope[at, grade] / chance, slope[at, grade + 1] / chance
        on_score = -(by_lower - by_upper) / len(x)
        on_theta = np.zeros(top)
        np.add.at(on_theta, grade[grade > 0] - 1, by_lower[grade > 0] / len(x))
        np.add.at(on_theta, grade[grade < top], -by_upper[grade < top] / len(x))
        tail = np.cumsum(on_theta[::-1])[::-1]
        slope_p = np.concatenate([np.bincount(col, on_score[row] * value, minlength=features) + ridge * w, [tail[0]], tail[1:] * gaps])
        m, v = 0.9 * m + 0.1 * slope_p, 0.99 * v + 0.01 * slope_p**2
        p = p - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    theta = p[features] + np.concatenate([[0.0], np.cumsum(np.exp(p[features + 1 :]))])
    return p[:features], theta


def trained(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Severity:
    sample = labelled(docs, labels, id_col, text_col, label_col)
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Severity({}, NOTHING_LEARNT)
    names = kept_features(sample, sizes[1], sizes[0])
    number = {f: i for i, f in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            feature, value, hits = [], [], []
            for text in batch.column(0):
                tally: Counter[int] = Counter()
                hit = 0
                for word, n in word_counts(text.as_py() or "").items():
                    own = [number[f] for f in word_features(word) if f in number]
                    tally.update({f: n for f in own})
                    hit += n * bool(own)
                feature.append(list(tally))
                value.append([float(np.log1p(n)) for n in tally.values()])
                hits.append(hit)
            columns = [pa.array(feature, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float64())), pa.array(hits, pa.int64()), batch.column(1)]
            yield pa.RecordBatch.from_arrays(columns, names=["feature", "value", "hits", "toxic"])

    held = sample.select("text", "toxic").mapInArrow(run, "feature array<int>, value array<double>, hits bigint, toxic int").collect()
    hits = np.array([r["hits"] for r in held])
    toxic = np.array([r["toxic"] for r in held]) == 1
    bounds = np.quantile(hits[toxic], np.arange(1, GRADES) / GRADES)
    grade = np.where(toxic, 1 + (hits[:, None] > bounds[None, :]).sum(axis=1), 0)
    rank = {g: i for i, g in enumerate(sorted(set(grade.tolist())))}
    grade = np.array([rank[g] for g in grade.tolist()])
    weights, theta = fitted([dict(zip(r["feature"], r["value"])) for r in held], grade, len(names))
    return Severity({f: float(weights[i]) for f, i in number.items()}, tuple(theta.tolist()))


def severity(docs: DataFrame, model: Severity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: id, score, expected_severity (0 to the top grade), grade (the
    likeliest reached: thresholds passed with probability one half) and toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    picked = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    kind = picked.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = shared.value, {}
        for batch in batches:
            scores = np.array([held.score(t.as_py(), known) for t in batch.column(1)], float)
            if len(known) > CACHED_WORDS:
                known = {}
            above = held.above(scores)
            columns = [batch.column(0), pa.array(scores), pa.array(above.sum(axis=1)), pa.array((above >= 0.5).sum(axis=1).astype(np.int32)), pa.array(above[:, 0] >= 0.5)]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "score", "expected_severity", "grade", "toxic"])

    return picked.mapInArrow(run, f"`{id_col}` {kind}, score double, expected_severity double, grade int, toxic boolean")
