"""Ordinal quality classifier: cumulative-link regression on hashed text features.

Grades are ordered. One weight vector over hashed words and text measures is shared by all grades;
ordered thresholds cut its score: P(grade >= j) = sigmoid(score - threshold_j). The model gives the
expected grade and the probability of at least a wanted grade.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gamepulse.llm.common import blocks, small_batches, written
from gamepulse.llm.hashing import LOWER, mix, span_hashes, text_bytes, word_spans

BUCKETS = 1 << 20
#: Words are runs of ASCII letters and bytes above 0x7F.
LETTER = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])
_CLASSES = {
    "upper": np.array([65 <= b <= 90 for b in range(256)]), "digit": np.array([48 <= b <= 57 for b in range(256)]),
    "mark": np.array([33 <= b <= 47 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 126 for b in range(256)]),
    "line": np.arange(256) == 10,
}


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) pairs, distinct: the words of every text, and binned measures of its form."""
    data, offsets = text_bytes(texts)
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, ~LETTER)
    n = len(offsets) - 1
    hashes = span_hashes(low, starts, ends)
    size = np.maximum(np.diff(offsets), 1)
    words = np.diff(first)
    owner = np.repeat(np.arange(n), words)
    letters = np.concatenate([[0], np.cumsum(LETTER[data])])
    letters = np.maximum(letters[offsets[1:]] - letters[offsets[:-1]], 1)
    measures = []
    for kind in _CLASSES.values():
        sums = np.concatenate([[0], np.cumsum(kind[data])])
        measures.append((sums[offsets[1:]] - sums[offsets[:-1]]) / size)
    measures[0] = measures[0] * size / letters
    pairs = np.unique(owner.astype(np.uint64) << np.uint64(20) | (hashes & np.uint64(BUCKETS - 1)))
    distinct = np.bincount((pairs >> np.uint64(20)).astype(np.int64), minlength=n)
    measures += [distinct / np.maximum(words, 1), np.minimum(letters / np.maximum(words, 1) / 20, 1)]
    text, bucket = (pairs >> np.uint64(20)).astype(np.int64), (pairs & np.uint64(BUCKETS - 1)).astype(np.int64)
    for k, m in enumerate(measures):  # each measure is one of 21 hashed indicators
        bins = mix((np.minimum(m, 1) * 20).astype(np.uint64) + np.uint64(1000 * (k + 1))) & np.uint64(BUCKETS - 1)
        text, bucket = np.concatenate([text, np.arange(n)]), np.concatenate([bucket, bins.astype(np.int64)])
    return text, bucket


@dataclass
class OrdinalModel:
    buckets: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, …, one row per score."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -40, 40)))


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, grades: np.ndarray, n_features: int, n_grades: int, steps: int, ridge: float):
    """Weights and ordered thresholds by gradient descent with Adam steps on the log-likelihood."""
    n = len(grades)
    share = np.array([(grades >= j).mean() for j in range(1, n_grades)]).clip(1e-3, 1 - 1e-3)
    theta = -np.log(share / (1 - share))
    params = np.concatenate([np.zeros(n_features), [theta[0]], np.log(np.maximum(np.diff(theta), 1e-2))])
    first, second = np.zeros_like(params), np.zeros_like(params)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    for t in range(1, steps + 1):
        w = params[:n_features]
        gaps = np.exp(params[n_features + 1:])
        theta = params[n_features] + np.concatenate([[0], np.cumsum(gaps)])
        score = np.bincount(rows, w[cols], minlength=n)
        cut = np.concatenate([[-np.inf], theta, [np.inf]])
        upper, lower = sigmoid(cut[grades + 1] - score), sigmoid(cut[grades] - score)
        upper[grades == n_grades - 1], lower[grades == 0] = 1.0, 0.0
        p = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p  # of log p by its two cuts
        g = np.zeros_like(params)
        g[:n_features] = np.bincount(cols, (dl - du)[rows], minlength=n_features) / n - ridge * w
        by_cut = np.bincount(grades, du, minlength=n_grades)[:n_grades - 1] - np.bincount(grades, dl, minlength=n_grades)[1:]
        by_cut /= n
        g[n_features] = by_cut.sum()
        g[n_features + 1:] = np.cumsum(by_cut[::-1])[::-1][1:] * gaps
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        params += 0.05 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-9)
    theta = params[n_features] + np.concatenate([[0], np.cumsum(np.exp(params[n_features + 1:]))])
    return params[:n_features], theta


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "text", 2 << 20):
        text, bucket = features(block.column("text"))
        order = np.argsort(text, kind="stable")
        spots = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=block.num_rows))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [block.column("grade"), pa.ListArray.from_arrays(pa.array(spots), pa.array(bucket[order].astype(np.int32)))], names=["grade", "buckets"])


def learn_quality(
    graded: DataFrame, n_grades: int, max_rows: int = 16384, max_features: int = 8192, min_rows: int = 5, min_z: float = 4.5,
    steps: int = 400, ridge: float = 1e-4,
) -> OrdinalModel:
    """Fits on rows (id, text, grade), grades 0 … n_grades - 1.

    About `max_rows` rows are used: all, or those with the smallest hash of their id. Buckets in at
    least `min_rows` of them with some grade `min_z` standard errors from its share, the
    `max_features` strongest, get a weight. So what reaches the driver is bounded by
    max_rows * max_features bits, and is a few numbers per row in practice. Rows without grade are
    left out. Without two different grades the model has no weights.
    """
    graded = graded.filter(F.col("grade").isNotNull())
    total = graded.count()
    share = min(1.0, max_rows / max(total, 1))
    sample = graded.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else graded
    rows = written(sample.select("text", F.col("grade").cast("int").alias("grade")).mapInArrow(_sample_features, "grade int, buckets array<int>"), "quality-sample")
    counts = {r["grade"]: r["count"] for r in rows.groupBy("grade").count().collect()}
    if len(counts) < 2:
        return OrdinalModel(np.zeros(0, np.int64), np.zeros(0), np.arange(n_grades - 1.0))
    n_rows = sum(counts.values())
    shares = {g: c / n_rows for g, c in counts.items()}
    errors = [F.abs(F.count_if(F.col("grade") == g) - F.count("*") * p) / F.sqrt(F.count("*") * p * (1 - p)) for g, p in shares.items()]
    picked = (
        rows.select("grade", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"), F.greatest(*errors).alias("z"))
        .filter((F.col("n") >= min_rows) & (F.col("z") >= min_z))
        .orderBy(F.col("z").desc(), "bucket").limit(max_features).select("bucket").collect()
    )
    buckets = np.sort(np.array([r["bucket"] for r in picked], np.int64))
    wanted = F.array(*[F.lit(int(b)) for b in buckets]) if len(buckets) else F.expr("cast(array() as array<int>)")
    design = rows.select("grade", F.array_intersect("buckets", wanted).alias("b")).collect()
    grades = np.array([r["grade"] for r in design])
    lengths = [len(r["b"]) for r in design]
    cols = np.searchsorted(buckets, np.array([b for r in design for b in r["b"]], np.int64))
    weights, thresholds = fit_ordinal(np.repeat(np.arange(len(design)), lengths), cols, grades, len(buckets), n_grades, steps, ridge)
    return OrdinalModel(buckets, weights, thresholds)


def score_quality(docs: DataFrame, model: OrdinalModel, select_grade: int, select_at: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs with expected_grade, tail_prob and keep.

    tail_prob is P(grade >= select_grade), keep is tail_prob >= select_at. Null and empty texts have
    no words and are judged by their form alone. Rows are judged one by one; input columns named
    like the three new ones, in any case, are replaced.
    """
    new = ["expected_grade", "tail_prob", "keep"]
    names = [c for c in docs.columns if c.lower() not in new]
    rows = small_batches(docs).select(*[f"`{c}`" for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(BUCKETS, np.float64)
        table[model.buckets] = model.weights
        for block in blocks(batches, text_col, 2 << 20):
            text, bucket = features(block.column(text_col))
            tails = model.tails(np.bincount(text, table[bucket], minlength=block.num_rows))
            at = tails[:, select_grade - 1]
            yield pa.RecordBatch.from_arrays(
                [block.column(c) for c in names] + [pa.array(tails.sum(axis=1)), pa.array(at), pa.array(at >= select_at)], names=names + new)

    schema = StructType([*rows.schema.fields]).add("expected_grade", "double").add("tail_prob", "double").add("keep", "boolean")
    return rows.mapInArrow(run, schema)


def graded_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, text, grade): 0 toxic, 1 of low quality, 2 neither; the lowest of several labels counts."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(F.min(grade).alias("grade")).filter(F.col("grade").isNotNull())
    return docs.select(F.col("doc_id").alias("id"), "text").join(marks, "id")
