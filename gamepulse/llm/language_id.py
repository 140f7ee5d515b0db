"""Language identification with hyperdimensional profiles.

Every letter, of any script, has a random vector of +1 and -1 from a hash of its code point. A run of three letters is the product (binding) of
its letters' vectors, each permuted by its place in the run; a text is the sum (bundling) of its
runs. A language prototype bundles all texts of a language. The prediction is the prototype
with the largest cosine.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gamepulse.llm.common import blocks, small_batches
from gamepulse.llm.hashing import U64, mix

GAP = 0  # the symbol of everything between words
POINTS = 0x110000
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter: one table of 1.1 MB per process."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(i).isalpha() for i in range(POINTS)]))
    return _LETTERS[0]


def sign_bits(points: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """The random vector of every code point as bits (set: -1), from a seeded hash: one row of 64-bit words each."""
    word = mix(np.arange(dimensions // 64, dtype=U64) + U64((seed + 1) << 32))
    return mix(mix(points.astype(U64))[:, None] + word[None, :])


class LetterRuns:
    """All three-letter runs of a block of texts, and the vectors of its letters.

    Runs are numbered by the block's own different letters, so that nothing is shared or kept between blocks.
    `spans` holds the first run of every text and the one after its last.
    """

    def __init__(self, texts: pa.Array):
        strings = [t.lower() for t in texts.fill_null("").to_pylist()]
        sizes = np.array([len(s) for s in strings], np.int64)
        joined = "\n" + "\n".join(strings) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.where(letters()[points], points, GAP)
        keep = np.ones(len(points), bool)
        keep[1:] = (points[1:] != GAP) | (points[:-1] != GAP)
        edges = np.concatenate([[0], np.cumsum(sizes + 1)])  # the gaps between texts
        place = np.cumsum(keep) - 1
        seen = np.zeros(POINTS, bool)
        seen[points] = True
        self.points = np.flatnonzero(seen)
        number = np.zeros(POINTS, np.int32)
        number[self.points] = np.arange(len(self.points))
        self.base = len(self.points)
        s = number[points[keep]].astype(np.int32 if self.base ** 3 < 1 << 31 else np.int64)
        self.runs = (s[:-2] * self.base + s[1:-1]) * self.base + s[2:]
        first = place[edges[:-1]]
        self.spans = np.stack([first, np.maximum(place[edges[1:]] - 1, first)], axis=1)

    def of(self, runs: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
        """Bits of the bound vectors: the letters', each permuted by its place in the run, multiplied."""
        signs = sign_bits(self.points, dimensions, seed)
        at = (runs // self.base ** 2, runs // self.base % self.base, runs % self.base)
        bits = np.roll(signs, 2, axis=1)[at[0]]
        bits ^= np.roll(signs, 1, axis=1)[at[1]]
        bits ^= signs[at[2]]
        return bits

    def bundle(self, runs: np.ndarray, counts: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
        """The sum of the runs' vectors, each as often as counted."""
        out = np.full(dimensions, float(counts.sum()))
        for k in range(0, len(runs), 4096):
            bits = np.unpackbits(self.of(runs[k:k + 4096], dimensions, seed).view(np.uint8), axis=1)
            out -= 2 * (counts[k:k + 4096].astype(np.float32) @ bits.astype(np.float32))
        return out


def partial_prototypes(dimensions: int, seed: int, open_langs: int = 32) -> Callable:
    """Per task and language the bundled vector of its texts and their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}  # the texts' number, then their vector

        def flush() -> pa.RecordBatch:
            rows = list(sums.items())
            sums.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in rows], pa.string()), pa.array([v.tolist() for _, v in rows], pa.list_(pa.float64()))], names=["lang", "vector"])

        for block in blocks(batches, "text", 2 << 20):
            found = LetterRuns(block.column("text"))
            by: dict[str, list[np.ndarray]] = {}
            for lang, (a, b) in zip(block.column("lang").to_pylist(), found.spans):
                by.setdefault(lang, []).append(found.runs[a:b])
            for lang, parts in by.items():
                if lang not in sums and len(sums) >= open_langs:
                    yield flush()
                own, counts = np.unique(np.concatenate(parts), return_counts=True)
                have = sums.setdefault(lang, np.zeros(dimensions + 1))
                have += np.concatenate([[len(parts)], found.bundle(own, counts, dimensions, seed)])
        if sums:
            yield flush()

    return run


def learn_prototypes(labelled: DataFrame, dimensions: int = 512, seed: int = 7, max_langs: int = 4096) -> dict[str, np.ndarray]:
    """Unit prototype per language from all rows (text, lang); `dimensions` (a multiple of 64) numbers a language reach the driver.

    Of more than `max_langs` different values, those with the most texts are learnt (ties: the smaller value);
    labels beyond that number are no languages. Repeated rows count each; null and empty texts add nothing; an
    empty table gives no prototype.
    """
    sums = (
        small_batches(labelled).select("text", "lang").filter("lang is not null").mapInArrow(partial_prototypes(dimensions, seed), "lang string, vector array<double>")
        .select("lang", F.posexplode("vector").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
        .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"))
        .select("lang", F.col("v.x").alias("v"))
    )
    out = {}
    for r in sorted(sums.orderBy(F.col("v")[0].desc(), "lang").limit(max_langs).collect(), key=lambda r: r["lang"]):
        v = np.array(r["v"][1:])
        if norm := float(np.linalg.norm(v)):
            out[r["lang"]] = v / norm
    return out


def identify(
    docs: DataFrame, prototypes: dict[str, np.ndarray], seed: int = 7, text_col: str = "text", lang_col: str = "lang_pred",
    score_col: str = "score", unknown: str = "und",
) -> DataFrame:
    """The rows of docs with a predicted language and its cosine, cut to 0..1.

    A null text, a text without a letter, and any text when nothing was learnt are `unknown` with
    score 0. Equal cosines go to the alphabetically first language. Rows are judged one by one, so
    repeated rows and null ids have the same result as any other; input columns named like the two new
    ones, in any case, are replaced.
    """
    langs, matrix = list(prototypes), np.array(list(prototypes.values()))
    dimensions = matrix.shape[1] if langs else 0
    new = {lang_col.lower(), score_col.lower()}
    kept = [f for f in docs.schema.fields if f.name.lower() not in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col, 2 << 20):
            pred, score = [unknown] * block.num_rows, np.zeros(block.num_rows)
            if langs:
                found = LetterRuns(block.column(text_col))
                for i, (a, b) in enumerate(found.spans):
                    if b > a:
                        own, counts = np.unique(found.runs[a:b], return_counts=True)
                        v = found.bundle(own, counts, dimensions, seed)
                        cosines = matrix @ v / (np.linalg.norm(v) or 1.0)
                        best = int(np.argmax(cosines))
                        pred[i], score[i] = langs[best], min(max(float(cosines[best]), 0.0), 1.0)
            columns = [block.column(f.name) for f in kept] + [pa.array(pred, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + [lang_col, score_col])

    rows = small_batches(docs).select(*[f"`{f.name}`" for f in kept])
    schema = StructType([*rows.schema.fields]).add(lang_col, "string").add(score_col, "double")
    return rows.mapInArrow(run, schema)


def least_cosine(
    labelled: DataFrame, prototypes: dict[str, np.ndarray], share: float = 0.001, seed: int = 7, judged: tuple[str, str] | None = None,
) -> float:
    """A cosine below which a text resembles no learnt language: half the `share` quantile of all labelled texts.

    `judged` names the prediction and the score in `labelled`, where `identify` has been over the rows before.
    The rank of the quantile is within 1 in 100,000 of the rows; 0 without rows or prototypes.
    """
    if not prototypes:
        return 0.0
    pred, score = judged or ("lang_pred", "score")
    rows = labelled if judged else identify(labelled.select("text"), prototypes, seed)
    known = rows.filter(F.col(pred) != "und")
    return float(known.agg(F.percentile_approx(score, F.lit(share), F.lit(100_000)).alias("q")).first()["q"] or 0.0) / 2
