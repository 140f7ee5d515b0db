"""Language-model scores from a hashed maximum-entropy model with class-factored softmax.

Words fall into 1,024 cells: the most frequent words have a cell each, all others share cells by
their ending. Cells form 32 classes of 32. P(word | text so far) is P(class | context) * P(cell |
class, context) * P(word | cell): two softmax layers over hashed features (the word before, the
one before that as a skip feature, and both together), and smoothed counts within a cell. Every
task trains on its texts by gradient steps; the tasks' weights are averaged, row by row, by how many tokens used
the row. Scoring runs in numpy batches over the same sparse features.

Word counts are exact. A bounded table of the most frequent words goes to every task; counts of the
other words are joined by hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamepulse.llm.common import blocks, written
from gamepulse.llm.hashing import LOWER, U64, mix, span_hashes, text_bytes, word_spans

SIDE = 32
CELLS = SIDE * SIDE
ENDINGS = 256
SINGLES = CELLS - ENDINGS
END_HASH = U64(0x5EED0E4D)
PAIRS, SKIPS = 8192, 8192
ROWS1, ROWS2 = 2 * CELLS + PAIRS, CELLS * SIDE + SKIPS
CHUNK = 512
STEP = 16384  # tokens per gradient step and scoring batch
SMOOTH = 0.1


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and ending of every token, an end after every text; first token of every text (n+1)."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets)
    n, words = len(first) - 1, len(starts)
    place = np.arange(words) + np.repeat(np.arange(n), np.diff(first))
    hashes = np.full(words + n, END_HASH, U64)
    hashes[place] = span_hashes(data, starts, ends)
    endings = np.zeros(words + n, np.uint8)
    if words:
        before = np.where(ends - 2 >= starts, data[np.maximum(ends - 2, 0)], 0).astype(np.uint32)
        endings[place] = ((data[ends - 1].astype(np.uint32) * 31 + before * 131) % 251 + before % 5).astype(np.uint8)
    return hashes, endings, first + np.arange(n + 1)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, ending, c) per task, summed before it leaves the task."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, e, c = (np.concatenate(x) for x in zip(*held))
        words, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        return words, e[first], np.bincount(inverse, c, len(words)).astype(np.int64)

    def out(part: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(part[0].view(np.int64)), pa.array(part[1].astype(np.int32)), pa.array(part[2])], names=["word", "ending", "c"])

    size = 0
    for block in blocks(batches, "text", 4 << 20):
        h, e, _ = tokens(block.column("text"))
        words, first, counts = np.unique(h, return_index=True, return_counts=True)
        held.append((words, e[first], counts.astype(np.float64)))
        size += len(words)
        if size > 4_000_000:
            held, size = [merged()], 0
            if len(held[0][0]) > 2_000_000:
                yield out(held.pop())
    if held:
        yield out(merged())


@dataclass
class Frequent:
    """Counts and ranks of the most frequent words, sorted by hash."""

    words: np.ndarray
    counts: np.ndarray
    ranks: np.ndarray

    def cells(self, hashes: np.ndarray, endings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of every token, and its place in the table or -1."""
        if not len(self.words):
            return SINGLES + endings.astype(np.int64), np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        found = self.words[at] == hashes
        ranks = np.where(found, self.ranks[at], SINGLES)
        return np.where(ranks < SINGLES, ranks, SINGLES + endings.astype(np.int64)), np.where(found, at, -1)


def contexts(cells: np.ndarray, first: np.ndarray, end_cell: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the token before and of the one before that; the end cell stands before a text."""
    one, two = np.empty_like(cells), np.empty_like(cells)
    one[1:], two[2:] = cells[:-1], cells[:-2]
    heads = first[:-1]
    one[heads] = end_cell
    two[heads] = end_cell
    second = heads[np.diff(first) > 1] + 1
    two[second] = end_cell
    return one, two


def rows_of(one: np.ndarray, two: np.ndarray, group: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Weight rows of the active features: of the class layer, of the cell layer."""
    pair = mix(one.astype(U64) * U64(CELLS) + two.astype(U64)) % U64(PAIRS)
    skip = mix((two * SIDE + group).astype(U64) + U64(1 << 40)) % U64(SKIPS)
    return [one, CELLS + two, 2 * CELLS + pair.astype(np.int64)], [one * SIDE + group, CELLS * SIDE + skip.astype(np.int64)]


@dataclass
class Weights:
    one: np.ndarray  # ROWS1 x SIDE
    two: np.ndarray  # ROWS2 x SIDE
    bias1: np.ndarray  # SIDE
    bias2: np.ndarray  # SIDE x SIDE

    def layers(self, one: np.ndarray, two: np.ndarray, group: np.ndarray):
        r1, r2 = rows_of(one, two, group)
        x = self.bias1 + self.one[r1[0]] + self.one[r1[1]] + self.one[r1[2]]
        y = self.bias2[group] + self.two[r2[0]] + self.two[r2[1]]
        return r1, r2, _log_softmax(x), _log_softmax(y)

    def score(self, cells: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Natural log-probability of every cell in its context."""
        out = np.empty(len(cells))
        for k in range(0, len(cells), STEP):
            s = slice(k, k + STEP)
            group, item = cells[s] // SIDE, cells[s] % SIDE
            _, _, x, y = self.layers(one[s], two[s], group)
            i = np.arange(len(group))
            out[s] = x[i, group] + y[i, item]
        return out


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


class Trainer:
    """Gradient steps with per-weight rates (AdaGrad) on the tokens of one task."""

    def __init__(self, bias1: np.ndarray, bias2: np.ndarray, rate: float):
        zeros = lambda n: np.zeros((n, SIDE), np.float32)
        self.w, self.rate = Weights(zeros(ROWS1), zeros(ROWS2), bias1, bias2), rate
        self.square = [zeros(ROWS1) + 1e-2, zeros(ROWS2) + 1e-2]
        self.used = [np.zeros(ROWS1), np.zeros(ROWS2)]

    def learn(self, cells: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        for k in range(0, len(cells), STEP):
            s = slice(k, k + STEP)
            group, item = cells[s] // SIDE, cells[s] % SIDE
            r1, r2, x, y = self.w.layers(one[s], two[s], group)
            for layer, table, rows, logs, goal in ((0, self.w.one, r1, x, group), (1, self.w.two, r2, y, item)):
                error = np.exp(logs)
                error[np.arange(len(goal)), goal] -= 1
                for r in rows:
                    order = np.argsort(r.astype(np.uint16), kind="stable")
                    values, at, n = np.unique(r[order], return_index=True, return_counts=True)
                    g = np.add.reduceat(error[order], at, axis=0)
                    self.square[layer][values] += g * g
                    table[values] -= self.rate * g / np.sqrt(self.square[layer][values])
                    self.used[layer][values] += n


def _trained(frequent, bias1, bias2, end_cell: int, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, table = Trainer(bias1, bias2, rate), frequent.value
        for block in blocks(batches, "text", 2 << 20):
            hashes, endings, first = tokens(block.column("text"))
            cells, _ = table.cells(hashes, endings)
            trainer.learn(cells, *contexts(cells, first, end_cell))
        used = np.concatenate(trainer.used)
        weights = np.concatenate([trainer.w.one, trainer.w.two]) * used[:, None]
        live = [i for i in range(0, len(used), CHUNK) if used[i:i + CHUNK].any()]
        yield pa.RecordBatch.from_arrays([
            pa.array([i // CHUNK for i in live], pa.int32()), pa.array([weights[i:i + CHUNK].astype(np.float32).tobytes() for i in live], pa.binary()),
            pa.array([used[i:i + CHUNK].tobytes() for i in live], pa.binary())], names=["chunk", "weights", "used"])

    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, used, own = 0.0, 0.0, 0
    for batch in batches:
        own = batch.column("chunk")[0].as_py()
        for w, u in zip(batch.column("weights"), batch.column("used")):
            total = total + np.frombuffer(w.as_buffer(), np.float32).astype(np.float64).reshape(-1, SIDE)
            used = used + np.frombuffer(u.as_buffer(), np.float64)
    mean = (total / np.maximum(used, 1)[:, None]).astype(np.float32)
    yield pa.RecordBatch.from_arrays([pa.array([own], pa.int32()), pa.array([mean.tobytes()], pa.binary())], names=["chunk", "mean"])


def _scored(frequent, weights, end_cell: int, cell_mass: np.ndarray):
    """Per text: its row, sums over its frequent tokens and classes, and its other words with counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, model = frequent.value, weights.value
        logs = np.log10(table.counts + SMOOTH)
        row = TaskContext.get().partitionId() << 36
        for block in blocks(batches, "text", 2 << 20):
            hashes, endings, first = tokens(block.column("text"))
            cells, at = table.cells(hashes, endings)
            n, size = block.num_rows, np.diff(first)
            known = at >= 0
            count_log = np.where(known, logs[at] if len(logs) else 0.0, 0.0)
            in_cell = np.where(cells >= SINGLES, count_log - cell_mass[cells], 0.0)
            model_log = model.score(cells, *contexts(cells, first, end_cell)) / np.log(10) + in_cell
            sums = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731 (every text has its end token)
            rest = np.flatnonzero(~known)
            owner = np.repeat(np.arange(n), size)[rest]
            order = np.lexsort((hashes[rest], owner))
            owner, words = owner[order], hashes[rest][order]
            new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (words[1:] != words[:-1])]) if len(owner) else np.zeros(0, bool)
            heads = np.flatnonzero(new)
            times = np.diff(np.append(heads, len(owner)))
            spots = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[heads], minlength=n))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                pa.array(row + np.arange(n)), block.column("id"), block.column("held_out"), pa.array(size.astype(np.int64)),
                pa.array(sums(known.astype(np.int64))), pa.array(sums(count_log)), pa.array(sums(model_log)),
                pa.ListArray.from_arrays(spots, pa.array(words[heads].view(np.int64))), pa.ListArray.from_arrays(spots, pa.array(times.astype(np.int32)))],
                names=["row", "id", "held_out", "n_tokens", "known", "base", "model", "words", "times"])
            row += n

    return run


def most_frequent(counts: DataFrame, limit: int) -> pd.DataFrame:
    """The most frequent words, at most `limit`, in descending order of counts.

    A histogram of counts in steps of 1/16 octave gives the bound, so no task sends more than the words above it.
    """
    step = F.floor(16 * F.log2("c")).cast("int")
    sizes = {r["step"]: r["count"] for r in counts.groupBy(step.alias("step")).count().collect()}
    bound, total = None, 0
    for s in sorted(sizes, reverse=True):
        total += sizes[s]
        if total > limit:
            break
        bound = s
    rows = counts.filter(step >= bound) if bound is not None else counts.limit(0)
    return rows.toPandas().sort_values(["c", "word"], ascending=[False, True], ignore_index=True)


def score_texts(
    docs: DataFrame, held_out: str, id_col: str = "doc_id", text_col: str = "text", max_frequent: int = 200_000, rate: float = 0.15,
) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    `held_out` is a SQL condition; rows where it is not true are learnt from, all of them. Tokens are
    words cut at ASCII white space, A-Z lower-cased, and an end per text. base_score is the unigram
    log10 probability with 0.1 added to counts, score the model's. An unseen word has the
    probability of 0.1 counts in its cell.

    A null or empty text is its end token. Repeated rows are scored each; a null id is
    kept as null; other columns are ignored; an empty table gives an empty table; with nothing to learn
    from all counts are 0.

    Bounds: max_frequent words and 51,200 rows of weights are what each task holds of the model.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.expr(held_out), F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    train = texts.filter("not held_out").select("text")
    counts = written(train.mapInArrow(_counted, "word long, ending int, c long").groupBy("word", "ending").agg(F.sum("c").alias("c")), "lm-counts")
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = most_frequent(counts, max_frequent)
    words = top["word"].to_numpy(np.int64).view(U64)
    order = np.argsort(words)
    frequent = Frequent(words[order], top["c"].to_numpy(np.int64)[order], np.minimum(order, SINGLES))
    singles = top.head(SINGLES)
    mass, kinds = np.zeros(CELLS), np.zeros(CELLS)
    mass[:len(singles)] = singles["c"]
    for r in counts.groupBy("ending").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        mass[SINGLES + r["ending"]], kinds[SINGLES + r["ending"]] = r["n"], r["v"]
    for ending, c in zip(singles["ending"], singles["c"]):
        mass[SINGLES + ending] -= c
        kinds[SINGLES + ending] -= 1
    cell_mass = np.log10(mass + SMOOTH * (kinds + 1))
    share = (mass + 1).reshape(SIDE, SIDE)
    bias1 = np.log(share.sum(axis=1) / share.sum()).astype(np.float32)
    bias2 = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)
    end = np.flatnonzero(singles["word"].to_numpy(np.int64).view(U64) == END_HASH)
    end_cell = int(end[0]) if len(end) else SINGLES
    shared = spark.sparkContext.broadcast(frequent)

    means = (
        train.mapInArrow(_trained(shared, bias1, bias2, end_cell, rate), "chunk int, weights binary, used binary")
        .groupBy("chunk").applyInArrow(_averaged, "chunk int, mean binary").collect()
    )
    table = np.zeros((ROWS1 + ROWS2, SIDE), np.float32)
    for r in means:
        part = np.frombuffer(r["mean"], np.float32).reshape(-1, SIDE)
        table[r["chunk"] * CHUNK:r["chunk"] * CHUNK + len(part)] = part
    weights = spark.sparkContext.broadcast(Weights(table[:ROWS1], table[ROWS1:], bias1, bias2))

    scored = written(texts.mapInArrow(
        _scored(shared, weights, end_cell, cell_mass),
        "row long, id long, held_out boolean, n_tokens long, known long, base double, model double, words array<long>, times array<int>"), "lm-scores")
    rare = (
        scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.times").alias("t"))
        .join(counts.select("word", "c"), "word", "left").groupBy("row").agg(
            F.sum(F.col("t") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(SMOOTH))).alias("log"),
            F.sum(F.when(F.col("c") > 0, F.col("t")).otherwise(0)).alias("seen"))
    )
    n, v = int(totals["n"]), int(totals["v"])
    unit = float(np.log10(n + SMOOTH * (v + 1)))
    # an unknown word and a rare one are smoothed alike, in the base and within their cell
    more = F.coalesce("log", F.lit(0.0))
    return scored.drop("words", "times").join(rare, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + more - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        (F.col("model") + more).alias("score"))
