"""Benchmark decontamination: near matches of benchmark items inside documents.

A random walk over a word sequence (each step stays at a word or leaves it, by a random bit of the word and the
step) embeds edit distance in Hamming distance: the walks of two windows agree wherever their words do. Bits of the
walk, here the words at a run of sampled steps, are hash keys. Item-sized windows start at every word of an item, the
walk going on to its end, and at every stride-th word of a document; windows that share a key make a candidate. Several
independent walks repeat the sampling. How many, how long and at which stride follows from a target recall.
A candidate counts if the edit distance of the whole item to the best place in the document is small, computed exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamepulse.llm.common import blocks, small_batches
from gamepulse.llm.hashing import U64, mix, ngram_hashes, word_hashes

FILTER_BITS = 20
PIECE = 8  # longest run of words that is looked up of a piece
PART = 1 << 20  # candidates of pieces held at a time


@dataclass(frozen=True)
class Sampling:
    """How windows are sampled: `walks` walks of `width` steps that visit `visits` words at least, at every stride-th word."""

    walks: int
    width: int
    visits: int
    stride: int


@dataclass(frozen=True)
class Walks:
    """Parameters of the embedding; `target` is the least recall of matches with as many edits as are allowed."""

    target: float = 0.98
    most_walks: int = 16
    seed: int = 11

    def miss(self, run: int, width: int, visits: int, stride: int) -> float:
        """Chance that one walk misses a match with an unedited run of so many words, at the worst phase of the stride.

        From its j-th word, a walk of width - 1 moves must visit enough words and stay inside the run.
        """
        moves = width - 1
        inside = [sum(comb(moves, a) for a in range(visits - 1, min(moves, run - 1 - j) + 1)) / 2 ** moves for j in range(run)]
        return max(float(np.prod([1 - p for p in inside[phase::stride]])) for phase in range(stride))

    def sampling(self, words: int, max_rate: float) -> Sampling:
        """The cheapest sampling that reaches the target for an item: e edits leave a run of (words - e) / (e + 1) words.

        Walks visit three words, or the whole run where it is shorter, so that a key is no single frequent word.
        """
        edits = int(max_rate * words)
        if not edits:  # equal or no match: one walk that moves at every step
            return Sampling(1, words, words, 1)
        run = min(-(-(words - edits) // (edits + 1)), 8)
        visits = min(run, 3)
        best: list[tuple[float, Sampling]] = []
        for width in range(visits + 1, visits + 4):
            for stride in range(1, run + 1):
                miss = self.miss(run, width, visits, stride)
                walks = 1 if miss <= 0 else ceil(log(1 - self.target) / log(miss)) if miss < 1 else self.most_walks + 1
                if walks <= self.most_walks:
                    best.append((walks / stride, Sampling(walks, width, visits, stride)))
        return min(best, key=lambda x: (x[0], x[1].width))[1]

    def keys(self, words: np.ndarray, starts: np.ndarray, sampling: Sampling) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(key, last word visited) of all starts, walk by walk; words past the end are zero."""
        padded = np.concatenate([words, np.zeros(sampling.width, U64)])
        for walk in range(sampling.walks):
            moves = mix(padded + U64(0x1000 * (walk + 1) + self.seed)) if sampling.width > sampling.visits else np.full(len(padded), ~U64(0))
            at = starts.astype(np.int64)
            sums = np.full(len(at), walk + 1, U64)
            for step in range(sampling.width):
                sums = sums * U64(0x9E3779B97F4A7C15) + padded[at]
                if step < sampling.width - 1:
                    at = at + ((moves[at] >> U64(step % 64)) & U64(1)).astype(np.int64)
            yield mix(sums), at


def best_place(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(edit distance, end) of the whole item against its best run of words in text."""
    spread = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(new - spread) + spread
    end = int(np.argmin(row))
    return int(row[end]), end


def by_key(keys: np.ndarray, owner: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys in order with their items and shifts, and a filter of their top bits."""
    order = np.argsort(keys)
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[(keys >> U64(64 - FILTER_BITS)).astype(np.int64)] = True
    return keys[order], owner[order], shift[order], seen


def matched(table: tuple, keys: np.ndarray, starts: np.ndarray, most: int | None = None) -> Iterator[np.ndarray]:
    """(start of the item, window, item) of all equal keys, in parts of about `most` rows."""
    index, owner, shift, seen = table
    maybe = np.flatnonzero(seen[(keys >> U64(64 - FILTER_BITS)).astype(np.int64)])
    low, high = (np.searchsorted(index, keys[maybe], side=s) for s in ("left", "right"))
    total = np.cumsum(high - low)
    cuts = np.flatnonzero(np.diff(total // most)) + 1 if most else []
    for low, high, own in zip(*(np.split(x, cuts) for x in (low, high, starts[maybe]))):
        n = high - low
        entry = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        window = np.repeat(own, n)
        yield np.stack([window - shift[entry], window, owner[entry]], axis=1)


class ItemIndex:
    """Keys of the windows of all items, per sampling and walk."""

    def __init__(self, ids: list, words: list[np.ndarray], walks: Walks, max_rate: float):
        self.walks, self.ids, self.words, self.max_rate = walks, ids, words, max_rate
        self.cut: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        alike: dict[Sampling, list[int]] = {}
        for i, w in enumerate(words):
            alike.setdefault(walks.sampling(len(w), max_rate), []).append(i)
        self.tables: dict[Sampling, list[tuple]] = {}
        for sampling, items in alike.items():
            sizes = np.array([len(words[i]) for i in items])
            begin = np.cumsum(sizes) - sizes
            flat, owner = np.concatenate([words[i] for i in items]), np.repeat(items, sizes)
            shift = np.arange(len(flat)) - np.repeat(begin, sizes)
            end = np.repeat(begin + sizes, sizes)
            self.tables[sampling] = []
            for keys, last in walks.keys(flat, np.arange(len(flat)), sampling):
                ok = (last < end) & (last - np.arange(len(flat)) >= sampling.visits - 1)
                self.tables[sampling].append(by_key(keys[ok], owner[ok], shift[ok]))

    def candidates(self, words: np.ndarray, first: np.ndarray) -> Iterator[np.ndarray]:
        """(start of the item in words, window, item) that shared keys suggest, in parts."""
        for sampling, tables in self.tables.items():
            starts = window_starts(first, sampling.stride)
            for table, (keys, last) in zip(tables, self.walks.keys(words, starts, sampling)):
                ok = last - starts >= sampling.visits - 1
                yield from matched(table, keys[ok], starts[ok], PART)

    def pieces(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per length the keys of slack + 1 disjoint runs of every item; an edit spoils at most one of them."""
        if not self.cut:
            held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
            for i, words in enumerate(self.words):
                n = int(self.max_rate * len(words)) + 1
                apart = len(words) // n
                if length := min(apart, PIECE):
                    at = apart * np.arange(n)
                    held.setdefault(length, []).append((ngram_hashes(words, length)[at], np.full(n, i), at))
            self.cut = {length: by_key(*(np.concatenate(x) for x in zip(*rows))) for length, rows in sorted(held.items())}
        return self.cut

    def whole_pieces(self, words: np.ndarray) -> Iterator[np.ndarray]:
        """As candidates: every place of every piece in words."""
        for length, table in self.pieces().items():
            keys = ngram_hashes(words, length)
            yield from matched(table, keys, np.arange(len(keys)), PART)


def window_starts(first: np.ndarray, stride: int) -> np.ndarray:
    """Every stride-th word of every text, from its first."""
    tries = -(-np.diff(first) // stride)
    return np.repeat(first[:-1] - stride * (np.cumsum(tries) - tries), tries) + stride * np.arange(tries.sum())


def index_of(items: list[tuple], walks: Walks, max_rate: float) -> ItemIndex:
    flat, first = word_hashes(pa.array([t for _, t in items], pa.string()))
    words = [flat[a:b] for a, b in zip(first[:-1], first[1:])]
    full = [k for k, w in enumerate(words) if len(w)]
    return ItemIndex([items[k][0] for k in full], [words[k] for k in full], walks, max_rate)


def plausible(index: ItemIndex, cand: np.ndarray, own: np.ndarray, first: np.ndarray, max_rate: float) -> np.ndarray:
    """The candidates whose text, near the place, has enough of the item's different words.

    Every word that is missing costs an edit, so no match is lost.
    """
    keep = np.zeros(len(cand), bool)
    order = np.argsort(cand[:, 2], kind="stable")
    items, at = np.unique(cand[order, 2], return_index=True)
    for item, rows in zip(items, np.split(order, at[1:])):
        words = np.unique(index.words[item])
        slack = int(max_rate * len(index.words[item]))
        reach = np.arange(-2 * slack, len(index.words[item]) + 2 * slack)
        for part in np.array_split(rows, len(rows) // 4096 + 1):
            text = np.searchsorted(first, cand[part, 1], side="right") - 1
            spots = cand[part, 0][:, None] + reach[None, :]
            inside = (spots >= first[text][:, None]) & (spots < first[text + 1][:, None])
            near = own[np.clip(spots, 0, len(own) - 1)]
            which = np.minimum(np.searchsorted(words, near), len(words) - 1)
            inside &= words[which] == near
            has = np.zeros((len(part), len(words)), bool)
            has[np.nonzero(inside)[0], which[inside]] = True
            keep[part] = has.sum(axis=1) >= len(words) - slack
    return cand[keep]


def find(index: ItemIndex, texts: pa.Array, complete: bool = False) -> dict[tuple[int, int], tuple[int, int]]:
    """(text, item) -> (distance, end word) of all verified matches in a run of texts."""
    max_rate = index.max_rate
    own, first = word_hashes(texts)
    hits: dict[tuple[int, int], tuple[int, int]] = {}
    if not len(own) or not index.words:
        return hits
    done: dict[tuple[int, int], set[int]] = {}
    parts = chain(index.candidates(own, first), index.whole_pieces(own) if complete else ())
    likely = [np.zeros((0, 3), np.int64), *(plausible(index, np.unique(part, axis=0), own, first, max_rate) for part in parts if len(part))]
    for place, window, item in np.unique(np.concatenate(likely), axis=0).tolist():
        word = index.words[item]
        slack = int(max_rate * len(word))
        text = int(np.searchsorted(first, window, side="right")) - 1
        tried = done.setdefault((text, item), set())
        if place in tried or hits.get((text, item), (1, 0))[0] == 0:  # no place is better than a verbatim one
            continue
        tried.add(place)
        low, high = max(int(first[text]), place - 2 * slack), min(int(first[text + 1]), place + len(word) + 2 * slack)
        if high - low < len(word) - slack:
            continue
        distance, end = best_place(word, own[low:high])
        if distance <= slack and distance < hits.get((text, item), (1 << 30, 0))[0]:
            hits[text, item] = (distance, low + end - int(first[text]))
    return hits


def _matches(items: list[tuple], walks: Walks, max_rate: float, complete: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_of(items, walks, max_rate)
        for block in blocks(batches, "text", 4 << 20):
            hits = sorted(find(index, block.column("text"), complete).items())
            rows = [(block.column("id")[d].as_py(), index.ids[i], distance, end, len(index.words[i])) for (d, i), (distance, end) in hits]
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["id", "item_id", "distance", "end_word", "item_words"])

    return run


def _clean(items: list[tuple], walks: Walks, max_rate: float, text_col: str, complete: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_of(items, walks, max_rate)
        for block in blocks(batches, text_col, 4 << 20):
            keep = np.ones(block.num_rows, bool)
            keep[[d for d, _ in find(index, block.column(text_col), complete)]] = False
            yield block.filter(pa.array(keep))

    return run


def item_blocks(items: DataFrame, item_id: str, item_text: str, block_chars: int) -> Iterator[list[tuple]]:
    """The items in runs of about block_chars characters, so that a task holds a bounded part of them."""
    wanted = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).filter(F.length(F.trim("t")) > 0)
    size = wanted.agg(F.sum(F.length("t"))).first()[0] or 0
    n = -(-size // block_chars)
    for b in range(n):
        own = wanted if n == 1 else wanted.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b)
        if part := [(r["i"], r["t"]) for r in own.collect()]:
            yield part


def contaminated(
    docs: DataFrame, items: DataFrame, max_rate: float = 0.2, walks: Walks = Walks(), id_col: str = "doc_id",
    text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_chars: int = 8 << 20,
    complete: bool = False,
) -> DataFrame:
    """(id, item_id, distance, end_word, item_words): items found in documents.

    Words are cut at ASCII white space, A-Z lower-cased. A match is a run of a document's words within
    max_rate * (words of the item) word edits of the whole item; the best run is reported, where
    it ends as a word count from the start. Candidates come from shared keys of the walks: a match without edits is
    always found, one with as many as allowed with the chance `walks.target` at least, at every length. With `complete`,
    exact pieces of the items are looked up as well, which no match within max_rate (below 1) can lack all.

    Every row of docs is searched by itself, whole: repeated rows give repeated results, a null id
    gives null. Null, empty and blank texts and items match nothing; repeated items each match; other
    columns are ignored; an empty table on either side gives an empty table.

    Items are searched in blocks of about `block_chars` characters, each a pass over the documents;
    a block is what a task holds of the items, so its size is bounded.
    """
    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    schema = "id long, item_id long, distance long, end_word long, item_words long"
    out = docs.sparkSession.createDataFrame([], schema)
    for part in item_blocks(items, item_id, item_text, block_chars):
        out = out.union(texts.mapInArrow(_matches(part, walks, max_rate, complete), schema))
    return out.withColumnRenamed("id", id_col)


def drop_contaminated(
    docs: DataFrame, items: DataFrame, max_rate: float = 0.2, walks: Walks = Walks(), text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_chars: int = 8 << 20,
    complete: bool = False,
) -> DataFrame:
    """The rows of docs that hold no item, in the sense of `contaminated`, with all their columns."""
    for part in item_blocks(items, item_id, item_text, block_chars):
        docs = small_batches(docs).mapInArrow(_clean(part, walks, max_rate, text_col, complete), docs.schema)
    return docs
