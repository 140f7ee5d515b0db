"""Packs documents into training sequences by cutting-stock column generation.

Every document is cut into full sequences and one remainder. A linear program over patterns of
remainder lengths is solved on the length histogram (at most `capacity` numbers, whatever the
table holds): a knapsack dynamic program prices new columns, the patterns are rounded, and the
documents of each length, ranked, take the places of the patterns. Documents beyond the rounded
patterns form one stream that is cut at sequence ends, so no sequence but powers of two is short.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamepulse.llm.common import blocks, small_batches, written
from gamepulse.llm.hashing import LOWER, span_hashes, text_bytes, word_spans

Pattern = dict[int, int]


def best_pattern(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, Pattern]:
    """The cheapest multiset of lengths that fills the capacity exactly, by knapsack dynamic program."""
    cost = np.full(capacity + 1, np.inf)
    cost[0] = 0.0
    for length, price in zip(lengths.tolist(), prices.tolist()):
        copies = 1
        while copies * length <= capacity:  # doubling reaches every number of copies
            step = copies * length
            np.minimum(cost[step:], cost[:-step] + copies * price, out=cost[step:])
            copies *= 2
    if not np.isfinite(cost[capacity]):
        return np.inf, {}
    pattern, left = {}, capacity
    while left:
        fits = lengths <= left
        length = int(lengths[fits][np.argmin(cost[left - lengths[fits]] + prices[fits])])
        pattern[length] = pattern.get(length, 0) + 1
        left -= length
    return float(cost[capacity]), pattern


def solve_patterns(lengths: np.ndarray, counts: np.ndarray, capacity: int, max_pivots: int) -> list[tuple[Pattern, int]]:
    """Most exactly filled sequences from the counted lengths: revised simplex, columns priced by knapsack.

    Slack columns are the start basis. Stopping at max_pivots leaves a feasible plan. Copies are
    rounded down, then up where enough documents are left.
    """
    m = len(lengths)
    where = {int(x): i for i, x in enumerate(lengths)}
    inverse, value = np.eye(m), counts.astype(float)
    basis: list[Pattern | int] = list(range(m))
    gain = np.zeros(m)
    for _ in range(max_pivots):
        dual = gain @ inverse
        entering: Pattern | int
        if dual.min() < -1e-7:
            entering = int(np.argmin(dual))
            column, worth = np.eye(m)[entering], 0.0
        else:
            cost, entering = best_pattern(lengths, np.maximum(dual, 0), capacity)
            if cost >= 1 - 1e-7:
                break
            column, worth = np.zeros(m), 1.0
            for length, copies in entering.items():
                column[where[length]] = copies
        direction = inverse @ column
        up = direction > 1e-9
        if not up.any():
            break
        ratio = np.full(m, np.inf)
        ratio[up] = value[up] / direction[up]
        out = int(np.argmin(ratio))
        step = ratio[out]
        value = np.maximum(value - step * direction, 0.0)
        value[out] = step
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
        basis[out], gain[out] = entering, worth
    left = counts.astype(np.int64).copy()
    plan = []
    chosen = sorted(((float(v), b) for v, b in zip(value, basis) if isinstance(b, dict) and v > 1e-9), key=lambda x: x[0] % 1, reverse=True)
    needs = [np.array([[where[k], n] for k, n in b.items()]) for _, b in chosen]
    for (v, b), need in zip(chosen, needs):
        n = min(int(v + 1e-6), int((left[need[:, 0]] // need[:, 1]).min()))
        left[need[:, 0]] -= n * need[:, 1]
        plan.append([b, n])
    for entry, need in zip(plan, needs):
        if (left[need[:, 0]] >= need[:, 1]).all():
            left[need[:, 0]] -= need[:, 1]
            entry[1] += 1
    return [(b, n) for b, n in plan if n]


def plan_patterns(histogram: np.ndarray, capacity: int, group: int = 256, pivots_per_length: int = 3) -> list[tuple[Pattern, int]]:
    """Patterns with copies for a histogram of lengths below the capacity.

    The lengths are dealt by a hash into groups of about `group`, so that each has short and long
    ones of every remainder, and every group is a linear program of its own. That bounds the
    driver's work.
    """
    lengths = np.flatnonzero(histogram[:capacity])
    parts = max(1, -(-len(lengths) // group))
    dealt = np.argsort(lengths * 2654435761 % (1 << 32))
    plan = []
    for i in range(parts):
        own = np.sort(lengths[dealt[i::parts]])
        if len(own):
            plan += solve_patterns(own, histogram[own], capacity, pivots_per_length * len(own))
    return plan


@dataclass
class Plan:
    """Where the document of rank k among those with one remainder length goes.

    Slots of a length are rows at[length]:at[length + 1]: from rank `first` on, `per` documents
    in each of the sequences from `base`, from `offset` on. Ranks beyond go to the stream.
    """

    capacity: int
    at: np.ndarray
    first: np.ndarray
    per: np.ndarray
    base: np.ndarray
    offset: np.ndarray
    covered: np.ndarray
    stream_at: np.ndarray
    patterns: int
    full: int
    ends: np.ndarray  # ends of the stream's last, power-of-two sequences
    body: int  # stream tokens in whole sequences

    @staticmethod
    def of(histogram: np.ndarray, full: int, capacity: int) -> Plan:
        rows: list[list[tuple[int, int, int, int]]] = [[] for _ in range(capacity)]
        covered = np.zeros(capacity, np.int64)
        base = 0
        for pattern, copies in plan_patterns(histogram, capacity):
            offset = 0
            for length, per in sorted(pattern.items(), reverse=True):
                rows[length].append((covered[length], per, base, offset))
                covered[length] += per * copies
                offset += per * length
            base += copies
        at = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        flat = np.array([x for r in rows for x in r], np.int64).reshape(-1, 4)
        weight = (histogram[:capacity] - covered) * np.arange(capacity)
        total = int(weight.sum())
        body = total - total % capacity
        bits = [1 << b for b in range(capacity.bit_length(), -1, -1) if (total % capacity) >> b & 1]
        return Plan(
            capacity, at, flat[:, 0], flat[:, 1], flat[:, 2], flat[:, 3], covered,
            np.concatenate([[0], np.cumsum(weight)[:-1]]), base, full, body + np.cumsum(bits, dtype=np.int64), body)

    def pieces(self, tokens: int, rank: int, full_rank: int) -> list[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of all pieces of a document."""
        cap = self.capacity
        whole, rest = divmod(tokens, cap)
        out = [(i * cap, cap, self.patterns + full_rank + i, 0) for i in range(whole)]
        if not rest:
            return out
        if rank < self.covered[rest]:
            a, b = self.at[rest], self.at[rest + 1]
            slot = a + int(np.searchsorted(self.first[a:b], rank, side="right")) - 1
            copy, place = divmod(rank - int(self.first[slot]), int(self.per[slot]))
            out.append((whole * cap, rest, int(self.base[slot]) + copy, int(self.offset[slot]) + place * rest))
            return out
        position = int(self.stream_at[rest]) + (rank - int(self.covered[rest])) * rest
        start, stop = whole * cap, position + rest
        while position < stop:
            if position < self.body:
                sequence, begin = divmod(position, cap)
                end = position - begin + cap
            else:
                k = int(np.searchsorted(self.ends, position, side="right"))
                sequence, end = self.body // cap + k, int(self.ends[k])
                begin = position - (int(self.ends[k - 1]) if k else self.body)
            n = min(stop, end) - position
            out.append((start, n, self.patterns + self.full + sequence, begin))
            start, position = start + n, position + n
        return out


#: Marks that a tokenizer with word ends parts from a letter before them.
CUT = np.array([chr(b) in ",.!?;:" for b in range(256)])
ASCII_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])


class Words:
    """Token ids of words: arrays sorted by the words' hashes, and a pool that they point into."""

    def __init__(self, kind: type):
        self.words, self.at, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool, self.used = np.zeros(1 << 12, kind), 0

    def has(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(words), bool)
        return self.words[np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)] == words

    def ids_of(self, words: np.ndarray, uses: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, which must be there, in a row, and how many each has; `uses` numbers the words used."""
        place = np.searchsorted(self.words, words)
        place = place if uses is None else place[uses]
        at, n = self.at[place], self.n[place]
        begin = np.cumsum(n, dtype=np.int64) - n
        return self.pool[np.repeat(at - begin, n) + np.arange(n.sum(dtype=np.int64))], n

    def add(self, words: np.ndarray, flat: np.ndarray, n: np.ndarray) -> None:
        if self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool[:self.used], np.zeros(max(len(flat), self.used // 2), self.pool.dtype)])
        self.pool[self.used:self.used + len(flat)] = flat
        at = self.used + np.cumsum(n, dtype=np.int64) - n
        self.used += len(flat)
        where = np.searchsorted(self.words, words)
        self.words, self.n, self.at = np.insert(self.words, where, words), np.insert(self.n, where, n), np.insert(self.at, where, at)


class WordTokens:
    """Token ids of whole texts, encoding most distinct words once per worker.

    Holds for tokenizers that lower-case, drop white space and merge neither across it nor across the
    end of a run of letters: a text's ids are then its words' ids in a row. Words are cut at ASCII
    white space and before a mark behind a letter; whatever else parts a word, the tokenizer parts
    itself. Words with "<|" keep their case, which special tokens depend on.

    Known words are kept in two generations of at most `limit` words (about 30 bytes each, so 2 x 16 MB):
    when the younger is full it becomes the older one, and words in use move over from there. A block's own
    words come on top while it is encoded.
    """

    def __init__(self, path: str, limit: int = 1 << 19):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.young, self.old = Words(self.kind), Words(self.kind)

    def spans(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        raw, offsets = text_bytes(texts)
        starts, ends, _ = word_spans(raw, offsets)
        if len(raw) > 1:
            cut = np.flatnonzero(CUT[raw[1:]] & ASCII_LETTER[raw[:-1]]) + 1
            cut = np.setdiff1d(cut, offsets, assume_unique=True)
            starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
        data = LOWER[raw]
        for k in np.flatnonzero((raw[:-1] == 60) & (raw[1:] == 124)).tolist():  # "<|"
            i = int(np.searchsorted(starts, k, side="right")) - 1
            data[starts[i]:ends[i]] = raw[starts[i]:ends[i]]
        return data, starts, ends, np.searchsorted(starts, offsets)

    def learn(self, words: np.ndarray, spans: Callable[[np.ndarray], list[str]]) -> None:
        """Makes all the words young; `spans` gives the strings of some by number."""
        missing = ~self.young.has(words)
        known = words[missing & self.old.has(words)]
        if len(known):
            self.young.add(known, *self.old.ids_of(known))
        new = np.flatnonzero(missing & ~self.old.has(words))
        for k in range(0, len(new), 1 << 16):
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(spans(new[k:k + (1 << 16)]), add_special_tokens=False)]
            self.young.add(words[new[k:k + (1 << 16)]], np.array(list(chain.from_iterable(ids)), self.kind), np.array([len(x) for x in ids], np.int32))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the first id of every text (n+1 values)."""
        data, starts, ends, first = self.spans(texts)
        if not len(starts):
            return np.zeros(0, self.kind), np.zeros(len(first), np.int64)
        hashes = span_hashes(data, starts, ends)
        words, sample, uses = np.unique(hashes, return_index=True, return_inverse=True)
        body = data.tobytes()
        self.learn(words, lambda at: [body[a:b].decode() for a, b in zip(starts[sample[at]].tolist(), ends[sample[at]].tolist())])
        ids, n = self.young.ids_of(words, uses)
        if len(self.young.words) > self.limit:
            self.old, self.young = self.young if len(self.young.words) <= 2 * self.limit else Words(self.kind), Words(self.kind)
        return ids, np.concatenate([[0], np.cumsum(n, dtype=np.int64)])[first]


_ENCODERS: dict[str, WordTokens] = {}  # the one last used


def tokens_of(path: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[path] = WordTokens(path)
        encoder = _ENCODERS[path]
        row = TaskContext.get().partitionId() << 36
        for block in blocks(batches, "text", 4 << 20):
            ids, first = encoder.encode(block.column("text"))
            n = block.num_rows
            lengths = np.diff(first) + 1
            ends = np.cumsum(lengths)
            body = np.full(int(ends[-1]), end_id, encoder.kind)
            keep = np.ones(len(body), bool)
            keep[ends - 1] = False
            body[keep] = ids
            width = body.itemsize
            spots = pa.py_buffer(np.concatenate([[0], ends * width]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([
                pa.array(row + np.arange(n)), block.column("doc_id"), pa.array(lengths), pa.array(np.full(n, width, np.int32)),
                pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, spots, pa.py_buffer(body)]).cast(pa.binary()),
            ], names=["row", "doc_id", "doc_tokens", "width", "ids"])
            row += n

    return run


def ranked(capacity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Numbers the rows of a sorted partition within their remainder length, and their full sequences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, full = TaskContext.get().partitionId(), np.zeros(capacity, np.int64), 0
        for batch in batches:
            tokens = batch.column("doc_tokens").to_numpy()
            rest, whole = tokens % capacity, tokens // capacity
            order = np.argsort(rest, kind="stable")
            values, starts, counts = np.unique(rest[order], return_index=True, return_counts=True)
            rank = np.empty(len(rest), np.int64)
            rank[order] = np.arange(len(rest)) - np.repeat(starts, counts) + np.repeat(seen[values], counts)
            seen[values] += counts
            before = full + np.cumsum(whole) - whole
            full += int(whole.sum())
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), pa.array(np.full(len(rest), part, np.int32)), pa.array(rest.astype(np.int32)),
                pa.array(rank), pa.array(whole), pa.array(before)], names=["row", "part", "rest", "rank", "whole", "before"])

    return run


def assigned(plan: Plan, rank_at: dict[tuple[int, int], int], full_at: dict[int, int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "ids", 4 << 20):
            cols = {name: batch.column(name).to_pylist() for name in ("doc_id", "doc_tokens", "width", "ids", "part", "rest", "rank", "before")}
            out: list[tuple] = []
            for doc, tokens, width, ids, part, rest, rank, before in zip(*cols.values()):
                values = np.frombuffer(ids, np.uint16 if width == 2 else np.uint32).astype("<u4")
                for start, n, sequence, offset in plan.pieces(tokens, rank + rank_at[part, rest], before + full_at[part]):
                    out.append((doc, start, n, zlib.crc32(values[start:start + n].tobytes()), tokens, sequence, offset))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            columns = list(zip(*out)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    `tokenizer` is the path of a word-wise tokenizer file. A document is its ids and `end_id`; a
    null or empty text is `end_id` alone. Every id lies in one piece; every sequence is gapless from
    offset 0 and holds `capacity` ids, but for the last few, which hold a power of two each.

    Rows are packed one by one: repeated ids, null ids and repeated rows each take their own place.
    Documents of one remainder length are ranked by id. Other columns are ignored; an empty table
    gives an empty table.

    The driver sees counts only: at most `capacity` lengths plus one row per partition.
    """
    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tokens = written(texts.mapInArrow(
        tokens_of(tokenizer, end_id), "row long, doc_id long, doc_tokens long, width int, ids binary"), "pack-tokens")
    sizes = tokens.select("row", "doc_id", "doc_tokens", (F.col("doc_tokens") % capacity).alias("rest"))
    places = written(
        sizes.repartitionByRange("rest", "doc_id", "row").sortWithinPartitions("rest", "doc_id", "row").drop("rest")
        .mapInArrow(ranked(capacity), "row long, part int, rest int, rank long, whole long, before long"), "pack-ranks")
    found = places.groupBy("part", "rest").agg(F.count("*").alias("n"), F.sum("whole").alias("whole")).collect()
    histogram, rank_at, whole_of = np.zeros(capacity, np.int64), {}, {}
    for r in sorted(found, key=lambda r: (r["part"], r["rest"])):
        rank_at[r["part"], r["rest"]] = int(histogram[r["rest"]])
        histogram[r["rest"]] += r["n"]
        whole_of[r["part"]] = whole_of.get(r["part"], 0) + r["whole"]
    full, full_at = 0, {}
    for part in sorted(whole_of):
        full_at[part] = full
        full += whole_of[part]
    histogram[0] = 0
    plan = Plan.of(histogram, full, capacity)
    return tokens.join(places, "row").mapInArrow(
        assigned(plan, rank_at, full_at),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
