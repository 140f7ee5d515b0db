"""Importance resampling towards a target distribution of hashed n-grams, in Arrow kernels.

Texts are lower-cased, split and flattened to one dictionary-encoded word column; runs of words are shifted
dictionary indices. The CRC of a longer run follows from the CRC of the run without its last word and that of
the word, once per distinct pair. Bucket counts of all documents and of the target give every bucket a gain; a document's
weight is the mean gain of its runs, and seeded Gumbel noise on top draws without replacement.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamepulse.llm.common import blocks, numbered, small_batches, written

#: What lies between words, after lower-casing: all ASCII but digits and letters.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _crc_tables() -> np.ndarray:
    """Tables that pass a CRC-32 over 2^k zero bytes: [k, byte of the register, its value]."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = (one >> 1) ^ np.where(one & 1, np.uint32(0xEDB88320), np.uint32(0))
    step = lambda c: one[c & 0xFF] ^ (c >> np.uint32(8))
    spread = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    tables = [step(spread)]
    for _ in range(31):
        tables.append(_pass(tables[-1], tables[-1]))
    return np.stack(tables)


def _pass(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 0xFF] ^ table[1][crc >> 8 & 0xFF] ^ table[2][crc >> 16 & 0xFF] ^ table[3][crc >> 24]


CRC_TABLES = _crc_tables()


def crc_joined(left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of two strings in a row from theirs and the second's length in bytes."""
    out = left.astype(np.uint32)
    for k in range(int(length.max(initial=0)).bit_length()):
        at = np.flatnonzero(length >> k & 1)
        out[at] = _pass(CRC_TABLES[k], out[at])
    return out ^ right


def run_buckets(texts: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs of 1 to `longest` words, text by text, and the first run of every text (n+1 values).

    Within a text, runs of one word come first, then those of two, and so on.
    """
    # Lower-cased before the cast: pyarrow 23 lower-cases the wrong bytes of a slice that was cast to large strings.
    lists = pc.split_pattern_regex(pc.ascii_lower(texts).cast(pa.large_string()).fill_null(""), GAPS)
    flat, offsets = pc.list_flatten(lists), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    first = np.concatenate([[0], np.cumsum(full)])[offsets]
    words = flat.filter(pa.array(full)).dictionary_encode()
    index, known = words.indices.to_numpy().astype(np.int64), words.dictionary
    size = pc.binary_length(known).to_numpy()
    alone = np.array([zlib.crc32(w) for w in known.cast(pa.large_binary()).to_pylist()], np.uint32)
    spaced = crc_joined(np.full(len(known), zlib.crc32(b" "), np.uint32), alone, size)
    crc, runs = alone[index], index  # of the runs that begin at each word; runs are numbered by their distinct values
    found, crcs = [crc], alone
    for n in range(2, longest + 1):
        pairs = runs[:-1] * len(known) + index[n - 1:] if len(index) >= n else np.zeros(0, np.int64)
        distinct, runs = np.unique(pairs, return_inverse=True)
        before, last = np.divmod(distinct, max(len(known), 1))
        crcs = crc_joined(crcs[before], spaced[last], size[last] + 1)
        found.append(crcs[runs])
    counts = np.stack([np.maximum(np.diff(first) - n, 0) for n in range(longest)])
    ends = np.concatenate([[0], np.cumsum(counts.sum(axis=0))])
    out = np.empty(int(ends[-1]), np.int64)
    begin = ends[:-1].copy()
    for crc, count in zip(found, counts):
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        out[np.repeat(begin, count) + within] = crc[np.repeat(first[:-1], count) + within] % buckets
        begin += count
    return out, ends


def _counts(longest: int, buckets: int) -> Callable:
    """Per task the used buckets with their number of runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for block in blocks(batches, "text", 4 << 20):
            total += np.bincount(run_buckets(block.column("text"), longest, buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, longest: int, buckets: int, text_col: str = "text") -> np.ndarray:
    """How many runs of all texts fall into each bucket; `buckets` numbers reach the driver."""
    parts = small_batches(texts).select(F.col(text_col).alias("text")).mapInArrow(_counts(longest, buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """floor(scale * ln of the ratio of smoothed shares, target to raw) per bucket."""
    size, s, t = float(len(raw)), float(raw.sum()), float(target.sum())
    return np.array([
        math.floor(scale * math.log((b + 1.0) * (s + size) / ((a + 1.0) * (t + size)))) for a, b in zip(raw.tolist(), target.tolist())], np.int64)


def _weights(longest: int, gains: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", 4 << 20):
            found, ends = run_buckets(block.column("text"), longest, len(gains))
            sums = np.concatenate([[0], np.cumsum(gains.take(found))])[ends]
            n = np.diff(ends)
            words = -(-(n + longest * (longest - 1) // 2) // longest)  # exact from `longest` words on
            weight = np.where(n > 0, np.floor_divide(np.diff(sums), np.maximum(n, 1)), 0)
            yield pa.RecordBatch.from_arrays([block.column("id"), pa.array(n), pa.array(words), pa.array(weight)], names=["id", "n_features", "words", "weight"])

    return run


def resample(
    docs: DataFrame, target: DataFrame, longest: int = 2, buckets: int = 10_000, percent: int = 25, min_words: int = 20, seed: int = 7,
    id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
) -> DataFrame:
    """Per row of docs: id, n_features, weight, score and rank (null: not drawn), all long.

    Features are all runs of 1 to `longest` words, hashed into buckets by CRC-32. A bucket's gain compares its share
    of the target's runs with its share of all documents' runs. The weight is the floored mean gain; the score adds Gumbel
    noise from a seeded hash of the id. Of the documents with at least `min_words` words, `percent` percent (rounded down)
    with the highest scores are drawn (ties: smaller id) and ranked from 1.

    Null and empty texts have no features and weight 0; a row without id hashes as an empty id; repeated rows are each
    weighted and may each be drawn; an empty target gains by smoothing alone; an empty table gives an empty table; other
    columns are ignored. `min_words` must be at least `longest`.

    Texts are read twice and never shuffled; only ids and scores of documents long enough are ordered.
    """
    gains = bucket_gains(bucket_counts(docs, longest, buckets, text_col), bucket_counts(target, longest, buckets, target_text))
    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    scored = written(
        texts.mapInArrow(_weights(longest, gains), "id long, n_features long, words long, weight long").withColumn("score", F.col("weight") + noise), "importance")
    ranked = numbered(scored.filter(F.col("words") >= min_words), [F.col("score").desc(), F.col("id")])
    drawn = F.when(F.col("rank") < F.floor(F.col("of") * percent / 100), F.col("rank") + 1).cast("long").alias("rank")
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    return ranked.select(*columns, drawn).union(scored.filter(F.col("words") < min_words).select(*columns, F.lit(None).cast("long").alias("rank")))
