"""N-gram Jaccard join with vertical partitioning.

All n-grams have one global order: rare ones first, by counts of their hash buckets over all
documents. Two sets over the threshold share an n-gram of the first fragment of that order (the
prefix of either), so that fragment alone finds who can meet. The rest of the order is cut into
fragments whose differences are bounded from below one by one: where the sizes of a fragment differ
in parity, an n-gram differs. The sum over the fragments rules out most pairs that meet. Pairs
that are left connect documents into candidate clusters. A cluster, or for a large one
each pair of its chunks, is one unit of work: every fragment of the order counts its partial
overlaps by itself, and the counts are summed per pair. Only spanning forests leave a task, so a large group is
never written out as pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamepulse.llm.common import blocks, small_batches, written
from gamepulse.llm.components import connected
from gamepulse.llm.hashing import shingle_sets

BUCKET_BITS = 20
SLICE = 4096  # bucket counts travel in runs of this many


def prefix_size(n: int, percent: int) -> int:
    """How many first n-grams of a set must contain one that any similar set has among its own first."""
    return n - -(-percent * n // 100) + 1 if n else 0


def parities(grams: np.ndarray) -> bytes:
    """One bit per fine fragment (a hash range): whether the set has an odd number of n-grams in it.

    About as many fragments as n-grams, a power of two from 64 to 32,768, so that halving fits
    a longer one to a shorter.
    """
    bits = min(max(64, 1 << (max(len(grams), 1) - 1).bit_length()), 1 << 15)
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(x: int, bits: int, to: int) -> int:
    while bits > to:
        bits //= 2
        x = (x ^ (x >> bits)) & ((1 << bits) - 1)
    return x


def _buckets(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _profiles(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n", "key", "parity", "slice", "counts"]
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        for block in blocks(batches, "text", 4 << 20):
            sets = shingle_sets(block.column("text"), n)
            counts += np.bincount(_buckets(np.concatenate(sets)), minlength=len(counts))
            keys = [hashlib.md5(s.tobytes()).digest() for s in sets]
            none = pa.nulls(len(sets))
            yield pa.RecordBatch.from_arrays([
                block.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                pa.array([parities(s) for s in sets], pa.binary()), none.cast(pa.int32()), none.cast(pa.binary())], names=names)
        parts = counts.reshape(-1, SLICE)
        used = np.flatnonzero(parts.any(axis=1))
        none = pa.nulls(len(used))
        yield pa.RecordBatch.from_arrays([
            none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.binary()), none.cast(pa.binary()), pa.array(used.astype(np.int32)),
            pa.array([np.minimum(parts[i], 2**31 - 1).astype(np.int32).tobytes() for i in used], pa.binary())], names=names)

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the bucket counts of one slice, batch after batch."""
    total, own = np.zeros(SLICE, np.int64), None
    for batch in batches:
        own = batch.column("slice")[0].as_py()
        for counts in batch.column("counts"):
            total += np.frombuffer(counts.as_buffer(), np.int32)
    yield pa.RecordBatch.from_pydict({"slice": pa.array([own], pa.int32()), "total": pa.array([total.tolist()], pa.list_(pa.int64()))})


def _prefixes(n: int, percent: int, order: np.ndarray, hot: int):
    """(gram, salt, id, many) for the prefix of every distinct set of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for block in blocks(batches, "text", 4 << 20):
            grams, ids = [], []
            for doc, grams_of in zip(block.column("id").to_pylist(), shingle_sets(block.column("text"), n)):
                key = hashlib.md5(grams_of.tobytes()).digest()
                if key in seen or not len(grams_of):
                    continue
                if len(seen) < 100_000:  # about 10 MB
                    seen.add(key)  # copies beyond these are met like other documents
                k = prefix_size(len(grams_of), percent)
                rank = order[_buckets(grams_of)]
                if k < len(grams_of):
                    cut = np.partition(rank, k - 1)[k - 1]
                    sure, edge = grams_of[rank < cut], grams_of[rank == cut]
                    grams_of = np.concatenate([sure, edge[:k - len(sure)]])  # grams are sorted, so ties go by hash
                grams.append(grams_of)
                ids.append(np.full(len(grams_of), doc, np.int64))
            if grams:
                own, who = np.concatenate(grams), np.concatenate(ids)
                parts = order[_buckets(own)] // hot + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.view(np.int64)), pa.array((who % parts).astype(np.int32)), pa.array(who), pa.array(parts > 1)],
                    names=["gram", "salt", "id", "many"])

    return run


def plausible(sizes: np.ndarray, marks: list[bytes], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets whose sizes and fragment parities allow the threshold."""
    room = lambda total: total * (100 - percent)  # noqa: E731  (100 + percent) * largest difference
    bits = np.array([8 * len(m) for m in marks], np.int64)
    if len(marks) <= 8:
        numbers, widths, out = [int.from_bytes(m, "little") for m in marks], bits.tolist(), []
        for i in range(len(marks)):
            for j in range(i + 1, len(marks)):
                to, total = min(widths[i], widths[j]), int(sizes[i] + sizes[j])
                apart = max((_folded(numbers[i], widths[i], to) ^ _folded(numbers[j], widths[j], to)).bit_count(), abs(int(sizes[i] - sizes[j])))
                if apart * (100 + percent) <= room(total):
                    out.append((i, j))
        return tuple(np.array(out, np.int64).reshape(-1, 2).T)
    rows, cols = [], []
    for to in np.unique(bits):
        mine, other = np.flatnonzero(bits == to), np.flatnonzero((bits >= to) & (bits * percent < 200 * to))  # widths differ less than twice as much as sizes
        width = max(int(to) // 64, 1)

        def matrix(at: np.ndarray) -> np.ndarray:
            return np.stack([
                np.frombuffer(_folded(int.from_bytes(marks[i], "little"), int(bits[i]), int(to)).to_bytes(width * 8, "little"), np.uint64) for i in at])

        right = matrix(other)
        for part in np.array_split(mine, len(mine) // 256 + 1):
            if not len(part):
                continue
            apart = np.abs(sizes[part][:, None] - sizes[other][None, :])
            total = sizes[part][:, None] + sizes[other][None, :]
            odd = np.zeros(apart.shape, np.int64)
            left = matrix(part)
            for w in range(width):
                odd += np.bitwise_count(left[:, w][:, None] ^ right[:, w][None, :])
            i, j = np.nonzero((np.maximum(odd, apart) * (100 + percent) <= room(total)) & (part[:, None] != other[None, :]))
            rows.append(part[i])
            cols.append(other[j])
    return np.concatenate(rows), np.concatenate(cols)


def _met(few: int):
    """Runs of one (gram, salt) in a sorted partition: pairs of at most `few` documents, else the rows.

    Single documents are left out, but for grams that are dealt over several salts.
    """
    def split(gram: np.ndarray, salt: np.ndarray, doc: np.ndarray, many: np.ndarray) -> pa.RecordBatch:
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (salt[1:] != salt[:-1])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(gram)))
        pairs = [np.zeros((0, 2), np.int64)]
        for size in range(2, few + 1):
            at = starts[(sizes == size) & ~many[starts]]
            pairs += [np.stack([doc[at + i], doc[at + j]], axis=1) for i in range(size) for j in range(i + 1, size)]
        pairs = np.unique(np.concatenate(pairs), axis=0)
        whole = np.repeat((sizes > few) | many[starts], sizes)
        none = pa.nulls(len(pairs), pa.int64())
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([none, pa.array(gram[whole])]), pa.concat_arrays([pa.array(pairs[:, 0]), pa.array(doc[whole])]),
            pa.concat_arrays([pa.array(pairs[:, 1]), pa.nulls(int(whole.sum()), pa.int64())])], names=["gram", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("gram", "salt", "id", "many")]
            if kept:
                columns = [np.concatenate(x) for x in zip(kept, columns)]
            if not len(columns[0]):
                continue
            end = len(columns[0]) - 1  # the last run may go on
            while end and columns[0][end - 1] == columns[0][-1] and columns[1][end - 1] == columns[1][-1]:
                end -= 1
            if len(columns[0]) - end > 1_000_000:  # a salt of a very frequent gram leaves in parts, whole in all
                columns[3][end:] = True
                end = len(columns[0])
            if end:
                yield split(*[c[:end] for c in columns])
            kept = [c[end:] for c in columns]
        if kept and len(kept[0]):
            yield split(*kept)

    return run


def _plausible_pairs(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for a, b, n, m, p, q in zip(*[batch.column(c).to_pylist() for c in ("a", "b", "n", "m", "p", "q")]):
                if len(plausible(np.array([n, m]), [p, q], percent)[0]):
                    found.append((a, b))
            yield _edge_batch(found)

    return run


def _candidates(percent: int):
    """Spanning forests of the plausible pairs of every (gram, i, j) run of a sorted partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.setdefault(x, x)) != x:
                root[x] = root[up]
                x = up
            return x

        def links(rows: list[tuple[int, int, bytes]]) -> list[tuple[int, int]]:
            out = []
            if len({find(r[0]) for r in rows}) == 1:
                return out
            a, b = plausible(np.array([r[1] for r in rows]), [r[2] for r in rows], percent)
            for x, y in zip(a.tolist(), b.tolist()):
                p, q = find(rows[x][0]), find(rows[y][0])
                if p != q:
                    root[max(p, q)] = min(p, q)
                    out.append((rows[x][0], rows[y][0]))
            return out

        held, unit = [], None
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("gram", "i", "j", "id", "n", "parity")]
            for gram, i, j, doc, n, parity in zip(*columns):
                if (gram, i, j) != unit:
                    found += links(held)
                    held, unit = [], (gram, i, j)
                held.append((doc, n, parity))
            if len(root) > 200_000:  # about 20 MB; forgetting repeats links, it loses none
                root.clear()
            yield _edge_batch(found)
        yield _edge_batch(links(held) if held else [])

    return run


def _edge_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])


def overlaps(sets: list[np.ndarray], ranks: list[np.ndarray], fragments: int) -> np.ndarray:
    """Sizes of the pairwise intersections: partial counts of each fragment of the order, summed."""
    k = len(sets)
    grams, who = np.concatenate(sets), np.repeat(np.arange(k), [len(s) for s in sets])
    order = np.lexsort((who, grams, np.concatenate(ranks)))
    grams, who = grams[order], who[order]
    starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    sizes = np.diff(np.append(starts, len(grams)))
    starts, sizes = starts[sizes > 1], sizes[sizes > 1]
    total = np.zeros((k, k), np.float32)
    weight = np.cumsum(sizes)
    bounds = np.searchsorted(weight, weight[-1] * np.arange(1, fragments + 1) / fragments - 0.5) + 1 if len(sizes) else []
    begin = 0
    for end in bounds:
        for a in range(begin, min(end, len(starts)), 2048):
            s, z = starts[a:min(a + 2048, end)], sizes[a:min(a + 2048, end)]
            held = np.zeros((k, len(s)), np.float32)
            at = np.repeat(s - np.concatenate([[0], np.cumsum(z)[:-1]]), z) + np.arange(z.sum())
            held[who[at], np.repeat(np.arange(len(s)), z)] = 1
            rows = np.flatnonzero(held.any(axis=1))
            if len(rows) < k:
                total[np.ix_(rows, rows)] += held[rows] @ held[rows].T
            else:
                total += held @ held.T
        begin = max(begin, end)
    return total


def _forest(a: np.ndarray, b: np.ndarray, k: int) -> list[tuple[int, int]]:
    root = list(range(k))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _links(n: int, percent: int, order: np.ndarray, fragments: int):
    def run(unit: pd.DataFrame) -> pd.DataFrame:
        sets = shingle_sets(pa.array(unit["text"], pa.string()), n)
        ids = unit["id"].to_numpy()
        size = np.array([len(s) for s in sets], np.float64)
        both = overlaps(sets, [order[_buckets(s)] for s in sets], fragments)
        a, b = np.nonzero(np.triu(100 * both >= percent * (size[:, None] + size[None, :] - both), 1))
        return pd.DataFrame([(ids[x], ids[y]) for x, y in _forest(a, b, len(sets))], columns=["a", "b"]).astype("int64")

    return run


def jaccard_components(
    docs: DataFrame, n: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text",
    fragments: int = 4, few: int = 8, unit_docs: int = 1024, unit_grams: int = 1 << 19, hot: int = 20_000,
) -> DataFrame:
    """Per input row: id, n_shingles and component_id, for links of Jaccard similarity >= percent / 100.

    A set holds the distinct runs of n words (A-Z lower-cased, cut at ASCII white space); a shorter
    text is one run. Sets are compared by 64-bit hashes. Defined cases: a null, empty or blank
    text has no shingles and no links; rows with one id count as linked; a row without id has a null
    component; repeated rows give repeated results; an empty table an empty one. Other columns
    are ignored.

    Up to `few` documents with a prefix n-gram in common are written as pairs, more as rows.
    Bounds: the global order is 2^20 numbers; a unit has about 2 * unit_docs documents or 2 * unit_grams
    shingles (one document may be longer). N-grams in buckets counted more than `hot` times are dealt
    over several tasks. None of these changes the result.
    """
    spark = docs.sparkSession
    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    profiles = written(texts.mapInArrow(_profiles(n), "id long, n long, key binary, parity binary, slice int, counts binary"), "ngram-profiles")
    order = np.zeros(1 << BUCKET_BITS, np.int64)
    for r in profiles.filter("slice is not null").select("slice", "counts").groupBy("slice").applyInArrow(_summed, "slice int, total array<long>").collect():
        order[r["slice"] * SLICE:(r["slice"] + 1) * SLICE] = r["total"]
    shared = spark.sparkContext.broadcast(order)  # 2^20 numbers, whatever the table holds
    order_of = _Shared(shared)

    rows = profiles.filter("slice is null").select("id", "n", "key", "parity")
    reps = rows.filter("n > 0 and id is not null").groupBy("key").agg(F.min("id").alias("rep"))
    copies = written(rows.filter("n > 0 and id is not null").join(reps, "key").select("id", "rep", "n", "parity").distinct(), "ngram-copies")
    same = copies.filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))

    prefixes = texts.filter("id is not null").mapInArrow(_late(_prefixes, order_of, n, percent, hot), "gram long, salt int, id long, many boolean")
    met = written(
        prefixes.repartition("gram", "salt").sortWithinPartitions("gram", "salt", "id").mapInArrow(_met(few), "gram long, a long, b long"), "ngram-met")
    size = copies.select(F.col("id").alias("a"), F.col("rep").alias("ra"), F.col("n"), F.col("parity").alias("p"))
    other = size.toDF("b", "rb", "m", "q")
    two = (
        met.filter("gram is null").select("a", "b").distinct().join(size, "a").join(other, "b").filter("ra <> rb")
        .filter(F.least("n", "m") * 100 >= F.greatest("n", "m") * percent)
        .select(F.col("ra").alias("a"), F.col("rb").alias("b"), "n", "m", "p", "q").mapInArrow(_plausible_pairs(percent), "a long, b long")
    )
    met = met.filter("gram is not null").select("gram", "a").join(size, "a").select("gram", F.col("ra").alias("id"), "n", F.col("p").alias("parity")).distinct()
    large = met.groupBy("gram").agg(F.count("*").alias("m")).filter(F.col("m") > 2 * unit_docs).select(
        "gram", F.ceil(F.col("m") / unit_docs).cast("int").alias("chunks"))
    chunks = F.coalesce("chunks", F.lit(1))
    part = F.pmod(F.xxhash64("id"), chunks).cast("int")
    met = met.join(large, "gram", "left").withColumn("own", part).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1))).select(
        "gram", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "n", "parity")
    maybe = met.repartition("gram", "i", "j").sortWithinPartitions("gram", "i", "j", "n", "id").mapInArrow(_candidates(percent), "a long, b long")
    clusters = written(connected(maybe.union(two)), "ngram-clusters")

    members = clusters.join(
        copies.filter("id = rep").groupBy(F.col("id").alias("node")).agg(F.max("n").alias("n"), F.count("*").alias("texts")), "node")
    sizes = members.groupBy("component").agg(F.sum("texts").alias("m"), F.sum("n").alias("grams")).filter("m > 1").select(
        "component", F.ceil(F.greatest(F.col("m") / unit_docs, F.col("grams") / unit_grams)).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    units = members.join(sizes, "component").withColumn("own", own).select(
        "node", "component", "own", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")).select(
        "node", "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    links = (
        texts.join(units, texts["id"] == units["node"]).select("component", "i", "j", "id", "text")
        .groupBy("component", "i", "j").applyInPandas(_late(_links, order_of, n, percent, fragments), "a long, b long")
    )
    linked = connected(links.union(same)).withColumnRenamed("component", "component_id")
    joined = rows.join(linked, rows["id"] == linked["node"], "left")
    return joined.select("id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")).withColumnRenamed("id", id_col)


class _Shared:
    """The broadcast order, read in the task."""

    def __init__(self, broadcast):
        self.broadcast = broadcast


def _late(make, order: _Shared, n: int, percent: int, last: int):
    """A task function built in the task, where the order can be read."""
    broadcast = order.broadcast

    def run(data):
        return make(n, percent, broadcast.value, last)(data)

    return run
