"""Approximate nearest neighbours on shifted space-filling curves.

Vectors are projected to a few dimensions by several random rotations, shifted, and ordered
along a Hilbert curve each. Spark range-partitions every order and numbers it; a query meets the
vectors within a window of places around its own on every curve. Each curve gives its best, and
the lists are merged and ranked by the exact inner product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamepulse.llm.common import written


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of integer points (0 … 2^bits - 1 per dimension) on the Hilbert curve.

    Undoes the curve's rotations bit by bit from the top, then Gray-codes across the dimensions.
    """
    x = points.astype(np.uint64).T.copy()
    dims = len(x)
    zero = np.uint64(0)
    for b in range(bits - 1, 0, -1):
        low = np.uint64((1 << b) - 1)
        for i in range(dims):
            set_here = (x[i] >> np.uint64(b)) & np.uint64(1) != 0
            swap = np.where(set_here, zero, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_here, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> np.uint64(b)) & np.uint64(1) != 0, np.uint64((1 << b) - 1), zero)
    x ^= flip
    key = np.zeros_like(flip)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << np.uint64(1) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return key


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)).astype(np.float64)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total, square = 0, 0.0, 0.0
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column("embedding"))
            n, total, square = n + len(x), total + x.sum(axis=0), square + x.T @ x
    if n:
        yield pa.RecordBatch.from_pydict({"n": [n], "total": [total.tolist()], "square": [square.ravel().tolist()]})


def _placed(rotations: np.ndarray, means: np.ndarray, spreads: np.ndarray, shifts: np.ndarray, bits: int):
    """One row per vector and curve with its key; coordinates cover four standard deviations."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("embedding"))
            for c, turn in enumerate(rotations):
                unit = ((x @ turn - means[c]) / spreads[c] + 4) / 16 + shifts[c]
                key = hilbert_keys(np.clip(unit * (1 << bits), 0, (1 << bits) - 1).astype(np.int64), bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), c, np.int32)), pa.array(key.astype(np.int64)), batch.column("rep"), batch.column("asks"), batch.column("embedding")],
                    names=["curve", "key", "rep", "asks", "embedding"])

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("curve", "rep", "asks", "embedding")]
            + [pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(np.arange(n, n + batch.num_rows))],
            names=["curve", "rep", "asks", "embedding", "part", "local"])
        n += batch.num_rows


def _best(k: int, window: int):
    """The k best of a block for every query that reaches into it."""
    def run(block: pd.DataFrame) -> pd.DataFrame:
        query = block["query"].to_numpy()
        x = np.stack(block["embedding"].to_numpy()).astype(np.float64)
        rank, rep = block["rank"].to_numpy(), block["rep"].to_numpy()
        mine, asked = np.flatnonzero(~query), np.flatnonzero(query)
        out = []
        for part in np.array_split(asked, len(asked) // 256 + 1):
            if not len(part) or not len(mine):
                continue
            scores = x[part] @ x[mine].T
            scores[np.abs(rank[part][:, None] - rank[mine][None, :]) > window] = -np.inf
            cut = np.partition(scores, -k, axis=1)[:, -k] if len(mine) > k else np.full(len(part), -np.inf)
            for q, row, low in zip(part, scores, cut):
                # The matrix product rounds by the shape of the block; row by row, a pair has one score everywhere.
                at = np.flatnonzero((row >= low - 1e-9 * abs(low)) & np.isfinite(row)) if np.isfinite(low) else np.flatnonzero(np.isfinite(row))
                score = (x[mine[at]] * x[q]).sum(axis=1)
                best = np.lexsort((rep[mine[at]], -score))[:k]
                out.append(pd.DataFrame({"query_rep": rep[q], "rep": rep[mine[at[best]]], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_rep": [], "rep": [], "score": []})

    return run


def nearest(
    vectors: DataFrame, is_query: Column | str, k: int = 20, curves: int = 16, dims: int = 6, bits: int = 10,
    window_share: float = 0.05, min_window: int = 256, block_rows: int = 4096, group_queries: int = 8192, seed: int = 3,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products found, in double precision.

    Queries are the rows where `is_query` holds; candidates all rows but those with the query's
    id. Equal scores go to the smaller id. The window is window_share of the different vectors to
    each side, at least min_window: for vectors without structure in 64 dimensions a smaller share
    does not reach 0.9 recall. One group of work is a block of a curve, block_rows vectors, and about
    group_queries of the queries within reach, however many reach it: they are dealt by a hash, and
    the block is sent once to each deal.

    Left out: null vectors, those with a null or non-finite part, all-zero ones, rows without id, and
    those of another length than the commonest. Repeated rows count once. Equal vectors are
    searched once; only the k + 1 smallest ids of one vector can be in a result, so the rest of a large
    group of copies is never joined. Other columns are ignored; an empty table gives an empty one.
    """
    spark = vectors.sparkSession
    e = F.col("embedding")
    ok = (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    asks = F.expr(is_query) if isinstance(is_query, str) else is_query
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"), asks.alias("asks")).filter(
        F.col("vec_id").isNotNull() & e.isNotNull() & ok)
    schema = "query_id long, rank int, vec_id long, score double"
    lengths = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("embedding") == lengths["d"])
    groups = written(rows.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.max("asks").alias("asks")), "ann-vectors")
    copies = written(rows.join(groups.select("embedding", "rep"), "embedding").select("vec_id", "rep", "asks").distinct(), "ann-copies")

    parts = groups.mapInArrow(_moments, "n long, total array<double>, square array<double>").collect()  # d * d numbers per task
    n, d = sum(p["n"] for p in parts), lengths["d"]
    mean = sum(np.array(p["total"]) for p in parts) / n
    cov = sum(np.array(p["square"]) for p in parts).reshape(d, d) / n - np.outer(mean, mean)
    rng = np.random.default_rng(seed)
    dims = min(dims, d)
    turns = np.stack([np.linalg.qr(rng.normal(size=(d, dims)))[0] for _ in range(curves)])
    spreads = np.stack([np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", t, cov, t), 1e-12)) for t in turns])
    shifts = rng.random((curves, dims)) * 0.5
    window = max(min_window, int(np.ceil(window_share * n)))

    order = groups.mapInArrow(_placed(turns, mean @ turns, spreads, shifts, bits), "curve int, key long, rep long, asks boolean, embedding " + groups.schema["embedding"].dataType.simpleString())
    ranked = written(
        order.repartitionByRange("curve", "key", "rep").sortWithinPartitions("curve", "key", "rep").mapInArrow(
            _counted, f"curve int, rep long, asks boolean, embedding {groups.schema['embedding'].dataType.simpleString()}, part int, local long"), "ann-order")
    sizes = {r["part"]: r["n"] for r in ranked.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one row per partition
    starts, total = {}, 0
    for part in sorted(sizes):
        starts[part] = total
        total += sizes[part]
    at = F.create_map(*[F.lit(int(v)) for kv in starts.items() for v in kv])
    ranked = ranked.withColumn("rank", at[F.col("part")] + F.col("local") - F.col("curve") * F.lit(n))  # each curve has n places
    reach = -(-window // block_rows)
    own = F.floor(F.col("rank") / block_rows).cast("int")
    loads = ranked.groupBy("curve", own.alias("block")).agg(F.sum(F.col("asks").cast("long")).alias("asking"))  # a row per block
    within = Window.partitionBy("curve").orderBy("block").rangeBetween(-reach, reach)
    deals = loads.select("curve", "block", F.greatest(F.lit(1), F.ceil(F.sum("asking").over(within) / group_queries)).cast("int").alias("deals"))
    deals = written(deals, "ann-deals")
    last = (n - 1) // block_rows
    base = ranked.select("curve", own.alias("block"), "rank", "rep", "embedding", F.lit(False).alias("query")).join(deals, ["curve", "block"])
    base = base.withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)))
    asked = ranked.filter("asks").select(
        "curve", F.explode(F.sequence(F.greatest(own - reach, F.lit(0)), F.least(own + reach, F.lit(last)))).alias("block"), "rank", "rep", "embedding",
        F.lit(True).alias("query")).join(deals, ["curve", "block"])
    asked = asked.withColumn("deal", F.pmod(F.xxhash64("rep"), F.col("deals")).cast("int"))
    found = base.union(asked).drop("deals").groupBy("curve", "block", "deal").applyInPandas(_best(k + 1, window), "query_rep long, rep long, score double")
    by_query = Window.partitionBy("query_rep").orderBy(F.col("score").desc(), "rep")
    merged = (
        found.groupBy("query_rep", "rep").agg(F.max("score").alias("score"))
        .withColumn("place", F.row_number().over(by_query)).filter(F.col("place") <= k + 1).drop("place")
    )
    few = copies.withColumn("place", F.row_number().over(Window.partitionBy("rep").orderBy("vec_id"))).filter(F.col("place") <= k + 1).select("rep", "vec_id")
    queries = copies.filter("asks").select(F.col("vec_id").alias("query_id"), F.col("rep").alias("query_rep"))
    answers = queries.join(merged, "query_rep").join(few, "rep").filter("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return answers.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
