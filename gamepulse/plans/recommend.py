"""Game recommendations from downloads: co-download counts and matrix factorisation."""

import gc
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import inheritable_thread_target
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gamepulse.operators.ordering import COPIES, dense_numbers, expand_copies
from gamepulse.session import enable_checkpoints

# List lengths and the search grid.
CO_DOWNLOAD_TOP, ALS_TOP = 80, 60
ALS_RANKS, ALS_REG, ALS_ITERATIONS = (5, 10), (0.01, 0.1), (10, 25)
TRAIN_SHARE = 0.8
BASKET_CHUNK = 256
USER_BLOCKS, ITEM_BLOCKS, BLOCK_RATINGS = 10, 3, 1 << 23
FITS_AT_ONCE = 4
OWNER_CHUNK, GAME_BLOCK, SCORES = 1 << 15, 4096, 1 << 22


def device_baskets(downloads: DataFrame) -> DataFrame:
    """(games, devices): each distinct set of two or more games and how many devices have it.

    A device's set holds each game once, so the game catalogue bounds it, however many
    download lines the device has. Devices with equal sets become one row here.
    """
    owned = downloads.select("imei", "game_id").filter(F.col("imei").isNotNull() & F.col("game_id").isNotNull())
    sets = owned.distinct().groupBy("imei").agg(F.array_sort(F.collect_list("game_id")).alias("games"))
    return sets.filter(F.size("games") > 1).groupBy("games").agg(F.count(F.lit(1)).alias("devices"))


def co_download_counts(downloads: DataFrame, chunk: int = BASKET_CHUNK) -> DataFrame:
    """(game_id, game_id_rs, download_num): devices that downloaded both games.

    Works on distinct baskets weighted by their devices and on ordered pairs only; both
    directions are restored after the counts are final. Pairs are counted in the stage that
    forms them. A basket above `chunk` games is cut into pairs of chunks that are spread
    over the tasks, so no task handles a large basket alone.
    """
    baskets = device_baskets(downloads)
    size = F.size("games")
    head = baskets.filter(size <= chunk).select("devices", "games", F.posexplode("games").alias("i", "a"))
    small = head.select("devices", "a", F.explode(F.slice("games", F.col("i") + 2, F.lit(chunk))).alias("b"))
    last = F.floor((size - 1) / chunk).cast("int")
    cut = (
        baskets.filter(size > chunk)
        .select("devices", "games", last.alias("last"), F.explode(F.sequence(F.lit(0), last)).alias("p"))
        .select("devices", "games", "p", F.explode(F.sequence("p", "last")).alias("q"))
        .select(
            "devices",
            F.slice("games", F.col("p") * chunk + 1, F.lit(chunk)).alias("left"),
            F.slice("games", F.col("q") * chunk + 1, F.lit(chunk)).alias("right"),
        )
        .repartition("left", "right")
    )
    large = (
        cut.select("devices", "right", F.explode("left").alias("a"))
        .select("devices", "a", F.explode("right").alias("b"))
        .filter(F.col("a") < F.col("b"))
    )
    pairs = small.unionByName(large).groupBy("a", "b").agg(F.sum("devices").alias("download_num"))
    both = F.array(
        F.struct(F.col("a").alias("game_id"), F.col("b").alias("game_id_rs")),
        F.struct(F.col("b").alias("game_id"), F.col("a").alias("game_id_rs")),
    )
    return pairs.select("download_num", F.inline(both)).select("game_id", "game_id_rs", "download_num")


def _pipe_list(ranked: DataFrame) -> DataFrame:
    """Rows (game_id, rn, game_id_rs) to one `|`-joined list per game in rank order."""
    items = F.array_sort(F.collect_list(F.struct("rn", F.col("game_id_rs").cast("string").alias("id"))))
    return ranked.groupBy("game_id").agg(F.concat_ws("|", F.transform(items, lambda x: x["id"])).alias("game_id_rs"))


def co_download_topk(counts: DataFrame, k: int = CO_DOWNLOAD_TOP, ranking: str = "most") -> DataFrame:
    """The k games most often downloaded together with each game, best first.

    `ranking="text"` orders by the text `<count>_<game>` ascending instead, as older lists do.
    """
    orders = {
        "most": [F.col("download_num").desc(), F.col("game_id_rs")],
        "text": [F.concat_ws("_", "download_num", "game_id_rs")],
    }
    rn = F.row_number().over(Window.partitionBy("game_id").orderBy(*orders[ranking]))
    return _pipe_list(counts.withColumn("rn", rn).filter(F.col("rn") <= k))


def head_pairs(baskets: DataFrame, heads: list[int]) -> DataFrame:
    """(game_id, game_id_rs, devices) of every game of a basket with each other head game in it."""
    known = F.array(*map(F.lit, heads)).cast("array<int>")
    own = F.transform("games", lambda g: g["game"])
    rows = baskets.select("devices", F.explode(own).alias("game_id"), F.array_intersect(own, known).alias("others"))
    return rows.select("devices", "game_id", F.explode("others").alias("game_id_rs")).filter("game_id <> game_id_rs")


def tail_pairs(baskets: DataFrame, heads: list[int], chunk: int = BASKET_CHUNK) -> DataFrame:
    """The same with the other games, but only those that can enter the list of the first.

    A basket holds (-devices of the game, game, count and number of the last game known in its list), most frequent
    games first. The chunks of a large basket are spread over the tasks.
    """
    known = F.array(*map(F.lit, heads)).cast("array<int>")
    rest = F.filter("games", lambda g: ~F.array_contains(known, g["game"]))
    cut = baskets.select("devices", "games", rest.alias("rest")).filter(F.size("rest") > 0)
    size = F.size("games")
    last = F.floor((size - 1) / chunk).cast("int")
    large = cut.filter(size > chunk).select("devices", "rest", "games", F.explode(F.sequence(F.lit(0), last)).alias("p"))
    large = large.select("devices", "rest", F.slice("games", F.col("p") * chunk + 1, F.lit(chunk)).alias("games")).repartition("games", "rest")
    each = cut.filter(size <= chunk).select("devices", "rest", "games").unionByName(large).select("devices", "rest", F.explode("games").alias("g"))

    def enters(b: Column) -> Column:
        most = -F.greatest(b["less"], F.col("g.less"))
        return (b["game"] != F.col("g.game")) & ((most > F.col("g.least")) | ((most == F.col("g.least")) & (b["game"] < F.col("g.last"))))

    able = F.filter("rest", enters)
    return each.select("devices", F.col("g.game").alias("game_id"), F.explode(able).alias("b")).select(
        "devices", "game_id", F.col("b.game").alias("game_id_rs"))


def _counted(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("game_id", "game_id_rs").agg(F.sum("devices").alias("download_num"))


def pruned_pairs(downloads: DataFrame, k: int = CO_DOWNLOAD_TOP, heads: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(pairs with head games, pairs with others that can still enter a list of k), before they are counted.

    Two games are together on no more devices than either is on. The `heads` most frequent games (2 k by default) are
    counted with every game first; to enter the list of a game, another must be able to beat the k-th best of these
    counts, or to reach it with a smaller number.
    """
    enable_checkpoints(downloads.sparkSession)
    owned = downloads.select("imei", F.col("game_id").cast("int").alias("game")).filter("imei is not null and game is not null").distinct()
    several = owned.groupBy("imei").agg(F.collect_list("game").alias("games")).filter(F.size("games") > 1)
    owned = several.select("imei", F.explode("games").alias("game")).checkpoint()
    sizes = owned.groupBy("game").agg(F.count(F.lit(1)).alias("n"))
    first = [r["game"] for r in sizes.orderBy(F.col("n").desc(), "game").limit(heads or 2 * k).collect()]

    def baskets(stats: DataFrame) -> DataFrame:
        entry = F.struct((-F.col("n")).alias("less"), "game", "least", "last")
        sets = owned.join(stats, "game").groupBy("imei").agg(F.array_sort(F.collect_list(entry)).alias("games"))
        return sets.groupBy("games").agg(F.count(F.lit(1)).alias("devices"))

    plain = baskets(sizes.withColumns({"least": F.lit(0).cast("bigint"), "last": F.lit(0)}))
    with_heads = head_pairs(plain, first)
    place = F.row_number().over(Window.partitionBy("game_id").orderBy(F.col("download_num").desc(), "game_id_rs"))  # at most `heads` rows each
    kth = _counted(with_heads).withColumn("place", place).filter(F.col("place") == k).select(
        F.col("game_id").alias("game"), F.col("download_num").alias("least"), F.col("game_id_rs").alias("last"))
    bounded = sizes.join(kth, "game", "left").withColumns({"least": F.coalesce("least", F.lit(0).cast("bigint")), "last": F.coalesce("last", F.lit(0))})
    return with_heads, tail_pairs(baskets(bounded), first)


def co_download_topk_pruned(downloads: DataFrame, k: int = CO_DOWNLOAD_TOP, heads: int | None = None) -> DataFrame:
    """`co_download_topk` of all counts, forming only pairs that can enter a list; for large catalogues and baskets."""
    head, tail = pruned_pairs(downloads, k, heads)
    return co_download_topk(_counted(head.unionByName(tail)), k)


def als_ratings(downloads: DataFrame, repeats: bool = True) -> DataFrame:
    """(user_id, game_id, rating): devices numbered densely, every download rated 1.

    Counts per device and game carry the repeats through the id join and are unfolded after
    it. They are checkpointed, so the download lines are read once for both sides of that
    join, and again with their numbers, so that every fit and prediction reads three numbers a pair
    instead of joining anew. `repeats=False` rates each pair once.
    """
    enable_checkpoints(downloads.sparkSession)
    pairs = downloads.groupBy("imei", "game_id").agg(F.count(F.lit(1)).alias(COPIES)).checkpoint()
    joined = pairs.join(dense_numbers(pairs, "imei", "user_id"), "imei")
    numbered = joined.select(F.col("user_id").cast("int").alias("user_id"), "game_id", COPIES).checkpoint()
    rows = expand_copies(numbered) if repeats else numbered
    return rows.select("user_id", "game_id", F.lit(1.0).cast("float").alias("rating"))


def _als(seed: int, ratings: DataFrame) -> ALS:
    """The factorisation, in blocks of devices and of games that hold a bounded number of ratings, and as few as that allows.

    A task holds the ratings of one block and the factors that they meet, so the number of blocks grows with the ratings. Every
    iteration sends a device's factors once to each block with one of its games; that is dropped when the next iteration has its
    factors of games, which are stored each time. The blocks of games and the storing have no bearing on the model.
    """
    blocks = -(-ratings.count() // BLOCK_RATINGS)
    return ALS(
        userCol="user_id", itemCol="game_id", ratingCol="rating", coldStartStrategy="drop", seed=seed, checkpointInterval=1,
        numUserBlocks=max(USER_BLOCKS, blocks), numItemBlocks=max(ITEM_BLOCKS, blocks))


def _let_go(spark: SparkSession) -> None:
    """What ended fits left on disk and in memory goes with the objects of the driver that refer to it, so collect those now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _rmse() -> RegressionEvaluator:
    return RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction")


@dataclass(frozen=True)
class AlsGrid:
    ranks: tuple[int, ...] = ALS_RANKS
    reg_params: tuple[float, ...] = ALS_REG
    iterations: tuple[int, ...] = ALS_ITERATIONS


def split_pairs(ratings: DataFrame, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of user and game, so that all ratings of a pair are on one side."""
    place = F.pmod(F.xxhash64("user_id", "game_id", F.lit(seed)), F.lit(1000))
    edge = int(TRAIN_SHARE * 1000)
    return ratings.filter(place < edge), ratings.filter(place >= edge)


def fit_als(ratings: DataFrame, grid: AlsGrid = AlsGrid(), seed: int = 17) -> ALSModel:
    """The grid's model with the least error on held-out ratings, refitted on all of them.

    Settings are fitted a few at a time, as the small stages of one leave most of a cluster idle; each fit holds its ratings and one
    iteration's factors, and leaves nothing behind.
    """
    enable_checkpoints(ratings.sparkSession)
    als = _als(seed, ratings)
    params = (
        ParamGridBuilder()
        .addGrid(als.rank, list(grid.ranks))
        .addGrid(als.regParam, list(grid.reg_params))
        .addGrid(als.maxIter, list(grid.iterations))
        .build()
    )
    train, test = split_pairs(ratings, seed)

    def error(p: dict) -> float:
        found = _rmse().evaluate(als.fit(train, p).transform(test))
        _let_go(ratings.sparkSession)
        return found

    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        ended = [pool.submit(inheritable_thread_target(ratings.sparkSession)(error), p) for p in params]
    errors = [e.result() for e in ended]
    known = [(e, i) for i, e in enumerate(errors) if e == e]  # no error where nothing could be predicted
    return als.fit(ratings, params[min(known)[1] if known else 0])


def als_rmse(ratings: DataFrame, rank: int, reg_param: float, iterations: int, seed: int = 17) -> DataFrame:
    """Root mean squared error of one setting on ratings it was not fitted on, one row."""
    enable_checkpoints(ratings.sparkSession)
    train, test = split_pairs(ratings, seed)
    model = _als(seed, train).setParams(rank=rank, regParam=reg_param, maxIter=iterations).fit(train)
    error = F.col("prediction") - F.col("rating")
    return model.transform(test).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), F.count(F.lit(1)).alias("predictions")
    )


def als_user_lists(model: ALSModel, users: DataFrame, k: int = ALS_TOP) -> DataFrame:
    """(user_id, recommendations) of the k best games for a given set of users."""
    return model.recommendForUserSubset(users.select("user_id").distinct(), k)


def _block_scores(k: int):
    def run(owners: pd.DataFrame, games: pd.DataFrame) -> pd.DataFrame:
        if owners.empty or games.empty:
            return pd.DataFrame({"game_id": [], "game_id_rs": [], "score": []}).astype({"game_id": "int32", "game_id_rs": "int32"})
        scores = np.stack(owners["taste"]).astype(np.float64) @ np.stack(games["features"]).astype(np.float64).T
        own, other = owners["game_id"].to_numpy(), games["id"].to_numpy()
        scores[own[:, None] == other[None, :]] = -np.inf
        parts = []
        for game, row in zip(own, scores):
            best = np.lexsort((other, -row))[:k]
            best = best[np.isfinite(row[best])]
            parts.append(pd.DataFrame({"game_id": game, "game_id_rs": other[best], "score": row[best]}))
        return pd.concat(parts)

    return run


def _norm(vector: str) -> Column:
    return F.sqrt(F.aggregate(F.transform(vector, lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + x * x))


@dataclass
class NormBlocks:
    """Games in blocks of falling norm. A block's first norm bounds every score with it, by Cauchy and Schwarz."""

    games: DataFrame  # id, features, block
    bounds: list[float]  # largest norm per block, falling
    sizes: list[int]

    @staticmethod
    def of(games: DataFrame, block: int) -> "NormBlocks":
        enable_checkpoints(games.sparkSession)
        normed = games.select("id", "features", _norm("features").alias("norm"))
        parts = max(1, -(-games.count() // block))
        placed = normed.repartitionByRange(parts, F.col("norm").desc(), "id").withColumn("block", F.spark_partition_id()).checkpoint()
        found = sorted(placed.groupBy("block").agg(F.max("norm").alias("m"), F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["block"])
        if not found:
            return NormBlocks(placed, [], [])
        numbers = {r["block"]: i for i, r in enumerate(found)}
        number = F.create_map(*[F.lit(x) for kv in numbers.items() for x in kv])[F.col("block")] if len(numbers) < parts else F.col("block")
        return NormBlocks(placed.withColumn("block", number), [r["m"] for r in found], [r["n"] for r in found])

    def first(self, k: int) -> int:
        """How many blocks hold more than k games."""
        held = np.cumsum(self.sizes)
        return min(int(np.searchsorted(held, k, side="right")) + 1, len(held))


def _scored(pairs: DataFrame, blocks: NormBlocks, k: int) -> DataFrame:
    """The k best of each block for pairs (game_id, taste, p, block) of chunks of owners and blocks."""
    wanted = pairs.select("p", "block").distinct()
    right = blocks.games.join(wanted, "block").select("id", "features", "p", "block").toDF("id", "features", "chunk", "part")
    return pairs.groupBy("p", "block").cogroup(right.groupBy("chunk", "part")).applyInPandas(
        _block_scores(k), "game_id int, game_id_rs int, score double")


def surviving_blocks(taste: DataFrame, best: DataFrame, blocks: NormBlocks, k: int) -> DataFrame:
    """(game_id, taste, p, block) beyond the first blocks whose bound reaches the k-th best score so far."""
    place = F.row_number().over(Window.partitionBy("game_id").orderBy(F.col("score").desc()))
    kth = best.withColumn("place", place).filter(F.col("place") == k).select("game_id", F.col("score").alias("kth"))
    bounds = F.array(*map(F.lit, blocks.bounds))
    reach = F.filter(bounds, lambda b: F.col("kth").isNull() | (b * F.col("length") * (1 + 1e-9) >= F.col("kth")))
    cut = taste.join(kth, "game_id", "left").withColumn("length", _norm("taste")).withColumn("reach", F.size(reach))
    first = blocks.first(k)
    return cut.filter(F.col("reach") > first).select("game_id", "taste", "p", F.explode(F.sequence(F.lit(first), F.col("reach") - 1)).alias("block"))


def factor_lists(taste: DataFrame, games: DataFrame, k: int = ALS_TOP, block: int = 1024) -> DataFrame:
    """One list per row (game_id, taste): the k games (id, features) with the largest inner products, itself left out.

    Exact. Games lie in blocks of falling norm; every row meets the blocks with the largest norms first, and later
    only those whose norm times its own can still reach its k-th best score. Equal scores: the smaller id.
    """
    enable_checkpoints(taste.sparkSession)
    blocks = NormBlocks.of(games, block)
    if not blocks.bounds:
        return _pipe_list(games.sparkSession.createDataFrame([], "game_id int, rn int, game_id_rs int"))
    chunks = max(1, -(-taste.count() // block))
    left = taste.select("game_id", "taste", F.pmod(F.xxhash64("game_id"), F.lit(chunks)).cast("int").alias("p"))
    start = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks.first(k) - 1))))
    best = _scored(start, blocks, k).checkpoint()
    later = _scored(surviving_blocks(left, best, blocks, k), blocks, k)
    rn = F.row_number().over(Window.partitionBy("game_id").orderBy(F.col("score").desc(), "game_id_rs"))
    return _pipe_list(best.unionByName(later).withColumn("rn", rn).filter(F.col("rn") <= k))


def _top_of_owners(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, last): the k + 1 largest scores of each row, the smaller place first where equal, and which of them is the least.

    With k or fewer columns all of them, and none is the least (-1).
    """
    rows, games = scores.shape
    if games <= k:
        return np.tile(np.arange(games), (rows, 1)), np.full(rows, -1)
    edge = np.partition(scores, games - k - 1, axis=1)[:, games - k - 1]
    held = scores >= edge[:, None]
    over = held.sum(axis=1) - (k + 1)
    for i in np.flatnonzero(over):  # of the games that share the least score, those with the largest numbers go
        held[i, np.flatnonzero(scores[i] == edge[i])[-over[i]:]] = False
    places = np.nonzero(held)[1].reshape(rows, k + 1)
    least = np.take_along_axis(scores, places, axis=1) == edge[:, None]
    return places, k - np.argmax(least[:, ::-1], axis=1)


def _best_games(users: np.ndarray, games: np.ndarray, k: int, block: int = GAME_BLOCK, products: int = SCORES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The games (as places), scores and least entry of `_top_of_owners` for users and games given by their factors.

    About `products` scores are held at once, of a block of games with a part of the users; the best so far are compared with
    those of the next block.
    """
    width = min(len(games), block)
    step = max(1, products // (width + k))
    parts = []
    for start in range(0, len(users), step):
        own, best, scores = users[start:start + step], None, None
        for first in range(0, len(games), width):
            found = own @ games[first:first + width].T
            ids = np.broadcast_to(np.arange(first, first + found.shape[1]), found.shape)
            if best is not None:
                found, ids = np.hstack([scores, found]), np.hstack([best, ids])
            places, last = _top_of_owners(found, k)
            best, scores = np.take_along_axis(ids, places, axis=1), np.take_along_axis(found, places, axis=1)
        parts.append((best, scores, last))
    return tuple(np.concatenate(p) for p in zip(*parts))


def _owner_votes(k: int):
    """Sums over a chunk of owners: what each game's owners give to the games they are recommended."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.table({n: pa.array([], t) for n, t in zip(("game_id", "game_id_rs", "score"), (pa.int32(), pa.int32(), pa.float64()))})

        def factors(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            flat = rows["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ids, order = np.unique(rows["id"].to_numpy(), return_index=True)
            return ids, flat.reshape(len(rows), -1)[order]

        items = right.filter(right["item"])
        users = right.filter(pc.invert(right["item"]))
        if not (len(left) and len(items) and len(users)):
            return none
        games, features = factors(items)
        known, tastes = factors(users)
        best, scores, last = _best_games(tastes, features, k)
        owner, game = left["user_id"].to_numpy(), left["game_id"].to_numpy()
        row = np.minimum(np.searchsorted(known, owner), len(known) - 1)
        keep = known[row] == owner
        order = np.argsort(game[keep], kind="stable")
        row, game = row[keep][order], game[keep][order]
        starts = np.flatnonzero(np.r_[True, game[1:] != game[:-1]]) if len(game) else []
        parts = []
        for a, b in zip(starts, [*starts[1:], len(game)]):
            place, of = np.searchsorted(games, game[a]), row[a:b]
            own = place if place < len(games) and games[place] == game[a] else -1
            given = votes(best, scores, last, of, own)
            if not len(given[0]):
                continue
            parts.append((np.full(len(given[0]), game[a], np.int32), games[given[0]].astype(np.int32), given[1]))
        if not parts:
            return none
        return pa.table(dict(zip(none.column_names, (np.concatenate(p) for p in zip(*parts)))))

    def votes(best: np.ndarray, scores: np.ndarray, last: np.ndarray, of: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
        listed = best[of]
        wanted = listed != own
        spare = wanted.sum(axis=1) > k  # the game itself is not among the k + 1 best, so the least of them is one too many
        wanted[np.flatnonzero(spare), last[of][spare]] = False
        ids, values = listed[wanted], scores[of][wanted]
        if not len(ids):
            return ids, values
        low = int(ids.min())
        if int(ids.max()) - low > 4 * len(ids):
            found, at = np.unique(ids, return_inverse=True)
            return found, np.bincount(at, values)
        counts = np.bincount(ids - low)
        found = np.flatnonzero(counts)
        return found + low, np.bincount(ids - low, values)[found]

    return run


def owner_votes(model: ALSModel, ratings: DataFrame, k: int = ALS_TOP, chunk: int = OWNER_CHUNK) -> DataFrame:
    """(game_id, game_id_rs, score): the scores of a game in the lists of the k best games of each owner, summed over the owners.

    A list leaves out the game whose owner it is for, so it holds k others where there are as many. Owners are dealt by a hash into
    chunks, in which their lists are made and summed up at once; lists themselves are not exchanged. Equal scores: the smaller id.
    """
    owned = ratings.select("user_id", "game_id").filter("user_id is not null and game_id is not null").distinct()
    chunks = max(1, -(-model.userFactors.count() // chunk))
    p = lambda c: F.pmod(F.xxhash64(c), F.lit(chunks)).cast("int").alias("p")
    left = owned.select(F.col("user_id").cast("int").alias("user_id"), F.col("game_id").cast("int").alias("game_id")).select("*", p("user_id"))
    users = model.userFactors.select("id", "features", F.lit(False).alias("item"), p("id"))
    games = model.itemFactors.select("id", "features", F.lit(True).alias("item"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("p"))
    votes = left.groupBy("p").cogroup(users.unionByName(games).groupBy("p")).applyInArrow(_owner_votes(k), "game_id int, game_id_rs int, score double")
    return votes.groupBy("game_id", "game_id_rs").agg(F.round(F.sum("score"), 6).alias("score"))


def als_lists(model: ALSModel, ratings: DataFrame, k: int = ALS_TOP, chunk: int = OWNER_CHUNK) -> DataFrame:
    """One list per game, from the k best games of each of its owners: those with the largest mean score over all owners, the game itself left out.

    An owner's score counts only for the games in that owner's list, and as nothing for the others.
    """
    rn = F.row_number().over(Window.partitionBy("game_id").orderBy(F.col("score").desc(), "game_id_rs"))
    return _pipe_list(owner_votes(model, ratings, k, chunk).withColumn("rn", rn).filter(F.col("rn") <= k))
