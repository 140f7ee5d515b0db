"""One row of every group of near copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamepulse.llm.common import fresh, two_hashes
from gamepulse.llm.ngram_join import jaccard_components


def drop_near_copies(docs: DataFrame, n: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Keeps one row of each group that n-gram Jaccard links join: of the smallest id the longest text.

    Rows are told apart by two 64-bit hashes of id and text, so different texts of a repeated id are documents
    of their own, and repeated rows, whatever their other columns, are one. Texts without words are near copies
    of any other text of their id. Rows without id belong to no group and stay. An empty table gives an empty
    table; all columns are kept, whatever their names.
    """
    k1, k2, size = fresh(docs, "k1", "k2", "size")
    own = F.col(id_col).cast("string"), F.coalesce(F.col(text_col), F.lit(""))
    both = two_hashes(F.concat_ws("\n", *own))
    keyed = docs.filter(F.col(id_col).isNotNull()).withColumns({k1: both["h1"], k2: both["h2"]})
    groups = jaccard_components(keyed.select(F.col(k1).alias("doc_id"), F.col(text_col).alias("text")), n, percent).select(
        F.col("doc_id").alias("k1"), "n_shingles", "component_id").distinct()
    rows = keyed.select(
        F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.col(id_col).alias("id"), F.coalesce(F.length(text_col), F.lit(0)).alias("size")).distinct()
    rows = rows.join(groups, "k1")
    first = F.min(F.struct("id", -F.col("size"), "k1", "k2")).alias("first")
    full, blank = rows.filter("n_shingles > 0"), rows.filter("n_shingles = 0")
    alone = blank.join(full.select("id").distinct(), "id", "left_anti")
    heads = full.groupBy("component_id").agg(first).union(alone.groupBy("id").agg(first)).select("first.k1", "first.k2").toDF(k1, k2)
    one = keyed.dropDuplicates([k1, k2]).join(heads, [k1, k2], "left_semi")
    return one.select(*docs.columns).union(docs.filter(F.col(id_col).isNull()))
