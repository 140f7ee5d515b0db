"""Drops lines that many documents share, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamepulse.llm.common import SPACE_CHARS, ascii_lower, fresh, two_hashes


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE_CHARS)))


def _holds(sorted_keys: Column, key: Column) -> Column:
    """Whether a sorted array holds the key, by halving: a document's work is its lines times a logarithm."""
    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        below = (at["low"] < at["high"]) & (F.element_at(sorted_keys, middle) < key)
        return F.struct(F.when(below, middle + 1).otherwise(at["low"]).alias("low"), F.when(below, at["high"]).otherwise(middle).alias("high"))

    size = F.size(sorted_keys)
    steps = F.sequence(F.lit(1), F.ceil(F.log2(size.cast("double"))).cast("int") + 1)
    start = F.struct(F.lit(1).alias("low"), size.alias("high"))
    return F.aggregate(steps, start, halve, lambda at: F.element_at(sorted_keys, at["low"]) == key)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dedup_lines(
    docs: DataFrame, min_chars: int = 10, min_docs: int = 2, id_col: str = "doc_id", text_col: str = "text",
    stats: bool = True,
) -> DataFrame:
    r"""Documents without the lines that at least `min_docs` documents hold.

    A text is split at \n; a line's key is the line stripped of ASCII white space with A-Z
    lower-cased. Keys under `min_chars` code points never count. A dropped key stays in the
    smallest id that holds it, there with all its repeats. The other lines are joined by \n.

    Returns every input row with its text replaced and, with `stats`, n_lines and n_dropped
    (replacing input columns of those names). Defined cases: a null or empty text is one empty
    line and comes back as an empty text; rows with one id are one document; a row without id
    keeps its lines and counts for no document; an empty table gives an empty table.

    Lines travel as hashes, once per document and key, and are counted before the join; the
    join partner of a very common line is one row, so a skewed join can be split by AQE.
    """
    held = (
        docs.filter(F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("id"), F.explode(_lines(F.col(text_col))).alias("line"))
        .select("id", line_key(F.col("line")).alias("key"))
        .filter(F.length("key") >= min_chars)
        .select("id", two_hashes(F.col("key")).alias("k"))
        .select("id", "k.h1", "k.h2").distinct()
    )
    common = (
        held.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.min("id").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper")
    )
    drop, own, kept, count = fresh(docs, "drop", "own", "kept", "count")
    drops = (
        held.join(common, ["h1", "h2"]).filter(F.col("id") != F.col("keeper"))
        .groupBy("id").agg(F.array_sort(F.collect_list(F.struct("h1", "h2"))).alias(drop)).withColumnRenamed("id", own)
    )

    def stays(line: Column) -> Column:
        return ~((line["n"] >= min_chars) & _holds(F.col(drop), line["key"]))

    lines = _lines(F.col(text_col))
    keyed = F.transform(F.transform(lines, lambda x: F.struct(x.alias("line"), line_key(x).alias("key"))), lambda x: F.struct(
        x["line"].alias("line"), F.length(x["key"]).alias("n"), two_hashes(x["key"]).alias("key")))
    joined = docs.join(drops, docs[id_col] == drops[own], "left").drop(own)
    left = F.when(F.col(drop).isNull(), lines).otherwise(F.transform(F.filter(keyed, stays), lambda x: x["line"]))
    out = joined.withColumns({kept: left, count: F.size(lines).cast("long")}) if stats else joined.withColumn(kept, left)
    out = out.withColumn(text_col, F.array_join(kept, "\n"))
    if stats:
        out = out.withColumns({"n_lines": F.col(count), "n_dropped": F.col(count) - F.size(kept)})
    return out.drop(kept, drop, count)
