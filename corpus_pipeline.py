"""A training corpus from the documents table, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet and read again as
the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamepulse.llm.common import delete_folder, fresh, scratch, stored, table, written
from gamepulse.llm.decontaminate import drop_contaminated
from gamepulse.llm.language_id import identify, learn_prototypes, least_cosine
from gamepulse.llm.line_dedup import dedup_lines
from gamepulse.llm.near_copies import drop_near_copies
from gamepulse.llm.packing import pack


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, null ones among them, and those far from every learnt language.

    Far is less than half the cosine of all but one in 1,000 labelled texts. Every text is judged once, and kept with its cosine.
    """
    labelled = docs.filter(F.col("lang").isNotNull())
    learnt = learn_prototypes(labelled)
    if not learnt:  # nothing to compare with: only letters count
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    pred, score = fresh(docs, "lang_pred", "score")
    judged = written(identify(docs, learnt, lang_col=pred, score_col=score).filter(F.col(pred) != "und"), "judged")
    least = least_cosine(judged.filter(F.col("lang").isNotNull()), learnt, judged=(pred, score))
    return judged.filter(F.col(score) >= least).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that an earlier document has; n_chars follows the text."""
    [before] = fresh(docs, "text_before")
    cut = dedup_lines(docs.withColumn(before, F.col("text")), stats=False)
    changed = ~F.col("text").eqNullSafe(F.coalesce(before, F.lit("")))
    return cut.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies: of the smallest id the longest text."""
    return drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, give or take a fifth of its words."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("decontaminate", decontaminate),
    ("packing", packing),
]
#: Learnt models, edit distances and a linear program are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage leaves behind is deleted once the next has been written."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch(spark):
            docs, path = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        if last:
            delete_folder(spark, last)
        last = path
    return docs
