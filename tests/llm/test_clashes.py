"""Columns whose names an operator uses itself, and the registered queries over a whole small table."""

import numpy as np
import pytest

import corpus_pipeline
from gamepulse.llm.common import fresh, scratch, stored, written
from gamepulse.llm.language_id import identify, learn_prototypes
from gamepulse.llm.line_dedup import dedup_lines
from gamepulse.llm.near_copies import drop_near_copies
from gamepulse.llm.quality import OrdinalModel, score_quality
from gamepulse.llm.queries import QUERIES

EXTRA = ["text_before", "K1", "k2", "row_key", "row_in_group", "drop", "own", "Kept", "count", "__id", "lang_pred_", "size"]


@pytest.fixture
def crowded(spark):
    rows = [(1, "the same line of text\nmine", "en"), (2, "the same line of text\nyours", "en"), (3, "der hund und die katze", "de"), (4, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)
    return spark.createDataFrame([(*r, "s", 1, *[f"{r[0]}-{c}" for c in EXTRA]) for r in rows], schema)


def kept_whole(frame):
    return all(r[c] == f"{r['doc_id']}-{c}" for r in frame.collect() for c in EXTRA)


def test_line_dedup_keeps_columns(crowded):
    out = dedup_lines(crowded)
    assert set(crowded.columns) <= set(out.columns) and kept_whole(out) and out.filter("n_dropped = 1").count() == 1


def test_near_copies_keep_columns(crowded):
    out = drop_near_copies(crowded)
    assert out.columns == crowded.columns and kept_whole(out) and out.count() == 4
    assert drop_near_copies(crowded.filter("false")).count() == 0


def test_predictions_replace_their_own_names_in_any_case(crowded):
    frame = crowded.withColumnsRenamed({"row_key": "Score", "size": "Keep"})
    judged = identify(frame, learn_prototypes(crowded))
    assert [c for c in judged.columns if c.lower() == "score"] == ["score"]
    scored = score_quality(frame, OrdinalModel(np.zeros(0, int), np.zeros(0), np.arange(2.0)), 2)
    assert [c for c in scored.columns if c.lower() == "keep"] == ["keep"] and scored.count() == 4


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES if s[0] not in ("packing", "decontaminate")], ids=lambda s: s[0])
def test_stages_keep_columns(spark, crowded, stage):
    out = stage[1](spark, crowded, "")
    assert out.columns == crowded.columns and kept_whole(out)


def test_fresh_names(crowded):
    assert fresh(crowded, "KEPT", "new", "New") == ["KEPT_", "new", "New_"]


def test_scratch_deletes_what_was_written_inside(spark, crowded):
    with scratch(spark):
        inner = written(crowded.select("doc_id"), "clash-test")
        kept, path = stored(inner, "clash-kept")
    assert kept.count() == 4
    with pytest.raises(Exception):
        inner.count()


@pytest.mark.parametrize(("name", "source"), [
    ("op3_packing", None), ("op6_maxent_lm", "documents"), ("op7_decontaminate", None), ("op8_ordinal_quality", "documents"), ("op10_hilbert_ann", None)])
def test_registered_queries_run_over_whole_tables(spark, sf_dir, table, name, source):
    rows = QUERIES[name](spark, sf_dir).collect()
    assert rows and (source is None or len(rows) == table(source).count())
