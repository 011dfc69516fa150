"""The registered queries, their statements, and the pipeline stage by stage."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF
from oracle_check import compare, connect
from tidemark.llm import golay_simhash, queries, repetition
from tidemark.llm.common import read


def test_all_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.queries()) | {"pipeline"} <= set(names)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_statement(spark, name):
    assert compare(entry.queries()[name](spark, SF), connect(SF), queries.oracle_sql()[name]) == ""


def test_stages_take_effect(spark):
    docs = read(spark, SF, "documents")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    kept = corpus_pipeline.quality_rules(spark, docs, SF)
    assert kept.columns == corpus_pipeline.COLUMNS
    assert ids(kept) == ids(repetition.repetition_rules(docs).where("kept"))
    alone = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert ids(alone) == sorted({r.component_id for r in golay_simhash.near_duplicates(docs).collect()})
    assert ids(corpus_pipeline.personal_data(spark, docs, SF)) == ids(docs)
    good = corpus_pipeline.quality_classifier(spark, docs, SF)
    low = queries.op8_knn_quality(spark, SF).where("predicted = 0")
    assert ids(good) == sorted(set(ids(docs)) - set(ids(low)))


def test_run_and_empty(spark):
    assert corpus_pipeline.run(spark, SF).columns[:3] == ["doc_id", "piece", "start"]
    docs = read(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


GOOD = (
    "The harbour office keeps a small library of charts, and every spring the clerks compare them with the soundings "
    "that the pilots bring home, because sand moves and a line drawn years ago may now lead a ship aground."
)


def test_stages_decide_per_row(spark):
    """Repeated and null ids: a rejected row goes whatever rows share its id, one row of each group stays."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    bad = "spam spam " * 200
    other = " ".join(f"word{i} stands for itself in place {i * i}" for i in range(40))
    rows = [(7, GOOD, "en", "a", 1), (7, bad, "en", "b", 2), (None, GOOD, "en", "c", 3), (None, bad, "en", "d", 4),
            (9, GOOD, "en", "e", 5), (9, GOOD, "en", "f", 6), (5, other, "en", "g", 7), (5, None, "en", "h", 8), (6, "", None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    kept = corpus_pipeline.quality_rules(spark, docs, SF)
    assert kept.columns == corpus_pipeline.COLUMNS
    assert sorted(r.source for r in kept.collect()) == ["a", "c", "e", "f", "g"]
    alone = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert len(alone) == 4
    by_text = {r.text or "": r.doc_id for r in alone}
    assert by_text == {GOOD: 7, bad: 7, other: 5, "": 5}
    scored = corpus_pipeline.quality_classifier(spark, docs, SF)
    assert {r.text for r in scored.collect()} <= {r[1] for r in rows}
    assert corpus_pipeline.personal_data(spark, docs, SF).count() == len(rows)
    packed = corpus_pipeline.best_fit_packing(spark, docs, SF)
    assert packed.where("piece = 0").count() == len(rows)
