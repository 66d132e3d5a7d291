"""The pipeline and the corpus queries on the smallest tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablewright.llm import queries
from tablewright.llm.common import table

from ..oracle import connected, same
from .frames import empty, odd
from .test_pairs import brute_components, brute_lines
from .test_rows import brute_hits

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connected(DIRECTORY)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_twin(spark, duck, name):
    same(queries.queries()[name](spark, DIRECTORY), duck, queries.oracle_sql()[name])


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


def test_stages_against_brute_force(spark, tmp_path):
    docs = table(spark, DIRECTORY, "documents")
    columns = docs.columns
    out = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, DIRECTORY)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert result.columns == columns
        result.write.parquet(str(tmp_path / str(k)))
        result = spark.read.parquet(str(tmp_path / str(k)))
        before, after = [(r.doc_id, r.text) for r in docs.collect()], {r.doc_id: r.text for r in result.collect()}
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in table(spark, DIRECTORY, "labels").collect()}
            assert all((i in after) == bool(q) for i, q in labels.items())
        if name == "line_dedup":
            kept = {x[0]: x[4] for x in brute_lines(before)}
            assert {i: len(t) for i, t in after.items()} == {i: kept[i] for i, t in before if kept[i] and i in after}
            assert all(not kept[i] for i, _ in before if i not in after)
        if name == "near_duplicates":
            roots = {x[0]: x[2] for x in brute_components(before, 5, 80)}
            assert set(after) == {i for i, r in roots.items() if i == r}
        if name == "decontamination":
            items = [(r.item_id, r.text) for r in table(spark, DIRECTORY, "benchmark").collect()]
            assert set(after) == {x[0] for x in brute_hits(before, items) if not x[-1]}
        if name == "mixing":
            assert 0 < len(after) <= len(before) and set(after) <= {i for i, _ in before}
        out.append(len(after))
        docs = result
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, DIRECTORY).collect()) == Counter(after.keys())


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_on_odd_and_empty_documents(spark, stage):
    assert stage(spark, odd(spark), DIRECTORY).columns[:5] == odd(spark).columns[:5]
    assert stage(spark, odd(spark), DIRECTORY).count() <= odd(spark).count()
    assert stage(spark, empty(spark), DIRECTORY).count() == 0
    assert stage(spark, odd(spark).where(F.col("text").isNull()), DIRECTORY).count() <= 2
