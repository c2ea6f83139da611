"""The registered corpus queries against their SQL, and every stage of the pipeline against its operator's rules."""

import os
from collections import Counter

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from checks import compare
from crivo.llm import catalog
from tests.llm import samples

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="shared tables are not here")


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, name):
    found = compare.difference(spark, compare.connect(FOLDER), driver.queries()[name], driver.oracle_sql()[name], FOLDER)
    assert found is None, found


def test_all_ten_are_registered():
    names = list(driver.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    before = docs.collect()
    for step, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        rows = out.collect()
        if step < 4:
            assert out.columns == docs.columns
            assert set(rows) <= set(before)
        if step == 0:
            kept = {r.doc_id for r in rows}
            wrong = [i for i, q in labels.items() if (i in kept) != bool(q)]
            assert len(wrong) <= 0.05 * len(labels)
        if step == 1:
            texts = [samples.lowered(r.text) for r in rows]
            assert len(set(texts)) == len(texts) and set(texts) == {samples.lowered(r.text) for r in before}
        if step == 2:
            grams = []
            for r in rows:
                words = samples.lowered(r.text).split()
                grams.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)})
            for i, a in enumerate(grams):
                for b in grams[:i]:
                    assert not a or not b or len(a & b) < 0.8 * len(a | b)
        if step == 4:
            assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in before)
        before, docs = rows, spark.createDataFrame(rows, out.schema)
    assert set(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == set(map(tuple, before))
