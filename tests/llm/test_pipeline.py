"""The registered queries and the pipeline, on the smallest tables and against brute force."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.check_oracles import compare, duck
from tests.llm.test_documents import grams, normal, statistics

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")


def test_ten_operators_and_the_pipeline_are_registered():
    names = {n for n in entry.queries() if n.startswith("op") and n[2].isdigit()}
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in entry.queries()


@needs_data
@pytest.mark.parametrize("name", ["op1_line_dedup", "op9_exact_dedup"])
def test_oracle(spark, name):
    assert compare(entry.queries()[name](spark, SF), duck(SF), entry.oracle_sql()[name]) == ""


@needs_data
@pytest.mark.parametrize("name", ["op1_line_dedup", "op3_sharding", "op8_quality_rules", "op9_exact_dedup", "op10_mixing"])
def test_no_python_in_native_plans(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@needs_data
def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    quality, exact, near, mixing, encoding = [f for _, f in corpus_pipeline.STAGES]
    good = quality(spark, docs, SF).cache()
    rows = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in good.collect()}
    assert good.columns == docs.columns and kept and not any(statistics(rows[i])[-1] for i in kept)
    once = exact(spark, good, SF).cache()
    best = {}
    for i in kept:
        best[normal(rows[i])] = max(i, best.get(normal(rows[i]), i))
    assert {r.doc_id for r in once.collect()} == set(best.values())
    apart = near(spark, once, SF).cache()
    left = {r.doc_id: grams(r.text) for r in apart.collect()}
    assert apart.columns == docs.columns
    sets = {i: grams(rows[i]) for i in best.values()}
    close = lambda a, b: len(a & b) >= 0.8 * len(a | b) - 1e-9
    assert all(not close(a, b) for i, a in left.items() for j, b in left.items() if i < j)
    linked = {i: {j for j in sets if j != i and close(sets[i], sets[j])} for i in sets}
    for i in set(sets) - set(left):  # every document that went is connected to a smaller one that stayed
        seen, stack = {i}, [i]
        while stack:
            for j in linked[stack.pop()] - seen:
                seen.add(j)
                stack.append(j)
        assert min(seen) in left and min(seen) < i
    mixed = mixing(spark, apart, SF).cache()
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= set(left)
    coded = encoding(spark, mixed, SF).collect()
    assert len(coded) == mixed.count() and all(r.lossless for r in coded)


@needs_data
def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and all(r.lossless for r in rows)
