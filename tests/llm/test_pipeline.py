from __future__ import annotations

import corpus_pipeline
import pytest

import __spark_entry__
from torqline.llm import decontamination, exact, jaccard, queries


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "best-fit packing"


@pytest.fixture(scope="module")
def kept(spark, sf_dir, tmp_path_factory):
    """The tables after each stage, in order."""
    tables = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / f"{k}.parquet")
        stage(spark, tables[-1], sf_dir).write.parquet(path)
        tables.append(spark.read.parquet(path))
    return tables


def test_stages_keep_the_columns_and_act_on_their_input(spark, sf_dir, kept):
    assert all(t.columns == kept[0].columns for t in kept[:-1])
    scores = queries.op6_pu_quality(spark, sf_dir).filter("predicted = 1")
    assert {r[0] for r in kept[1].select("doc_id").collect()} == {r[0] for r in scores.select("doc_id").collect()}
    own = exact.digest_groups(kept[1]).filter("kept")
    assert {r[0] for r in kept[2].select("doc_id").collect()} == {r[0] for r in own.select("doc_id").collect()}
    groups = jaccard.near_duplicate_groups(kept[2]).filter("doc_id = component_id")
    assert {r[0] for r in kept[3].select("doc_id").collect()} == {r[0] for r in groups.select("doc_id").collect()}
    assert jaccard.near_duplicate_groups(kept[3]).filter("doc_id != component_id").count() == 0
    assert kept[4].count() == kept[3].count()
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    changed = kept[3].join(kept[4].select("doc_id", kept[4]["text"].alias("new")), "doc_id").filter("text != new")
    hit = decontamination.contamination(kept[3], bench).filter("n_hit > 0")
    assert {r["doc_id"] for r in changed.collect()} == {r["doc_id"] for r in hit.collect()}
    assert {r[0] for r in kept[5].select("doc_id").collect()} == {r[0] for r in kept[4].select("doc_id").collect()}
