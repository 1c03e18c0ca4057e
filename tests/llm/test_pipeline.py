"""The pipeline's stages on the small tables, and the registered queries with SQL."""

import pytest

import compare
import corpus_pipeline
import __spark_entry__ as registry
from matchlens.llm import queries as llm
from matchlens.llm import packing
from matchlens.llm.columns import stored
from test_llm_operators import near_by_force


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [("documents", frame)]
    for name, stage in corpus_pipeline.STAGES:
        frame = stored(stage(spark, frame, sf_dir), f"test-{name}")
        out.append((name, frame))
    return dict(out)


def test_stages_keep_the_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "pii",
                                                      "packing"]
    columns = stages["documents"].columns
    assert all(stages[n].columns == columns for n in ("quality", "exact_dedup", "near_dedup", "pii"))


def test_quality_stage_drops_junk_and_keeps_clean_documents(spark, sf_dir, stages):
    labels = {r["doc_id"]: r["quality"] for r in
              spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in stages["quality"].select("doc_id").collect()}
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    assert sum(i in kept for i in bad) <= 0.4 * len(bad)


def test_dedup_stages_match_brute_force(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages["quality"].collect()]
    best = {}
    for i, t in rows:
        best[t] = max(best.get(t, i), i)
    exact_rows = [(r["doc_id"], r["text"]) for r in stages["exact_dedup"].collect()]
    assert sorted(i for i, _ in exact_rows) == sorted(best.values())
    expected = [i for i, _, _, kept in near_by_force(exact_rows, 5, 80) if kept]
    assert sorted(r["doc_id"] for r in stages["near_dedup"].collect()) == sorted(expected)


def test_personal_data_is_masked_and_everything_packed(stages):
    masked = {r["doc_id"]: r for r in stages["pii"].collect()}
    before = {r["doc_id"]: r for r in stages["near_dedup"].collect()}
    assert masked.keys() == before.keys()
    changed = [i for i in masked if masked[i]["text"] != before[i]["text"]]
    assert changed and all("<" in masked[i]["text"] for i in changed)
    assert all(r["n_chars"] == len(r["text"]) for i, r in masked.items() if i in changed)
    pieces = stages["packing"].collect()
    assert {r["doc_id"] for r in pieces} == masked.keys()
    assert all(len(r["ids"]) == r["length"] <= packing.LENGTH for r in pieces)


def test_stages_take_empty_tables(spark, sf_dir, stages):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, stages["documents"].where("false"), sf_dir).count() == 0


def test_stages_take_odd_rows(spark, sf_dir, odd_docs):
    frame = odd_docs.withColumnRenamed("n", "n_chars")
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, frame, sf_dir).count() > 0


@pytest.mark.parametrize("name", sorted(llm.SQL))
def test_query(spark, sf_dir, name):
    assert compare.difference(spark, compare.connect(sf_dir), name, sf_dir) is None


def test_registered():
    names = set(registry.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names}
    assert "pipeline" in names
