"""Registered corpus queries against their SQL, and the pipeline against plain Python."""

import brute
import pytest
from check import compare

import __spark_entry__ as entry
import corpus_pipeline
from braidline.llm import common, toxicity
from braidline.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_all_thirteen_and_the_pipeline_are_registered():
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in names


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    out = QUERIES[name].build(spark, SMALL)
    if QUERIES[name].sql is None:
        tables = {"op8_warc": "pages"}
        least = common.read(spark, SMALL, tables.get(name, "documents")).count()
        assert out.count() >= least
        return
    problem, _ = compare(out, duck.sql(QUERIES[name].sql))
    assert problem is None, problem


def test_suffix_query_and_simhash_query_equal_plain_python(spark):
    rows = [(r.doc_id, r.text) for r in common.read(spark, SMALL, "documents").collect()]
    found = QUERIES["op7_suffix_dedup"].build(spark, SMALL).collect()
    assert sorted(map(tuple, found)) == sorted(brute.without_repeats(rows))
    prints = {r.doc_id: r.fingerprint for r in QUERIES["op3_simhash"].build(spark, SMALL).collect()}
    assert prints == {d: f"{brute.simhash(t):016x}" for d, t in rows}


def test_toxicity_query_on_the_held_out_fold(spark):
    folder = "/root/testdata/sf0.01"
    scored = QUERIES["op6_toxicity"].build(spark, folder)
    labelled = scored.join(common.read(spark, folder, "labels"), "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in labelled)
    assert right >= 0.95 * len(labelled)
    toxic = [r for r in labelled if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.7 * len(toxic)


def test_pipeline_stages_equal_plain_python(spark, none):
    source = common.read(spark, SMALL, "documents")
    items = [(r.item_id, r.text) for r in common.read(spark, SMALL, "benchmark").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [
        "toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing",
    ]
    rows = [(r.doc_id, r.text) for r in source.collect()]

    lexicon = toxicity.learn(spark, source, common.read(spark, SMALL, "labels"))
    scored = toxicity.score(spark, source, lexicon, ["doc_id"])
    toxic = {r.doc_id for r in scored.where("score >= 0.7").collect()}
    rows = [(d, t) for d, t in rows if d not in toxic]
    docs = stages["toxicity"](spark, source, SMALL)
    assert docs.columns == source.columns and sorted(r.doc_id for r in docs.collect()) == sorted(
        d for d, _ in rows
    )

    def same(docs, rows):
        assert docs.columns == source.columns
        assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(rows)
        return common.written(spark, docs, "stage")

    rows = [(d, kept) for d, _, _, kept in brute.kept_lines(rows)]
    docs = same(stages["line_dedup"](spark, docs, SMALL), rows)
    rows.sort()
    prints = [brute.simhash(t) for _, t in rows]
    sets = [brute.shingles(t, 5) for _, t in rows]
    top = brute.components(
        len(rows),
        lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2 or brute.jaccard(sets[i], sets[j]) >= 0.8,
    )
    rows = [row for k, row in enumerate(rows) if top[k] == k]
    docs = same(stages["simhash_near_dedup"](spark, docs, SMALL), rows)
    hit = {d for d, _, h, _ in brute.contamination(rows, items) if h}
    rows = [(d, t) for d, t in rows if d not in hit]
    docs = same(stages["benchmark_decontamination"](spark, docs, SMALL), rows)
    packed = stages["best_fit_packing"](spark, docs, SMALL)
    assert {r.doc_id for r in packed.collect()} == {d for d, _ in rows}


def test_pipeline_runs_whole(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0


def test_stages_take_odd_rows(spark, docs):
    shaped = docs.select("doc_id", "text", *[c for c in docs.columns if c not in ("doc_id", "text")])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        shaped = common.written(spark, stage(spark, shaped, SMALL), "odd")
        assert shaped.columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, shaped, SMALL).count() > 0
