"""The registered queries and the pipeline on the driver's small tables."""

import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from carelens.llm import langid
from carelens.llm.common import table
from carelens.llm.queries import ORACLE, QUERIES
from tests.llm import brute

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def rows_of(sf, name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{sf}/{name}.parquet' ORDER BY 1").fetchall()


def test_registry():
    names = list(entry.queries())
    assert [n for n in names if re.match(r"op\d+_", n)] == list(QUERIES) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES) and set(entry.oracle_sql()) <= set(names)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "suffix_dedup", "decontamination", "tokenise"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(r) for r in got.select(columns).collect()) == sorted(want.fetchall())


def test_language_model_beats_the_base(spark):
    rows = QUERIES["op1_hmm"](spark, MIDDLE).collect()
    docs = rows_of(MIDDLE, "documents", "doc_id, text")
    want = {i: w for (i, _), w in zip(docs, brute.base_scores(docs, lambda i: brute.fold(i, 5) != 1), strict=True)}
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3] and np.isclose(r.base_score, want[r.doc_id][3])
        assert r.held_out == (brute.fold(r.doc_id, 5) == 1)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > 0.9 * sum(r.base_score for r in held)


def test_held_out_accuracy(spark):
    langs = dict(rows_of(MIDDLE, "documents", "doc_id, lang"))
    held = [r for r in QUERIES["op2_langid"](spark, MIDDLE).collect() if r.held_out]
    assert np.mean([langs[r.doc_id] == r.lang_pred for r in held]) > 0.98 and not any(r.rejected for r in held)
    labels = {i: (q, t) for i, q, t in rows_of(MIDDLE, "labels", "doc_id, quality, toxic")}
    quality = [(labels[r.doc_id][0], r.predicted) for r in QUERIES["op8_quality"](spark, MIDDLE).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in quality]) > 0.9
    toxic = [(labels[r.doc_id][1], r.score) for r in QUERIES["op3_toxicity"](spark, MIDDLE).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([s for y, s in toxic if y]) > 3 * np.mean([s for y, s in toxic if not y])


def test_repeats_and_edits(spark):
    docs = rows_of(SMALL, "documents", "doc_id, text")
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op10_suffixes"](spark, SMALL).collect()}
    assert got == {i: (*w[:4], n) for (i, _), w, (n, _) in zip(docs, brute.repeats(docs), brute.passages(docs), strict=True)}
    got = {r.doc_id: (r.n_chars, r.edited_sha256) for r in QUERIES["op7_fingerprints"](spark, SMALL).collect()}
    assert got == {i: (n, brute.sha(e)) for (i, _), (n, e) in zip(docs, brute.neighbour_edits(docs), strict=True)}


def test_urls(spark):
    rows = QUERIES["op6_urls"](spark, MIDDLE).collect()
    assert len(rows) == len(rows_of(MIDDLE, "pages", "page_id")) and {r.verdict for r in rows} == {"allow", "block"}
    assert all(r.rule is None for r in rows if r.host.endswith(".net")) and any(r.rule == "example.org/en/1" for r in rows)


def test_native_queries_run_no_python(spark):
    for name in ("op4_decontaminate", "op6_urls", "op7_fingerprints"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "MapIn"))


def test_pipeline_against_brute_force(spark):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = table(spark, SMALL, "documents")
    model = langid.train(docs)
    good = {r.doc_id for r in langid.identify(docs, model, keep=["doc_id"]).collect() if not r.rejected}
    rows = [(i, t) for i, t in rows_of(SMALL, "documents", "doc_id, text") if i in good]
    rows = [r for r, (_, least) in zip(rows, brute.near_classes(rows, 5), strict=True) if r[0] == least]
    rows = [(i, t) for (i, _), (_, t) in zip(rows, brute.passages(rows), strict=True)]
    items = rows_of(SMALL, "benchmark", "item_id, text")
    rows = [r for r, w in zip(rows, brute.contamination(rows, items), strict=True) if not w[-1]]
    want = {i: lib.encode(t, add_special_tokens=False).ids for i, t in rows}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert {i: list(r.ids) for i, r in got.items()} == want
    assert all(r.decoded_sha256 == brute.sha(t) for (i, t), r in ((x, got[x[0]]) for x in rows))


def test_intermediate_tables_go_with_their_run(spark):
    from pathlib import Path

    from carelens.llm import simhash
    from carelens.llm.common import scratch_run

    folders = lambda: {x.name for x in Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"), "llm").iterdir()}
    simhash.classes(table(spark, SMALL, "documents")).count()
    before = folders()
    with scratch_run(spark) as folder:
        assert simhash.classes(table(spark, SMALL, "documents")).count() == 200 and Path(folder.removeprefix("file:")).exists()
    assert folders() == before and not Path(folder.removeprefix("file:")).exists()


ODD = [(1, None, None, None, None), (2, "", "en", "web", 0), (None, "  ", "en", "web", 2), (3, "word", "en", None, 4)]


def test_pipeline_stages_on_odd_rows(spark):
    """Nulls, empty and very long texts, repeated rows and further columns with clashing names, in every stage."""
    docs = table(spark, SMALL, "documents")
    text = docs.where("lang = 'en'").orderBy("doc_id").first().text
    rows = [*ODD, (4, " ".join([text] * 400), "en", "web", 9), (5, text, "en", "web", 1), (5, text, "en", "web", 1), (6, text, "xx", "web", 1), (None, text, "en", "web", 1)]
    odd = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, k string, t string, runs string")
    stages = dict(corpus_pipeline.STAGES)
    columns = corpus_pipeline.COLUMNS
    both = docs.withColumns({"k": F.lit("x"), "t": F.lit("y"), "runs": F.lit("z")}).unionByName(odd)
    kept = stages["language_id"](spark, both, SMALL)
    assert kept.columns == columns
    mine = sorted(r.doc_id for r in kept.collect() if r.text and text in r.text and r.doc_id is not None and r.doc_id < 7)
    assert {4, 5, 6} <= set(mine) and kept.where("text IS NULL OR trim(text) = ''").count() == 0
    near = stages["near_dedup"](spark, odd, SMALL)
    assert near.columns == columns
    assert sorted((r.doc_id for r in near.collect()), key=lambda x: (x is not None, x)) == [None, 1, 2, 3, 4]  # 400 times the text has its shingles
    left = {r.doc_id: r for r in stages["suffix_dedup"](spark, odd.where("doc_id < 5"), SMALL).collect()}
    assert left[1].text == "" and left[2].text == "" and left[3].text == "word" and len(left[4].text) < 100 and left[4].n_chars == len(left[4].text)
    clean = stages["decontamination"](spark, odd, SMALL)
    assert clean.columns == columns and {1, 2, 3, 5} <= {r.doc_id for r in clean.collect()}
    ids = {r.doc_id: r for r in stages["tokenise"](spark, odd, SMALL).collect()}
    assert len(ids[1].ids) == 0 and ids[1].decoded_sha256 == brute.sha("") and ids[4].decoded_sha256 == brute.sha(" ".join([text] * 400))


def test_pipeline_stages_on_an_empty_table(spark):
    docs = table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0
