"""The registered queries: against their SQL where there is any, and the pipeline stage by stage."""

from __future__ import annotations

import hashlib
import re

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from convoy.llm import oracle, queries, simhash, toxicity
from convoy.llm.common import held_out
from tests.compare import differences, duck
from tests.llm.data import awkward, docs, prose
from tests.llm.test_bpe import library  # noqa: F401
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_simhash import brute_groups, brute_print
from tests.llm.test_text_dedup import brute_lines

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert differences(spark, duck(SF), SF, queries.queries()[name], oracle.oracle_sql()[name]) == []


def test_every_operator_has_a_query():
    names = queries.queries()
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in names] == list(range(1, 14))
    assert set(oracle.oracle_sql()) <= set(names)


def test_bpe_query(spark, library):  # noqa: F811
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for row in queries.op4_bpe(spark, SF).collect():
        ids = library.encode_ordinary(texts[row.doc_id])
        joined = " ".join(map(str, ids)).encode()
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(joined).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_simhash_query(spark):
    texts = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    prints = [brute_print(r.text) for r in texts]
    groups = brute_groups(prints, 4)
    want = sorted((r.doc_id, f"{p:016x}", texts[g].doc_id) for r, p, g in zip(texts, prints, groups))
    assert sorted(tuple(r) for r in queries.op5_simhash(spark, SF).collect()) == want


def test_neighbour_query(spark):
    from tests.llm.test_ann import brute

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in queries.op9_neighbours(spark, SF).collect())
    want = brute(rows, {i for i, _ in rows if i % 20 == 0}, 20)
    assert [g[:3] for g in got] == [w[:3] for w in want]


def test_learned_queries_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = queries.op1_toxicity(spark, sf).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in scored)
    assert right >= 0.98 * len(scored) and all(0 <= r.score <= 1 for r in scored)
    langs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    guessed = queries.op7_language(spark, sf).join(langs, "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in guessed) >= 0.97 * len(guessed)


def stage_rows(spark, rows):
    """The rows of a stage's input as its brute force sees them."""
    return [(r.doc_id, r.text) for r in rows.collect()]


def test_pipeline_stages(spark, tmp_path, library):  # noqa: F811
    """Every stage over sample documents and awkward rows, each against brute force on its own input."""
    sample = spark.read.parquet(f"{SF}/documents.parquet")
    more = [(None if i is None else 10_000 + i, t) for i, t in awkward()]
    block = "\n".join(prose(i, 6) for i in range(4))
    more += [(20_001, block), (20_002, f"{block}\n{prose(70, 9)}"), (20_003, prose(71, 60))]
    table = sample.unionByName(docs(spark, more))
    path = iter(range(9))

    def written(df):
        name = str(tmp_path / str(next(path)))
        df.write.parquet(name)
        return spark.read.parquet(name)

    stages = dict(corpus_pipeline.STAGES)
    table = written(table)
    model = toxicity.learn(table, spark.read.parquet(f"{SF}/labels.parquet").where(~held_out(3, 1)))
    calm = table.where(toxicity.toxicity(F.col("text"), model)["score"] < 0.7)
    kept = written(stages["toxicity"](spark, table, SF))
    assert kept.columns == table.columns
    assert sorted(map(repr, stage_rows(spark, kept))) == sorted(map(repr, stage_rows(spark, calm)))

    before, kept = kept, written(stages["line_dedup"](spark, kept, SF))
    assert kept.columns == before.columns
    want = sorted(((i, t) for i, _, _, t in brute_lines(stage_rows(spark, before))), key=repr)
    assert sorted(stage_rows(spark, kept), key=repr) == want
    assert kept.where("n_chars <> char_length(text)").count() == 0

    before, kept = kept, written(stages["near_dedup"](spark, kept, SF))
    rows = stage_rows(spark, before)
    best = {}
    for (i, t), g in zip(rows, brute_groups([brute_print(t) for _, t in rows], 4)):
        best[g] = min(best.get(g, (True, 0)), (i is None, i or 0))
    assert sorted((i is None, i or 0) for i, _ in stage_rows(spark, kept)) == sorted(best.values())

    before, kept = kept, written(stages["decontamination"](spark, kept, SF))
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [i for i, _, n, _ in brute_hits(stage_rows(spark, before), bench) if not n]
    assert sorted((i for i, _ in stage_rows(spark, kept)), key=repr) == sorted(clean, key=repr)

    got = {r.doc_id: r.n_tokens for r in stages["bpe"](spark, kept, SF).collect()}
    assert got == {i: len(library.encode_ordinary(t or "")) for i, t in stage_rows(spark, kept)}


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
