import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from compare import connect, differences
from tierline.llm import packing, queries, secret_scan

SF_DIR = "/root/testdata/sf0.001"
HEX = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_its_sql(spark, name):
    assert differences(entry.queries()[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLES[name]) == []


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def corpus():
    rng = random.Random(20)
    plain = "stone river walk green paper light house under table window old long road small tree bird".split()
    texts = [" ".join(rng.choices(plain, k=rng.randint(30, 300))) for _ in range(120)]
    toxic = [f"{t} you idiot and you worthless moron, you scum" for t in texts[:30]]
    copies = [t.replace(" ", "\n ", 3) for t in texts[30:40]]
    secret = [f"{t} token = \"{HEX}\" end" for t in texts[40:45]]
    rows = [(i, t) for i, t in enumerate(texts + toxic + copies + secret)]
    return rows, range(120, 150), range(150, 160), range(160, 165)


def test_stages(spark, documents, tmp_path):
    rows, toxic, copies, secret = corpus()
    documents(*rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i, _ in rows], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    left = {i for i, _ in rows}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "toxicity":
            assert left - kept == set(toxic)
        elif name == "exact_dedup":
            assert left - kept == set(copies)
        elif name == "secret_scan":
            assert kept == left
        left = kept
    texts = {r.doc_id: r for r in docs.collect()}
    whole = dict(rows)
    for i, row in texts.items():
        assert HEX not in row.text and row.n_chars == len(row.text)
        assert i in secret or row.text == whole[i]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == left
    assert sum(r.length for r in packed) == sum({r.doc_id: r.doc_tokens for r in packed}.values())
    assert spark.createDataFrame(packed).count() == corpus_pipeline.run(spark, str(tmp_path)).count()


def test_stages_of_an_empty_table(spark, documents, tmp_path):
    documents().write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_of_nulls_and_repeats(spark, documents, tmp_path):
    documents((1, None), (1, None), (None, None), (2, ""), (3, "x" * 300_000), (3, "x" * 300_000)).write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert found == {1, 3}


def test_stages_call_their_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "secret_scan", "packing"]
    assert secret_scan.redact and packing.pack_documents
