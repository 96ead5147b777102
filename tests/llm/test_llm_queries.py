"""The registered queries against their SQL, and the pipeline against one that works through it in plain Python."""

import public_tokenizers
import pytest
from compare import assert_same, canonical, oracle_rows
from llm_data import edge_docs, empty_docs
from test_decontaminate import plain as plain_hits
from test_simhash import plain_components, plain_fingerprint
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from slotwise.llm import mixing
from slotwise.llm.oracle import llm_oracles
from slotwise.llm.queries import llm_queries

DATA = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in llm_queries()}
    assert set(llm_queries()) | {"pipeline"} <= set(entry.queries())
    assert set(llm_oracles()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_matches_sql(spark, name):
    result = llm_queries()[name](spark, DATA)
    nullable = {"op9_license_scan": ("first_word", "last_word"), "op11_importance_resampling": ("rank",)}
    if name in nullable:  # nulls make these columns floats in one of the two
        ours, theirs = canonical(result.toPandas()), canonical(oracle_rows(llm_oracles()[name], DATA))
        for column in nullable[name]:
            ours[column], theirs[column] = ours[column].astype("float"), theirs[column].astype("float")
        assert ours.equals(theirs.astype(ours.dtypes.to_dict()))
    else:
        assert assert_same(result, llm_oracles()[name], DATA) > 0


def test_pipeline_against_plain_python(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()]
    rows = [(i, t) for i, t in rows if any(c.isalpha() for c in t or "")]
    roots = plain_components([plain_fingerprint(t) for _, t in rows])
    rows = [x for k, x in enumerate(rows) if roots[k] == k]
    bench = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {r[0] for r in plain_hits(rows, bench) if not r[4]}
    rows = [(i, t) for i, t in rows if i in clean]
    mixed = mixing.mix(docs.where(docs["doc_id"].isin(list(clean))), block_docs=corpus_pipeline.BLOCK_DOCS)
    order = [r["doc_id"] for r in sorted(mixed.collect(), key=lambda r: (r["slot"], r["place"]))]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    texts, at, expected = dict(rows), 0, []
    for doc_id in order:
        n = len(tokenizer.encode(texts[doc_id], add_special_tokens=False).ids) + 1
        expected.append((doc_id, at, n))
        at += n
    found = corpus_pipeline.run(spark, DATA).select("doc_id", "start", "n_tokens").collect()
    assert sorted((tuple(r) for r in found), key=lambda r: r[1]) == expected


@pytest.mark.parametrize("make", [edge_docs, empty_docs])
def test_stages_take_awkward_rows(spark, make, tmp_path):
    docs = make(spark)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DATA)
        if i + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
