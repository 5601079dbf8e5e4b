"""The corpus pipeline against a plain version built from the operators' per-text rules."""

import pytest

import corpus_pipeline
from homespan.llm import pii, queries, trie_bpe
from test_set_operators import plain_components, plain_fingerprint, plain_leaks

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "rows")
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_each_stage_keeps_what_a_plain_version_keeps(spark, stages):
    documents = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    good, single, clean, private, encoded = ({r.doc_id: r for r in s.collect()} for s in stages)
    assert set(good) == {r.doc_id for r in queries.op1_quality(spark, FOLDER).where("kept").collect()}
    groups = plain_components({i: plain_fingerprint(r.text or "") for i, r in good.items()})
    assert set(single) == set(groups.values())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert set(clean) == set(single) - {d for d, *_ in plain_leaks([(i, r.text) for i, r in single.items()], items)}
    assert set(private) == set(encoded) == set(clean)
    for i, r in private.items():
        assert not pii.base_spans(r.text) and r.n_chars == len(r.text)
        assert (r.text == documents[i].text) == (not pii.find(documents[i].text, pii.fit(stages[2]))[1]) if i % 20 == 0 else True
    bpe = trie_bpe.encoder(queries.tokenizer_path())
    assert all(list(r.token_ids) == bpe.encode([r.text])[0].tolist() for r in encoded.values())


def test_columns_and_odd_rows(spark, stages, odd_docs, no_docs):
    names = spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    assert all(s.columns == names for s in stages[:-1])
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            assert set(docs.columns) <= set(stage(spark, docs, FOLDER).columns)
            stage(spark, docs, FOLDER).collect()
