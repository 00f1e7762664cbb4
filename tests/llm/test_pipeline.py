"""The pipeline's stages on awkward rows, and over a small table as a whole."""

import os
from array import array

import corpus_pipeline
from logsight.llm.queries import ORACLE, QUERIES, tokenizer_path


def test_stages_take_any_rows(spark, docs, rows, nothing, sf_dir):
    for table in (docs, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, sf_dir)
            assert out.columns == table.columns and out.count() <= table.count()
        assert corpus_pipeline.STAGES[-1][1](spark, table, sf_dir).columns[:3] == ["doc_id", "start", "length"]


def test_one_of_each_group_stays(spark, docs):
    left = corpus_pipeline.distinct_documents(spark, docs, "")
    texts = ["".join((r.text or "").split()) for r in left.collect()]
    assert len(texts) == len(set(texts))
    near = corpus_pipeline.dissimilar_documents(spark, left, "").collect()
    assert {r.doc_id for r in near} >= {0, 46} and not {r.doc_id for r in near} & {50, 51, 52}


def test_run_over_a_small_table(spark, sf_dir):
    import tokenizers

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    library = tokenizers.Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    expected = {r.doc_id: array("I", [*library.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in docs.collect()}
    got: dict = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        got.setdefault(p.doc_id, array("I")).frombytes(bytes(p.ids))
    assert got == expected


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
