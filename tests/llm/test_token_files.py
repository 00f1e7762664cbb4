"""Token files: order, positions, layout and selective reads."""

import os
import random
import zlib
from array import array

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from logsight.llm import token_files as TF
from logsight.llm.queries import QUERIES, tokenizer_path
from logsight.scratch import scratch_path

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
tokenizers = pytest.importorskip("tokenizers")
WORD = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(WORD)


def expected(library, rows):
    """(id, start, n_tokens, ids) by the library, in id order, null ids last."""
    coded = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]
    return sorted(coded, key=lambda r: (r[0] is None, r[0] or 0))


@pytest.fixture(scope="module")
def folder(spark, docs):
    path = scratch_path(spark, "tokens-test")
    layout = TF.TokenLayout(row_group_bytes=2_000, page_bytes=1_000, page_rows=5)
    TF.write_tokens(docs, path, WORD, carry=["lang", "key", "part"], files=3, layout=layout)
    return path


def test_all_rows_in_order(spark, folder, rows, library):
    got = TF.read_tokens(spark, folder).orderBy("start").collect()
    want = expected(library, rows)
    assert [r.id for r in got] == [i for i, _ in want]
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(len(got))]
    assert sorted((r.id or -1, list(r.ids)) for r in got) == sorted((i or -1, ids) for i, ids in want)
    assert {(r.meta.key, r.meta.part, r.meta.lang) for r in got} == {("k", "p", None)}


def test_layout_of_the_files(folder):
    files = [os.path.join(folder, "tokens", f) for f in os.listdir(os.path.join(folder, "tokens")) if f.endswith(".parquet")]
    assert len(files) == 3
    for f in files:
        meta = pq.ParquetFile(f).metadata
        assert meta.num_row_groups > 1
        names = [meta.schema.column(i).path for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            columns = {n: meta.row_group(g).column(i) for i, n in enumerate(names)}
            assert "DELTA_BINARY_PACKED" in columns["local_start"].encodings and "DELTA_BINARY_PACKED" in columns["id"].encodings
            assert columns["ids.list.element"].has_dictionary_page
            assert all(c.has_column_index and c.has_offset_index for n, c in columns.items() if n in ("id", "local_start"))


def test_delta_layout_holds_the_same(spark, docs, folder, tmp_path):
    path = scratch_path(spark, "tokens-test")
    TF.write_tokens(docs, path, WORD, files=2, layout=TF.TokenLayout(ids="delta"))
    a, b = (sorted((r.id or -1, list(r.ids)) for r in TF.read_tokens(spark, p).collect()) for p in (path, folder))
    assert a == b
    with pytest.raises(ValueError):
        TF.TokenLayout(ids="plain").options()


def test_reads_of_some_columns_and_rows(spark, folder, capsys):
    index = TF.read_tokens(spark, folder).select("id", "start", "n_tokens")
    index.explain()
    plan = capsys.readouterr().out
    assert "ids:" not in plan and "meta:" not in plan
    one = TF.read_tokens(spark, folder, F.col("id") == 87)
    one.explain()
    assert "EqualTo(id,87)" in capsys.readouterr().out
    assert [r.id for r in one.collect()] == [87]


def test_spans(spark, folder):
    whole = [i for r in TF.read_tokens(spark, folder).orderBy("start").collect() for i in r.ids]
    for first, end in ((0, 1), (10, 700), (1000, 9000), (len(whole) - 3, len(whole) + 50), (len(whole), len(whole) + 9)):
        pieces = TF.read_span(spark, folder, first, end).orderBy("start").collect()
        assert [i for p in pieces for i in p.ids] == whole[first:end]


def test_empty_table(spark, nothing):
    path = scratch_path(spark, "tokens-test")
    TF.write_tokens(nothing, path, WORD)
    assert TF.with_crc32(TF.read_tokens(spark, path)).count() == 0
    assert TF.read_span(spark, path, 0, 10).count() == 0


def test_what_a_worker_keeps_is_bounded_in_bytes(library):
    small = TF.KeptEncoder(WORD, kept_bytes=20_000)
    texts = [f"{'x' * 20_000} word{i} <|endoftext|>y{i % 7}" for i in range(60)]
    for t in texts:
        ids = array("I", small.encode(t)).tolist()
        assert ids == library.encode(t, add_special_tokens=False).ids
    assert max(map(len, small)) <= TF.LONGEST_KEPT and small.size <= 21_000


def test_encoding_of_any_string(library):
    rng, encoder = random.Random(4), TF.KeptEncoder(WORD)
    letters = "aábcÇÉñßŁĄſŉİıΣσς .,'!<|>endoftext\n\t\xa0\x1c\u0301\0ć  12sdlvre¡ÿ×÷\x85　ZQ"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        assert array("I", encoder.encode(text)).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_query_over_a_whole_table(spark, sf_dir, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    start, want = 0, []
    for i, ids in expected(library, docs):
        want.append((i, start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
    got = sorted(tuple(r) for r in QUERIES["op11_token_files"](spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == want
