"""Encoding, counting and packing against the tokenizers library."""

import os
import random
from array import array
from collections import defaultdict

import pytest

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
tokenizers = pytest.importorskip("tokenizers")

from logsight.llm import packing  # noqa: E402
from logsight.llm.bpe import Encoder, encode_decode  # noqa: E402
from logsight.llm.queries import tokenizer_path  # noqa: E402
from logsight.llm.token_counts import Counter, token_counts  # noqa: E402

WORD, BYTE = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")
LETTERS = "aábcΣσς .,'!<|>endoftext\n\t\xa0\x1cć  12sdlvre¡ÿ\x85　"


@pytest.fixture(scope="module")
def word_library():
    return tokenizers.Tokenizer.from_file(WORD)


def strings(n, longest=30):
    rng = random.Random(3)
    for _ in range(n):
        s = "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, longest)))
        yield s + " <|endoftext|> " + s[:3] if rng.random() < 0.2 else s


def test_prefix_encoding_of_any_string(word_library):
    e = Encoder(WORD)
    for s in strings(3000):
        expected = word_library.encode(s, add_special_tokens=False).ids
        parts = e.encode(s)
        assert array("I", b"".join(parts)).tolist() == expected, repr(s)
        assert e.decode_parts(parts) == word_library.decode(expected, skip_special_tokens=False)


def test_encode_decode_of_all_rows(docs, rows, nothing, word_library):
    got = sorted((r.doc_id or -1, r.ids, r.decoded) for r in encode_decode(docs, WORD).collect())
    expected = []
    for i, t in rows:
        ids = word_library.encode(t or "", add_special_tokens=False).ids
        expected.append((i or -1, array("I", ids).tobytes(), word_library.decode(ids, skip_special_tokens=False)))
    assert [(i, bytes(x), s) for i, x, s in got] == sorted(expected)
    assert encode_decode(nothing, WORD).count() == 0


def test_spliced_counts_of_any_string():
    library = tokenizers.Tokenizer.from_file(BYTE)
    small, whole = Counter(BYTE, 40, 6), Counter(BYTE, 1 << 30, 6)
    for k, s in enumerate(strings(2000)):
        long = s * (1 + k % 9)
        expected = len(library.encode(long, add_special_tokens=False))
        assert (small.count(long), whole.count(long)) == (expected, expected), repr(long)


def test_a_text_without_boundaries_is_encoded_whole():
    library = tokenizers.Tokenizer.from_file(BYTE)
    text = "ab" * 5000
    assert Counter(BYTE, 100, 10).count(text) == len(library.encode(text, add_special_tokens=False))


def test_token_counts_of_all_rows(docs, rows, nothing):
    library = tokenizers.Tokenizer.from_file(BYTE)
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, BYTE, chunk_chars=2000).collect())
    counts = [(i or -1, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for i, t in rows]
    assert got == sorted((i, b, n, n > 512) for i, b, n in counts)
    assert token_counts(nothing, BYTE).count() == 0


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing(docs, rows, nothing, word_library, capacity):
    pieces = packing.pack(docs, WORD, capacity=capacity, end_id=1).collect()
    expected = sorted(array("I", [*word_library.encode(t or "", add_special_tokens=False).ids, 1]).tobytes() for _, t in rows)
    sequences, documents = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        sequences[p.sequence_id].append(p)
        documents[p.doc_id, p.doc_tokens].append(p)
    padding = 0
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        total = 0
        for p in own:
            assert p.offset == total
            total += p.length
        assert total <= capacity
        padding += 0 if total & (total - 1) == 0 else capacity - total
    assert padding <= 0.05 * sum(p.length for p in pieces)
    single = [b"".join(bytes(p.ids) for p in sorted(own, key=lambda p: p.start)) for (i, n), own in documents.items() if sum(p.length for p in own) == n]
    assert set(single) <= set(expected)
    assert sum(p.length for p in pieces) == sum(len(x) // 4 for x in expected)
    assert packing.pack(nothing, WORD).count() == 0


@pytest.mark.parametrize("capacity", [64, 2048])
def test_classes_have_fixed_counts_that_fit(capacity):
    for n in range(1, 3 * capacity):
        found = list(packing.cuts(n, capacity))
        assert sum(length for length, _ in found) == n
        assert all(length * k <= capacity < (length + 1) * k + length for length, k in found)


def test_the_query_has_the_digests(spark, sf_dir):
    from logsight.llm.queries import QUERIES

    r = QUERIES["op1_packing"](spark, sf_dir).first()
    assert r.ids_crc32 >= 0 and r.length > 0
