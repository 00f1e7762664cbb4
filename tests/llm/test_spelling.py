"""Spelling variants against a comparison of all words with all."""

import itertools
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import connect, difference

from logsight.llm import spelling
from logsight.llm.queries import ORACLE, QUERIES


def near(a, b):
    """One insertion, deletion or replacement, by trying all of them at the first difference."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(counts):
    out = {}
    for w, n in counts.items():
        others = [(-m, o) for o, m in counts.items() if near(w, o)]
        best = min(others, default=None)
        form = best[1] if best and -best[0] >= 2 * n else None
        out[w] = (n, len(others), form, counts[form] if form else None)
    rows = set()
    for w, v in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        rows.add((w, *v, root))
    return rows


def variants(spark, counts, **kw):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    return {tuple(r) for r in spelling.spelling_variants(words, **kw).collect()}


def words_of(seed, n=250):
    rng = random.Random(seed)
    made = set()
    while len(made) < n:
        w = "".join(rng.choice("abé") for _ in range(rng.choice([5, 5, 6, 7, 8, 12])))
        made.add(w)
        i = rng.randrange(len(w))
        made.add(rng.choice([w[:i] + w[i + 1 :], w[:i] + "ÿ" + w[i:], w[:i] + "z" + w[i + 1 :]]))
    return {w: rng.choice([3, 3, 4, 8, 9, 20, 100]) for w in made if len(w) >= 5}


@pytest.mark.parametrize("seed", range(6))
def test_sorted_scan_finds_all_pairs(seed):
    rng = random.Random(seed)
    lists = [sorted({"".join(rng.choice("abc") for _ in range(rng.choice([0, 1, 2, 4, 6]))) for _ in range(60)}) for _ in range(4)]
    words, group = sum(lists, []), np.repeat([-5, 2, 3, 9], list(map(len, lists)))
    got = [(i, j) for a, b in spelling.SortedList(words, group).near() for i, j in zip(a.tolist(), b.tolist())]
    want = {(i, j) for i, j in itertools.combinations(range(len(words)), 2) if group[i] == group[j] and near(words[i], words[j])}
    assert set(got) == want and len(got) == len(want)


def test_one_edit():
    for a, b in itertools.product(["", "a", "b", "ab", "ba", "abc", "abd", "aabc", "abcd", "xabc"], repeat=2):
        assert spelling.one_edit(a, b) == near(a, b)


@pytest.mark.parametrize("largest", [20_000, 4])
def test_variants_against_all_pairs(spark, largest):
    counts = words_of(largest)
    assert variants(spark, counts, largest=largest) == plain(counts)


def test_long_and_repetitive_words(spark):
    counts = {"a" * k: 3 + 7 * (k % 5) for k in range(5, 60)} | {"b" * 3000: 3, "b" * 2999: 6, "b" * 1500 + "c" + "b" * 1499: 12}
    assert variants(spark, counts, largest=8) == plain(counts)


def test_ties_and_chains(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaaac": 6, "aaaabb": 12, "aaaabbb": 24, "aaaabbbb": 48, "zzzzz": 5}
    got = {r[0]: r for r in variants(spark, counts)}
    assert got["aaaaa"][3] == "aaaab" and got["aaaaa"][5] == "aaaabbbb" and got["zzzzz"][2:] == (0, None, None, "zzzzz")


def plain_counts(rows):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def test_vocabulary_of_awkward_rows(spark, docs, rows, nothing):
    more = docs.unionByName(docs.limit(0))
    assert dict(map(tuple, spelling.vocabulary(more).collect())) == plain_counts(rows)
    assert spelling.spelling_variants(spelling.vocabulary(nothing)).count() == 0


def test_query_over_a_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_spelling"](spark, sf_dir)
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert {r.word: r.n for r in got.collect()} == plain_counts(rows)
    assert difference(got, connect(sf_dir), ORACLE["op13_spelling"]) is None
