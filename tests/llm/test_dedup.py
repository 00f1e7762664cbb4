"""Exact, near and suffix-array deduplication against brute force."""

import hashlib
import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from logsight.llm import suffix_array, suffix_dedup
from logsight.llm.components import components
from logsight.llm.exact_dedup import exact_dedup
from logsight.llm.hypermin import Banding, accidental, band_keys, densified, registers
from logsight.llm.near_dedup import _candidates, near_dedup
from logsight.llm.queries import QUERIES

LAST = 1 << 70


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


@pytest.mark.parametrize("digest_all", [True, False])
def test_exact_groups(docs, rows, nothing, digest_all):
    groups = defaultdict(list)
    for i, t in rows:
        groups[bare(t)].append((-len(t or ""), i is None, i, t))
    expected = []
    for text, own in groups.items():
        best = min(own, key=lambda x: (x[0], x[1], x[2] or 0))
        for p, _, i, _ in own:
            expected.append((str(i), str(best[2]), len(own), i == best[2] and p == best[0]))
    found = exact_dedup(docs, digest_all=digest_all).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in found) == sorted(expected)
    if digest_all:
        assert sorted(r.digest for r in found) == sorted(hashlib.sha256(bare(t).encode()).hexdigest() for _, t in rows)
    assert exact_dedup(nothing).count() == 0


def test_hubs_of_larger_buckets_without_a_join_by_node(spark):
    bands = {1: range(10), 2: range(5, 15), 3: range(3), 4: [7, 20]}
    rows = [(b, len(own), bytes([k])) for b, own in bands.items() for k in own]
    weight = defaultdict(int)
    for _, size, key in rows:
        weight[key] += size - 1
    star, pairs = _candidates(spark.createDataFrame(rows, "band long, size long, key binary"))
    hubs = {b: max((weight[bytes([k])], bytes([k])) for k in own)[1] for b, own in bands.items() if len(own) > 8}
    expected = {(hubs[b], bytes([k])) for b in hubs for k in bands[b] if bytes([k]) != hubs[b]}
    assert {(bytes(r.hub), bytes(r.key)) for r in star.distinct().collect()} == expected
    near = {tuple(sorted(p)) for p in expected} | {(bytes([a]), bytes([b])) for b_ in (3, 4) for a, b in combinations(bands[b_], 2)}
    assert {(bytes(r.a), bytes(r.b)) for r in pairs.collect()} == near
    # the only join is that of buckets and hubs
    assert star._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def near_brute(rows, n, per_mille):
    sets = [shingles(t, n) for _, t in rows]
    group = list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 1000 * both >= per_mille * (len(sets[a]) + len(sets[b]) - both):
            group[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = root(k)
        least[r] = min(least.get(r, LAST), LAST if i is None else i)
    out = []
    for k, (i, _) in enumerate(rows):
        c = least[root(k)]
        c = None if c == LAST else c
        out.append((str(i), len(sets[k]), str(c), i == c))
    return sorted(out)


@pytest.mark.parametrize(("n", "threshold"), [(3, 0.85), (5, 0.8)])
def test_near_groups(docs, rows, nothing, n, threshold):
    found = near_dedup(docs, words=n, threshold=threshold).collect()
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in found)
    assert got == near_brute(rows, n, round(1000 * threshold))
    assert near_dedup(nothing).count() == 0


def test_near_groups_when_all_buckets_are_large(spark, monkeypatch):
    """Hub and blocks alone find what all pairs would."""
    from logsight.llm import near_dedup as module

    rng = random.Random(9)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(25)}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(module, "SMALL_BUCKET", 1)
    monkeypatch.setattr(module, "BLOCK", 7)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_dedup(docs, words=3, threshold=0.85).collect())
    expected = near_brute(rows, 3, 850)
    assert got == expected
    assert 1 < len({c for _, _, c, _ in expected}) < 60


def test_registers_agree_as_sets_do():
    rng = np.random.default_rng(2)
    size = Banding(0.8).registers
    pool = np.sort(rng.integers(0, 1 << 52, 1400).astype(np.uint64))
    a, b = pool[:1200], pool[200:]
    ra, rb = (registers(x, np.array([len(x)]), size)[0] for x in (a, b))
    share = ((ra == rb) & (ra > 0)).mean()
    chance = accidental(np.array([1200.0]), np.array([1200.0]), size)[0]
    assert abs((share - chance) / (1 - chance) - 1000 / 1400) < 0.1
    assert 0 < chance < 0.01


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, 200 + i) for i in range(1, 60)] + [(5, 5), (1, 0)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(101)} | {200 + i: 200 for i in range(60)}


def suffix_brute(rows, length):
    least = {}
    for i, t in rows:
        raw = (t or "").encode()
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            least[w] = min(least.get(w, LAST), LAST if i is None else i)
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        cover = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if least[raw[p : p + length]] < (LAST if i is None else i):
                cover[p : p + length] = b"\1" * length
        kept = bytes(c for c, x in zip(raw, cover, strict=True) if not x)
        spans = sum(1 for k, x in enumerate(cover) if x and not (k and cover[k - 1]))
        out.append((str(i), len(raw), sum(cover), spans, kept))
    return sorted(out)


def test_removed_strings(docs, rows, nothing):
    found = suffix_dedup.suffix_dedup(docs, carry=["key", "part"]).collect()
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found)
    assert got == suffix_brute(rows, 50)
    assert all(r.carried.key == "k" and sum(b - a for a, b in r.spans) == r.n_removed for r in found)
    assert suffix_dedup.suffix_dedup(nothing).count() == 0


def test_shards_that_share_an_anchor_are_merged(monkeypatch):
    """One anchor's snippets over many shards give what one shard does."""
    rng = random.Random(4)
    middle = "".join(rng.choice("ab") for _ in range(30))
    lefts, rights = (["".join(rng.choice("ab") for _ in range(16)) for _ in range(4)] for _ in range(2))
    snippets = [(rng.choice(lefts)[-rng.randint(12, 16) :] + middle + rng.choice(rights)).encode() for _ in range(200)]
    length = 50
    windows = np.array([len(s) - length + 1 for s in snippets])
    text = np.frombuffer(b"".join(snippets), np.uint8)
    sizes = np.array([len(s) for s in snippets])
    begins = np.cumsum(sizes) - sizes
    owner = np.array([rng.randrange(40) for _ in snippets])
    args = (text, begins, windows, owner, np.zeros(200, np.uint64), np.ones(200, bool), length)
    one = suffix_dedup._flagged(*args)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 500)
    many = suffix_dedup._flagged(*args)
    assert len(one[0]) and all((a == b).all() for a, b in zip(one, many, strict=True))
    least = {}
    for s, o in zip(snippets, owner, strict=True):
        for p in range(len(s) - length + 1):
            least[s[p : p + length]] = min(least.get(s[p : p + length], LAST), o)
    flagged = {(k, p) for k, s in enumerate(snippets) for p in range(len(s) - length + 1) if least[s[p : p + length]] < owner[k]}
    got = {(k, p) for k, a, n in zip(*one, strict=True) for p in range(a, a + n - length + 1)}
    assert got == flagged


def test_suffix_order_of_any_bytes():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 3, 500).astype(np.uint8)
    rank = suffix_array.suffix_ranks(text, 50)
    keys = [bytes(text[i : i + 50]) for i in range(450)]
    order = sorted(range(450), key=lambda i: keys[i])
    assert all((rank[a] < rank[b]) == (keys[a] < keys[b]) for a, b in zip(order, order[1:], strict=False))


@pytest.mark.parametrize(("name", "brute"), [("op10_near_dedup", near_brute), ("op5_suffix_dedup", suffix_brute)])
def test_queries_over_a_whole_small_table(spark, sf_dir, name, brute):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = QUERIES[name](spark, sf_dir).collect()
    if name.startswith("op10"):
        got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in found)
        assert got == brute(rows, 3, 850)
    else:
        got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)
        assert got == sorted((*x[:4], hashlib.sha256(x[4]).hexdigest()) for x in brute(rows, 50))


def common_line():
    rng = random.Random(4)
    return [(i, f"{rng.getrandbits(200):x} Licensed to whom it concerns {rng.getrandbits(200) if i % 9 else 7:060x}") for i in range(300)]


def test_windows_of_a_common_anchor_go_to_many_buckets(monkeypatch):
    import zstandard

    monkeypatch.setattr(suffix_dedup, "SPLIT_BYTES", 2000, raising=False)
    pack = zstandard.ZstdCompressor().compress
    rows = common_line()
    docs = pa.table({"id": [i for i, _ in rows], "part": [0] * 300, "packed": pa.array([pack(t.encode()) for _, t in rows], pa.binary())})
    hashes = suffix_dedup._hash_sender(50, 1)(docs)
    shared = suffix_dedup._sharer(suffix_dedup.SPLIT_BYTES)(hashes) if hasattr(suffix_dedup, "_sharer") else suffix_dedup._shared(hashes)
    sent = suffix_dedup._snippet_sender(50, 64)(docs, shared).to_pylist()
    size = [len(suffix_dedup._unpack(r["payload"], suffix_dedup.SNIPPETS)[4]) for r in sent if r["bucket"] >= 0]
    assert len(size) == 64 and max(size) < sum(size) / 20


def test_split_anchors_give_the_same_spans(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SPLIT_BYTES", 2000, raising=False)
    rows = common_line() + [(i + 300, t[20:]) for i, t in common_line()[::7]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = suffix_dedup.suffix_dedup(docs).collect()
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found)
    assert got == suffix_brute(rows, 50)
    assert sum(r[2] for r in got) > 1000


@pytest.mark.parametrize(("n", "shared"), [(5, 4), (20, 16), (60, 30), (390, 117)])
def test_bands_follow_the_similarity_of_short_and_long_sets(n, shared):
    """Empty registers that borrow agree as often as the sets do."""
    rng, banding = np.random.default_rng(n), Banding(0.8)
    a, b = [], []
    for _ in range(300):
        union, own = rng.integers(0, 1 << 52, n).astype(np.uint64), (n - shared) // 2
        a.append(np.sort(union[: shared + own]))
        b.append(np.sort(np.concatenate([union[:shared], union[shared + own :]])))
    ra, rb = (registers(np.concatenate(x), np.array([len(s) for s in x]), banding.registers) for x in (a, b))
    da, db = densified(ra), densified(rb)
    assert (da != 0).all() and abs((da == db).mean() - shared / n) < 0.02
    met = (band_keys(ra, banding.rows)[0] == band_keys(rb, banding.rows)[0]).mean()
    assert abs(met - (shared / n) ** banding.rows) < 0.03
    assert not densified(np.zeros((2, banding.registers), np.uint16)).any()
