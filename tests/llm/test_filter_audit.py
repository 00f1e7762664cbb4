"""The audit of filters against plain enumeration."""

import itertools
import random

import pytest
from compare import connect, difference

from logsight.llm import filter_audit as FA
from logsight.llm.queries import ORACLE, QUERIES


def plain(counts):
    """{(order, step): (kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)}"""
    out, shapley = {}, [0] * 5
    for order in itertools.permutations(range(5)):
        left = dict(counts)
        for i, f in enumerate(order):
            gone = {m: c for m, c in left.items() if m >> f & 1}
            left = {m: c for m, c in left.items() if m not in gone}
            fails = sum(c[0] for m, c in counts.items() if m >> f & 1)
            removed = [sum(c[k] for c in gone.values()) for k in range(3)]
            shapley[f] += removed[0]
            alone = counts.get(1 << f, (0, 0, 0))[0]
            key = "".join("ABCDE"[x] for x in order), i + 1
            out[key] = (sum(c[0] for c in left.values()), removed[0], fails - removed[0], alone, removed[1], removed[2])
    return {k: (*v, shapley["ABCDE".index(k[0][k[1] - 1])]) for k, v in out.items()}


def test_all_orders_by_adjacent_swaps():
    for n in range(6):
        order, seen = list(range(n)), {tuple(range(n))}
        for level in FA.adjacent_swaps(n):
            order[level], order[level + 1] = order[level + 1], order[level]
            seen.add(tuple(order))
        assert len(seen) == len(list(itertools.permutations(range(n))))


@pytest.mark.parametrize("seed", range(8))
def test_diagrams_against_enumeration(seed):
    rng = random.Random(seed)
    masks = rng.sample(range(32), rng.choice([0, 1, 3, 12, 32]))
    counts = {}
    for m in masks:
        n = rng.choice([0, 1, 5, 5, 900])
        counts[m] = (n, rng.randint(0, n), rng.randint(0, n))
    got = {(s.order, s.step): (s.kept, s.removed, s.redundant, s.unique_fails, s.good_lost, s.toxic_lost, share) for s, share in FA.audit(counts)}
    assert got == plain(counts)


def test_diagram_is_reduced():
    d = FA.Diagram({m: (1, 0, 0) for m in range(32)})
    assert len(d.var) == 7  # one node a level, one end, the empty node
    for level in FA.adjacent_swaps(5):
        d.swap(level)
        assert d.weight(d.root, {}) == (32, 0, 0)


def failures(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    capitals = len(re.findall("[A-Z]", text))
    bits = [len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * capitals > 10 * len(text), bool(re.search("[#$%&*|]", text))]
    return sum(1 << i for i, b in enumerate(bits) if b)


def test_counts_of_awkward_rows(spark, docs, rows, nothing):
    labels = spark.createDataFrame(
        [(3, 1, 0), (3, 0, 1), (40, 1, None), (42, None, 1), (None, 1, 1), (87, 1, 1), (9999, 1, 1)], "doc_id long, quality int, toxic int"
    )
    first = {}
    for i, t in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good, toxic, want = {3, 40, 87}, {3, 42, 87}, {}
    for i, t in rows:
        m = failures(t or "") | (16 if i is not None and first.get(t or "", i) < i else 0)
        n, g, x = want.get(m, (0, 0, 0))
        want[m] = n + 1, g + (i in good), x + (i in toxic)
    got = {r["mask"]: (r["n"], r["good"], r["toxic"]) for r in FA.failure_counts(docs, labels).collect()}
    assert got == want and all(r["part"] == "" for r in FA.failure_counts(docs, labels).collect())
    steps = FA.filter_audit(FA.failure_counts(docs, labels)).collect()
    assert {(r.filter_order, r.step): tuple(r)[3:] for r in steps} == plain(want) and len(steps) == 600
    assert FA.filter_audit(FA.failure_counts(nothing, labels)).count() == 0
    assert FA.filter_audit(FA.failure_counts(docs, labels.where("false"))).agg({"good_lost": "sum"}).first()[0] == 0


def test_query_against_sql(spark, sf_dir):
    assert difference(QUERIES["op12_filter_audit"](spark, sf_dir), connect(sf_dir), ORACLE["op12_filter_audit"]) is None
