"""Exact search and role repair against brute force."""

import itertools
import random
from collections import defaultdict

import numpy as np
import pytest

from logsight.llm import chat, topk
from logsight.llm.chat import ASSISTANT, FOLLOWS, START, SYSTEM, USER, Costs, Template, format_chats
from logsight.llm.topk import BallTree, top_k

NAN, INF = float("nan"), float("inf")


def brute_top(rows, queries, k):
    whole = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            whole[i] = [int(np.floor(1024 * np.float64(np.float32(x)))) for x in v]
    out = []
    for q in queries:
        if q in whole:
            scored = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_top_k(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(topk, "SHARD_ROWS", 40)
        monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6).astype(np.float32)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(20)]  # ties
    rows += [(400, None), (401, []), (402, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (403, [NAN] * 6), (404, [INF] + [0.0] * 5), (None, rows[0][1])]
    rows += [rows[9], (405, [0.5, 0.5]), (406, [0.25, 0.5]), (407, [-0.25, 0.5])]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    queries = [0, 7, 9, 300, 305, 400, 403, 405]
    found = top_k(vectors, vectors.where(vectors.vec_id.isin(queries)), k=10)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == brute_top(dict(rows).items(), queries, 10)
    none = vectors.where("false")
    assert top_k(none, none).count() == 0
    assert top_k(vectors, none).count() == 0


def test_no_row_exceeds_its_node_bound():
    rng = np.random.default_rng(2)
    rows, queries = np.floor(rng.normal(size=(500, 8)) * 1000), np.floor(rng.normal(size=(20, 8)) * 1000)
    tree = BallTree(rows)
    bounds = tree.bounds(queries)
    for node, (lo, hi) in enumerate(zip(tree.low, tree.high, strict=True)):
        assert ((queries @ rows[tree.order[lo:hi]].T).max(axis=1) <= bounds[:, node]).all()


def brute_cost(roles, costs):
    """The least cost over all choices of a new role, or a merge, for each turn, empty turns put in as needed."""
    best = None
    for choice in itertools.product((SYSTEM, USER, ASSISTANT), repeat=len(roles)):
        for merged in itertools.product((False, True), repeat=len(roles)):
            cost, state = 0, START
            for role, to, joined in zip(roles, choice, merged, strict=True):
                cost += costs.unknown if role == "" else costs.relabel * (chat.ROLES[to - 1] != role)
                if joined:
                    if state != to:
                        break
                    cost += costs.merge
                    continue
                gap = next((n for n, ways in ((0, FOLLOWS[state]), (1, [c for b in FOLLOWS[state] for c in FOLLOWS[b]])) if to in ways), None)
                if gap is None:
                    break
                cost += gap * costs.insert
                state = to
            else:
                cost += {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[state] * costs.insert
                best = cost if best is None else min(best, cost)
    return best


def test_repair_is_the_cheapest():
    rng = random.Random(8)
    for costs in (Costs(), Costs(merge=5, insert=1, relabel=2, unknown=1)):
        for _ in range(60):
            roles = [rng.choice([*chat.ROLES, ""]) for _ in range(rng.randint(0, 5))]
            assert chat.repair(roles, costs)[0] == brute_cost(roles, costs), roles


@pytest.mark.parametrize("block", [2, 512])
def test_chats_in_blocks(spark, block):
    rng = random.Random(6)
    rows = []
    for conv in range(12):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "User ", "system", "tool", None])
            rows.append((conv, turn, role, rng.choice(["hi", "", None, "é\n"]), "x"))
    rows += [rows[0], (None, 1, "assistant", "a", "x"), (3, None, "user", "end", "x")]
    # a conversation with a third of all turns
    rows += [(99, t, rng.choice(chat.ROLES), f"t{t}", "x") for t in range(40)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string").repartition(4)
    found = defaultdict(list)
    for r in format_chats(turns, block_turns=block).collect():
        found[r.conv_id].append(r)
    given = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
        given[r[0]].append(r)
    assert set(found) == set(given)
    for conv, own in found.items():
        known = [(r[2] or "").strip().lower() for r in given[conv]]
        known = [k if k in chat.ROLES else "" for k in known]
        assert sum(r.cost for r in own) == chat.repair(known, Costs())[0]
        own.sort(key=lambda r: (r.position, r.action != "insert", r.action == "end"))
        assert [r.turn for r in own if r.action not in ("insert", "end")] == [r[1] for r in given[conv]]
        text = "".join(r.piece for r in own)
        roles = [part.split("|>")[0] for part in text.split("<|")[1:]]
        roles = roles[1:] if roles[0] == "system" else roles
        assert roles == ["user", "assistant"] * (len(roles) // 2) and roles
        assert text.endswith(Template().after)
        assert all((r[3] or "") in text for r in given[conv])
    assert format_chats(turns.where("false")).count() == 0
