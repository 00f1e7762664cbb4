"""Minimum-cost repair of the roles in conversations, and their rendering in a chat template.

A legal conversation is an optional system turn and then user and assistant turns in alternation, the first a
user's, the last an assistant's. Each turn is kept, merged into the one before it (same role), or given another
role; empty turns are put in where one is missing. A dynamic program over the automaton of legal turns finds
the cheapest repair. Steps of the program are matrices in (min, +) algebra, so a conversation of any length is
cut into blocks of turns: each block's matrix is computed apart, the matrices are chained, and each block is
then traced back with the states around it known.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsight.llm.scratch import written
from logsight.llm.text import prepare, whole_text

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 40
BLOCK_TURNS = 512


@dataclass(frozen=True)
class Costs:
    """Costs of the repairs; a role that is none of the three costs an unknown one to name."""

    merge: int = 1
    insert: int = 3
    relabel: int = 4
    unknown: int = 2


@dataclass(frozen=True)
class Template:
    before: str = "<|{role}|>\n"
    after: str = "\n"
    between: str = "\n"


#: What may follow what, without and with an empty turn in between.
FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
VIA = {(a, c): b for a, bs in FOLLOWS.items() for b in bs for c in FOLLOWS[b] if c not in bs}


def steps(costs: Costs) -> dict[str, np.ndarray]:
    """The cost of going from one state to another by a turn of each role; "" is any unknown role."""
    out = {}
    for role in (*ROLES, ""):
        m = np.full((4, 4), FAR, np.int64)
        for to in (SYSTEM, USER, ASSISTANT):
            name = costs.unknown if not role else costs.relabel * (ROLES[to - 1] != role)
            for of in range(4):
                if to in FOLLOWS[of]:
                    m[of, to] = name
                elif (of, to) in VIA:
                    m[of, to] = name + costs.insert
            m[to, to] = min(m[to, to], name + costs.merge)
        out[role] = m
    return out


def last_cost(state: int, costs: Costs) -> int:
    """What it costs to end in a state: an assistant's turn is put in where the last is not one."""
    return {START: 0, SYSTEM: 2 * costs.insert, USER: costs.insert, ASSISTANT: 0}[state]


def chained(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


def block_matrix(roles: list[str], costs: Costs) -> np.ndarray:
    """The cheapest cost from each state before a block of turns to each state after it."""
    table = steps(costs)
    out = np.full((4, 4), FAR, np.int64)
    np.fill_diagonal(out, 0)
    for role in roles:
        out = chained(out, table[role])
    return out


def trace(roles: list[str], begin: int, end: int, costs: Costs) -> list[int]:
    """The states after each turn of the cheapest way between two states; of equal ones the lower state."""
    table = steps(costs)
    costs_to = [np.where(np.arange(4) == begin, 0, FAR)]
    for role in roles:
        costs_to.append(np.minimum((costs_to[-1][:, None] + table[role]).min(axis=0), FAR))
    out, state = [], end
    for k in range(len(roles), 0, -1):
        out.append(state)
        state = int((costs_to[k - 1] + table[roles[k - 1]][:, state]).argmin())
    return out[::-1]


def repair(roles: list[str], costs: Costs) -> tuple[int, list[int]]:
    """The least cost of a whole conversation and the states after its turns."""
    total = block_matrix(roles, costs)[START]
    ends = [int(total[s]) + last_cost(s, costs) for s in range(4)]
    end = int(np.argmin(ends))
    return ends[end], trace(roles, START, end, costs)


def format_chats(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    costs: Costs | None = None,
    template: Template | None = None,
    block_turns: int = BLOCK_TURNS,
) -> DataFrame:
    """(id, position, turn, role, new_role, action, piece, cost) of every turn, and of every turn put in.

    Turns stand in the order of turn (null last), role and text; position numbers them in their conversation
    from 0, an empty turn that is put in has the position of the turn it stands before. action is keep,
    relabel, merge, relabel and merge, insert or end; cost is the step's, so a conversation's costs add up to the
    least possible. A conversation's rendering is its pieces in the order of position, puts in first: a message
    is closed where the next one begins, the last one by a row of its own with action end.

    Roles count without case and outer white space; other and null roles are unknown and get the cheapest one.
    Null texts are empty; a null id is a conversation like any other. Repeated turns are turns. A merged text
    follows the one before it after the template's `between`. A table without rows gives none. Other columns
    are not read.

    Turns are sorted across partitions by range and cut into blocks there, so a conversation of any length is
    dealt over tasks; of its blocks only 4 x 4 matrices come together.
    """
    spark = prepare(turns.sparkSession)
    costs, template = costs or Costs(), template or Template()
    role = F.lower(F.trim(F.col(role_col).cast("string")))
    rows = turns.select(
        F.col(id_col).alias("id"),
        F.col(turn_col).alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        F.when(role.isin(*ROLES), role).otherwise(F.lit("")).alias("known"),
        whole_text(text_col).alias("text"),
    )
    keys = ["id", F.col("turn").asc_nulls_last(), "role", "text"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *keys, F.rand(7)).sortWithinPartitions(*keys)
    blocks = _schema(rows, "part int, block bigint, at bigint")
    dealt = written(dealt.mapInArrow(_in_blocks(block_turns), blocks), "turns")

    steps_of = dealt.groupBy("id", "part", "block").agg(F.sort_array(F.collect_list(F.struct("at", "known"))).alias("steps"))
    matrix = steps_of.mapInArrow(_matrices(costs), _schema(rows.select("id"), "part int, block bigint, turns bigint, matrix array<bigint>"))
    chain = matrix.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("part", "block", "turns", "matrix"))).alias("chain"))
    around = "part int, block bigint, first bigint, begin int, end int, last boolean"
    states = written(chain.mapInArrow(_chained(costs), _schema(rows.select("id"), around)), "states")

    same = (F.col("s.id").eqNullSafe(F.col("d.id"))) & (F.col("s.part") == F.col("d.part")) & (F.col("s.block") == F.col("d.block"))
    full = dealt.alias("d").join(states.alias("s"), same).select(
        *[f"d.{c}" for c in ("id", "part", "block", "at", "turn", "role", "known", "text")],
        *[f"s.{c}" for c in ("first", "begin", "end", "last")],
    )
    made = "new_role string, action string, piece string, cost bigint"
    out_schema = T.StructType(
        [rows.schema["id"], T.StructField("position", T.LongType()), rows.schema["turn"], rows.schema["role"], *_fields(made)]
    )
    out = full.groupBy("id", "part", "block").applyInArrow(_rendered(costs, template, out_schema), out_schema)
    return out.withColumnsRenamed({"id": id_col, "turn": turn_col, "role": role_col})


def _fields(ddl: str) -> list[T.StructField]:
    return list(T.StructType.fromDDL(ddl).fields)


def _schema(rows: DataFrame, more: str) -> T.StructType:
    return T.StructType([*rows.schema.fields, *_fields(more)])


def _in_blocks(block_turns: int):
    """Numbers the turns of each conversation inside a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), _NONE, 0
        for batch in batches:
            at = np.zeros(batch.num_rows, np.int64)
            for k, name in enumerate(batch.column(0).to_pylist()):
                count = count + 1 if last is not _NONE and name == last else 0
                at[k], last = count, name
            columns = [pa.array([part] * len(at), pa.int32()), pa.array(at // block_turns), pa.array(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "part", "block", "at"])

    return run


_NONE = object()


def _matrices(costs: Costs):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles = [[s["known"] for s in steps] for steps in batch.column("steps").to_pylist()]
            found = [block_matrix(r, costs).ravel().tolist() for r in roles]
            columns = [pa.array([len(r) for r in roles], pa.int64()), pa.array(found, pa.list_(pa.int64()))]
            names = ["id", "part", "block", "turns", "matrix"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names[:3]], *columns], names=names)

    return run


def _chained(costs: Costs):
    """The states of the cheapest repair before and after each block of a conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, rows = [], []
            for k, chain in enumerate(batch.column("chain").to_pylist()):
                matrices = [np.array(b["matrix"]).reshape(4, 4) for b in chain]
                reach = [np.where(np.arange(4) == START, 0, FAR)]
                for m in matrices:
                    reach.append(np.minimum((reach[-1][:, None] + m).min(axis=0), FAR))
                state = int(np.argmin([int(reach[-1][s]) + last_cost(s, costs) for s in range(4)]))
                ends = [state]
                for m, before in zip(matrices[::-1], reach[-2::-1], strict=True):
                    ends.append(int((before + m[:, ends[-1]]).argmin()))
                ends.reverse()
                first = 0
                for i, b in enumerate(chain):
                    which.append(k)
                    rows.append((b["part"], b["block"], first, ends[i], ends[i + 1], i + 1 == len(chain)))
                    first += b["turns"]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            names = ["id", "part", "block", "first", "begin", "end", "last"]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(which, pa.int64())), *columns], names=names)

    return run


def render(
    turns: list[tuple], states: list[int], begin: int, first: int, last: bool, costs: Costs, template: Template
) -> Iterator[tuple]:
    """(index of the turn or None, position, new role, action, piece, cost) of turns with (role, known, text)."""
    table = steps(costs)
    state = begin

    def opened(role: int, after: int) -> str:
        return (template.after if after != START else "") + template.before.format(role=ROLES[role - 1])

    for k, ((known, text), to) in enumerate(zip(turns, states, strict=True)):
        position, cost, name = first + k, int(table[known][state, to]), ROLES[to - 1]
        relabel = "" if known == name else "relabel"
        if to == state:
            yield k, position, name, relabel + " and merge" if relabel else "merge", template.between + text, cost
            continue
        if to not in FOLLOWS[state]:
            between = VIA[state, to]
            yield None, position, ROLES[between - 1], "insert", opened(between, state), costs.insert
            state, cost = between, cost - costs.insert
        yield k, position, name, relabel or "keep", opened(to, state) + text, cost
        state = to
    if last:
        position = first + len(turns)
        while state in (SYSTEM, USER):
            to = FOLLOWS[state][0]
            yield None, position, ROLES[to - 1], "insert", opened(to, state), costs.insert
            state = to
        if state != START:
            yield None, position, ROLES[state - 1], "end", template.after, 0


def _rendered(costs: Costs, template: Template, schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("at")
        known, text = rows.column("known").to_pylist(), rows.column("text").to_pylist()
        begin, end, first, last = (rows.column(c)[0].as_py() for c in ("begin", "end", "first", "last"))
        states = trace(known, begin, end, costs)
        out = list(render(list(zip(known, text, strict=True)), states, begin, first, last, costs, template))
        at = pa.array([o[0] for o in out], pa.int64())
        made = {n: pa.array([o[i] for o in out], arrow.field(n).type) for i, n in ((1, "position"), (2, "new_role"), (3, "action"), (4, "piece"), (5, "cost"))}
        made |= {n: rows.column(n).take(at) for n in ("turn", "role")}
        made["id"] = rows.column("id").take(pa.array([0] * len(out), pa.int64()))
        return pa.table([made[f.name] for f in arrow], schema=arrow)

    return run
