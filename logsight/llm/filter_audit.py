"""How filters interact: what each removes in every order, read from decision diagrams of failure masks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsight.llm.scratch import written
from logsight.llm.text import prepare, whole_text
from logsight.operators.lookup import lookup

LETTERS = "ABCDE"
Count = tuple[int, int, int]  # documents, good ones, toxic ones
NONE: Count = (0, 0, 0)
#: The node without documents.
EMPTY = 0


def text_failures(text: Column) -> dict[str, Column]:
    """What a text fails by itself: A under 100 words, B many repeated words, C many capitals, D symbols."""
    # space and U+0009 to U+000D end a word
    words = F.array_remove(F.split(text, r"[ \t-\r]+"), "")
    capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 80 * F.size(words).cast("long"),
        "C": 100 * capitals.cast("long") > 10 * F.char_length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_counts(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """(part, mask, n, good, toxic): how many documents of a part fail exactly the filters of a mask (A is bit 0).

    A null text is empty, a null part the empty string. E fails where a smaller id has the same text anywhere in
    the table; a null id is neither smaller nor larger than another. A document is good or toxic if any row of
    its labels says so. Each row counts by itself, repeated ones too. Other columns are not read.

    Texts are reduced to masks and digests in the scan. Copies of one text may be any share of all rows: their
    smallest id is found by partial aggregates and looked up without a hot partition, as labels are.
    """
    text = whole_text(text_col)
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(text_failures(F.col("text")).values())), F.lit(0))
    rows = docs.select(
        F.col(id_col).alias("id"), text.alias("text"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part")
    )
    rows = rows.select("id", "part", F.sha2("text", 256).alias("digest"), mask.alias("mask"))
    rows = written(rows, "failures")
    copies = rows.groupBy("digest").agg(F.min("id").alias("first_id"), F.count("*").alias("rows")).where("rows > 1")
    rows = lookup(rows, written(copies, "copies"), ["digest"], "rows", ["id", "part"])
    rows = rows.select("id", "part", (F.col("mask") + F.when(F.col("id") > F.col("first_id"), 16).otherwise(0)).alias("mask"))

    label = F.col(id_col).cast(rows.schema["id"].dataType)
    known = labels.where(F.col(id_col).isNotNull()).groupBy(label.alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    ).where("good = 1 or toxic = 1")
    # ids that many rows share are counted before the labels join them
    counted = rows.groupBy("id", "part", "mask").agg(F.count("*").alias("n")).where("id is not null")
    nameless = rows.where("id is null").groupBy("part", "mask").agg(F.count("*").alias("n"))
    met = counted.join(known, "id", "left").unionByName(nameless, allowMissingColumns=True)
    return met.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


class Diagram:
    """An ordered, zero-suppressed decision diagram over filters, whose ends are counts of documents.

    A path takes `passes` or `fails` at each filter; a filter that no document of a node fails has no level
    there. Nodes with the same filter and branches are one. Two neighbouring filters of the order change places
    by rewriting the nodes of the upper one, so what is above and below stays as it is.
    """

    def __init__(self, counts: dict[int, Count], filters: int = len(LETTERS)):
        self.order = list(range(filters))
        self.var: list[int] = [-1]  # of each node; ends have -1
        self.branches: list[tuple[int, int]] = [(EMPTY, EMPTY)]  # passes, fails
        self.ends: dict[int, Count] = {EMPTY: NONE}
        self._nodes: dict[tuple, int] = {}
        self.root = self._build(0, {m: c for m, c in counts.items() if any(c)})

    def _build(self, level: int, counts: dict[int, Count]) -> int:
        if not counts:
            return EMPTY
        if level == len(self.order):
            return self._end(next(iter(counts.values())))
        bit = 1 << self.order[level]
        passes = self._build(level + 1, {m: c for m, c in counts.items() if not m & bit})
        return self._node(self.order[level], passes, self._build(level + 1, {m: c for m, c in counts.items() if m & bit}))

    def _new(self, key: tuple, var: int, branches: tuple[int, int]) -> int:
        self._nodes[key] = len(self.var)
        self.var.append(var)
        self.branches.append(branches)
        return len(self.var) - 1

    def _end(self, count: Count) -> int:
        if ("end", count) not in self._nodes:
            self.ends[self._new(("end", count), -1, (EMPTY, EMPTY))] = count
        return self._nodes["end", count]

    def _node(self, var: int, passes: int, fails: int) -> int:
        if fails == EMPTY:
            return passes
        key = (var, passes, fails)
        return self._nodes[key] if key in self._nodes else self._new(key, var, (passes, fails))

    def _split(self, node: int, var: int) -> tuple[int, int]:
        return self.branches[node] if self.var[node] == var else (node, EMPTY)

    def swap(self, level: int) -> None:
        """Let the filters at level and level + 1 change places."""
        upper, lower = self.order[level : level + 2]
        self.order[level : level + 2] = lower, upper
        self.root = self._swapped(self.root, upper, lower, set(self.order[:level]), {})

    def _swapped(self, node: int, upper: int, lower: int, above: set[int], done: dict[int, int]) -> int:
        if node not in done:
            passes, fails = self.branches[node]
            if self.var[node] in above:
                branches = (self._swapped(b, upper, lower, above, done) for b in (passes, fails))
                done[node] = self._node(self.var[node], *branches)
            elif self.var[node] == upper:
                (pp, pf), (fp, ff) = self._split(passes, lower), self._split(fails, lower)
                done[node] = self._node(lower, self._node(upper, pp, fp), self._node(upper, pf, ff))
            else:
                done[node] = node
        return done[node]

    def weight(self, node: int, known: dict[int, Count]) -> Count:
        """The documents at the ends of all paths from a node."""
        if node not in known:
            if node in self.ends:
                known[node] = self.ends[node]
            else:
                parts = [self.weight(b, known) for b in self.branches[node]]
                known[node] = tuple(map(sum, zip(*parts, strict=True)))
        return known[node]

    def steps(self, known: dict[int, Count]) -> Iterator[tuple[int, Count, Count]]:
        """(filter, kept, removed) along the path on which every filter is passed, in the present order."""
        node = self.root
        for var in self.order:
            node, fails = self._split(node, var)
            yield var, self.weight(node, known), self.weight(fails, known)


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels whose swaps, one after the other, lead from one order of n filters through all the others."""
    if n < 2:
        return
    inner, down = adjacent_swaps(n - 1), True
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        yield step + down  # the last filter now stands first, so the others are one level lower
        down = not down


@dataclass(frozen=True)
class Step:
    order: str
    step: int
    kept: int
    removed: int
    redundant: int
    unique_fails: int
    good_lost: int
    toxic_lost: int


def audit(counts: dict[int, Count]) -> list[tuple[Step, int]]:
    """The steps of all orders of the filters, each with its filter's removals summed over all orders."""
    diagram, known = Diagram(counts), {}
    n = len(diagram.order)
    fails = [sum(c[0] for m, c in counts.items() if m >> f & 1) for f in range(n)]
    alone = [counts.get(1 << f, NONE)[0] for f in range(n)]
    found, shares = [], [0] * n
    for level in [None, *adjacent_swaps(n)]:
        if level is not None:
            diagram.swap(level)
        order = "".join(LETTERS[f] for f in diagram.order)
        for i, (f, kept, removed) in enumerate(diagram.steps(known)):
            step = Step(order, i + 1, kept[0], removed[0], fails[f] - removed[0], alone[f], removed[1], removed[2])
            shares[f] += removed[0]
            found.append((f, step))
    return [(step, shares[f]) for f, step in found]


SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def filter_audit(counts: DataFrame) -> DataFrame:
    """One row for each part, order of the five filters and step; counts as `failure_counts` gives them.

    kept documents are left after a step, removed ones went in it, redundant ones fail its filter but went
    earlier; unique_fails fail no other filter; good_lost and toxic_lost are among the removed. shapley is what
    the filter removes, summed over all orders. A part has at most 32 counts, so parts are the unit of work. No
    counts give no rows.
    """
    import pandas as pd

    prepare(counts.sparkSession)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        masks = {int(m): (int(n), int(g), int(t)) for m, n, g, t in rows[["mask", "n", "good", "toxic"]].to_numpy()}
        part = rows["part"].iloc[0]
        out = [
            (part, s.order, s.step, s.kept, s.removed, s.redundant, s.unique_fails, s.good_lost, s.toxic_lost, share)
            for s, share in audit(masks)
        ]
        return pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return counts.groupBy("part").applyInPandas(run, SCHEMA)
