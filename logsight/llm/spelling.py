"""Spelling variants in a vocabulary: words one edit apart, found by dynamic programming along sorted lists.

The edit matrix of a word against a sorted list is filled row by row, a band of three cells each. Rows of what
a word of the list shares with its predecessor are used again; when all cells of a row exceed one edit, every
following word that shares the prefix up to it is passed over.

The list is cut first. One edit leaves at least half of the shorter word untouched at its start or its end, so
words meet in groups with equal starts and equal ends of that length; groups that are too large are halved again
by what is left between the parts they share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsight.llm.scratch import written
from logsight.llm.text import prepare, whole_text

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What ends a run of letters once A to Z are lower-cased.
NO_LETTER = r"[^a-zÀ-ÿ]+"
#: Groups with more words are halved again.
LARGEST_GROUP = 20_000
#: Words that a task scans together, at least; whole groups.
SCANNED = 50_000
#: Cells of the edit matrices that are held at once.
CELLS = 48 << 20


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    every: int = 97, shortest: int = 5, least: int = 3,
) -> DataFrame:
    """(word, n) of words with at least `shortest` code points that occur `least` times or more.

    Words are the runs of Latin letters of whole texts, A to Z lower-cased. Of the runs for which `every`
    divides the crc32 of `<id>:<run>`, the code point at that number modulo the length is left out: made-up
    slips, so that there is something to find. A null text has no words, a null id is written as nothing. Each
    row counts, repeated ones too; other columns are not read. Counts are partial aggregates, so a frequent
    word costs one row a task.
    """
    text = F.translate(whole_text(text_col), UPPER, LOWER)
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = docs.select(name.alias("name"), F.explode(F.split(text, NO_LETTER)).alias("run"))
    length = F.char_length("run")
    runs = runs.where(length >= shortest)
    h = F.crc32(F.concat("name", F.lit(":"), "run"))
    runs = runs.select("run", F.when(h % every == 0, (h % length).cast("int")).alias("slip"))
    slipped = F.concat(F.substring("run", F.lit(1), F.col("slip")), F.substring("run", F.col("slip") + 2, length))
    words = runs.select(F.coalesce(slipped, F.col("run")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).where((F.col("n") >= least) & (F.char_length("word") >= shortest))


def _halved(rows: DataFrame) -> DataFrame:
    """Rows (key, mid, word, n) by an equal start and by an equal end of half the shorter of two middles.

    The middle of a word is what its group does not share. With r code points in it, another middle is as long,
    one longer or one shorter: the shorter has r or r - 1.
    """
    r = F.char_length("mid")
    half = F.floor(r / 2).cast("int")
    halves = F.when(r % 2 == 0, F.array(half, half - 1)).otherwise(F.array(half))
    sides = F.explode(F.array(F.lit(0), F.lit(1))).alias("side")
    taken = rows.withColumn("h", F.explode(halves)).where("h >= 0").select("*", sides)
    start = F.col("side") == 0
    shared = F.when(start, F.substring("mid", F.lit(1), F.col("h"))).otherwise(F.substring("mid", r - F.col("h") + 1, F.col("h")))
    rest = F.when(start, F.substring("mid", F.col("h") + 1, r)).otherwise(F.substring("mid", F.lit(1), r - F.col("h")))
    return taken.select(F.xxhash64("key", "side", "h", shared).alias("key"), rest.alias("mid"), "word", "n")


def _grouped(words: DataFrame, largest: int) -> DataFrame:
    """Rows (key, mid, word, n) in groups of `largest` words or whose middles have two code points or fewer.

    Every pair of words one edit apart meets in some group. With 90 letters, a group of middles that short has
    at most 8,191 words, so no group grows with the vocabulary.
    """
    rows = _halved(words.select(F.lit(0).cast("long").alias("key"), F.col("word").alias("mid"), "word", "n"))
    done = None
    while True:
        rows = written(rows, "groups")
        # the largest sizes only: at most as many keys as there are rows over the bound
        sizes = rows.groupBy("key").agg(F.count("*").alias("size"), F.max(F.char_length("mid")).alias("longest"))
        sizes = written(sizes.where("size > 1"), "sizes")
        over = sizes.where((F.col("size") > largest) & (F.col("longest") > 2)).select("key")
        fits = sizes.where((F.col("size") <= largest) | (F.col("longest") <= 2)).select("key")
        ready = rows.join(fits, "key", "left_semi")
        done = ready if done is None else done.unionByName(ready)
        if over.isEmpty():
            return done
        rows = _halved(rows.join(over, "key", "left_semi"))


class SortedList:
    """Words in the order of their code points, in groups that do not look into each other."""

    def __init__(self, words: list[str], group: np.ndarray):
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.lengths = lengths
        self.starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        self.points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        n = len(words)
        self.group_end = np.searchsorted(group, group, "right") if n else np.zeros(0, np.int64)
        self.shared = self._prefixes(group)  # of each word and the one before it
        # least shared prefix of blocks of 2^k words from each position on
        self.least = [self.shared]
        while len(self.least[-1]) > 1 << (len(self.least) - 1):
            a, w = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(a[:-w], a[w:]))

    def _prefixes(self, group: np.ndarray) -> np.ndarray:
        n = len(self.lengths)
        shared = np.zeros(n, np.int64)
        open_ = np.flatnonzero(group[1:] == group[:-1]) + 1 if n else np.zeros(0, np.int64)
        at = 0
        while len(open_):
            open_ = open_[np.minimum(self.lengths[open_], self.lengths[open_ - 1]) > at]
            same = self.points[self.starts[open_] + at] == self.points[self.starts[open_ - 1] + at]
            open_ = open_[same]
            at += 1
            shared[open_] = at
        shared[np.flatnonzero(group[1:] != group[:-1]) + 1 if n else []] = -1
        return shared

    def next_below(self, at: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        """The first word after each position that shares less than `prefix` code points with its predecessor."""
        at = at + 1
        n = len(self.lengths)
        for k in range(len(self.least) - 1, -1, -1):
            least = self.least[k]
            inside = at < len(least)
            skip = inside & (least[np.where(inside, at, 0)] >= prefix)
            at = np.where(skip, at + (1 << k), at)
        return np.minimum(at, n)

    def near(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (i, j), i before j in one group, of words one edit apart.

        Every word scans the words after it in its group. The matrices of many words are filled side by side,
        one row of each at a time.
        """
        n = len(self.lengths)
        first = 0
        while first < n:
            depth = int(self.lengths[first])
            end = first + 1
            while end < n and (end + 1 - first) * (max(depth, int(self.lengths[end])) + 3) * 3 <= CELLS:
                depth = max(depth, int(self.lengths[end]))
                end += 1
            yield self._scan(first, end, depth + 3)
            first = end

    def _scan(self, first: int, end: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
        pairs: list[np.ndarray] = []
        q = np.arange(first, end)
        q = q[self.group_end[q] > q + 1]
        # row d of a matrix: edits between d code points of the list's word and d - 1, d, d + 1 of the own one.
        # Against itself: what the own word shares with the next one needs no more.
        rows = np.empty((end - first, depth, 3), np.uint8)
        rows[:] = (1, 0, 1)
        rows[:, 0, 0] = 2
        at = q + 1
        done = self.shared[at].copy()  # rows filled
        while len(q):
            ends = done >= self.lengths[at]
            i = q - first
            # the next row, where the word of the list goes on
            here = np.flatnonzero(~ends)
            if len(here):
                qi, ai, d = q[here], at[here], done[here]
                c = self.points[self.starts[ai] + d]
                above = rows[i[here], d]
                length = self.lengths[qi]
                new = np.full((len(here), 3), 2, np.uint8)
                for k in range(3):  # column d + k of the own word, of its code point d + k - 1
                    column = d + k
                    valid = column <= length
                    p = column - 1
                    real = valid & (p >= 0)
                    same = np.zeros(len(here), bool)
                    same[real] = self.points[self.starts[qi[real]] + p[real]] == c[real]
                    best = np.where(real, above[:, k] + ~same, 2)
                    if k < 2:
                        best = np.minimum(best, above[:, k + 1] + 1)
                    if k > 0:
                        best = np.where(real, np.minimum(best, new[:, k - 1] + 1), best)
                    new[:, k] = np.where(valid, np.minimum(best, 2), 2)
                rows[i[here], d + 1] = new
                done[here] = d + 1
                dead = here[new.min(axis=1) > 1]
            else:
                dead = here
            # words of the list at their end: the last cell of the own word
            over = np.flatnonzero(ends)
            if len(over):
                gap = self.lengths[q[over]] - done[over] + 1
                inside = (gap >= 0) & (gap <= 2)
                cell = rows[i[over], done[over], np.where(inside, gap, 0)]
                hit = over[inside & (cell == 1)]
                if len(hit):
                    pairs.append(np.stack([q[hit], at[hit]]))
            moved = np.concatenate([dead, over])
            if len(moved):
                a = at[moved]
                prefix = done[moved].copy()
                prefix[len(dead) :] = np.iinfo(np.int64).max
                to = a + 1
                to[: len(dead)] = self.next_below(a[: len(dead)], prefix[: len(dead)])
                at[moved] = to
                left = to < self.group_end[q[moved]]
                stays = moved[left]
                # what the new word shares with the last one: less than the row that was dead, or its own prefix
                done[stays] = np.minimum(done[stays], self.shared[at[stays]])
                if not left.all():
                    alive = np.ones(len(q), bool)
                    alive[moved[~left]] = False
                    q, at, done = q[alive], at[alive], done[alive]
        return tuple(np.concatenate([np.zeros((2, 0), np.int64), *pairs], axis=1))


def one_edit(a: str, b: str) -> bool:
    """Whether two strings differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def near_words(words: DataFrame, largest: int = LARGEST_GROUP) -> DataFrame:
    """(word, n, other, other_n) of words one edit apart, both ways round, each once; words are distinct."""
    prepare(words.sparkSession)
    grouped = _grouped(words, largest)
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = grouped.repartition(parts, "key").sortWithinPartitions("key", "mid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, cut = np.asarray(batch.column(0)), 0
            if size + len(keys) >= SCANNED:  # up to the last whole group
                cut = int(np.searchsorted(keys, keys[-1]))
                if cut or (held and held[-1].column(0)[-1].as_py() != keys[0]):
                    yield from scan([*held, pa.Table.from_batches([batch.slice(0, cut)])])
                    held, size = [], 0
                else:
                    cut = 0
            held.append(pa.Table.from_batches([batch.slice(cut)]))
            size += len(keys) - cut
        yield from scan(held)

    def scan(tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        table = pa.concat_tables(tables) if tables else None
        if table is None or not table.num_rows:
            return
        middles, names = table.column(1).to_pylist(), table.column(2).to_pylist()
        counts = table.column(3).to_numpy()
        for a, b in SortedList(middles, table.column(0).to_numpy()).near():
            # groups meet by hashes of what they share, so the words are held against each other
            true = np.fromiter((one_edit(names[i], names[j]) for i, j in zip(a.tolist(), b.tolist(), strict=True)), bool, len(a))
            i, j = np.concatenate([a[true], b[true]]), np.concatenate([b[true], a[true]])
            columns = [[names[k] for k in i], counts[i], [names[k] for k in j], counts[j]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns, KINDS)), names=NEAR.names)

    # dealt by the word, which serves the sums over it as well
    return dealt.mapInArrow(run, NEAR).repartition(parts, "word").distinct()


NEAR = T.StructType(
    [
        T.StructField("word", T.StringType()), T.StructField("n", T.LongType()),
        T.StructField("other", T.StringType()), T.StructField("other_n", T.LongType()),
    ]
)
KINDS = [pa.string(), pa.int64(), pa.string(), pa.int64()]


def spelling_variants(words: DataFrame, largest: int = LARGEST_GROUP, ratio: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of a vocabulary (word, n) of distinct words.

    n_near counts the words one edit away. The form of a word is the most frequent of them, the first in the
    order of code points among equals, if it is at least `ratio` times as frequent, else null. The root is the
    end of the chain of forms, the word itself if it has none. Counts rise along a chain, so it ends; each
    round doubles the steps taken. An empty vocabulary gives no rows.
    """
    words = written(words.select("word", F.col("n").cast("long").alias("n")), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))).alias("best")
    near = near_words(words, largest).groupBy("word").agg(F.count("*").alias("n_near"), best)
    most = -F.col("best.less")
    frequent = most >= ratio * F.col("n")
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(frequent, F.col("best.other")).alias("form"), F.when(frequent, most).alias("form_n"),
    )
    found = written(found, "forms")
    # word -> the word that 2^k forms lead to; words with a form only
    steps = written(found.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = written(steps.join(onward, "root", "left"), "roots")
        ended = longer.where("further is not null").isEmpty()
        steps = longer.select("word", F.coalesce("further", "root").alias("root"))
        if ended:
            break
    return found.join(steps, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
