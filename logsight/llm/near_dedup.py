"""Near-duplicate groups by banded HyperMinHash registers, with links confirmed on whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsight.llm import hypermin as H
from logsight.llm.components import components
from logsight.llm.scratch import written
from logsight.llm.text import Texts, give_back, prepare, spread, whole_text
from logsight.llm.token_files import release_encoders

SMALL_BUCKET = 8  # all pairs of a bucket of so many sets are compared
BLOCK = 1024  # sets compared with each other at once in larger buckets
BROADCAST_IDS = 200_000


def near_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    threshold: float = 0.8,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row.

    Two texts are linked when their sets of distinct shingles have a Jaccard similarity of at least the
    threshold, as counted on the whole sets; groups are closed over links. component_id is the smallest id
    of the group, kept marks its row.

    Equal sets are one node first, so copies of any number cost nothing further. Nodes meet in bands of
    registers. Small buckets compare all their pairs. In larger ones every node is compared with the hub,
    the node that meets the most others; what is then still apart is compared in blocks with all of the
    hub's nodes, so no link is lost. A pair at the threshold shares no band with a chance of 1e-8 where its
    registers are independent, of about 3e-7 where short texts borrow the same ones often.

    Null and empty texts and texts without words have no shingles and are alone. Rows with the same id and
    text share a result. A null id is larger than any other; a group of null ids only has a null
    component_id, and its rows are kept. Other columns are not read.
    """
    spark = prepare(docs.sparkSession)
    banding = H.Banding(threshold)
    per_mille = round(threshold * 1000)
    docs = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    id_type = docs.schema["id"].dataType

    signed = written(docs.mapInArrow(_signer(words, banding), _signed_schema(id_type)), "signatures")
    nodes = written(signed.where("n > 0").dropDuplicates(["key"]), "nodes")
    meetings = _meetings(nodes)
    star, pairs = _candidates(meetings)
    likely = written(_likely(pairs, nodes, threshold, per_mille), "likely")
    members = written(star.select("hub", F.col("key")).distinct(), "members")

    links = written(_confirmed(likely, _sets(docs, nodes, likely, words), per_mille), "confirmed")
    joined = components(links)
    apart = _apart(members, joined)
    active = written(_active(apart, nodes, threshold, per_mille), "active")
    if active.take(1):
        ends = active.select(F.col("key").alias("a"), F.col("key").alias("b"))
        more = _block_links(active, _sets(docs, nodes, ends, words), per_mille)
        joined = components(links.unionByName(written(more, "confirmed")))

    classes = signed.where("n > 0").groupBy("key").agg(F.min("id").alias("least"))
    classes = classes.join(joined.withColumnRenamed("node", "key"), "key", "left")
    classes = classes.withColumn("component", F.coalesce("component", "key"))
    labels = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    placed = classes.select("key", "component").join(labels, "component").select("key", "component_id")
    out = signed.select("id", "n", "key").join(placed, "key", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


# --- signatures and sets -----------------------------------------------------------------------


def _signed_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("n", T.LongType()),
            T.StructField("key", T.BinaryType()),
            T.StructField("regs", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )


def _fixed(rows: np.ndarray) -> pa.Array:
    """Rows of an array as binary values of equal length."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    at = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(at), pa.py_buffer(rows)])


def _signer(words: int, banding: H.Banding):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        for batch in batches:
            for lo, hi, data, starts in Texts(batch.column(1)).blocks(H.BLOCK_BYTES, H.BLOCK_ROWS):
                hashes, counts = H.shingle_sets(data, starts, words)
                regs = H.registers(hashes, counts, banding.registers)
                keys, held = H.band_keys(regs, banding.rows)
                at = np.concatenate([[0], np.cumsum(held.sum(axis=1))]).astype(np.int32)
                bands = pa.ListArray.from_arrays(at, pa.array(keys[held].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(counts.astype(np.int64)),
                        _fixed(H.set_keys(hashes, counts)),
                        _fixed(regs),
                        bands,
                    ],
                    names=["id", "n", "key", "regs", "bands"],
                )
        give_back()

    return run


def _sets(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """(key, hashes) of the nodes in pairs, from the text of one row of each."""
    wanted = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    wanted = written(nodes.select("key", "id").join(wanted, "key", "left_semi"), "wanted")
    ids = wanted.select(F.col("id").alias("wanted_id")).distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.join(ids, F.col("id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, starts in Texts(batch.column(0)).blocks(H.BLOCK_BYTES, H.BLOCK_ROWS):
                hashes, counts = H.shingle_sets(data, starts, words)
                at = np.concatenate([[0], np.cumsum(counts)]) * 8
                sets = pa.Array.from_buffers(
                    pa.binary(), len(counts), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(hashes)]
                )
                yield pa.RecordBatch.from_arrays([_fixed(H.set_keys(hashes, counts)), sets], names=["key", "hashes"])
        give_back()

    made = texts.mapInArrow(run, "key binary, hashes binary").dropDuplicates(["key"])
    return written(made.join(wanted.select("key"), "key", "left_semi"), "sets")


# --- candidates --------------------------------------------------------------------------------


def _meetings(nodes: DataFrame) -> DataFrame:
    """(band, size, key) of the bands that several nodes share."""
    rows = nodes.select(F.explode("bands").alias("band"), "key")
    sizes = rows.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    return written(rows.join(sizes, "band"), "meetings")


def _candidates(meetings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hub, key) of larger buckets, and (a, b) of all pairs to be compared, a before b."""
    small = meetings.where(F.col("size") <= SMALL_BUCKET).groupBy("band").agg(F.array_sort(F.collect_list("key")).alias("keys"))
    first = small.select("keys", F.posexplode("keys").alias("at", "a"))
    pairs = first.select("a", F.explode(F.expr("slice(keys, at + 2, size(keys))")).alias("b"))

    # a node has no more rows than bands, however many it meets in them
    weight = F.sum(F.col("size") - 1).over(Window.partitionBy("key"))
    large = written(meetings.withColumn("weight", weight).where(F.col("size") > SMALL_BUCKET), "large")
    hubs = large.groupBy("band").agg(F.max(F.struct("weight", "key"))["key"].alias("hub"))
    star = large.select("band", "key").join(hubs, "band").where("key <> hub")
    met = star.select(F.least("key", "hub").alias("a"), F.greatest("key", "hub").alias("b"))
    return star, pairs.unionByName(met).distinct()


def _likely(pairs: DataFrame, nodes: DataFrame, threshold: float, per_mille: int) -> DataFrame:
    """The pairs whose sizes and collision-corrected register estimates allow a link."""
    n = nodes.select("key", "n", "regs")
    both = pairs.join(n.toDF("a", "na", "ra"), "a").join(n.toDF("b", "nb", "rb"), "b")
    both = both.where(F.least("na", "nb") * 1000 >= F.greatest("na", "nb") * per_mille)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            ra, rb = (_matrix(batch.column(c)) for c in ("ra", "rb"))
            keep = H.likely_similar(ra, rb, na, nb, threshold)
            yield batch.select(["a", "b", "na", "nb"]).filter(pa.array(keep))

    return both.mapInArrow(run, "a binary, b binary, na bigint, nb bigint")


def _matrix(column: pa.Array) -> np.ndarray:
    raw = Texts(column)
    return raw.data[raw.offsets[0] : raw.offsets[-1]].view(np.uint16).reshape(len(column), -1)


def _confirmed(likely: DataFrame, sets: DataFrame, per_mille: int) -> DataFrame:
    """The pairs at or over the threshold, counted on whole sets."""
    both = likely.select("a", "b").join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sa, sb = Texts(batch.column("sa")), Texts(batch.column("sb"))
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = _set(sa, i), _set(sb, i)
                shared = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                keep[i] = 1000 * shared >= per_mille * (len(x) + len(y) - shared)
            yield batch.select(["a", "b"]).filter(pa.array(keep))
        give_back()

    return both.mapInArrow(run, "a binary, b binary")


def _set(column: Texts, i: int) -> np.ndarray:
    return column.data[column.offsets[i] : column.offsets[i + 1]].view(np.uint64)


# --- larger buckets: what the hub left apart ---------------------------------------------------


def _apart(members: DataFrame, joined: DataFrame) -> DataFrame:
    """(hub, key, component, away) of hubs some of whose nodes are in other components."""
    all_members = members.unionByName(members.select("hub", F.col("hub").alias("key")).distinct())
    placed = all_members.join(joined.withColumnRenamed("node", "key"), "key", "left")
    placed = placed.withColumn("component", F.coalesce("component", "key"))
    home = placed.where("hub = key").select("hub", F.col("component").alias("home"))
    marked = placed.join(home, "hub").withColumn("away", F.col("component") != F.col("home")).drop("home")
    counts = marked.groupBy("hub").agg(F.count("*").alias("size"), F.max("away").alias("open")).where("open")
    return marked.join(counts.select("hub", "size"), "hub")


def _blocks(rows: DataFrame, what: list[str]) -> DataFrame:
    """(hub, key and `what` of a block of nodes), blocks of a bounded size."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / BLOCK))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key"), blocks))
    return dealt.groupBy("hub", "block").agg(F.collect_list(F.struct("key", "component", *what)).alias("nodes"))


def _facing(rows: DataFrame, what: list[str]) -> DataFrame:
    """Each block of nodes away from their hub's component beside each block of that hub's nodes, spread evenly."""
    away = _blocks(rows.where("away"), what).select("hub", F.col("block").alias("x"), F.col("nodes").alias("away"))
    every = _blocks(rows, what).select("hub", F.col("block").alias("y"), F.col("nodes").alias("all"))
    return spread(away.join(every, "hub"), ["hub", "x", "y"])


def _active(apart: DataFrame, nodes: DataFrame, threshold: float, per_mille: int) -> DataFrame:
    """(hub, key, component, away, size) of the nodes that the estimates let link another component's node."""
    rows = apart.join(nodes.select("key", "n", "regs"), "key")
    facing = _facing(rows, ["n", "regs"]).select("hub", "away", "all")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x, y = batch.column("away")[i].values, batch.column("all")[i].values
                nx, ny = (c.field("n").to_numpy() for c in (x, y))
                rx, ry = (_matrix(c.field("regs")) for c in (x, y))
                cx, cy = (np.array(c.field("component").to_pylist(), object) for c in (x, y))
                hit_x, hit_y = np.zeros(len(nx), bool), np.zeros(len(ny), bool)
                for k in range(len(nx)):
                    near = np.minimum(nx[k], ny) * 1000 >= np.maximum(nx[k], ny) * per_mille
                    at = np.flatnonzero(near & (cy != cx[k]))
                    if len(at):
                        sure = H.likely_similar(np.broadcast_to(rx[k], (len(at), rx.shape[1])), ry[at], np.full(len(at), nx[k]), ny[at], threshold)
                        hit_y[at[sure]] = True
                        hit_x[k] = sure.any()
                keys = x.field("key").filter(pa.array(hit_x)).to_pylist() + y.field("key").filter(pa.array(hit_y)).to_pylist()
                hub = [batch.column("hub")[i].as_py()] * len(keys)
                yield pa.RecordBatch.from_arrays([pa.array(hub, pa.binary()), pa.array(keys, pa.binary())], names=["hub", "key"])

    hit = facing.mapInArrow(run, "hub binary, key binary").distinct()
    kept = apart.join(hit, ["hub", "key"])
    sizes = kept.groupBy("hub").agg(F.count("*").alias("size"))
    return kept.drop("size").join(sizes, "hub")


def _block_links(active: DataFrame, sets: DataFrame, per_mille: int) -> DataFrame:
    """Links between components among active nodes: intersections of blocks as products of 0/1 matrices."""
    facing = _facing(active.join(sets, "key"), ["hashes"]).select("away", "all")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x, y = batch.column("away")[i].values, batch.column("all")[i].values
                kx, ky = x.field("key").to_pylist(), y.field("key").to_pylist()
                cx, cy = (np.array(c.field("component").to_pylist(), object) for c in (x, y))
                shared, nx, ny = _intersections(Texts(x.field("hashes")), Texts(y.field("hashes")))
                links = 1000 * shared >= per_mille * (nx[:, None] + ny[None, :] - shared)
                # one link of each node to each component: further ones join nothing new
                one = {(p, cy[q]): q for p, q in zip(*np.nonzero(links), strict=True) if cx[p] != cy[q]}
                a, b = [kx[p] for p, _ in one], [ky[q] for q in one.values()]
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return facing.mapInArrow(run, "a binary, b binary")


def _intersections(x: Texts, y: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the intersections of all sets of x and y, and of the sets themselves."""
    hx, hy = (t.data[t.offsets[0] : t.offsets[-1]].view(np.uint64) for t in (x, y))
    nx, ny = np.diff(x.offsets) // 8, np.diff(y.offsets) // 8
    common = np.intersect1d(hx, hy)
    out = np.zeros((len(nx), len(ny)))
    for lo in range(0, len(common), 4096):
        part = common[lo : lo + 4096]
        out += _indicator(hx, nx, part) @ _indicator(hy, ny, part).T
    return np.rint(out).astype(np.int64), nx, ny


def _indicator(hashes: np.ndarray, counts: np.ndarray, columns: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(columns, hashes), len(columns) - 1)
    has = columns[at] == hashes
    out = np.zeros((len(counts), len(columns)), np.float32)
    out[np.repeat(np.arange(len(counts)), counts)[has], at[has]] = 1
    return out
