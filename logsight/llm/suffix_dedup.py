"""Removal of byte strings that an earlier document has too, by suffix arrays of content-addressed shards.

Every window of `length` bytes is filed under its anchor, the k-gram of least hash inside it, so equal windows
of all documents meet in one shard. Documents stay in groups, which are shuffled once. Each group first sends
the hashes of its anchors, and learns which of them other documents have. Neighbouring windows with the same
anchor then travel as one snippet, equal snippets of a group as one, and only for shared anchors. A shard
gives each window of its snippets the least document that has it, and returns the spans to be removed.
Anchors with many different snippets are split: their windows travel singly, filed under their whole content.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsight.llm.suffix_array import Shard, merge_shards
from logsight.llm.text import U64, Hashed, give_back, mix, prepare, ranges, whole_text
from logsight.llm.token_files import release_encoders

GRAM = 16
BLOCK_BYTES = 1 << 20
SHARD_BYTES = 1 << 20
#: Text in a group of documents, behind one bucket of anchors, and behind one bucket of anchor hashes.
GROUP_TEXT = 8 << 20
BUCKET_TEXT = 4 << 20
HASH_TEXT = 24 << 20
#: Bytes of different snippets from which on an anchor is split.
SPLIT_BYTES = 4 << 20
LAST = np.iinfo(np.int64).max

MARK = np.dtype([("doc", "<u4"), ("start", "<u4"), ("size", "<u4")])
SNIPPETS = ["<i8", "<i8", "u1", "u1", "u1", "<u4", "<u4", "<u4"]


def suffix_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 50,
    carry: list[str] | None = None,
    as_text: bool = False,
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, spans, kept, carried) of every row.

    A byte is removed if a string of `length` bytes that covers it also starts in a row with a smaller id,
    both as given. spans are the maximal removed runs, [start, end) in bytes of the UTF-8 text; kept is what
    remains, as bytes, or with as_text as text without the characters that lost a part. carried holds the
    columns named in carry.

    Ids are integers; a null id is larger than all others. Rows with equal ids take nothing from each other.
    Null texts are empty. Texts shorter than length are never touched. Each window is in one snippet, so the
    work follows the text; a snippet that many rows share is sent once by each group of documents.
    """
    spark = prepare(docs.sparkSession)
    if not GRAM <= length <= 255:
        raise ValueError(f"length must be from {GRAM} to 255")
    text = whole_text(text_col)
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    groups, buckets, hash_buckets = (max(32, total // size) for size in (GROUP_TEXT, BUCKET_TEXT, HASH_TEXT))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.pmod(F.xxhash64(F.col(id_col).cast("bigint"), text), F.lit(groups)).alias("part"),
        F.struct(*[F.col(c) for c in carry or []]).alias("carried") if carry else F.lit(None).cast("int").alias("carried"),
        text.alias("text"),
    )
    packed_schema = T.StructType([*rows.schema.fields[:3], T.StructField("packed", T.BinaryType())])
    placed = rows.mapInArrow(_packer, packed_schema).groupBy("part")

    hashes = placed.applyInArrow(_tidy(_hash_sender(length, hash_buckets)), "part bigint, bucket bigint, payload binary")
    shared = hashes.groupBy("bucket").applyInArrow(_tidy(_sharer(SPLIT_BYTES)), "part bigint, bucket bigint, payload binary")
    sent = placed.cogroup(shared.groupBy("part")).applyInArrow(
        _tidy_pair(_snippet_sender(length, buckets)), "bucket bigint, part bigint, payload binary"
    )
    marks = sent.groupBy("bucket").applyInArrow(_tidy(_finder(length)), "part bigint, payload binary")
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("n_spans", T.LongType()),
            T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
            T.StructField("kept", T.StringType() if as_text else T.BinaryType()),
            T.StructField("carried", rows.schema["carried"].dataType),
        ]
    )
    out = placed.cogroup(marks.groupBy("part")).applyInArrow(_tidy_pair(_remover(schema)), schema)
    named = F.col("id").cast(docs.schema[id_col].dataType).alias(id_col)
    return out.select(named, *[f.name for f in schema.fields[1:]])


# --- groups of documents -----------------------------------------------------------------------


def _packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts compressed, to be shuffled."""
    release_encoders()
    compress = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            packed = pa.array([compress(t.as_py().encode()) for t in part.column(3)], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns[:3], packed], names=["id", "part", "carried", "packed"])


class Group:
    """The documents of a group, in the order of their ids and texts."""

    def __init__(self, docs: pa.Table):
        unpack = zstandard.ZstdDecompressor().decompress
        raw = [unpack(p.as_py()) for p in docs.column("packed")]
        ids = [LAST if i is None else i for i in docs.column("id").to_pylist()]
        self.order = sorted(range(len(raw)), key=lambda k: (ids[k], raw[k]))
        self.raw = [raw[k] for k in self.order]
        self.ids = np.array([ids[k] for k in self.order], np.int64)


class Snippets:
    """All snippets of a group: neighbouring windows of a document with the same anchor."""

    def __init__(self, group: Group, length: int):
        sizes = np.array([len(r) for r in group.raw], np.int64)
        ends = np.cumsum(sizes)
        self.data = np.frombuffer(b"".join(group.raw), np.uint8)
        found, lo = [], 0
        while lo < len(sizes):
            base = ends[lo] - sizes[lo]
            hi = max(lo + 1, int(np.searchsorted(ends, base + BLOCK_BYTES, "right")))
            starts = np.concatenate([[0], ends[lo:hi] - base])
            hashed = Hashed(self.data[base : ends[hi - 1]])
            doc, first, windows, anchor = _anchors(hashed, starts, length)
            found.append(
                (
                    doc + lo, first + base, first - starts[doc], windows, anchor - first,
                    hashed.slices(anchor, anchor + GRAM), hashed.slices(first, first + windows + length - 1),
                )
            )
            lo = hi
        none = [np.zeros(0, k) for k in (np.int64,) * 5 + (U64,) * 2]
        columns = [np.concatenate([n, *[f[k] for f in found]]) for k, n in enumerate(none)]
        self.doc, self.first, self.inside, self.windows, self.offset, self.anchor, self.content = columns
        #: what buckets are chosen by
        self.key = self.anchor
        #: 48 bits of each anchor's hash, mixed anew since anchors' hashes are small ones, and the distinct ones
        self.short = mix(self.anchor) >> U64(16)
        self.distinct, self.which = np.unique(self.short, return_inverse=True)

    def weights(self, length: int) -> np.ndarray:
        """Of each distinct anchor the bytes of its different snippets, as the power of two that is as many or more."""
        order = np.lexsort((self.content, self.which))
        which, content = self.which[order], self.content[order]
        new = np.concatenate([[True], (which[1:] != which[:-1]) | (content[1:] != content[:-1])])[: len(order)]
        size = np.bincount(which[new], self.windows[order[new]] + length - 1, len(self.distinct))
        return np.ceil(np.log2(np.maximum(size, 1))).astype("u1")

    def keep(self, whole: np.ndarray, split: np.ndarray, length: int) -> None:
        """Leaves the snippets that are whole, and of those to be split each window as a snippet of its own."""
        cut = np.flatnonzero(split)
        own = np.repeat(cut, self.windows[cut])
        step = ranges(np.zeros(len(cut), np.int64), self.windows[cut])
        first, offset, sizes = self.first[own] + step, self.offset[own] - step, np.full(len(own), length)
        content = _snippet_hashes(self.data[ranges(first, sizes)], np.arange(len(own)) * length, sizes, offset)[1]
        single = {
            "doc": self.doc[own], "first": first, "inside": self.inside[own] + step, "windows": np.ones(len(own), np.int64),
            "offset": offset, "anchor": self.anchor[own], "content": content, "key": mix(content),
        }
        for name, values in single.items():
            setattr(self, name, np.concatenate([getattr(self, name)[whole], values]))


def _anchors(hashed: Hashed, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, number of windows, anchor) of each snippet in a block of texts."""
    n = int(starts[-1])
    sizes = np.diff(starts)
    none = np.zeros(0, np.int64)
    if n < length or sizes.max() < length:
        return none, none, none, none
    at = np.arange(n - GRAM + 1)
    h = hashed.slices(at, at + GRAM)
    # the smaller hash wins, then the place further left
    least = (h & U64(0xFFFFFFFF00000000)) | at.astype(U64)
    span, width = length - GRAM + 1, 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    windows = np.maximum(sizes - length + 1, 0)
    places = ranges(starts[:-1], windows)
    anchor = (least[places] & U64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    counts = np.diff(np.append(new, len(anchor)))
    text = np.searchsorted(starts, places[new], "right") - 1
    return text, places[new], counts, anchor[new]


def _cuts(distinct: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket of ascending 48-bit hashes begins, and the end."""
    limits = (np.arange(1, buckets, dtype=np.float64) / buckets * float(1 << 48)).astype(U64)
    return np.concatenate([[0], np.searchsorted(distinct, limits), [len(distinct)]])


def _batch(names: str, **columns: list) -> pa.Table:
    kinds = {"payload": pa.binary()}
    return pa.table([pa.array(columns[n], kinds.get(n, pa.int64())) for n in names.split()], names=names.split())


def _tidy(run):
    """The function of one group, which returns what it has freed."""

    def tidy(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            give_back()

    return tidy


def _tidy_pair(run):
    def tidy(docs: pa.Table, others: pa.Table) -> pa.Table:
        try:
            return run(docs, others)
        finally:
            give_back()

    return tidy


def _hash_sender(length: int, buckets: int):
    def run(docs: pa.Table) -> pa.Table:
        group = Group(docs)
        s = Snippets(group, length)
        # anchors that several documents of this group have are shared anyhow
        ids = group.ids[s.doc]
        low = np.full(len(s.distinct), LAST)
        high = np.full(len(s.distinct), -LAST - 1)
        np.minimum.at(low, s.which, ids)
        np.maximum.at(high, s.which, ids)
        cuts = _cuts(s.distinct, buckets)
        weights = s.weights(length)
        six = s.distinct.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        payload = [
            np.int64(b - a).tobytes() + six[a:b].tobytes() + np.packbits(low[a:b] < high[a:b]).tobytes() + weights[a:b].tobytes()
            for a, b in zip(cuts, cuts[1:], strict=False)
        ]
        part = docs.column("part")[0].as_py()
        return _batch("part bucket payload", part=[part] * buckets, bucket=list(range(buckets)), payload=payload)

    return run


def _sharer(split_bytes: int):
    def run(table: pa.Table) -> pa.Table:
        return _shared(table, split_bytes)

    return run


def _shared(table: pa.Table, split_bytes: int) -> pa.Table:
    """Of each group's hashes in a bucket, which are shared, and which of those are to be split, as bits."""
    hashes, several, weights, counts = [], [], [], []
    for p in table.column("payload"):
        raw = p.as_py()
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :6] = np.frombuffer(raw, np.uint8, 6 * n, 8).reshape(n, 6)
        hashes.append(wide.view("<u8").ravel())
        several.append(np.unpackbits(np.frombuffer(raw, np.uint8, offset=8 + 6 * n), count=n).astype(bool))
        weights.append(np.frombuffer(raw, np.uint8, n, len(raw) - n))
        counts.append(n)
    h, out = np.concatenate(hashes), np.concatenate(several)
    order = np.argsort(h)
    new = np.concatenate([[True], h[order][1:] != h[order][:-1]])[: len(h)]
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(h)))
    any_several = np.logical_or.reduceat(out[order], at) if len(at) else out[:0]
    out[order] = np.repeat((size > 1) | any_several, size)
    total = np.add.reduceat(2.0 ** np.concatenate(weights)[order], at) if len(at) else np.zeros(0)
    split = np.zeros(len(h), bool)
    split[order] = np.repeat(total > split_bytes, size)
    cuts = np.cumsum(counts)[:-1]
    bits = [np.packbits(x).tobytes() + np.packbits(x & y).tobytes() for x, y in zip(np.split(out, cuts), np.split(split, cuts), strict=True)]
    return table.select(["part", "bucket"]).append_column("payload", pa.array(bits, pa.binary()))


def _snippet_sender(length: int, buckets: int):
    def run(docs: pa.Table, shared: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _batch("bucket part payload", bucket=[], part=[], payload=[])
        group = Group(docs)
        s = Snippets(group, length)
        replies = sorted(zip(shared.column("bucket").to_pylist(), shared.column("payload").to_pylist(), strict=True))
        cuts = _cuts(s.distinct, len(replies))
        bits = [
            np.stack([np.unpackbits(x, count=b - a) for x in np.frombuffer(p, np.uint8).reshape(2, -1)])
            for (_, p), a, b in zip(replies, cuts, cuts[1:], strict=False)
        ]
        known, split = np.concatenate(bits, axis=1).astype(bool) if bits else np.zeros((2, 0), bool)
        s.keep((known & ~split)[s.which], split[s.which], length)
        return _snippets(group, s, np.arange(len(s.doc)), docs.column("part")[0].as_py(), length, buckets)

    return run


def _snippets(group: Group, s: Snippets, chosen: np.ndarray, part: int, length: int, buckets: int) -> pa.Table:
    """Snippets by bucket, equal ones once with their least owner; the others' spans are settled here."""
    bucket = (s.key[chosen] % U64(buckets)).astype(np.int64)
    order = np.lexsort((group.ids[s.doc[chosen]], s.content[chosen], s.anchor[chosen], bucket))
    bucket, at = bucket[order], chosen[order]
    anchor, content, ids = s.anchor[at], s.content[at], group.ids[s.doc[at]]
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])])[: len(at)]
    klass = np.cumsum(new) - 1
    firsts = np.flatnonzero(new)
    settled = ids > ids[new][klass]
    done = _marks(s.doc[at[settled]], s.inside[at[settled]], s.windows[at[settled]] + length - 1)
    stays = np.flatnonzero(~settled)
    kept_class = klass[stays]
    edges = np.flatnonzero(np.concatenate([[True], bucket[firsts][1:] != bucket[firsts][:-1]]))[: len(firsts)]
    out_bucket, payload = [-1 - part], [done]
    for a, b in zip(edges, np.append(edges, len(firsts))[1:], strict=True):
        c = at[firsts[a:b]]
        lo, hi = np.searchsorted(kept_class, [a, b])
        o = at[stays[lo:hi]]
        size = s.windows[c] + length - 1
        out_bucket.append(int(bucket[firsts[a]]))
        payload.append(
            _pack(
                np.array([part], "<i8"), group.ids[s.doc[c]], s.windows[c].astype("u1"), s.offset[c].astype("u1"),
                s.data[ranges(s.first[c], size)], (kept_class[lo:hi] - a).astype("<u4"),
                s.doc[o].astype("<u4"), s.inside[o].astype("<u4"),
            )
        )
    return _batch("bucket part payload", bucket=out_bucket, part=[part] * len(payload), payload=payload)


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([a.nbytes for a in arrays], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def _unpack(payload: bytes, kinds: list) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    sizes = np.frombuffer(raw, "<i8", len(kinds))
    at, out = 8 * len(kinds), []
    for kind, n in zip(kinds, sizes, strict=True):
        out.append(np.frombuffer(raw, kind, int(n) // np.dtype(kind).itemsize, at))
        at += int(n)
    return out


def _marks(doc: np.ndarray, start: np.ndarray, size: np.ndarray) -> bytes:
    """Spans to be removed from documents of a group, as bytes."""
    out = np.zeros(len(doc), MARK)
    out["doc"], out["start"], out["size"] = doc, start, size
    return _pack(out[np.lexsort((start, doc))])


# --- in a shard --------------------------------------------------------------------------------


def _finder(length: int):
    def run(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            return table.select(["part", "payload"])
        parts, payload = _found([_unpack(p.as_py(), SNIPPETS) for p in table.column("payload")], length)
        return _batch("part payload", part=parts, payload=payload)

    return run


def _found(sent: list[list[np.ndarray]], length: int) -> tuple[list, list]:
    """Spans of the snippets of one bucket, by the group that sent them."""
    base = np.cumsum([0, *[len(x[1]) for x in sent]])
    ids, windows, offset, text = (np.concatenate([x[k] for x in sent]) for k in range(1, 5))
    windows = windows.astype(np.int64)
    klass = np.concatenate([x[5].astype(np.int64) + b for x, b in zip(sent, base, strict=False)])
    part = np.repeat([int(x[0][0]) for x in sent], [len(x[5]) for x in sent])
    doc, inside = (np.concatenate([x[k] for x in sent]).astype(np.int64) for k in (6, 7))
    sizes = windows + length - 1
    begins = np.cumsum(sizes) - sizes
    anchor, content = _snippet_hashes(text, begins, sizes, offset)

    # snippets by anchor, then content, then owner; anchors of one document only are done
    order = np.lexsort((ids, content, anchor))
    a, c, owner = anchor[order], content[order], ids[order]
    new_anchor = np.concatenate([[True], a[1:] != a[:-1]])
    new = new_anchor | np.concatenate([[True], c[1:] != c[:-1]])
    of_anchor, of_snippet = np.cumsum(new_anchor) - 1, np.cumsum(new) - 1
    at = np.flatnonzero(new_anchor)
    several = np.minimum.reduceat(owner, at) < np.maximum.reduceat(owner, at)
    least = owner[new]  # of each distinct snippet
    distinct = np.flatnonzero(new)
    per_anchor = np.bincount(of_anchor[distinct], minlength=len(at))
    examined = several[of_anchor[distinct]] & (per_anchor[of_anchor[distinct]] > 1)
    span_snippet, span_at, span_size = _flagged(
        text, begins[order[distinct]], windows[order[distinct]], least, a[distinct], examined, length
    )

    # occurrences: wholly covered if a lesser document has the same snippet, else where its windows are
    snippet = np.zeros(len(order), np.int64)
    snippet[order] = of_snippet
    mine, who = snippet[klass], ids[klass]
    whole = np.flatnonzero(who > least[mine])
    rest = np.flatnonzero(who <= least[mine])
    low = np.searchsorted(span_snippet, mine[rest])
    many = np.searchsorted(span_snippet, mine[rest], "right") - low
    which, back = ranges(low, many), np.repeat(rest, many)
    start = np.concatenate([inside[whole], inside[back] + span_at[which]])
    size = np.concatenate([sizes[klass[whole]], span_size[which]])
    occurrence = np.concatenate([whole, back])
    order = np.argsort(part[occurrence], kind="stable")
    occurrence, start, size = occurrence[order], start[order], size[order]
    parts, cuts = np.unique(part[occurrence], return_index=True)
    pieces = [np.split(x, cuts[1:]) for x in (doc[occurrence], start, size)]
    return parts.tolist(), [_marks(*x) for x in zip(*pieces, strict=True)] if len(parts) else []


def _snippet_hashes(text: np.ndarray, begins: np.ndarray, sizes: np.ndarray, offset: np.ndarray) -> tuple:
    """Hashes of the snippets' anchors and contents, a block of snippets at a time."""
    anchor, content = np.zeros(len(begins), U64), np.zeros(len(begins), U64)
    lo = 0
    while lo < len(begins):
        hi = max(lo + 1, int(np.searchsorted(begins, begins[lo] + SHARD_BYTES)))
        hashed = Hashed(text[begins[lo] : begins[hi - 1] + sizes[hi - 1]])
        at = begins[lo:hi] - begins[lo]
        anchor[lo:hi] = hashed.slices(at + offset[lo:hi], at + offset[lo:hi] + GRAM)
        content[lo:hi] = hashed.slices(at, at + sizes[lo:hi])
        lo = hi
    return anchor, content


def _flagged(text, begins, windows, owner, anchor, examined, length) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(snippet, start in it, size) of the spans of examined snippets that a lesser owner's snippet has."""
    which = np.flatnonzero(examined)
    sizes = windows[which] + length - 1
    out: list[tuple] = []
    made: list[tuple[Shard, np.ndarray]] = []
    lo = 0
    ends = np.cumsum(sizes)
    while lo < len(which):
        hi = max(int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SHARD_BYTES, "right")), lo + 1)
        if hi < len(which) and anchor[which[lo]] != anchor[which[hi]]:  # end with an anchor where there is one
            while anchor[which[hi - 1]] == anchor[which[hi]]:
                hi -= 1
        part = which[lo:hi]
        own = sizes[lo:hi]
        at = np.cumsum(own) - own
        shard = Shard(text[ranges(begins[part], own)], at, windows[part], owner[part], length)
        made.append((shard, part))
        lo = hi
        if lo == len(which) or anchor[which[lo]] != anchor[which[lo - 1]]:
            if len(made) > 1:
                merge_shards([s for s, _ in made])
            for s, p in made:
                out.append(_spans(s, p, windows[p], length))
            made = []
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate([x[k] for x in out]) for k in range(3))


def _spans(shard: Shard, snippets: np.ndarray, windows: np.ndarray, length: int) -> tuple:
    hit = np.flatnonzero(shard.earlier())
    owner = np.repeat(np.arange(len(snippets)), windows)[hit]
    at = hit - (np.cumsum(windows) - windows)[owner]
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)])) if len(hit) else hit
    runs = np.diff(np.append(new, len(hit)))
    return snippets[owner[new]], at[new], runs + length - 1


# --- back at the documents ---------------------------------------------------------------------


def _remover(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(docs: pa.Table, marks: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return arrow.empty_table()
        group = Group(docs)
        found = np.concatenate([np.zeros(0, MARK), *[_unpack(p.as_py(), [MARK])[0] for p in marks.column("payload")]])
        found = found[np.argsort(found["doc"], kind="stable")]
        cuts = np.searchsorted(found["doc"], np.arange(len(group.raw) + 1))
        n_bytes, n_removed, spans, kept = [], [], [], []
        as_text = pa.types.is_string(arrow.field("kept").type)
        for k, raw in enumerate(group.raw):
            runs = _union(found[cuts[k] : cuts[k + 1]], len(raw)) if cuts[k] < cuts[k + 1] else []
            edges = [0, *[x for r in runs for x in r], len(raw)]
            n_bytes.append(len(raw))
            n_removed.append(sum(b - a for a, b in runs))
            spans.append(runs)
            left = b"".join([raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]) if runs else raw
            kept.append(left.decode("utf-8", "ignore") if as_text else left)
        order = pa.array(group.order)
        columns = {
            "id": docs.column("id").take(order), "carried": docs.column("carried").take(order),
            "n_bytes": n_bytes, "n_removed": n_removed, "n_spans": [len(r) for r in spans], "spans": spans, "kept": kept,
        }
        made = [columns[f.name] if isinstance(columns[f.name], pa.ChunkedArray) else pa.array(columns[f.name], f.type) for f in arrow]
        return pa.table(made, schema=arrow)

    return run


def _union(marks: np.ndarray, size: int) -> list[list[int]]:
    """Maximal runs covered by marks."""
    start = marks["start"].astype(np.int64)
    edges = np.bincount(start, minlength=size + 1) - np.bincount(start + marks["size"].astype(np.int64), minlength=size + 1)
    inside = np.concatenate([[False], np.cumsum(edges) > 0])
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    return turn.reshape(-1, 2).tolist()
