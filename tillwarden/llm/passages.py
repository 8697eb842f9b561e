"""Repeated passages: which windows of a fixed length occur elsewhere in the corpus.

Work grows with the corpus, not with pairs, and no window is skipped:

1. Of all runs of ``gram`` tokens in a window, the one with the least hash is its anchor. Equal
   windows have equal anchors, and neighbouring windows mostly share one; the windows of one
   anchor form a segment.
2. Equal segments are settled by their hash. This happens first inside a batch of chunks, so of
   the many copies of a frequent passage only one per batch is shuffled; then in the bucket of the
   segment's hash, so that an anchor with very many different segments is spread over all tasks.
3. The different segments of each anchor are counted. An anchor with one has nothing to compare.
   Which anchors have more goes to the tasks as a bitmap of fixed size.
4. Where different segments share an anchor, windows may still be equal in part (the edges of
   a repeated passage, an edited copy). Their texts are fetched and compared exactly by an
   index that the caller gives.
5. An anchor with more than ``most_segments`` segments to compare (a second bitmap) never meets in
   one task: its windows are dealt out by their own hashes and settled like equal segments.

Two rules say what counts: ``elsewhere`` (a window that starts at any other place) and
``earlier`` (a window that also starts in a document with a smaller id).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwarden.llm.bitmaps import Bitmap, region_of
from tillwarden.llm.text import U64, Chunk, Prefix, byte_values, chunks, grams, inner, keyed, mix, unioned, words
from tillwarden.session import materialise

#: One entry: a segment of ``n`` window starts from ``start`` in the document (id, copy).
ENTRY = np.dtype(
    [("seg", "<u8"), ("id", "<i8"), ("anchor", "<u8"), ("copy", "<i8"), ("start", "<u4"), ("n", "<u4"), ("weight", "u1")]
)
_PLACE = U64((1 << 28) - 1)
#: Bytes of text whose hashes a worker holds at once.
CHUNK = 1 << 19
#: Tokens of a longer text whose hashes it holds at once.
LONG = 1 << 21
#: Entries (of many chunks) that are settled together before they are sent: 8 MB, about 25 MB of text.
BATCH = 180_000


@dataclass(frozen=True)
class Scheme:
    """unit: 'byte' or 'word'. rule: 'elsewhere' or 'earlier'. Windows are of ``window`` units."""

    unit: str
    window: int
    gram: int
    rule: str
    most_segments: int = 2048
    buckets_per_task: int = 8

    def tokens(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """A value per token, and each document's first token (and the end)."""
        if self.unit == "byte":
            return byte_values(chunk.data), chunk.offsets
        w = words(chunk)
        return w.hashes, w.first


def packed(entries: np.ndarray) -> bytes:
    """Field by field, so that equal high bytes stand together and compress."""
    return b"".join(np.ascontiguousarray(entries[f]).tobytes() for f in ENTRY.names)


def unpacked(blob: bytes) -> np.ndarray:
    n = len(blob) // ENTRY.itemsize
    out, at = np.zeros(n, ENTRY), 0
    for f in ENTRY.names:
        size = ENTRY[f].itemsize * n
        out[f] = np.frombuffer(blob, ENTRY[f], n, at)
        at += size
    return out


def segments(scheme: Scheme, values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, first window start, window count, segment hash, anchor) of each segment; starts
    count from the document's first token."""
    size, gram = scheme.window, scheme.gram
    none = np.zeros(0, np.int64)
    valid = inner(first, size)
    if not valid.any():
        return none, none, none, none.astype(U64), none.astype(U64)
    hashed = grams(values, gram)
    key = hashed & ~_PLACE | np.arange(len(hashed), dtype=U64)
    span = size - gram + 1
    rows = -(-len(key) // span)
    grid = np.full(rows * span, np.iinfo(U64).max, U64)
    grid[: len(key)] = key
    ahead = np.minimum.accumulate(grid.reshape(rows, span), axis=1).ravel()
    back = np.minimum.accumulate(grid.reshape(rows, span)[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - size + 1
    anchor = (np.minimum(back[:count], ahead[span - 1 : span - 1 + count]) & _PLACE).astype(np.int64)
    starts = np.flatnonzero(valid)
    at = anchor[starts]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    head = np.flatnonzero(fresh)
    n = np.diff(np.append(head, len(starts)))
    begin = starts[head]
    seg = Prefix(values).hash(begin, begin + n - 1 + size)
    document = np.searchsorted(first, begin, "right") - 1
    return document, begin - first[document], n, seg, hashed[at[head]]


def entries_of(scheme: Scheme, chunk: Chunk) -> np.ndarray:
    parts = _parts_of(scheme, chunk)
    out = [np.zeros(0, ENTRY)]
    for shift, values, first in parts:
        document, start, n, seg, anchor = segments(scheme, values, first)
        found = np.zeros(len(document), ENTRY)
        found["id"] = chunk.column("_id")[document]
        found["copy"] = chunk.column("_copy")[document]
        found["start"], found["n"], found["seg"], found["anchor"], found["weight"] = start + shift, n, seg, anchor, 1
        out.append(found)
    return np.concatenate(out)


def _parts_of(scheme: Scheme, chunk: Chunk) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first token, values, each document's first) of parts that hold all windows of a chunk. A
    text that is far longer than a chunk is one on its own and comes in parts, so its hashes take
    bounded memory; a segment that is cut there is two segments of one anchor, which are compared."""
    if chunk.batch.num_rows > 1 or len(chunk.data) <= LONG:
        yield 0, *scheme.tokens(chunk)
        return
    tokens = chunk.data if scheme.unit == "byte" else words(chunk).hashes
    for a in range(0, len(tokens), LONG):
        part = tokens[a : a + LONG + scheme.window - 1]
        yield a, byte_values(part) if scheme.unit == "byte" else part, np.array([0, len(part)])


def settle(rule: str, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort entries by (anchor, segment, id). Returns them, which are covered by an equal
    segment, and where each group of equal segments begins."""
    entries = entries[np.lexsort((entries["id"], entries["seg"], entries["anchor"]))]
    if not len(entries):
        return entries, np.zeros(0, bool), np.zeros(0, np.int64)
    fresh = np.ones(len(entries), bool)
    fresh[1:] = (entries["seg"][1:] != entries["seg"][:-1]) | (entries["anchor"][1:] != entries["anchor"][:-1])
    head = np.flatnonzero(fresh)
    size = np.diff(np.append(head, len(entries)))
    if rule == "elsewhere":
        covered = np.repeat(np.add.reduceat(entries["weight"].astype(np.int64), head) > 1, size)
    else:
        covered = entries["id"] > np.repeat(entries["id"][head], size)
    return entries, covered, head


def _settled_in_batch(rule: str, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(covered entries, entries to send): what equal segments of the same batch already decide.
    An entry of weight 2 stands for several, whose verdict is known."""
    entries, covered, head = settle(rule, entries)
    if rule == "earlier":
        return entries[covered], entries[~covered]
    sent = entries[head]
    sent["weight"] = 1 + covered[head]
    return entries[covered], sent


def _dealt(entries: np.ndarray, key: np.ndarray, buckets: int, kind: int) -> Iterator[tuple[int, int, bytes]]:
    """(bucket, kind, packed entries) by the top bits of a 64-bit key."""
    if len(entries) == 0:
        return
    bucket = ((key >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    entries, bucket = entries[order], bucket[order]
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    for a, b in zip(cuts, np.append(cuts[1:], len(entries)), strict=True):
        yield int(bucket[a]), kind, packed(entries[a:b])


_SENT = "bucket int, kind int, packed binary"


def _sent(rows: Iterator[tuple[int, int, bytes]]) -> pa.RecordBatch:
    found = list(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in found], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], ["bucket", "kind", "packed"]
    )


_FOUND = "_id long, _copy long, start int, n int, kind int, anchor long"
#: Kinds of found entries: settled; to compare; only to compare with; the last two with too many segments for one task.
COVERED, OPEN, KNOWN, OPEN_HOT, KNOWN_HOT = range(5)
#: Two more kinds of rows that tasks write: packed entries not settled yet, packed counts of anchors.
UNDECIDED, COUNTED = 5, 6
#: An anchor, its different segments, and its entries to compare (one document can hold a segment very often).
COUNT = np.dtype([("anchor", "<u8"), ("different", "<u4"), ("opened", "<u4")])
#: Anchors whose counts a worker keeps before it sends them (16 MB).
BATCH_ANCHORS = 1 << 20


def _found(entries: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
    columns = [entries["id"], np.ascontiguousarray(entries["copy"]), entries["start"].astype(np.int32), entries["n"].astype(np.int32), kind.astype(np.int32), np.ascontiguousarray(entries["anchor"]).view(np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["_id", "_copy", "start", "n", "kind", "anchor"])


_JUDGED = f"{_FOUND}, region int, packed binary"


def _plain(found: pa.RecordBatch) -> pa.RecordBatch:
    n = found.num_rows
    return pa.RecordBatch.from_arrays([*found.columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], [*found.schema.names, "region", "packed"])


def _blobs(kind: int, regions: list[int], blobs: list[bytes]) -> pa.RecordBatch:
    n = len(blobs)
    none = [pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32())]
    columns = [*none, pa.array([kind] * n, pa.int32()), pa.nulls(n, pa.int64()), pa.array(regions, pa.int32()), pa.array(blobs, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _JUDGED.split(", ")])


def judged_bucket(scheme: Scheme, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(settled entries, undecided ones) of one bucket of segments. An undecided entry has
    weight 1 if it is to be compared, 2 if it is only compared with."""
    entries, covered, head = settle(scheme.rule, entries)
    if not len(entries):
        return entries, entries
    settled = entries[covered & (entries["weight"] == 1)]  # of others the verdict was given in their batch
    opened = entries[~covered]
    opened["weight"] = 1
    if scheme.rule == "earlier":
        return settled, opened
    known = entries[head[covered[head]]]
    known["weight"] = 2
    return settled, np.concatenate([opened, known])


def counted_anchors(undecided: np.ndarray) -> np.ndarray:
    """Counts of each anchor, in order. Entries of one segment are all here."""
    out = np.zeros(0, COUNT)
    if len(undecided):
        pairs = undecided[np.lexsort((undecided["seg"], undecided["anchor"]))]
        turn = np.concatenate([[True], pairs["anchor"][1:] != pairs["anchor"][:-1]])
        fresh = turn.copy()
        fresh[1:] |= pairs["seg"][1:] != pairs["seg"][:-1]
        head = np.flatnonzero(turn)
        out = np.zeros(len(head), COUNT)
        out["anchor"] = pairs["anchor"][head]
        out["different"] = np.add.reduceat(fresh.astype(np.uint32), head)
        out["opened"] = np.add.reduceat((pairs["weight"] == 1).astype(np.uint32), head)
    return out


def summed_anchors(parts: list[np.ndarray]) -> np.ndarray:
    """Counts of several parts of the corpus, one per anchor."""
    counts = np.concatenate(parts)
    counts = counts[np.argsort(counts["anchor"], kind="stable")]
    head = np.flatnonzero(np.concatenate([[True], counts["anchor"][1:] != counts["anchor"][:-1]]))
    out = counts[head]
    for field in ("different", "opened"):
        sums = np.add.reduceat(counts[field].astype(np.int64), head)
        out[field] = np.minimum(sums, np.iinfo(np.uint32).max)
    return out


def _count_rows(parts: list[np.ndarray], region_bits: int) -> pa.RecordBatch:
    """Counts of anchors, one row per region of anchors."""
    counts = summed_anchors(parts)
    regions = region_of(counts["anchor"], region_bits)
    cuts = np.flatnonzero(np.concatenate([[True], regions[1:] != regions[:-1]]))
    blobs = [counts[a:b].tobytes() for a, b in zip(cuts, np.append(cuts[1:], len(counts)), strict=True)]
    return _blobs(COUNTED, regions[cuts].tolist(), blobs)


_SLICES = "region int, shared binary, hot binary"


def _anchor_slices(scheme: Scheme, region_bits: int) -> Callable:
    """The slices of both bitmaps, of one region of anchors after another."""
    empty = Bitmap(region_bits, np.zeros(0, np.uint8))

    def sliced(region: int, held: list[np.ndarray]) -> pa.RecordBatch:
        counts = summed_anchors(held)
        shared = counts[(counts["different"] > 1) & (counts["opened"] > 0)]
        hot = shared[np.maximum(shared["different"], shared["opened"]) > scheme.most_segments]
        slices = [empty.slice(region, np.ascontiguousarray(x["anchor"])) for x in (shared, hot)]
        return pa.RecordBatch.from_arrays([pa.array([region], pa.int32()), *(pa.array([x], pa.binary()) for x in slices)], ["region", "shared", "hot"])

    def reduce(batches):
        at, held = None, []
        for batch in batches:
            for region, blob in zip(batch.column("region").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                if region != at:
                    if held:
                        yield sliced(at, held)
                    at, held = region, []
                held.append(np.frombuffer(blob, COUNT))
                if len(held) >= 64:
                    held = [summed_anchors(held)]
        if held:
            yield sliced(at, held)

    return reduce


def _decided(scheme: Scheme, sent) -> Callable:
    """Undecided entries whose anchors have different segments, as found entries."""

    def decide(batches):
        region_bits, shared_bits, hot_bits = sent.value
        shared, hot = Bitmap(region_bits, shared_bits), Bitmap(region_bits, hot_bits)
        for batch in batches:
            for blob in batch.column("packed").to_pylist():
                entries = unpacked(blob)
                entries = entries[shared.has(np.ascontiguousarray(entries["anchor"]))]
                if len(entries):
                    kind = np.where(entries["weight"] == 1, OPEN, KNOWN)
                    many = hot.has(np.ascontiguousarray(entries["anchor"]))
                    yield _found(entries, np.where(many, kind + OPEN_HOT - OPEN, kind))

    return decide


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes], list[bytes]]]:
    """Blobs of one bucket at a time (rows come sorted by bucket): of kind 0 and of kind 1."""
    bucket, plain, passed = None, [], []
    for batch in batches:
        for b, kind, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "packed")), strict=True):
            if b != bucket:
                if bucket is not None:
                    yield bucket, plain, passed
                bucket, plain, passed = b, [], []
            (passed if kind else plain).append(blob)
    if bucket is not None:
        yield bucket, plain, passed


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def find(docs: DataFrame, scheme: Scheme, compare: Callable) -> DataFrame:
    """_id, _copy, start, n: ranges of window starts (in tokens) of ``docs`` (made by ``keyed``)
    that the rule covers. ``compare`` maps record batches of requests (see ``request_runs``) to
    record batches of covered ranges (see ``ranges``)."""
    tasks = _partitions(docs)
    buckets = tasks * scheme.buckets_per_task
    region_bits = min(16, max(8, buckets.bit_length()))

    def gather(batches):
        held: list[np.ndarray] = []
        for chunk in chunks(batches, "_text", CHUNK):
            held.append(entries_of(scheme, chunk))
            if sum(map(len, held)) >= BATCH:
                yield _dealt_batch(np.concatenate(held))
                held = []
        if held:
            yield _dealt_batch(np.concatenate(held))

    def _dealt_batch(entries):
        covered, sent = _settled_in_batch(scheme.rule, entries)
        # What is settled only passes through, so it is dealt evenly, and its hashes have done their work.
        covered["seg"] = covered["anchor"] = 0
        passing = mix(covered["id"].astype(U64))
        return _sent([*_dealt(sent, sent["seg"], buckets, 0), *_dealt(covered, passing, buckets, 1)])

    def judge(batches):
        counts: list[np.ndarray] = []
        for _, plain, passed in _by_bucket(batches):
            for blob in passed:
                entries = unpacked(blob)
                yield _plain(_found(entries, np.zeros(len(entries), np.int64)))
            if plain:
                settled, undecided = judged_bucket(scheme, np.concatenate([unpacked(b) for b in plain]))
                settled["anchor"] = 0
                yield _plain(_found(settled, np.zeros(len(settled), np.int64)))
                if len(undecided):
                    counts.append(counted_anchors(undecided))
                    undecided["seg"] = 0  # not needed any more
                    yield _blobs(UNDECIDED, [0], [packed(undecided)])
                if sum(map(len, counts)) >= BATCH_ANCHORS:
                    yield _count_rows(counts, region_bits)
                    counts = []
        if counts:
            yield _count_rows(counts, region_bits)

    dealt = docs.mapInArrow(gather, _SENT).repartition(tasks, "bucket").sortWithinPartitions("bucket")
    judged = materialise(dealt.mapInArrow(judge, _JUDGED), "zstd")
    anchors = judged.filter(F.col("kind") == COUNTED).select("region", "packed")
    anchors = anchors.repartition(min(tasks, 1 << region_bits), "region").sortWithinPartitions("region")
    shared, hot = Bitmap.empty(region_bits), Bitmap.empty(region_bits)
    # One row of two slices per region: 32 MB in all, whatever the corpus.
    for row in anchors.mapInArrow(_anchor_slices(scheme, region_bits), _SLICES).collect():
        shared.put(row["region"], row["shared"])
        hot.put(row["region"], row["hot"])
    sent = docs.sparkSession.sparkContext.broadcast((region_bits, shared.bits, hot.bits))
    undecided = judged.filter(F.col("kind") == UNDECIDED).select("packed")
    found = undecided.mapInArrow(_decided(scheme, sent), _FOUND)
    covered = judged.filter(F.col("kind") == COVERED).select("_id", "_copy", "start", "n")

    # Rows that share id and text bring the same entries each, of which one will do.
    requests = (
        found.groupBy("_id", "_copy")
        .agg(F.collect_set(F.struct("start", "n", "kind", "anchor")).alias("asked"))
    )
    texts = docs.join(requests, ["_id", "_copy"])
    # What is compared is written once: two branches read it.
    fetched = materialise(texts.mapInArrow(_fetch(scheme, buckets), _FETCHED), "zstd")

    near = fetched.filter("hot = 0").repartition(tasks, "anchor").sortWithinPartitions("anchor")
    near = near.mapInArrow(compare, "_id long, _copy long, start int, n int")

    def judge_windows(batches):
        for _, plain, passed in _by_bucket(batches):
            for blob in passed:
                entries = unpacked(blob)
                yield _found(entries, np.zeros(len(entries), np.int64))
            if plain:
                entries, covered, _ = settle(scheme.rule, np.concatenate([unpacked(b) for b in plain]))
                entries = entries[covered & (entries["weight"] == 1)]
                yield _found(entries, np.zeros(len(entries), np.int64))

    hot = fetched.filter("hot = 1").select(F.col("anchor").cast("int").alias("bucket"), F.col("known").cast("int").alias("kind"), F.col("content").alias("packed"))
    hot = hot.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(judge_windows, _FOUND)
    return covered.unionByName(near).unionByName(hot.select("_id", "_copy", "start", "n"))


_FETCHED = "hot int, anchor long, _id long, _copy long, start int, n int, known boolean, content binary"


def _fetch(scheme: Scheme, buckets: int) -> Callable:
    """Texts of the requested segments. Those of too frequent anchors become one entry per
    window, dealt out by the window's hash and settled within the chunk as far as possible."""

    def rows(chunk: Chunk):
        n = chunk.batch.num_rows
        values, first = scheme.tokens(chunk)
        at = words(chunk) if scheme.unit == "word" else None
        asked = chunk.batch.column("asked")
        flat = asked.flatten()
        start, count, kind, anchor = (flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("start", "n", "kind", "anchor"))
        owner = np.repeat(np.arange(n), asked.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        ids, copies = chunk.column("_id")[owner], chunk.column("_copy")[owner]
        base = first[owner] + start
        hot = kind >= OPEN_HOT
        known = (kind == KNOWN) | (kind == KNOWN_HOT)
        for i in np.flatnonzero(~hot):
            a, b = base[i], base[i] + count[i] - 1 + scheme.window
            content = chunk.data[a:b].tobytes() if at is None else values[a:b].tobytes()
            yield 0, int(anchor[i]), int(ids[i]), int(copies[i]), int(start[i]), int(count[i]), bool(known[i]), content
        some = np.flatnonzero(hot)
        if len(some):
            step = np.arange(int(count[some].sum())) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
            pick = np.repeat(some, count[some])
            window = base[pick] + step
            entries = np.zeros(len(pick), ENTRY)
            entries["seg"] = Prefix(values).hash(window, window + scheme.window)
            entries["id"], entries["copy"], entries["start"] = ids[pick], copies[pick], start[pick] + step
            entries["n"], entries["weight"] = 1, np.where(known[pick], 2, 1)
            # Windows have no anchor of their own here; equal ones share a segment hash.
            covered, sent = _settled_in_batch(scheme.rule, entries)
            covered["seg"] = 0
            passing = mix(covered["id"].astype(U64))
            for bucket, settled, blob in (*_dealt(sent, sent["seg"], buckets, 0), *_dealt(covered, passing, buckets, 1)):
                yield 1, bucket, 0, 0, 0, 0, bool(settled), blob

    def fetch(batches):
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
        names = [c.split()[0] for c in _FETCHED.split(", ")]
        for chunk in chunks(batches, "_text", CHUNK):
            found = list(rows(chunk))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], t) for k, t in enumerate(types)], names)

    return fetch


@dataclass
class Request:
    """A segment to compare: its windows start at ``start``.. in (id, copy); ``content`` is its
    bytes or its word hashes; a known one is only compared with."""

    anchor: int
    id: int
    copy: int
    start: int
    n: int
    known: bool
    content: bytes


def request_runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[Request]]:
    """Requests of whole anchors, about ``size`` bytes or one anchor at once. An anchor has at
    most ``most_segments`` segments to compare here and as many to compare with, so runs are bounded
    (an anchor that the bitmap takes for shared or frequent is compared or dealt out for nothing)."""
    names = ("anchor", "_id", "_copy", "start", "n", "known", "content")
    run, held = [], 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            r = Request(*row)
            if held >= size and run[-1].anchor != r.anchor:
                yield run
                run, held = [], 0
            run.append(r)
            held += len(r.content)
    if run:
        yield run


def ranges(requests: list[Request], owner: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Covered ranges of window starts; ``owner`` indexes requests."""
    ids = np.array([r.id for r in requests], np.int64)[owner]
    copies = np.array([r.copy for r in requests], np.int64)[owner]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(copies), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))], ["_id", "_copy", "start", "n"]
    )


def with_ranges(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs and, for each, ``_starts`` and ``_counts`` of its covered ranges (missing if none).
    Rows that share id and text have found the same ranges; each of them gets them once."""
    by_doc = found.groupBy("_id", "_copy").agg(F.collect_set(F.struct("start", "n")).alias("_r"))
    by_doc = by_doc.select("_id", "_copy", F.col("_r.start").alias("_starts"), F.col("_r.n").alias("_counts"))
    return docs.join(by_doc, ["_id", "_copy"], "left")


def spans(scheme: Scheme, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first token, end token) of the maximal covered runs of each row of ``with_ranges``."""
    starts, counts = batch.column("_starts"), batch.column("_counts")
    lengths = starts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(batch.num_rows), lengths)
    start = starts.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    end = start + counts.flatten().to_numpy(zero_copy_only=False) - 1 + scheme.window
    return unioned(owner, start, end)


__all__ = ["Request", "Scheme", "find", "keyed", "ranges", "request_runs", "spans", "with_ranges"]
