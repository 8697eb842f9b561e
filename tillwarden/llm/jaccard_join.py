"""Near-duplicate join on five-word shingles with Bayesian pruning of candidates.

1. Rows with equal shingle sets are one class; only classes are compared.
2. Classes that agree in one band of their MinHash values are candidates. Within such a group
   two signatures are compared a few values at a time; after n values with m equal ones the
   similarity has the posterior Beta(m + 1, n - m + 1), and a pair is dropped as soon as the
   probability of reaching the threshold is below ``tolerance``. What survives is kept as a
   forest, so a group of n classes gives less than n rows.
3. Classes that hang together by survivors form a cluster. All pairs of a cluster are verified
   by the exact Jaccard similarity of their shingle sets; again links leave as counts and a
   forest, never as pairs.

A group or cluster above a set size is cut into blocks, and each pair of blocks is a task of
its own, so no group has to fit one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwarden.llm.components import components
from tillwarden.llm.text import NO_ID, U64, Chunk, chunks, grams, inner, key_columns, keyed, mix, words, wrapped
from tillwarden.session import materialise

SHINGLE = 5


@dataclass(frozen=True)
class JoinSettings:
    """threshold: least Jaccard similarity of a link. bands of ``rows`` values each: at the
    threshold 0.8 a pair shares no band of 24 x 4 with probability 3e-6. step: values compared
    at a time. group_block, cluster_block: most classes of a group or cluster on each side of a task."""

    threshold: float = 0.8
    values: int = 128
    bands: int = 24
    rows: int = 4
    step: int = 16
    tolerance: float = 1e-6
    group_block: int = 2048
    cluster_block: int = 1024
    seed: int = 5


def least_matches(settings: JoinSettings) -> list[tuple[int, int]]:
    """(n, m): after n values a pair goes on only with at least m equal ones.

    With a uniform prior, P(similarity >= t | m of n) = P(Binomial(n + 1, t) <= m).
    """
    t, out = settings.threshold, []
    for n in range(settings.step, settings.values + 1, settings.step):
        below, m = 0.0, 0
        while m <= n:
            below += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below >= settings.tolerance:
                break
            m += 1
        out.append((n, m))
    return out


def shingle_sets(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle hash), distinct and sorted. A text of 1 to 4 words is one shingle."""
    w = words(chunk)
    counts = w.counts
    document = np.repeat(np.arange(len(counts)), counts)
    owners, found = [document[: max(0, len(document) - SHINGLE + 1)][inner(w.first, SHINGLE)]], [grams(w.hashes, SHINGLE)[inner(w.first, SHINGLE)]]
    for size in range(1, SHINGLE):
        short = np.flatnonzero(counts == size)
        if len(short):
            owners.append(short)
            found.append(grams(w.hashes, size)[w.first[short]])
    owner, shingle = np.concatenate(owners), np.concatenate(found)
    order = np.lexsort((shingle, owner))
    owner, shingle = owner[order], shingle[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])
    return owner[fresh], shingle[fresh]


def signed(docs: DataFrame, settings: JoinSettings) -> DataFrame:
    """_id, _copy, class (16 bytes that stand for the shingle set; missing without a word),
    n_shingles, signature (2 bytes a value), bands (a key for each)."""
    rng = np.random.default_rng(settings.seed)
    factor = rng.integers(0, 2**63, settings.values, dtype=np.uint64) * U64(2) + U64(1)
    shift = rng.integers(0, 2**63, settings.values, dtype=np.uint64)
    in_band = rng.integers(0, 2**63, (settings.bands, settings.rows), dtype=np.uint64) * U64(2) + U64(1)

    def sign(batches):
        for chunk in chunks(batches, "_text"):
            owner, shingle = shingle_sets(chunk)
            n = np.bincount(owner, minlength=chunk.batch.num_rows)
            full = np.flatnonzero(n)
            head = np.searchsorted(owner, full)
            minima = np.zeros((len(full), settings.values), U64)
            if len(full):
                for k in range(settings.values):
                    minima[:, k] = np.minimum.reduceat(shingle * factor[k] + shift[k], head)
                mixed = mix(shingle)
                keys = np.stack(
                    [mix(np.add.reduceat(mixed, head) + n[full].astype(U64)), mix(np.bitwise_xor.reduceat(mixed, head) ^ n[full].astype(U64) * U64(0x9E3779B97F4A7C15))],
                    axis=1,
                )
            banded = minima[:, : settings.bands * settings.rows].reshape(len(full), settings.bands, settings.rows)
            bands = mix((banded * in_band).sum(axis=2, dtype=U64) + np.arange(settings.bands, dtype=U64))
            short = (mix(minima) >> U64(48)).astype("<u2")
            at = {int(d): k for k, d in enumerate(full)}
            pick = [at.get(i) for i in range(chunk.batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.batch.column("_id"),
                    chunk.batch.column("_copy"),
                    pa.array([None if k is None else keys[k].tobytes() for k in pick], pa.binary()),
                    pa.array(n.astype(np.int32)),
                    pa.array([None if k is None else short[k].tobytes() for k in pick], pa.binary()),
                    pa.array([None if k is None else bands[k].view(np.int64) for k in pick], pa.list_(pa.int64())),
                ],
                ["_id", "_copy", "class", "n_shingles", "signature", "bands"],
            )

    return docs.mapInArrow(sign, "_id long, _copy long, class binary, n_shingles int, signature binary, bands array<long>")


def _in_blocks(rows: DataFrame, key: list[str], size: str, block: int) -> DataFrame:
    """Rows of groups (``key``, with ``size`` members) for each pair of blocks (i <= j) that they
    are part of, with ``side`` 0 for members of i."""
    n = F.ceil(F.col(size) / F.lit(block)).cast("int")
    own = F.pmod(F.hash("class"), n)
    rows = rows.withColumn("_n", n).withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    i, j = F.least("_own", "_other"), F.greatest("_own", "_other")
    # A member of block i is on side 1 of the tasks whose other block comes before its own.
    side = (F.col("_other") < F.col("_own")).cast("int")
    return rows.select(*rows.columns[: rows.columns.index("_n")], i.alias("i"), j.alias("j"), side.alias("side"))


def _groups(batches: Iterator[pa.RecordBatch], key: tuple[str, ...], columns: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows with equal keys."""
    at, held = None, []
    for batch in batches:
        data = [batch.column(c).to_pylist() for c in (*key, *columns)]
        for row in zip(*data, strict=True):
            if row[: len(key)] != at:
                if held:
                    yield at, held
                at, held = row[: len(key)], []
            held.append(row[len(key) :])
    if held:
        yield at, held


def surviving_forest(signatures: np.ndarray, side: np.ndarray, crossing: bool, needed: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Edges that connect what the surviving pairs connect. Only pairs over the two sides count
    if ``crossing``. Each reached member is compared with all that are not reached yet."""
    waiting = np.arange(len(signatures))
    edges = []
    while len(waiting):
        frontier, waiting = [int(waiting[0])], waiting[1:]
        while frontier and len(waiting):
            x = frontier.pop()
            alive = waiting[side[waiting] != side[x]] if crossing else waiting
            equal, before = np.zeros(len(alive), np.int64), 0
            for n, least in needed:
                equal += (signatures[alive, before:n] == signatures[x, before:n]).sum(axis=1)
                go_on = equal >= least
                alive, equal, before = alive[go_on], equal[go_on], n
                if not len(alive):
                    break
            if len(alive):
                edges += [(x, int(y)) for y in alive]
                frontier += alive.tolist()
                waiting = np.setdiff1d(waiting, alive, assume_unique=True)
    return edges


def candidate_edges(classes: DataFrame, settings: JoinSettings) -> DataFrame:
    """a, b: classes joined by surviving candidates (a forest of each group)."""
    needed = least_matches(settings)
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    banded = classes.select("class", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1")
    groups = banded.join(shared, "band").join(classes.select("class", "signature"), "class")
    rows = _in_blocks(groups, ["band"], "members", settings.group_block)
    rows = rows.repartition(tasks, "band", "i", "j").sortWithinPartitions("band", "i", "j")

    def prune(batches):
        for batch in _edges(_pruned(batches)):
            yield batch

    def _pruned(batches):
        for (_, i, j), members in _groups(batches, ("band", "i", "j"), ("side", "class", "signature")):
            signatures = np.frombuffer(b"".join(m[2] for m in members), "<u2").reshape(len(members), -1)
            side = np.array([m[0] for m in members])
            for x, y in surviving_forest(signatures, side, i != j, needed):
                yield min(members[x][1], members[y][1]), max(members[x][1], members[y][1])

    return rows.mapInArrow(prune, "a binary, b binary").distinct()


def _edges(pairs: Iterator[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
    held = []
    for pair in pairs:
        held.append(pair)
        if len(held) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*held, strict=True)], ["a", "b"])
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*held, strict=True)], ["a", "b"])


def common_counts(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices over slabs of shingles
    that at least two sets hold."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, which, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.cumsum(times > 1) - 1
    keep = times[which] > 1
    owner, which = owner[keep], rank[which[keep]]
    order = np.argsort(which, kind="stable")
    owner, which = owner[order], which[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(which[-1]) + 1 if len(which) else 0, columns):
        a, b = np.searchsorted(which, [low, low + columns])
        slab = np.zeros((len(sets), columns), np.float32)
        slab[owner[a:b], which[a:b] - low] = 1
        out += slab @ slab.T
    return out


def linked(sets: list[np.ndarray], side: np.ndarray, crossing: bool, threshold: float) -> np.ndarray:
    """Matrix of links: exact Jaccard similarity of at least the threshold."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.float64)
    if n <= 16:
        plain = [frozenset(s.tolist()) for s in sets]
        common = np.zeros((n, n))
        for x in range(n):
            for y in range(x + 1, n):
                common[x, y] = common[y, x] = len(plain[x] & plain[y])
    else:
        common = common_counts(sets).astype(np.float64)
    link = common >= threshold * (size[:, None] + size[None, :] - common) - 1e-9
    np.fill_diagonal(link, False)
    return link & (side[:, None] != side[None, :]) if crossing else link


def _forest(link: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest."""
    waiting = np.ones(len(link), bool)
    edges = []
    for start in range(len(link)):
        if not waiting[start]:
            continue
        waiting[start] = False
        frontier = [start]
        while frontier:
            x = frontier.pop()
            reached = np.flatnonzero(link[x] & waiting)
            waiting[reached] = False
            edges += [(x, int(y)) for y in reached]
            frontier += reached.tolist()
    return edges


def verified(clusters: DataFrame, docs: DataFrame, settings: JoinSettings) -> DataFrame:
    """class, other, n: for every class of a cluster the rows that its links add (other missing),
    and a forest of the links (n missing)."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def fetch(batches):
        for chunk in chunks(batches, "_text"):
            owner, shingle = shingle_sets(chunk)
            cuts = np.searchsorted(owner, np.arange(chunk.batch.num_rows + 1))
            sets = pa.array([shingle[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
            kept = ["class", "cluster", "members", "n_docs"]
            yield pa.RecordBatch.from_arrays([*map(chunk.batch.column, kept), sets], [*kept, "shingles"])

    texts = docs.join(clusters, ["_id", "_copy"]).select("class", "cluster", "members", "n_docs", "_text")
    sets = texts.mapInArrow(fetch, "class binary, cluster binary, members long, n_docs long, shingles binary").dropDuplicates(["class"])
    rows = _in_blocks(sets, ["cluster"], "members", settings.cluster_block)
    rows = rows.repartition(tasks, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    threshold = settings.threshold

    def verify(batches):
        for (_, i, j), members in _groups(batches, ("cluster", "i", "j"), ("side", "class", "n_docs", "shingles")):
            side = np.array([m[0] for m in members])
            link = linked([np.frombuffer(m[3], U64) for m in members], side, i != j, threshold)
            rows_added = link @ np.array([m[2] for m in members], np.int64)
            forest = _forest(link)
            some = np.flatnonzero(rows_added)
            names = [m[1] for m in members]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([names[x] for x in some] + [min(names[x], names[y]) for x, y in forest], pa.binary()),
                    pa.array([None] * len(some) + [max(names[x], names[y]) for x, y in forest], pa.binary()),
                    pa.array(rows_added[some].tolist() + [None] * len(forest), pa.int64()),
                ],
                ["class", "other", "n"],
            )

    return rows.mapInArrow(verify, "class binary, other binary, n long")


def joined(docs: DataFrame, settings: JoinSettings | None = None) -> DataFrame:
    """doc_id, class_id, n_links, keeper and the key columns _id, _copy: one row per row of ``docs``.

    class_id is the least doc_id among the rows that links connect (missing if none has an id),
    n_links the number of other rows with a similarity of at least the threshold, copies
    included. ``keeper`` marks one row of each class: the least id, then the least text hash;
    rows equal in both are all marked (see ``one_of_each``). Rows without a word have no links
    and are classes of their own.
    """
    settings = settings or JoinSettings()
    rows = keyed(docs)
    signatures = materialise(signed(rows, settings))
    full = signatures.filter(F.col("class").isNotNull())
    classes = full.groupBy("class").agg(
        F.min(F.struct("_id", "_copy")).alias("first"),
        F.count("*").alias("n_docs"),
        F.first("signature").alias("signature"),
        F.first("bands").alias("bands"),
    )
    classes = materialise(classes)
    near = components(candidate_edges(classes, settings)).select(F.col("node").alias("class"), F.col("root").alias("cluster"))
    near = materialise(near)
    sizes = near.groupBy("cluster").agg(F.count("*").alias("members"))
    clusters = near.join(sizes, "cluster").join(classes.select("class", "first._id", "first._copy", "n_docs"), "class")
    found = materialise(verified(clusters, rows, settings))
    roots = components(found.filter("other IS NOT NULL").select(F.col("class").alias("a"), F.col("other").alias("b")))
    added = found.filter("n IS NOT NULL").groupBy("class").agg(F.sum("n").alias("added"))
    named = (
        classes.select("class", "first", "n_docs")
        .join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
        .join(added, "class", "left")
        .select("class", "first", F.coalesce("root", "class").alias("root"), (F.col("n_docs") - 1 + F.coalesce("added", F.lit(0))).alias("n_links"))
    )
    leaders = named.groupBy("root").agg(F.min("first").alias("leader"))
    named = named.join(leaders, "root").select("class", "leader", "n_links")
    own = F.struct("_id", "_copy")
    out = signatures.select("_id", "_copy", "class").join(named, "class", "left")
    leader = F.coalesce("leader", own)
    real = lambda c: F.when(c != NO_ID, c)
    return out.select(
        real(F.col("_id")).alias("doc_id"),
        real(leader["_id"]).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (leader == own).alias("keeper"),
        "_id",
        "_copy",
    )


def one_of_each(docs: DataFrame, settings: JoinSettings | None = None) -> DataFrame:
    """One row of ``docs`` per class, with its columns. Rows that repeat a keeper's id and text
    are copies of it, so one of them stays; rows without a word stay."""
    verdict = joined(docs, settings).filter("keeper").select("_id", "_copy")
    rows = wrapped(docs).withColumns(key_columns("row.text", "row.doc_id")).join(verdict, ["_id", "_copy"], "left_semi")
    return rows.dropDuplicates(["_id", "_copy"]).select("row.*")
