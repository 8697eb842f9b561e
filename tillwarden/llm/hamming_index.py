"""Nearest neighbours by multi-index hashing of learned binary codes.

A bounded sample of the vectors teaches several rotations: principal directions, turned until
the signs of the coordinates lose least (iterative quantisation). The signs are a vector's code.
A code is split into substrings and each substring is indexed: if two codes differ in at most r
of their bits, some substring differs in at most r / (number of substrings), so looking up every
value that near in each substring finds every code within r. What is found is compared by code,
and what is left is ranked by its distance to the original vector.

The radius of a question follows from the nearest vectors known so far: the sample also teaches how
many bits differ at a distance, and only what may be nearer than the k-th best is asked for.
Every row is indexed, in the task that holds it; a question goes to all of them, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwarden.session import materialise


@dataclass(frozen=True)
class HammingSettings:
    """neighbours: wanted per question. sample: most vectors to learn from. rotations: learned one
    after another; each adds one bit per dimension. substring: bits of a part that is indexed.
    covered: share of the pairs at a distance whose codes the radius has to reach. rows: indexed
    at once by a task. block: questions sent at once."""

    neighbours: int = 10
    sample: int = 8192
    rotations: int = 4
    steps: int = 20
    substring: int = 16
    covered: float = 0.98
    rows: int = 1 << 15
    block: int = 4096
    seed: int = 7


@dataclass
class Coder:
    """centre and directions give the signs; ``edges`` are distances and ``reach`` the number of
    differing bits that covers pairs up to each of them."""

    centre: np.ndarray
    directions: np.ndarray
    edges: np.ndarray
    reach: np.ndarray
    sample: np.ndarray
    sample_ids: np.ndarray

    def codes(self, vectors: np.ndarray, substring: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each vector, its code in words of 64 bits and its substrings as numbers; what is
        left over in the last ones is 0."""
        bits = ((vectors - self.centre) @ self.directions) > 0
        words = np.packbits(_padded(bits, 64), axis=1, bitorder="little").view(np.uint64)
        parts = _padded(bits, substring)
        weight = 1 << np.arange(substring, dtype=np.int64)
        return words, (parts.reshape(len(bits), parts.shape[1] // substring, substring) @ weight).astype(np.uint32)

    def radius(self, distance: float) -> int:
        """Bits that codes of vectors up to ``distance`` apart differ in, at most of ``covered`` of them."""
        at = int(np.searchsorted(self.edges, distance, "left"))
        return int(self.reach[min(at, len(self.reach) - 1)]) if np.isfinite(distance) else self.directions.shape[1]


def _padded(bits: np.ndarray, to: int) -> np.ndarray:
    return np.pad(bits, ((0, 0), (0, -bits.shape[1] % to)))


def distances(rows: np.ndarray, question: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, by the differences themselves."""
    difference = rows - question
    return np.sqrt((difference * difference).sum(axis=1))


def _rotated(projected: np.ndarray, rng: np.random.Generator, steps: int) -> np.ndarray:
    """An orthogonal turn of the principal directions that brings coordinates near to their signs."""
    turn = np.linalg.qr(rng.standard_normal((projected.shape[1],) * 2))[0]
    for _ in range(steps):
        signs = np.sign(projected @ turn)
        u, _, v = np.linalg.svd(signs.T @ projected)
        turn = (u @ v).T
    return turn


def learn(sample: np.ndarray, ids: np.ndarray, settings: HammingSettings) -> Coder:
    rng = np.random.default_rng(settings.seed)
    centre = sample.mean(axis=0)
    moved = sample - centre
    directions = np.linalg.svd(moved.T @ moved)[0]
    projected = moved @ directions
    turned = [directions @ _rotated(projected, rng, settings.steps) for _ in range(settings.rotations)]
    coder = Coder(centre, np.hstack(turned), np.zeros(0), np.zeros(0), sample, ids)
    coder.edges, coder.reach = _calibrated(coder, settings)
    return coder


def _calibrated(coder: Coder, settings: HammingSettings) -> tuple[np.ndarray, np.ndarray]:
    """For rising distances, the number of differing bits that ``covered`` of the sample's pairs
    around that distance do not pass. Only the nearer pairs of each vector are looked at."""
    sample, bits = coder.sample, coder.directions.shape[1]
    signs = np.where((sample - coder.centre) @ coder.directions > 0, 1.0, -1.0)
    squares = (sample * sample).sum(axis=1)
    near, differ = [], []
    nearest = min(len(sample), 1 + 10 * settings.neighbours)
    for at in range(0, min(len(sample), 2048), 256):
        some = slice(at, at + 256)
        d = np.sqrt(np.maximum(0, squares[some, None] + squares[None] - 2 * sample[some] @ sample.T))
        pick = np.argpartition(d, nearest - 1, axis=1)[:, :nearest]
        near.append(np.take_along_axis(d, pick, 1).ravel())
        differ.append(np.take_along_axis((bits - signs[some] @ signs.T) / 2, pick, 1).ravel())
    near, differ = np.concatenate(near), np.concatenate(differ)
    order = np.argsort(near)
    groups = np.array_split(order, max(1, min(32, len(order) // 200)))
    edges = np.array([near[g].max() for g in groups])
    reach = np.array([np.quantile(differ[g], settings.covered) for g in groups])
    return edges, np.ceil(np.maximum.accumulate(reach)).astype(np.int64)


class SubstringIndex:
    """Rows by the value of each substring of their codes."""

    def __init__(self, words: np.ndarray, parts: np.ndarray, substring: int):
        self.words, self.width = words, substring
        self.order = [np.argsort(column, kind="stable") for column in parts.T]
        self.sorted = [column[order] for column, order in zip(parts.T, self.order, strict=True)]

    def within(self, word: np.ndarray, part: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose codes differ from that of ``word`` and ``part`` in at most ``radius`` bits."""
        flips = _flips(self.width, radius // len(part))
        if len(flips) * len(part) >= len(self.words):
            # There are more values to look up than rows: every row is compared.
            return np.flatnonzero(np.bitwise_count(self.words ^ word).sum(axis=1) <= radius)
        hit = np.zeros(len(self.words), bool)
        for own, order, value in zip(self.sorted, self.order, part, strict=True):
            keys = value ^ flips
            low, high = np.searchsorted(own, keys, "left"), np.searchsorted(own, keys, "right")
            for a, b in zip(low[high > low].tolist(), high[high > low].tolist(), strict=True):
                hit[order[a:b]] = True
        found = np.flatnonzero(hit)
        return found[np.bitwise_count(self.words[found] ^ word).sum(axis=1) <= radius]


_FLIPS: dict[tuple[int, int], np.ndarray] = {}


def _flips(width: int, radius: int) -> np.ndarray:
    """Every value of ``width`` bits with at most ``radius`` ones."""
    key = width, min(radius, width)
    if key not in _FLIPS:
        if key[1] > 3:  # more than the rows of any index: every value
            return np.arange(1 << width, dtype=np.uint32)
        values = [sum(1 << b for b in ones) for n in range(key[1] + 1) for ones in combinations(range(width), n)]
        _FLIPS[key] = np.array(values, np.uint32)
    return _FLIPS[key]


class Nearest:
    """The k nearest ids seen so far, by distance and id; an id counts at its nearest vector."""

    def __init__(self, k: int):
        self.k, self.ids, self.found = k, np.zeros(0, np.int64), np.zeros(0)

    @property
    def limit(self) -> float:
        return float(self.found[-1]) if len(self.found) == self.k else np.inf

    def take(self, ids: np.ndarray, found: np.ndarray) -> None:
        some = found <= self.limit
        ids, found = np.concatenate([self.ids, ids[some]]), np.concatenate([self.found, found[some]])
        order = np.lexsort((ids, found))
        order = order[np.sort(np.unique(ids[order], return_index=True)[1])][: self.k]
        self.ids, self.found = ids[order], found[order]


def _usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that can be searched."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(sound & F.exists("embedding", lambda x: x != 0))


def _matrix(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) of the rows with ``size`` components."""
    lists = batch.column("embedding")
    whole = lists.value_lengths().to_numpy() == size
    lists = lists.filter(pa.array(whole))
    return batch.column("vec_id").to_numpy()[whole], lists.flatten().to_numpy().reshape(-1, size)


def _runs(batches: Iterator[pa.RecordBatch], size: int, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            held.append(_matrix(batch.slice(at, rows), size))
            if sum(len(i) for i, _ in held) >= rows:
                yield np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held])
                held = []
    if sum(len(i) for i, _ in held):
        yield np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held])


def without_spare_copies(ids: np.ndarray, vectors: np.ndarray, kept: int) -> tuple[np.ndarray, np.ndarray]:
    """Of rows with equal vectors, one each of the ``kept`` smallest ids. Equal vectors are equally
    far from anything, so no question can have use for more."""
    order = np.lexsort((ids, *vectors.T))
    ids, vectors = ids[order], vectors[order]
    fresh = np.concatenate([[True], (vectors[1:] != vectors[:-1]).any(axis=1)])
    other = fresh.copy()
    other[1:] |= ids[1:] != ids[:-1]
    ids, vectors, fresh = ids[other], vectors[other], fresh[other]
    head = np.flatnonzero(fresh)
    place = np.arange(len(ids)) - head[np.cumsum(fresh) - 1]
    return ids[place < kept], vectors[place < kept]


def _least(rows: DataFrame, place: Column, settings: HammingSettings) -> pa.Table:
    return rows.orderBy(F.pmod(place, F.lit(1 << 32)), "vec_id").limit(settings.sample).toArrow()


def fitted(vectors: DataFrame, settings: HammingSettings) -> Coder | None:
    """A coder from the rows with the least hashes of their ids; None if no row can be searched.
    Vectors of another length than most of the sample's are left out here and later."""
    usable, place = _usable(vectors), F.xxhash64("vec_id")
    share = 2 * settings.sample / max(1, usable.count())
    # Of a large table only rows that may be among the least are sent to be ordered.
    near = usable if share >= 1 else usable.where(F.pmod(place, F.lit(1 << 32)) < int(share * (1 << 32)))
    rows = _least(near, place, settings)
    if not rows.num_rows:  # few ids, with very many rows each
        rows = _least(usable, place, settings)
    if not rows.num_rows:
        return None
    batch = rows.combine_chunks().to_batches()[0]
    size = int(np.bincount(batch.column("embedding").value_lengths().to_numpy()).argmax())
    ids, sample = _matrix(batch, size)
    return learn(sample, ids, settings)


def _questions(asked: DataFrame, size: int, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of at most ``block`` questions at a time; the driver holds one block. Rows
    that share an id ask once, with the least vector."""
    one = asked.where(F.size("embedding") == size).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    held: list = []
    for row in one.toLocalIterator():
        held.append((row["vec_id"], row["embedding"]))
        if len(held) == block:
            yield np.array([i for i, _ in held]), np.array([v for _, v in held])
            held = []
    if held:
        yield np.array([i for i, _ in held]), np.array([v for _, v in held])


_FOUND = "query_id long, vec_id long, score double"


def _nearest(rows: DataFrame, coder: Coder, ids: np.ndarray, questions: np.ndarray, settings: HammingSettings) -> DataFrame:
    """query_id, rank, vec_id, score of one block of questions."""
    spark = rows.sparkSession
    known = [_known(coder, i, q, settings.neighbours) for i, q in zip(ids.tolist(), questions, strict=True)]
    limits = np.array([near.limit for near in known])
    sent = spark.sparkContext.broadcast((coder, ids, questions, limits))

    def search(batches):
        coder, ids, questions, limits = sent.value
        words, parts = coder.codes(questions, settings.substring)
        best = [Nearest(settings.neighbours) for _ in ids]
        for own, vectors in _runs(batches, questions.shape[1], settings.rows):
            own, vectors = without_spare_copies(own, vectors, settings.neighbours + 1)
            index = SubstringIndex(*coder.codes(vectors, settings.substring), settings.substring)
            for k, near in enumerate(best):
                limit = min(near.limit, limits[k])
                at = index.within(words[k], parts[k], coder.radius(limit))
                at = at[own[at] != ids[k]]
                far = distances(vectors[at], questions[k])
                near.take(own[at[far <= limit]], far[far <= limit])
        yield _listed(ids, best)

    # What the sample holds is known already; the codes may miss some of it.
    seen = spark.createDataFrame(pa.Table.from_batches([_listed(ids, known)]))
    found = rows.mapInArrow(search, _FOUND).unionByName(seen)
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = found.withColumn("rank", F.row_number().over(order))
    return found.where(F.col("rank") <= settings.neighbours).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _known(coder: Coder, own: int, question: np.ndarray, k: int) -> Nearest:
    """The nearest other vectors of the sample: no result lies beyond the k-th of them."""
    near, other = Nearest(k), coder.sample_ids != own
    near.take(coder.sample_ids[other], distances(coder.sample[other], question))
    return near


def _listed(ids: np.ndarray, best: list[Nearest]) -> pa.RecordBatch:
    columns = [np.repeat(ids, [len(n.ids) for n in best]), *(np.concatenate([getattr(n, f) for n in best]) for f in ("ids", "found"))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])


_RESULT = "query_id long, rank int, vec_id long, score double"


def neighbours(vectors: DataFrame, asked: DataFrame, settings: HammingSettings | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``asked`` its nearest rows of ``vectors``
    (both vec_id, embedding), nearest first, equal distances by ascending id; rows with the question's own id
    are left out. The score is the Euclidean distance.

    Rows without an id or a vector, with a missing or non-finite component, all zeros, or of
    another length than most take no part on either side. Rows that share an id are one candidate,
    at the nearest of their vectors, and one question, with the least. An empty table gives no
    row; other columns are not looked at.
    """
    settings = settings or HammingSettings()
    spark = vectors.sparkSession
    coder = fitted(vectors, settings)
    out = None
    rows = _usable(vectors)
    for ids, questions in _questions(_usable(asked), len(coder.centre), settings.block) if coder else ():
        found = _nearest(rows, coder, ids, questions, settings)
        out = found if out is None else materialise(out.unionByName(found))
    return spark.createDataFrame([], _RESULT) if out is None else out
