"""Texts as byte arrays inside tasks: chunks of documents, words, rolling hashes.

A word is a run of ``[^\\x20\\x09-\\x0D]``; these separators are single bytes of UTF-8, so words
are found on bytes. All work is on whole texts; a chunk only says how many documents are
handled at once, never where a text ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands for a missing document id inside the operators: it sorts after all others.
NO_ID = 2**63 - 1
CHUNK_BYTES = 1 << 20

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads every input bit over the whole value."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = U64(pow(int(_BASE), -1, 2**64))
    out = []
    for base in (_BASE, inverse):
        table = np.full(size, base, U64)
        table[0] = 1
        out.append(np.cumprod(table, dtype=U64))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, for positions 0..n."""
    return _powers(1 << max(16, int(n).bit_length()))


class Prefix:
    """Hashes of any range of a sequence in constant time (polynomial modulo 2**64)."""

    def __init__(self, values: np.ndarray):
        power, self.inverse = powers(len(values))
        self.sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values * power[: len(values)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(U64) * U64(0xA0761D6478BD642F)
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + length)


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUES[data]


@dataclass
class Chunk:
    """Some whole documents: ``batch`` has their rows, text i is data[offsets[i]:offsets[i + 1]]."""

    batch: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray

    def column(self, name: str) -> np.ndarray:
        """A column of longs; missing values become NO_ID."""
        return self.batch.column(name).cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


@dataclass
class Words:
    """All words of a chunk: byte ranges, hashes, and each document's first word (and the end)."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def chunk_of(batch: pa.RecordBatch, column: str = "text") -> Chunk:
    """``column`` may name a field of a struct column (``row.text``)."""
    outer, _, field = column.partition(".")
    values = pc.struct_field(batch.column(outer), field) if field else batch.column(outer)
    values = values.cast(pa.large_string()) if pa.types.is_string(values.type) else values
    values = values.cast(pa.large_binary())
    values = values.fill_null(b"") if values.null_count else values  # this copies the texts
    if len(values) == 0:
        return Chunk(batch, np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Chunk(batch, data[offsets[0] : offsets[-1]], offsets - offsets[0])


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut record batches into runs of whole documents of about ``size`` bytes."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = chunk_of(batch, column).offsets[1:]
        row = 0
        while row < batch.num_rows:
            before = ends[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, before + size, "right")))
            yield chunk_of(batch.slice(row, stop - row), column)
            row = stop


def lowered(chunk: Chunk) -> Chunk:
    """The same texts with A-Z in lower case and all else as it is."""
    return Chunk(chunk.batch, _LOWER[chunk.data], chunk.offsets)


def words(chunk: Chunk, separator: np.ndarray = SEPARATOR) -> Words:
    """``separator`` says for each byte whether it stands between words."""
    data, offsets = chunk.data, chunk.offsets
    inside = ~separator[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(start, end, np.searchsorted(start, offsets), Prefix(byte_values(data)).hash(start, end))


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` values (runs that cross documents are the caller's to drop)."""
    if len(hashes) < size:
        return np.zeros(0, U64)
    start = np.arange(len(hashes) - size + 1)
    return Prefix(hashes).hash(start, start + size)


def inner(first: np.ndarray, size: int) -> np.ndarray:
    """Which runs of ``size`` stay inside one document: a mask over the starts 0..n - size."""
    total = int(first[-1])
    if total < size:
        return np.zeros(0, bool)
    document = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return document[: total - size + 1] == document[size - 1 :]


def unioned(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge ranges of each owner that overlap or touch; returned by owner and start."""
    if len(owner) == 0:
        return owner, start, end
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], end[order]
    # Shift each owner's ranges beyond those of the owner before, then a running maximum does.
    rank = np.concatenate([[0], np.cumsum(owner[1:] != owner[:-1])])
    step = int(end.max()) + 2
    reach = np.maximum.accumulate(end + rank * step)
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (start + rank * step)[1:] > reach[:-1]
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(owner)) - 1
    return owner[first], start[first], reach[last] - rank[first] * step


def wrapped(docs: DataFrame) -> DataFrame:
    """Whole rows in one struct column ``row``, so that no column of theirs can clash with those
    that an operator adds; ``select("row.*")`` gives them back."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def key_columns(text: str = "text", doc_id: str = "doc_id") -> dict[str, Column]:
    """``_id`` (doc_id, NO_ID if missing) and ``_copy`` (hash of the text, so rows that share an
    id but not a text stay apart)."""
    words_ = F.coalesce(F.col(text), F.lit(""))
    return {"_id": F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)), "_copy": F.xxhash64(words_)}


def keyed(docs: DataFrame) -> DataFrame:
    """Only what the pair operators need, under names of their own: the key columns and
    ``_text`` (missing: empty)."""
    return docs.select(*(c.alias(n) for n, c in key_columns().items()), F.coalesce(F.col("text"), F.lit("")).alias("_text"))


def real_id(column: str = "_id") -> Column:
    return F.when(F.col(column) != NO_ID, F.col(column)).alias("doc_id")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def learns(divisor: int, held_out: int) -> Column:
    """True for documents whose crc32 of the id as text isn't the held-out remainder."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor != held_out
