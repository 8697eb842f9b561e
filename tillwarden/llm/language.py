"""Language of a text from averaged subword embeddings.

Every run of 2 to 4 bytes that has no separator inside is a subword, hashed to a bucket with an
embedding; a text is the mean of its embeddings, a linear softmax gives the languages. Both
layers are learned by stochastic gradient descent. The softmax is linear in the embeddings, so
for scoring they are multiplied out once: a text's logits are the mean of one row per subword.

A temperature fitted on documents kept from the training makes the scores probabilities, and
the rejection threshold is the least score at which those documents' error is within a bound.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwarden.llm.samples import labelled_sample
from tillwarden.llm.text import SEPARATOR, chunks, learns

UNKNOWN = "und"
_FACTORS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[SEPARATOR] = 0x20
_LOWER[0x41:0x5B] += 0x20


@dataclass(frozen=True)
class LanguageSettings:
    """bits: 2**bits buckets. sample: most documents to learn from; every ``calibrate``-th of
    them only fits the temperature and the rejection threshold. steps: batches to learn from,
    whatever the size of the sample."""

    bits: int = 13
    dimensions: int = 16
    sample: int = 4000
    steps: int = 900
    batch: int = 32
    rate: float = 0.5
    calibrate: int = 5
    top_error: float = 0.01
    seed: int = 11


@dataclass(frozen=True)
class LanguageModel:
    """table: logits of each bucket's embedding, one column per language."""

    bits: int
    languages: tuple[str, ...]
    table: np.ndarray
    offset: np.ndarray
    temperature: float
    reject_below: float


def subwords(chunk, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each size: buckets of all subwords, and where each document's begin (and the end)."""
    n = len(chunk.offsets) - 1
    # One separator before each document and after the last: subwords at the edges of words
    # have one, and none can cross documents.
    at = chunk.offsets + np.arange(n + 1)
    data = np.full(len(chunk.data) + n + 1, 0x20, np.uint8)
    inside = np.ones(len(data), bool)
    inside[at] = False
    data[inside] = _LOWER[chunk.data]
    accented = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1
    data[accented] += 0x20
    gap = data == 0x20
    value = data.astype(np.uint32) + np.uint32(1)
    found = []
    for size in (2, 3, 4):
        m = max(0, len(data) - size + 1)
        good = ~(gap[:m] & gap[1 : 1 + m])
        mixed = np.full(m, 0x165667B1 * size & 0xFFFFFFFF, np.uint32)
        for k in range(size):
            mixed += value[k : k + m] * _FACTORS[k]
            mixed ^= mixed >> np.uint32(15)
            if 0 < k < size - 1:
                good &= ~gap[k : k + m]
        place = np.flatnonzero(good)
        bucket = (mixed[place] * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
        found.append((bucket.astype(np.int64), np.searchsorted(place, at)))
    return found


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[np.ndarray], shares: list[np.ndarray], names: list[str], settings: LanguageSettings) -> LanguageModel:
    """rows: buckets of each document; shares: their shares of its subwords."""
    languages = tuple(sorted(set(names)))
    if not languages:
        return LanguageModel(settings.bits, (UNKNOWN,), np.zeros((1 << settings.bits, 1), np.float32), np.zeros(1, np.float32), 1.0, 0.0)
    y = np.array([languages.index(x) for x in names])
    rng = np.random.default_rng(settings.seed)
    width, classes = 1 << settings.bits, len(languages)
    embed = rng.normal(0, 0.1, (width, settings.dimensions)).astype(np.float32)
    out = rng.normal(0, 0.1, (settings.dimensions, classes)).astype(np.float32)
    offset = np.zeros(classes, np.float32)

    def dense(some):
        x = np.zeros((len(some), width), np.float32)
        for k, i in enumerate(some):
            x[k, rows[i]] = shares[i]
        return x

    every = np.arange(len(y))
    kept = every % settings.calibrate == 0 if len(y) >= 10 * settings.calibrate else np.zeros(len(y), bool)
    learn = every[~kept]
    order = learn[:0]
    for step in range(settings.steps):
        rate = settings.rate * (1 - step / settings.steps)
        if not len(order):
            order = rng.permutation(learn)
        some, order = order[: settings.batch], order[settings.batch :]
        x = dense(some)
        hidden = x @ embed
        g = _softmax(hidden @ out + offset)
        g[np.arange(len(some)), y[some]] -= 1
        g /= len(some)
        down = g @ out.T
        out -= rate * (hidden.T @ g)
        offset -= rate * g.sum(0)
        # A bucket's gradient carries its small share, so embeddings take larger steps.
        embed -= rate * 200 * (x.T @ down)
    table = embed @ out
    test = every[kept] if kept.any() else learn
    logits = np.array([shares[i] @ table[rows[i]] for i in test]).reshape(len(test), classes) + offset
    grid = np.geomspace(0.05, 20, 60)
    losses = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(test)), y[test]], 1e-12)).mean() for t in grid]
    temperature = float(grid[int(np.argmin(losses))])
    p = _softmax(logits / temperature)
    score, right = p.max(1), p.argmax(1) == y[test]
    order = np.argsort(-score)
    errors = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(errors <= settings.top_error)
    reject_below = float(score[order][good[-1]]) if len(good) else 1.0
    return LanguageModel(settings.bits, languages, table.astype(np.float32), offset, temperature, reject_below)


def fit(docs: DataFrame, settings: LanguageSettings) -> LanguageModel:
    """Learn from at most ``settings.sample`` documents with a language outside the held-out
    quarter. Their bucket shares (never texts) come to the driver."""
    bits = settings.bits

    def extract(batches):
        for chunk in chunks(batches):
            sizes = subwords(chunk, bits)
            own = [np.concatenate([bucket[cuts[i] : cuts[i + 1]] for bucket, cuts in sizes]) for i in range(chunk.batch.num_rows)]
            counted = [np.unique(x, return_counts=True) for x in own]
            ends = np.concatenate([[0], np.cumsum([len(b) for b, _ in counted])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.batch.column("doc_id"),
                    chunk.batch.column("label"),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate([b for b, _ in counted]), pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate([c / c.sum() for _, c in counted]), pa.float32())),
                ],
                ["doc_id", "label", "bucket", "share"],
            )

    sample = labelled_sample(docs.select("doc_id", "text"), docs, "lang", learns(4, 2), settings.sample)
    got = sample.mapInArrow(extract, "doc_id long, label string, bucket array<int>, share array<float>")
    got = got.toArrow().combine_chunks().sort_by("doc_id")
    rows, shares = ([np.asarray(x.values) for x in got[c]] for c in ("bucket", "share"))
    full = [i for i, r in enumerate(rows) if len(r)]
    names = got["label"].to_pylist()
    return train([rows[i] for i in full], [shares[i] for i in full], [names[i] for i in full], settings)


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def predicted(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score, rejected per row. A missing text or one without a letter is
    ``und`` with score 0 and rejected; other texts get the likeliest language, its calibrated
    probability, and whether that is below the rejection threshold."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits rows, whatever the corpus

    def predict(batches):
        m = sent.value
        for chunk in chunks(batches):
            total, count = np.zeros((chunk.batch.num_rows, len(m.languages))), np.zeros(chunk.batch.num_rows)
            for bucket, cuts in subwords(chunk, m.bits):
                sums = np.concatenate([np.zeros((1, len(m.languages))), np.cumsum(m.table[bucket], axis=0, dtype=np.float64)])
                total += np.diff(sums[cuts], axis=0)
                count += np.diff(cuts)
            logits = total / np.maximum(count, 1)[:, None] + m.offset
            p = _softmax(logits / m.temperature)
            letters = np.concatenate([[0], np.cumsum(((chunk.data | 0x20) >= 0x61) & ((chunk.data | 0x20) <= 0x7A))])
            known = np.diff(letters[chunk.offsets]) > 0
            for i in np.flatnonzero(~known):
                known[i] = _has_letter(chunk.bytes_of(i))
            score = np.where(known, p.max(1), 0.0)
            best = p.argmax(1)
            names = [m.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [chunk.batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(~known | (score < m.reject_below))],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double, rejected boolean")
