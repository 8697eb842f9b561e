"""Quality scores from a factorisation machine.

Features of a text: its words, hashed to buckets, as shares of all words; statistics of its
structure; and the table's own count of characters. With x the features and v their
k-dimensional factors, the score is

    sigmoid(b + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)),

so all pairwise interactions cost one pass over the features.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwarden.llm.host_rules import measured_chunk
from tillwarden.llm.samples import labelled_sample
from tillwarden.llm.text import U64, chunks, learns, words

STATISTICS = (
    "log_words", "word_length", "symbols", "repeats", "dup_lines", "capitals", "digits", "marks", "line_words",
    "distinct", "wide", "log_n_chars", "n_chars_off",
)


@dataclass(frozen=True)
class FmSettings:
    """bits: 2**bits word buckets. sample: most labelled documents to learn from."""

    bits: int = 12
    rank: int = 8
    sample: int = 6000
    epochs: int = 12
    batch: int = 64
    rate: float = 0.02
    decay: float = 1e-5
    seed: int = 7
    accept: float = 0.3


@dataclass(frozen=True)
class FmModel:
    """Factors of 2**bits word buckets, then of STATISTICS (standardised by center and scale)."""

    bits: int
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    center: np.ndarray
    scale: np.ndarray


def features(chunk, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, share of the words) of the word features, sorted, and the statistics."""
    data, offsets = chunk.data, chunk.offsets
    n = len(offsets) - 1
    w = words(chunk)
    document = np.repeat(np.arange(n), w.counts)
    key, times = np.unique((document << bits) | (w.hashes >> U64(64 - bits)).astype(np.int64), return_counts=True)
    owner = key >> bits
    share = times / np.maximum(w.counts, 1)[owner]

    m = measured_chunk(chunk)
    total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
    chars = np.maximum(total((data & 0xC0) != 0x80), 1)
    per_word, per_char = 1 / np.maximum(m["n_words"], 1), 1 / np.maximum(m["word_chars"], 1)
    lower = (data >= 0x61) & (data <= 0x7A)
    upper, digit = (data >= 0x41) & (data <= 0x5A), (data >= 0x30) & (data <= 0x39)
    lines = total(data == 0x0A) + 1
    marks = total((data > 0x20) & (data < 0x7F) & ~lower & ~upper & ~digit)
    distinct = np.bincount(owner, minlength=n)
    given = np.where(chunk.column("n_chars") < 2**62, chunk.column("n_chars"), chars).clip(0)
    stats = np.stack(
        [
            np.log1p(m["n_words"]), m["word_chars"] * per_word, m["n_symbols"] * per_char, m["n_repeat_words"] * per_word,
            m["n_dup_lines"] / lines, total(upper) * per_char, total(digit) * per_char, marks * per_char,
            np.log1p(m["n_words"] / lines), distinct / np.sqrt(np.maximum(m["n_words"], 1)), total(data >= 0x80) * per_char,
            np.log1p(given), np.log1p(np.abs(given - np.where(chars > 1, chars, given))),
        ],
        axis=1,
    )
    return owner, key & ((1 << bits) - 1), share, stats


def _rows(docs: DataFrame) -> DataFrame:
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.withColumn("n_chars", n_chars)


def fit(docs: DataFrame, labels: DataFrame, settings: FmSettings) -> FmModel:
    """Learn from at most ``settings.sample`` labelled documents outside the held-out fifth.

    Their features (never texts) come to the driver: at most ``sample`` * 2**bits numbers.
    """
    bits = settings.bits

    def extract(batches):
        for chunk in chunks(batches):
            owner, bucket, share, stats = features(chunk, bits)
            cuts = np.searchsorted(owner, np.arange(len(chunk.offsets))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.batch.column("doc_id"),
                    chunk.batch.column("label"),
                    pa.ListArray.from_arrays(cuts, pa.array(bucket, pa.int32())),
                    pa.ListArray.from_arrays(cuts, pa.array(share, pa.float32())),
                    pa.array(list(stats), pa.list_(pa.float64())),
                ],
                ["doc_id", "label", "bucket", "share", "stats"],
            )

    rows = _rows(docs).select("doc_id", "text", "n_chars")
    sample = labelled_sample(rows, labels, "quality", learns(5, 0), settings.sample)
    sample = sample.withColumn("label", F.col("label").cast("double"))
    schema = "doc_id long, label double, bucket array<int>, share array<float>, stats array<double>"
    got = sample.mapInArrow(extract, schema).toArrow().combine_chunks().sort_by("doc_id")
    y = (got["label"].to_numpy() > 0).astype(np.float32)
    stats = np.array(got["stats"].to_pylist()).reshape(len(y), len(STATISTICS))
    center = stats.mean(0) if len(y) else np.zeros(len(STATISTICS))
    scale = np.maximum(stats.std(0), 1e-3) if len(y) else np.ones(len(STATISTICS))
    stats = ((stats - center) / scale).clip(-4, 4)
    buckets, shares = ([np.asarray(x.values) for x in got[c]] for c in ("bucket", "share"))

    rng = np.random.default_rng(settings.seed)
    width = (1 << bits) + len(STATISTICS)
    theta = [np.zeros(1, np.float32), np.zeros(width, np.float32), rng.normal(0, 0.05, (width, settings.rank)).astype(np.float32)]
    first, second = ([np.zeros_like(p) for p in theta] for _ in range(2))
    step = 0
    for _ in range(settings.epochs if len(y) else 0):
        order = rng.permutation(len(y))
        for at in range(0, len(y), settings.batch):
            some = order[at : at + settings.batch]
            x = np.zeros((len(some), width), np.float32)
            for row, i in enumerate(some):
                x[row, buckets[i]] = shares[i]
            x[:, 1 << bits :] = stats[some]
            bias, linear, factors = theta
            sums = x @ factors
            z = bias + x @ linear + 0.5 * ((sums**2).sum(1) - (x**2) @ (factors**2).sum(1))
            g = ((1 / (1 + np.exp(-z.clip(-30, 30))) - y[some]) / len(some)).astype(np.float32)
            grads = [
                g.sum(keepdims=True),
                x.T @ g + settings.decay * linear,
                x.T @ (g[:, None] * sums) - factors * ((x**2).T @ g)[:, None] + settings.decay * factors,
            ]
            step += 1
            for p, d, a, b in zip(theta, grads, first, second, strict=True):
                a += 0.1 * (d - a)
                b += 0.001 * (d * d - b)
                p -= settings.rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-6)
    return FmModel(bits, float(theta[0][0]), theta[1], theta[2], center, scale)


def raw_scores(model: FmModel, chunk) -> np.ndarray:
    owner, bucket, share, stats = features(chunk, model.bits)
    n, base = len(chunk.offsets) - 1, 1 << model.bits
    stats = ((stats - model.center) / model.scale).clip(-4, 4)
    cuts = np.searchsorted(owner, np.arange(n + 1))
    total = lambda v: np.diff(np.concatenate([np.zeros((1, v.shape[1])), np.cumsum(v, 0, dtype=np.float64)])[cuts], axis=0)
    v, w = model.factors, model.linear
    x = share[:, None]
    sums = total(v[bucket] * x) + stats @ v[base:]
    squares = total((v**2).sum(1)[bucket, None] * x**2)[:, 0] + (stats**2) @ (v[base:] ** 2).sum(1)
    return model.bias + total(w[bucket, None] * x)[:, 0] + stats @ w[base:] + 0.5 * ((sums**2).sum(1) - squares)


def scored(docs: DataFrame, model: FmModel, accept: float = 0.3) -> DataFrame:
    """doc_id, score (0 to 1, higher: quality 1 likelier), predicted (score >= accept) per row.

    Missing and empty texts are scored by their statistics alone; a missing n_chars is counted.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits rows, whatever the corpus

    def score(batches):
        for chunk in chunks(batches):
            p = 1 / (1 + np.exp(-raw_scores(sent.value, chunk).clip(-30, 30)))
            yield pa.RecordBatch.from_arrays(
                [chunk.batch.column("doc_id"), pa.array(p), pa.array((p >= accept).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    rows = _rows(docs).select(F.col("doc_id").cast("long"), "text", "n_chars")
    return rows.mapInArrow(score, "doc_id long, score double, predicted int")
