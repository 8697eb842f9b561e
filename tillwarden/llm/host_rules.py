"""Quality rules of documents, judged again by host.

Each document is measured and tested by simple rules. Failures are counted by host; a host's
rate is shrunk towards the rate of all hosts by a beta prior fitted to the hosts themselves, so
a host with few documents is not condemned by chance. Hosts whose shrunken rate is too high
take their documents with them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tillwarden.llm.text import SEPARATOR, U64, Prefix, byte_values, chunks, grams, inner, mix, words
from tillwarden.session import materialise

SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class HostRules:
    """min_words, max_repeat_percent: a document fails below the one or above the other.
    max_host_rate: a host fails if its shrunken failure rate is above. top_strength: bound of
    the fitted prior's weight in documents (hosts that don't differ give an infinite one)."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_host_rate: float = 0.5
    top_strength: float = 10_000.0


def _in_document(values: np.ndarray, document: np.ndarray) -> np.ndarray:
    """Hashes made distinct by document, so that equal ones count within a text only."""
    return mix(values ^ mix(document.astype(U64) + U64(1)))


def measured_chunk(chunk) -> dict[str, np.ndarray]:
    """MEASURES of each text of a chunk."""
    data, offsets = chunk.data, chunk.offsets
    n = len(offsets) - 1
    w = words(chunk)
    total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    out = {"n_words": w.counts, "word_chars": total(~SEPARATOR[data] & ((data & 0xC0) != 0x80)), "n_symbols": total(symbol[data])}

    newline = np.flatnonzero(data == 0x0A)
    full = offsets[:-1] < offsets[1:]
    start = np.unique(np.concatenate([offsets[:-1][full], newline[newline + 1 < len(data)] + 1]))
    if len(start):
        end = np.append(start[1:], len(data))
        end = end - (data[end - 1] == 0x0A)
        held = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
        start, end = start[held], end[held]
    line_of = np.searchsorted(offsets, start, "right") - 1
    key = _in_document(Prefix(byte_values(data)).hash(start, end), line_of)
    _, first = np.unique(key, return_index=True)
    out["n_dup_lines"] = np.bincount(line_of, minlength=n) - np.bincount(line_of[first], minlength=n)

    document = np.repeat(np.arange(n), w.counts)
    key = _in_document(grams(w.hashes, 3), document[: max(0, len(document) - 2)])
    at = np.flatnonzero(inner(w.first, 3))
    _, where, times = np.unique(key[at], return_inverse=True, return_counts=True)
    covered = np.zeros(len(document) + 1, bool)
    for shift in range(3):
        covered[at[times[where] > 1] + shift] = True
    out["n_repeat_words"] = np.bincount(document[covered[:-1]], minlength=n)
    return out


def measured(docs: DataFrame, host: Column) -> DataFrame:
    """doc_id, host and MEASURES of every whole text; a missing text is empty, a missing host ''."""

    def measure(batches):
        for chunk in chunks(batches):
            found = measured_chunk(chunk)
            kept = [chunk.batch.column(c) for c in ("doc_id", "host")]
            yield pa.RecordBatch.from_arrays(
                [*kept, *(pa.array(found[m].astype(np.int64)) for m in MEASURES)], ["doc_id", "host", *MEASURES]
            )

    picked = docs.select(F.col("doc_id").cast("long"), F.coalesce(host.cast("string"), F.lit("")).alias("host"), "text")
    return picked.mapInArrow(measure, "doc_id long, host string, " + ", ".join(f"{m} long" for m in MEASURES))


def failed(rules: HostRules) -> Column:
    repeats = F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent
    return (F.col("n_words") < rules.min_words) | repeats


def host_verdicts(documents: DataFrame, rules: HostRules) -> DataFrame:
    """host, n_docs, n_failed, host_rate (shrunken), host_kept from rows of (host, base_failed).

    The prior is Beta(m k, (1 - m) k): m is the mean of the hosts' rates, k follows from their
    variance (m (1 - m) / v - 1), kept within 1 and ``top_strength``. One row, the mean and
    the variance, goes to the driver.
    """
    hosts = documents.groupBy("host").agg(F.count("*").alias("n_docs"), F.count_if("base_failed").alias("n_failed"))
    hosts = materialise(hosts)  # read twice
    rate = F.col("n_failed") / F.col("n_docs")
    fit = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v")).first()
    mean, spread = fit["m"] or 0.0, fit["v"] or 0.0
    strength = max(1.0, min(rules.top_strength, mean * (1 - mean) / spread - 1)) if spread > 0 else rules.top_strength
    shrunk = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    rated = hosts.withColumn("host_rate", shrunk)
    return rated.select("host", "n_docs", "n_failed", "host_rate", (F.col("host_rate") <= rules.max_host_rate).alias("host_kept"))


def _with_verdicts(rows: DataFrame, rules: HostRules, salts: int, key: list[str]) -> DataFrame:
    """rows (host, base_failed, ...) with host_rate, host_kept and kept. In the join each host
    stands ``salts`` times, so the documents of one large host spread over tasks."""
    verdicts = host_verdicts(rows, rules).select("host", "host_rate", "host_kept")
    verdicts = verdicts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.hash(*key), F.lit(salts)))
    return salted.join(verdicts, ["host", "_salt"]).drop("_salt").withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))


def judged(docs: DataFrame, host: Column | None = None, rules: HostRules | None = None, salts: int = 16) -> DataFrame:
    """doc_id, host, MEASURES, base_failed, host_rate, host_kept, kept: one row per document.

    ``host`` defaults to the column ``source``. Measures are written once and read twice.
    Missing and empty texts have no words and fail; repeated rows each count; an empty table
    gives an empty result.
    """
    rules = rules or HostRules()
    rows = measured(docs, F.col("source") if host is None else host)
    rows = materialise(rows.withColumn("base_failed", failed(rules)))
    return _with_verdicts(rows, rules, salts, ["doc_id", *MEASURES])


def kept(docs: DataFrame, host: Column | None = None, rules: HostRules | None = None, salts: int = 16) -> DataFrame:
    """The rows of ``docs`` whose verdict is kept, unchanged. Texts are measured once for the
    hosts and once for themselves, which costs less than writing them down in between; they
    stay where they are, and the few verdicts of hosts come to them."""
    rules = rules or HostRules()
    own = F.coalesce((F.col("source") if host is None else host).cast("string"), F.lit(""))
    held = docs.select(own.alias("host"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    schema = StructType([*held.schema.fields, *(StructField(m, LongType()) for m in MEASURES)])

    def measure(batches):
        for chunk in chunks(batches, "row.text"):
            found = measured_chunk(chunk)
            columns = [*chunk.batch.columns, *(pa.array(found[m].astype(np.int64)) for m in MEASURES)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    rows = held.mapInArrow(measure, schema).select("host", "row", failed(rules).alias("base_failed"))
    tested = measured(docs, own).select("host", failed(rules).alias("base_failed"))
    # Written, so that its size is known, and texts need no shuffle where it is small.
    verdicts = materialise(host_verdicts(tested, rules).filter("host_kept"))
    verdicts = verdicts.select("host", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    salted = rows.filter("NOT base_failed").withColumn("salt", F.pmod(F.xxhash64("row.doc_id", "row.text"), F.lit(salts)).cast("int"))
    return salted.join(verdicts, ["host", "salt"], "left_semi").select("row.*")
