"""The named queries of this package; each takes (spark, sf_dir) and covers whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwarden.llm import automata, collocations, decontaminate, hamming_index, host_rules, jaccard_join, language, piece_sampling, quality_fm, ranked_search, suffix_levels, token_files, token_lengths
from tillwarden.llm.check_sql import COLLOCATIONS, HOST_RULES, RANKED_SEARCH
from tillwarden.llm.text import learns, table
from tillwarden.session import new_run_dir

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text: doc_id, held_out, score, predicted."""
    docs, settings = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars"), quality_fm.FmSettings()
    model = quality_fm.fit(docs, table(spark, sf_dir, "labels"), settings)
    scores = quality_fm.scored(docs, model, settings.accept)
    return scores.select("doc_id", F.coalesce(~learns(5, 0), F.lit(False)).alias("held_out"), "score", "predicted")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids written to Parquet lists and read back: doc_id, start, n_tokens, ids_crc32."""
    path = new_run_dir(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, TOKENIZER)
    return token_files.digest(spark, path)


def op3_suffix_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without strings of 400 bytes that start elsewhere too: doc_id, n_bytes,
    n_removed, n_spans, kept_sha256."""
    return suffix_levels.digest(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, shares and truncated totals for every length that occurs as a context limit."""
    lengths = token_lengths.document_lengths(table(spark, sf_dir, "documents"), TOKENIZER)
    return token_lengths.limits(token_lengths.histogram(lengths))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text: doc_id, held_out, lang_pred, score, rejected."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs, language.LanguageSettings())
    found = language.predicted(docs, model)
    return found.select("doc_id", F.coalesce(~learns(4, 2), F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op6_suffix_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without runs of 13 words of earlier ones: doc_id, n_words, n_removed, kept_sha256."""
    return automata.digest(table(spark, sf_dir, "documents"))


def op7_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every whole text and its decoding: doc_id, n_tokens, ids_crc32, lossless."""
    return piece_sampling.checked(table(spark, sf_dir, "documents"), PIECES)


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdicts of every document; its host is its source."""
    return host_rules.judged(table(spark, sf_dir, "documents")).select("doc_id", *host_rules.MEASURES, "base_failed", "host_kept", "kept")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of five-word shingles at 0.8: doc_id, class_id, n_links, keeper."""
    return jaccard_join.joined(table(spark, sf_dir, "documents")).drop("_id", "_copy")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in every document: doc_id, contaminated, n_items, item_ids, best_similarity."""
    return decontaminate.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    return collocations.mined(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for each benchmark item: item_id, rank, doc_id, score."""
    return ranked_search.searched(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_hamming_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every vector whose id is divisible by 100: query_id, rank, vec_id, score."""
    vectors = table(spark, sf_dir, "embeddings")
    return hamming_index.neighbours(vectors, vectors.where("vec_id % 100 = 0"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_fm,
        op2_token_files,
        op3_suffix_levels,
        op4_token_counts,
        op5_language_id,
        op6_suffix_automata,
        op7_piece_sampling,
        op8_host_rules,
        op9_jaccard_join,
        op10_decontamination,
        op11_collocations,
        op12_ranked_search,
        op13_hamming_index,
    )
}
SQL: dict[str, str] = {"op8_host_rules": HOST_RULES, "op11_collocations": COLLOCATIONS, "op12_ranked_search": RANKED_SEARCH}
