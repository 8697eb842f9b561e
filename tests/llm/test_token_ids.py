"""Ids of the word encoder against the library, on whole texts."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillwarden.llm import token_files
from tillwarden.llm.text import chunk_of
from tillwarden.llm.word_encoder import KEPT_BYTES, WordEncoder, _ids

WORDS = public_tokenizers.path("word_bpe_49k.json")
MARKS = ".,;:!?'-\""


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def ours(texts):
    chunk = chunk_of(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"]))
    encoder = WordEncoder(WORDS)
    ids, first = encoder(chunk)
    assert encoder.lengths(chunk).tolist() == np.diff(first).tolist()
    return [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]


def same(library, texts):
    mine, theirs = ours(texts), library.encode_batch(texts, add_special_tokens=False)
    for text, a, b in zip(texts, mine, theirs, strict=True):
        assert a == b.ids, ascii(text[:80])


@pytest.mark.parametrize("part", range(4))
def test_every_code_point_before_and_after_every_mark(library, part):
    # Of the two large blocks of letters that are all alike, every seventh.
    alike = lambda c: (0x4E00 <= c < 0xA000 or 0xAC00 <= c < 0xD7A4) and c % 7
    points = [chr(c) for c in range(part * 0x5000, (part + 1) * 0x5000) if not 0xD800 <= c < 0xE000 and not alike(c)]
    if part == 3:
        points += [chr(c) for c in [*range(0x14000, 0x20000, 5), *range(0x20000, 0x30000, 41), *range(0xE0000, 0xE0200)]]
    same(library, [" ".join(w for m in MARKS for w in (c + m, m + c, "a" + c + m)) for c in points])


def test_words_of_latin_letters(library):
    """All letters that are taken as such, alone and side by side, and long words of them."""
    dice = random.Random(2)
    letters = [chr(c) for c in [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x250)]]
    words = letters + [a + b for a in letters for b in dice.sample(letters, 40)]
    words += ["".join(dice.choices(letters, k=dice.randrange(3, 25))) for _ in range(20_000)]
    words += ["".join(dice.choices("aeinrst", k=dice.randrange(2, 60))) for _ in range(20_000)]
    same(library, [" ".join(words[k : k + 500]) for k in range(0, len(words), 500)])


def test_random_strings(library):
    dice = random.Random(1)
    alphabets = ["abcXYZ019.,;:!?'", "İıſßΣςÅÀé́̇क़ְ.;!", "日本한国あ。、.,", "<|endoftext|>startof ", "‍ \u0085 　\x1c﻿.a"]
    texts = []
    for n in range(100_000):
        alphabet = alphabets[n % 5] if n % 7 else "".join(alphabets)
        texts.append("".join(dice.choices(alphabet, k=dice.randrange(1, 9))))
    same(library, texts)
    for blank in (" ", "\n", "\t", "\x0b", "\x0c", "\r", " \r\n "):
        same(library, [blank.join(texts[k : k + 400]) + blank for k in range(0, 40_000, 400)])


def test_long_words_and_texts(library):
    long = ["a" * (KEPT_BYTES - 1), "a" * KEPT_BYTES, "a" * (KEPT_BYTES + 1), "Ab." * 300, "日" * 500, "x" * 5000 + "."]
    same(library, [" ".join(long), *long, "", " ", " ".join(["so it goes,"] * 200_000)])
    assert not any(len(w) > KEPT_BYTES for w in _ids(WORDS))


def test_no_texts():
    assert ours([None, "", None]) == [[], [], []]


def test_starts_with_several_files_to_a_task(spark, tmp_path):
    rows = [(k, "word " * (k % 5)) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "7")
    try:
        token_files.write(docs, f"{tmp_path}/ids", WORDS)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    got = token_files.digest(spark, f"{tmp_path}/ids").orderBy(F.col("doc_id")).collect()
    start = 0
    for r in got:
        assert (r["start"], r["n_tokens"]) == (start, r["doc_id"] % 5 + 1)
        start += r["n_tokens"]
    assert len(got) == 300
