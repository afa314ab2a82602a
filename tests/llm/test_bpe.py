"""BPE against the tokenizers library, text by text."""

import hashlib
import sys

import numpy as np
import pytest

from barlake.llm import bpe

PATH = bpe.vocabulary_path()
TEXTS = ["", "   ", None, "a  b", "a\n b\n\nc", "x <|endoftext|> y<|endoftext|>", "tab\t b  \n  c", "日本語 テスト 🙂 🙂🙂",
         "I'll don't 'S 're", "é x", " lead", "trail ", "\n", "\r\n a\r\nb", "a" * 5000, "\x00 \x00x", "a 　b \xa0 c",
         "﻿x ﻿y", "\x85 a\x1c b \x1f", "word " * 4000, "𝔘𝔫𝔦 𝟙𝟚 ​ z"]


def expected(text):
    t = bpe.load_tokenizer(PATH)
    ids = t.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), \
        hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_round_trip_equals_library(spark):
    rows = [*enumerate(TEXTS), (3, "a  b"), (None, "null id")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, part string").repartition(3)
    got = sorted((tuple(r) for r in bpe.encode_and_decode(df, PATH).collect()), key=str)
    assert got == sorted(((i, *expected(t)) for i, t in rows), key=str)


def test_cut_is_safe_before_and_after_every_character(spark):
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    step = 4000
    rows = [(i, "".join(f"a {chr(c)}b\n{chr(c)} c\n " for c in points[i:i + step])) for i in range(0, len(points), step)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r.doc_id: list(r.ids) for r in bpe.encode(df, PATH).collect()}
    t = bpe.load_tokenizer(PATH)
    for i, text in rows:
        assert got[i] == t.encode(text, add_special_tokens=False).ids, i


def test_other_columns_pass_through_and_clashes_raise(spark):
    df = spark.createDataFrame([(1, "a b", None, 2.5, [1, 2])], "doc_id long, text string, block string, part double, data array<int>")
    r = bpe.encode(df, PATH).collect()[0]
    assert (r.block, r.part, r.data, list(r.ids)) == (None, 2.5, [1, 2], bpe.load_tokenizer(PATH).encode("a b").ids)
    with pytest.raises(ValueError):
        bpe.encode(df, PATH, out="part")


def test_very_long_texts(spark):
    """Two million characters of words of their own, and one word of 60,000."""
    rows = [(1, " ".join(f"word{i}" for i in range(200_000))), (2, "ab" * 30_000), (3, " " * 100_000 + "x")]
    got = sorted(tuple(r) for r in bpe.encode_and_decode(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect())
    assert got == [(i, *expected(t)) for i, t in rows]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_and_decode(df, PATH).collect() == []


def test_decode_invalid_utf8_and_null(spark):
    t = bpe.load_tokenizer(PATH)
    whole = t.encode("🙂é", add_special_tokens=False).ids
    rows = [(1, whole[:1]), (2, whole[::-1]), (3, None), (4, [])]
    got = {r.k: r.text for r in bpe.decode(spark.createDataFrame(rows, "k long, ids array<int>"), PATH).collect()}
    assert got == {1: t.decode(whole[:1], skip_special_tokens=False), 2: t.decode(whole[::-1], skip_special_tokens=False), 3: None, 4: ""}
