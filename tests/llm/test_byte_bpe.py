"""Byte-level BPE: against the rank library, an exact round trip, offsets, odd rows."""

import hashlib
import sys

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from ratecraft.llm import byte_bpe
from ratecraft.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return byte_bpe.ByteTokenizer(PATH)


def digest(reference, text):
    ids = reference.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_pattern_is_the_public_one():
    assert byte_bpe.PATTERN == public_tokenizers.PATTERN and len(set(byte_bpe.byte_characters())) == 256


def test_query_as_the_rank_library(spark, reference):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted((r.doc_id, *digest(reference, r.text)) for r in docs.collect())
    assert sorted(map(tuple, QUERIES["op13_byte_bpe"](spark, SF).collect())) == want


def test_every_character(reference, tokenizer):
    characters = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}b {c}1!{c}" for c in characters[i:i + 500]) for i in range(0, len(characters), 500)]
    for text, (ids,) in zip(texts, tokenizer.encode(texts, offsets=False), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text)
        assert tokenizer.decode(ids).tobytes() == text.encode()


def test_random_and_long_texts(reference, tokenizer):
    rng = np.random.default_rng(5)
    alphabet = list("aaaabbc'stred  \n\t\r.,!1234ßéİ字。，​ \x85\x1ć𝒳😀") + ["<|endoftext|>"]
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 60))) for _ in range(4000)]
    texts += ["word and 字。字\n\n  more " * 60_000, "a" * 300_000, "字" * 5000 + "。" + "é" * 300_000, " " * 400_000, "\n \t" * 200_000 + "x"]
    for text, (ids,) in zip(texts, tokenizer.encode(texts, offsets=False), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text), text[:80]
    assert len(byte_bpe.cut(texts[4000])) > 3 and "".join(p for _, p in byte_bpe.cut(texts[4000])) == texts[4000]


def test_offsets_and_split_characters(spark, reference):
    texts = ["naïve 😀 text", "𝒳y", "x" * 10, None, "word 😀 " * 60_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = byte_bpe.encode(docs)
    back = {r.doc_id: r for r in byte_bpe.decode(coded, pieces=True).collect()}
    for r in coded.collect():
        text = texts[r.doc_id] or ""
        assert r.ids == reference.encode_ordinary(text) and len(r.starts) == len(r.ids) == len(r.ends)
        for i, a, b in zip(r.ids, r.starts, r.ends):
            piece = reference.decode_single_token_bytes(i)
            # a token lies within the characters at its place, whole if it splits none
            assert piece in text[a:b].encode()
        covered = sorted(set(zip(r.starts, r.ends)))
        assert not covered or (covered[0][0] == 0 and covered[-1][1] == len(text) and all(y[0] <= x[1] for x, y in zip(covered, covered[1:])))
        assert back[r.doc_id].text == text == "".join(back[r.doc_id].pieces) and len(back[r.doc_id].pieces) == len(r.ids)
    split = back[1]
    assert split.pieces[0] == "" and "𝒳" in split.pieces


def test_decoding_parts_and_unknown_ids(spark, reference):
    ids = reference.encode_ordinary("𝒳y")
    rows = [(1, ids[:1]), (2, ids[1:]), (3, [50256, -1, 10**6, *ids]), (4, []), (None, None), (6, [None, ids[0]])]
    got = {r.doc_id: r for r in byte_bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>")).collect()}
    assert bytes(got[1].decoded) + bytes(got[2].decoded) == "𝒳y".encode() and "�" in got[1].text and got[1].n_unknown == 0
    assert (got[3].n_unknown, got[3].text, got[4].text, got[None].text, got[6].n_unknown) == (3, "𝒳y", "", "", 1)


def test_odd_rows(spark, reference):
    rows = [(1, None), (2, ""), (None, "no id"), (3, "twice"), (3, "twice"), (4, "<|endoftext|>"), (5, "w " * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("ids", "decoded", "n_tokens", "starts")})
    got = sorted(map(tuple, byte_bpe.round_trip_digest(df).collect()), key=repr)
    assert got == sorted(((i, *digest(reference, t)) for i, t in rows), key=repr)
    assert byte_bpe.round_trip_digest(df.where("false")).count() == 0
    broken = spark.range(1).select(F.col("id").alias("doc_id"), F.expr("cast(X'61FF62' as string)").alias("text"))
    assert byte_bpe.round_trip_digest(broken).first().n_tokens == len(reference.encode_ordinary("a�b"))
