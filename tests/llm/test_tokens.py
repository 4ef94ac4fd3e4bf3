"""Byte-level BPE against the tiktoken library and its own inverse."""

import hashlib

import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from runlens.llm import byte_bpe, queries

from .helpers import DATA, docs


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(queries.RANKS)


@pytest.fixture(scope="module")
def codec(ranks):
    vocabulary, merges = byte_bpe.model_parts(ranks)
    return byte_bpe.Codec(ranks, merges, vocabulary, queries.PATTERN)


@pytest.fixture(scope="module")
def plain(ranks):
    return tiktoken.Encoding("plain", pat_str=queries.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXT = st.one_of(st.text(max_size=60), st.lists(st.sampled_from(
    ["a", " ", "  ", "\n", "\t", " ", "　", "'s", "'LL", "12", "é", "中", "🙂", "!?", "the", " the", "\x1c", "​", "<|endoftext|>"]),
    max_size=25).map("".join))


@settings(max_examples=400, deadline=None)
@given(text=TEXT)
def test_ids_digests_and_inverse(codec, plain, text):
    ids = plain.encode_ordinary(text)
    raw = text.encode()
    assert codec.ids(text) == ids
    assert codec.decode(ids) == text
    assert codec.digests(text) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                                   hashlib.sha256(raw).hexdigest())
    with_ranges, ranges = codec.ids_and_offsets(text)
    assert with_ranges == ids and b"".join(raw[a:b] for a, b in ranges) == raw
    assert [raw[a:b] for a, b in ranges] == [codec.bytes_of[i] for i in ids]


@settings(max_examples=300, deadline=None)
@given(text=TEXT)
def test_cuts_at_spaces_are_between_matches(codec, text):
    pattern = regex.compile(queries.PATTERN)
    assert [m for piece in codec.split(text) for m in pattern.findall(piece)] == pattern.findall(text)


def test_remembered_pieces_are_bounded(codec, plain, monkeypatch):
    codec.pieces.clear()
    codec.words.clear()
    monkeypatch.setattr(codec, "held", 0)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 4 * byte_bpe.ENTRY)
    text = "a few words that are more than three, a few words"
    for _ in range(3):
        assert codec.digests(text)[0] == len(plain.encode_ordinary(text))
        assert len(codec.pieces) <= 3 and len(codec.words) <= 3


def test_split_characters_and_unknown_ids(codec, plain):
    ids = plain.encode_ordinary("🙂")
    assert len(ids) > 1
    assert codec.decode(ids[:1]).startswith("�") and codec.decode([]) == "" and codec.decode(None) is None
    assert codec.decode([50256, *ids]) == "🙂"


def test_every_vocabulary(ranks):
    other = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    vocabulary, merges = byte_bpe.model_parts(other)
    codec = byte_bpe.Codec(other, merges, vocabulary, queries.PATTERN)
    plain = tiktoken.Encoding("multi", pat_str=queries.PATTERN, mergeable_ranks=other, special_tokens={})
    for text in ("Straße und größer", "Çà et là, où?", "中文 текст 🙂", " a  b\n\n c "):
        assert codec.ids(text) == plain.encode_ordinary(text)


def test_two_vocabularies_of_one_size_in_one_session(spark):
    """Both rank files have equally many ranks and merges; each gets its own codec in the workers."""
    texts = ["Straße und größer", "Çà et là, où?", "中文 текст 🙂", "plain words"]
    table = docs(spark, texts)
    for name in ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"):
        path = public_tokenizers.path(name)
        plain = tiktoken.Encoding(name, pat_str=queries.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
        found = byte_bpe.Tokens(table, path, queries.PATTERN).encode(table).collect()
        assert {r["text"]: r["ids"] for r in found} == {t: plain.encode_ordinary(t) for t in texts}


def test_memory_is_bounded_by_characters(codec, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 5_000)
    for i in range(40):
        codec.digests(f"{i}x" * 200)  # pieces of hundreds of characters
        codec.digests(" ".join(f"w{i}{j}" for j in range(60)))
        assert sum(map(len, codec.pieces)) + sum(map(len, codec.words)) <= 5_000
    assert all(len(p) <= 625 for p in codec.pieces)


def test_query_against_the_library(spark, plain):
    found = {r["doc_id"]: r for r in queries.QUERIES["op7_byte_bpe"](spark, DATA).collect()}
    for row in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        ids = plain.encode_ordinary(row["text"])
        digest = found[row["doc_id"]]
        assert (digest["n_tokens"], digest["ids_sha256"], digest["decoded_sha256"]) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(row["text"].encode()).hexdigest())


def test_round_trip_of_odd_rows(spark):
    texts = [None, "", " ", "a" * 100_000, "word " * 50_000, "🙂🙂", "same", "same", "\x00 \x00"]
    table = docs(spark, texts, ids=[*range(8), None]).withColumn("tokens", F.lit("clash"))
    tokens = byte_bpe.Tokens(table, queries.RANKS, queries.PATTERN)
    encoded = tokens.encode(table, offsets="ranges")
    rows = tokens.decode(encoded).collect()
    assert {r["doc_id"]: r["decoded"] for r in rows} == {
        i: t or "" for i, t in zip([*range(8), None], texts, strict=True)}
    assert all(len(r["ids"]) == len(r["ranges"]) for r in rows)
    assert {r["doc_id"]: r["ids"] for r in tokens.encode(table).collect()} == {r["doc_id"]: r["ids"] for r in rows}
    assert tokens.digests(table).where("tokens.n_tokens = 0").count() == 2
    assert tokens.digests(table.limit(0)).count() == 0
