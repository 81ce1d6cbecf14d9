"""Encoding by ranks against the tiktoken library, and exact round trips."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybeam.llm import rank_bpe
from tallybeam.llm.bpe import SPLIT
from tests.llm.test_llm import awkward, documents, nothing


def make(name="byte_bpe_50k.tiktoken"):
    with open(public_tokenizers.path(name), encoding="ascii") as f:
        codec = rank_bpe.Codec(f.read(), SPLIT)
    return codec, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


@pytest.fixture(scope="module")
def both():
    return make()


def digests(library, text):
    ids = library.encode_ordinary(text or "")
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return len(ids), sha(" ".join(map(str, ids)).encode()), sha(library.decode_bytes(ids))


def test_pattern_is_the_published_one():
    assert SPLIT == public_tokenizers.PATTERN


def test_documents_equal_the_library(spark, sf, both):
    docs = documents(spark, sf)
    got = {r.doc_id: tuple(r)[1:] for r in rank_bpe.digests(docs).collect()}
    for d in docs.collect():
        assert got[d.doc_id] == digests(both[1], d.text)
        assert got[d.doc_id][2] == hashlib.sha256((d.text or "").encode()).hexdigest()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aeintSTRÑé \t\n\r\x1c\x1f\x85 　'sd0189-=_<|>中\U0001f600́"), max_size=60) | st.text(max_size=20), max_size=20))
def test_any_texts(both, texts):
    codec, library = both
    assert codec.encode_all(texts).to_pylist() == [library.encode_ordinary(t) for t in texts]


def test_every_kind_of_character(both):
    codec, library = both
    points = [*range(0xD800), *range(0xE000, 0x20000, 7), *range(0x1F300, 0x1F700)]
    texts = ["a".join(map(chr, points[i : i + 200])) + " " + "  ".join(map(chr, points[i : i + 200])) for i in range(0, len(points), 200)]
    assert codec.encode_all(texts).to_pylist() == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_both_forms_of_the_query(monkeypatch, name, limit):
    """Words that contract equal pairs together, and words that contract one pair a round."""
    monkeypatch.setattr(rank_bpe, "LONG", limit)
    codec, library = make(name)
    rng = random.Random(5)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 90))) for letters in ("ab", "the", "etaoin", "ÀÉéñ", "=-", "中文字", "\U0001f600\U0001f601") for _ in range(60)]
    words += ["a" * n for n in (2, 3, 127, 1000)] + ["-" * 999, "ha" * 333, "\n" * 301]
    assert codec.encode_all(words).to_pylist() == [library.encode_ordinary(w) for w in words]


def test_long_words_do_not_take_a_round_a_letter(both):
    codec, library = both
    for word in ("-" * 40_000, "ab" * 20_000, " " * 30_001):
        assert codec.encode_all([word]).to_pylist() == [library.encode_ordinary(word)]


def test_memory_of_words_is_bounded(monkeypatch, both):
    monkeypatch.setattr(rank_bpe, "REMEMBERED", 50)
    codec, library = both
    codec.known, codec.known_ids = dict(codec.tokens), codec.token_ids
    for i in range(6):
        texts = [f"zqx{k}vwk qqzz{k}xx{'abcdefgh'[k % 8]}wq" for k in range(i * 20, i * 20 + 60)]
        assert codec.encode_all(texts).to_pylist() == [library.encode_ordinary(t) for t in texts]
        assert len(codec.known) == len(codec.known_ids) <= len(codec.tokens) + 500  # no more than a batch beyond the limit


@pytest.mark.parametrize("extra", ["n_tokens", "ids", "content", "key"])
def test_awkward_rows_and_clashing_names(spark, both, extra):
    docs = awkward(spark, extra)
    want = sorted(((d.doc_id, *digests(both[1], d.text)) for d in docs.collect()), key=repr)
    assert sorted(map(tuple, rank_bpe.digests(docs).collect()), key=repr) == want
    back = rank_bpe.decode(rank_bpe.encode(docs)).collect()
    assert sorted((r.doc_id, bytes(r.content).decode()) for r in back if r.doc_id) == sorted((d.doc_id, d.text or "") for d in docs.collect() if d.doc_id)
    assert rank_bpe.digests(nothing(spark, extra)).count() == 0 and rank_bpe.encode(nothing(spark, extra)).count() == 0


def test_unknown_and_null_ids_decode_to_nothing(spark, both):
    ids = both[1].encode_ordinary("kept text")
    rows = spark.createDataFrame([(1, [-1, ids[0], None, 50_256, 2_000_000, *ids[1:]]), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: bytes(r.content) for r in rank_bpe.decode(rows).collect()}
    assert got == {1: b"kept text", 2: b"", 3: b""}


def test_other_keys(spark, both):
    rows = spark.createDataFrame([("x", "some words"), (None, "others")], "name string, body string")
    got = rank_bpe.encode(rows, text="body", key="name").orderBy(F.col("name").desc()).collect()
    assert [r.ids for r in got] == [both[1].encode_ordinary("some words"), both[1].encode_ordinary("others")]


def test_ranks_without_every_byte_are_refused():
    with pytest.raises(ValueError, match="every byte"):
        rank_bpe.Codec("YQ== 0", SPLIT)
