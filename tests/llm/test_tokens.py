"""Word-wise encoding against the library in one call; packing and token files against plain versions."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerly.llm import packing, token_files
from ledgerly.llm.common import scratch, stage
from ledgerly.llm.tokens import encoder, library_tokenizer, tokenizer_path

KINDS = [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)]
ODD = ["", " ", "a  b", " a\n b\n\nc ", "x\tb \n", "İstanbul ΣΑΣ \x1c y z", "don't stop'll <|endoftext|> a", "a \nb c", "e ́x", "日本 語　テ", "\r\nfoo\r\n bar", "²³ ªº ÀÉ ſ ß soft\xadhy", "\x00 a\x00b", None]


def plain(name, texts):
    return [e.ids for e in library_tokenizer(tokenizer_path(name)).encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize(("name", "blanks"), KINDS)
@given(texts=st.lists(st.text(alphabet=st.sampled_from("abéΣİ日1' .,\n\t\u00a0!"), max_size=30), max_size=5))
@settings(max_examples=60, deadline=None)
def test_same_ids_as_the_library(name, blanks, texts):
    texts = texts + ODD
    ids, n = encoder(tokenizer_path(name), blanks).encode(texts)
    assert [list(x) for x in np.split(ids, np.cumsum(n)[:-1])] == plain(name, texts)


@pytest.mark.parametrize(("name", "blanks"), KINDS)
def test_added_tokens_get_their_own_ids(name, blanks):
    """As in a plain call of the library on a tokenizer loaded anew."""
    from tokenizers import Tokenizer

    texts = ["a </s> <|endoftext|> b", "<|ENDOFTEXT|>", "x<|endoftext|>", "<|startoftext|> y", "no <|end of|> it"]
    want = [e.ids for e in Tokenizer.from_file(tokenizer_path(name)).encode_batch(texts, add_special_tokens=False)]
    ids, n = encoder(tokenizer_path(name), blanks).encode(texts)
    assert [list(x) for x in np.split(ids, np.cumsum(n)[:-1])] == want


def test_token_files(spark, odd, none):
    docs = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    path = scratch(spark, "files")
    token_files.write(docs, path, "word_bpe_49k.json", 1, blanks=False)
    rows = {r["doc_id"]: r for r in token_files.read_back(token_files.read(spark, path)).collect()}
    start = 0
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for i in sorted(texts):
        ids = np.array(plain("word_bpe_49k.json", [texts[i]])[0] + [1], "<u4")
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    # null and repeated doc_ids: a row each, nulls first, equal ids in the order of their texts
    path = scratch(spark, "files")
    token_files.write(odd, path, "word_bpe_49k.json", 1, blanks=False)
    lists = token_files.read(spark, path).collect()
    rows = token_files.read_back(token_files.read(spark, path)).orderBy("start").collect()
    every = sorted(((r["doc_id"], r["text"]) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = [[*x, 1] for x in plain("word_bpe_49k.json", [t for _, t in every])]
    assert [(r["doc_id"], r["n_tokens"]) for r in rows] == [(i, len(x)) for (i, _), x in zip(every, want, strict=True)]
    assert [r["start"] for r in rows] == [sum(map(len, want[:i])) for i in range(len(want))]
    assert sorted((r["doc_id"] or 0, r["ids"]) for r in lists) == sorted((i or 0, x) for (i, _), x in zip(every, want, strict=True))
    path = scratch(spark, "files")
    token_files.write(none, path, "word_bpe_49k.json", 1, blanks=False)
    assert token_files.read_back(spark.read.schema("doc_id long, n_tokens long, ids array<int>").parquet(path)).count() == 0


def test_packing(spark, odd, none):
    pieces = stage(packing.cut(odd, "byte_bpe_50k.json", 0, blanks=True, capacity=64, ids=True), "pieces")
    packed = packing.pack(pieces, 64)
    rows = packed.collect()
    sums = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == sums.get(r["sequence_id"], 0) and len(r["ids"]) == r["length"]
        sums[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(sums.values()) <= 64 and len(sums) <= -(-sum(r["length"] for r in rows) // 64) + 1
    whole = sorted(i for r in packing.sequences(packed).collect() for i in r["ids"])
    assert whole == sorted(i for x in plain("byte_bpe_50k.json", [r["text"] for r in odd.collect()]) for i in [*x, 0])
    assert packing.pack(stage(packing.cut(none, "byte_bpe_50k.json", 0, blanks=True), "pieces")).count() == 0


@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=12))
@settings(max_examples=100, deadline=None)
def test_plan_fits(histogram):
    room, seen = {}, {}
    for length, first, pieces, sequence, each, at in packing.plan(histogram, 50):
        assert first == seen.get(length, 0)
        seen[length] = first + pieces
        for k in range(pieces):
            s, o = sequence + k // each, at + k % each * length
            assert o == room.get(s, 0)
            room[s] = o + length
    assert seen == histogram and max(room.values(), default=0) <= 50
