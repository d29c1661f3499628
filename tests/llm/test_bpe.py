from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from wheelhouse.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def pair():
    tokens = bpe.read_ranks(PATH)
    reference = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={}
    )
    return bpe.Encoder(tokens, public_tokenizers.PATTERN), reference


TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a   b", "\n", "a\n b", "a \nb", "x\n\n y", "don't we'll 'sx", "  lead", "trail  ",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "é" * 300, "日本語 テキスト 12345", "<|endoftext|>", "\x1c a\x1c", "²Ⅷ½x", "a" * 5000,
    "ab" * 3000 + " " * 400 + "\t\t x", "   x", "🙂🙂 👍🏽",
]


@pytest.mark.parametrize("text", TEXTS)
def test_equals_reference(pair, text):
    encoder, reference = pair
    ids = encoder.encode([text])[0]
    assert ids.tolist() == reference.encode_ordinary(text)
    assert bpe.decode_ids(bpe.read_ranks(PATH), ids.astype("<u4").tobytes()) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab é\n\t '.1²stre日"), max_size=40), max_size=4))
def test_equals_reference_on_any_text(pair, texts):
    encoder, reference = pair
    assert [ids.tolist() for ids in encoder.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_segments_and_forgetting_change_nothing(pair, monkeypatch):
    encoder, reference = pair
    text = "One two, three. " * 50 + "end"
    wanted = reference.encode_ordinary(text)
    monkeypatch.setattr(bpe, "SEGMENT", 16)
    monkeypatch.setattr(bpe, "KNOWN", 2)
    for body in (text, text.replace(" three", "  three"), text.replace(" ", "\n")):
        assert encoder.encode([body, body])[1].tolist() == reference.encode_ordinary(body)
    assert encoder.encode([text.rstrip()])[0].tolist() == wanted


def test_tables(spark, pair):
    rows = [(1, "Hello wörld", 7), (2, None, None), (2, None, None), (3, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_bytes int")
    out = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH).collect()
    assert len(out) == 4
    for row in out:
        assert bytes(row.decoded) == (row.text or "").encode()
        assert np.frombuffer(bytes(row.token_bytes), "<u4").tolist() == pair[1].encode_ordinary(row.text or "")
    once = bpe.encode(docs, PATH, public_tokenizers.PATTERN, decoded=True).select(*out[0].asDict()).collect()
    assert sorted(once, key=str) == sorted(out, key=str)
    assert bpe.encode(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_query_against_reference(spark, pair):
    from wheelhouse.llm import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op7_byte_bpe"](spark, folder).collect()
    assert len(got) == len(texts)
    for row in got:
        ids = np.array(pair[1].encode_ordinary(texts[row.doc_id]), "<u4")
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
