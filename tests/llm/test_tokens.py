"""Chunked encoding equals the library's plain call."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ordermart.llm import tokens

ODD = ["", None, " ", "  a", " a  b\n c ", "a\n", "\na", "a\nb", "it's 's  't", "a\0b c", "<|endoftext|> a <|endoftext|>",
       "a<|endoftext|>b", "<|endoftext|>", " <|endoftext|><|endoftext|>\n x <|endoftext", "　 a", " 　a", "a\x1cb \x1cc",
       "x,y.z, foo. ²³ ½."]


def plain_call(controls_as_text=False):
    model = Tokenizer.from_file(tokens.default_path())
    if controls_as_text:
        model.encode_special_tokens = True
    return lambda t: model.encode(t or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def plain():
    return plain_call()


@pytest.mark.parametrize("segment", [1 << 20, 5])
@pytest.mark.parametrize("controls_as_text", [False, True])
def test_odd_texts(monkeypatch, segment, controls_as_text):
    monkeypatch.setattr(tokens, "SEGMENT_BYTES", segment)
    encoder = tokens.ChunkTokenizer(tokens.default_path(), controls_as_text=controls_as_text)
    plain = plain_call(controls_as_text)
    for _ in range(2):
        assert [x.tolist() for x in encoder.encode(ODD)] == [plain(t) for t in ODD]
    assert (50256 in next(iter(encoder.encode([ODD[10]])))) != controls_as_text


def test_documents(plain, documents):
    texts = [r.text for r in documents.select("text").collect()]
    got = tokens.tokenizer(tokens.default_path()).encode(texts)
    assert all(np.array_equal(x, plain(t)) for x, t in zip(got, texts, strict=True))


PIECES = [*" \n\t\r.,'as1!é\x1c\x85漢。，😀_", "<|endoftext|>", "<|", "word!?", "né_-", "a.b", "'s", "it's", " word", "\n\n", "x1y2"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25), st.sampled_from([1 << 20, 3, 9]))
def test_any_text(plain, pieces, segment):
    text, before = "".join(pieces), tokens.SEGMENT_BYTES
    tokens.SEGMENT_BYTES = segment
    try:
        got = next(iter(tokens.tokenizer(tokens.default_path()).encode([text])))
    finally:
        tokens.SEGMENT_BYTES = before
    assert got.tolist() == plain(text)


def test_unbroken_texts_are_cut(plain, monkeypatch):
    encoder = tokens.ChunkTokenizer(tokens.default_path())
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abcXYZ019+/"), 2000)) for _ in range(300)] + ["漢字、" * 3000]
    assert [x.tolist() for x in encoder.encode(texts)] == [plain(t) for t in texts]
    monkeypatch.setattr(tokens, "SEGMENT_BYTES", 100)
    assert max(len(s) for s in tokens._segments(texts[0].encode())) < 200
    assert max(len(s) for s in tokens._segments(texts[-1].encode())) < 200
    assert [x.tolist() for x in encoder.encode(texts[-3:])] == [plain(t) for t in texts[-3:]]


def test_bytes(plain):
    texts = ["né à", "a\0b", None, "", "x"]
    encode = tokens.tokenizer(tokens.default_path()).encode
    assert [x.tolist() for x in encode([t if t is None else t.encode() for t in texts])] == [plain(t) for t in texts]
    assert next(iter(encode([b"a \xff\xe3 b"]))).tolist() == plain("a \ufffd\ufffd b")


def test_batches(plain, monkeypatch):
    monkeypatch.setattr(tokens, "BATCH_BYTES", 7)
    assert [x.tolist() for x in tokens.ChunkTokenizer(tokens.default_path()).encode(ODD * 2)] == [plain(t) for t in ODD * 2]
