"""The encoder against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from grist.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids(text):
    return np.frombuffer(bpe.vocabulary(PATH).encode(text), "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet="ab éß漢'strvl \n\t\x85\x1c ٣½🙂!?.<|endoftext|>", max_size=60))
def test_equals_the_library(text):
    expected = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ids(text) == expected
    assert bpe.vocabulary(PATH).decode(bpe.vocabulary(PATH).encode(text)) == LIBRARY.decode(expected, skip_special_tokens=False) == text


@pytest.mark.parametrize("text", ["", "a" * 100_000, " " * 5000 + "x", "<|endoftext|><|endoftext|> a", "the\n\n  cat", " lead", "trail "])
def test_odd_texts(text):
    assert ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_random_joins_of_tokens():
    rng = random.Random(3)
    v = bpe.vocabulary(PATH)
    tokens = [t for t in v.token.values() if t.isalpha()]
    for _ in range(3000):
        piece = b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 6))).decode()
        assert ids(piece) == LIBRARY.encode(piece, add_special_tokens=False).ids


def test_every_token_alone():
    v = bpe.vocabulary(PATH)
    for i, b in v.token.items():
        if i != 50256:
            assert np.frombuffer(v.encode_piece(b), "<u4").tolist() == [i]


def test_bytes_that_are_no_text_decode_with_replacement():
    v = bpe.vocabulary(PATH)
    packed = np.array([v.id[b"\xc3"], v.id[b"a"], 10**6], "<u4").tobytes()
    assert v.decode(packed) == "�a"


def test_frames(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, "the cat", 7), (3, "the cat", 7)], "doc_id long, text string, ids int")
    coded = bpe.decode(bpe.encode(docs, PATH), PATH)
    got = [(r.doc_id, len(r.ids), r.decoded) for r in coded.orderBy("doc_id").collect()]
    assert got == [(1, 0, ""), (2, 0, ""), (3, 8, "the cat"), (3, 8, "the cat")]
    assert bpe.encode(docs.limit(0), PATH).count() == 0


def test_query(spark):
    import hashlib

    from grist.llm.registry import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op4_bpe"](spark, sf).collect():
        own = LIBRARY.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(own), hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("few", [0, bpe.FEW])
def test_texts_together_equal_the_library(monkeypatch, few):
    monkeypatch.setattr(bpe, "FEW", few)
    monkeypatch.setattr(bpe, "SLICE", 2000)
    monkeypatch.setattr(bpe, "CACHE_PIECES", 300)
    rng = random.Random(11)
    v = bpe.Vocabulary(PATH)
    syllables = "an the schung ció über é 日本 don't 's ## ... \n \x85 \x1c A1 99 xq".split(" ")
    texts = [" ".join("".join(rng.choices(syllables, k=rng.randint(0, 6))) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += [None, "", " ", "a ", "end\n", "a" * 3000, "x" * 70 + " " + "y" * 70, "a  b", "a <|endoftext|> b"]
    expected = [np.array(LIBRARY.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert v.encode_all(texts) == expected == v.encode_all(texts)


def test_new_words_are_encoded_together(monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choices("aeioubcdfgst", k=9)) for _ in range(5000)]
    singly = []
    v, one = bpe.Vocabulary(PATH), bpe.Vocabulary.encode_piece
    monkeypatch.setattr(bpe.Vocabulary, "encode_piece", lambda self, piece: singly.append(piece) or one(self, piece))
    assert v.encode_all([" ".join(words)]) == [np.array(LIBRARY.encode(" ".join(words)).ids, "<u4").tobytes()]
    assert len(singly) < 100
