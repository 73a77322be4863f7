"""Word BPE ids by batches: equal to the library's, and few calls of its model."""

import random
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from foliomill.llm import packing, token_planes
from foliomill.llm.word_ids import WordEncoder

WORD = public_tokenizers.path("word_bpe_49k.json")
PLAIN, ALL = "aAbstrevmlldSTREVMD'''''01 9  \n\t.,<>éÉÀßÿ", "aAstrevmlldTREVM''\"01 9 \n\t\x0b\x85\xa0.,<|>éÉß×µ²ª中́"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(WORD)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def counted(most):
    """An encoder and the pieces that it has given to the library's model."""
    encoder, asked = WordEncoder(WORD, most=most), []
    model = encoder.model
    encoder.model = SimpleNamespace(tokenize=lambda s: asked.append(s) or model.tokenize(s))
    return encoder, asked


def test_frequent_pieces_stay_remembered():
    encoder, asked = counted(20)
    letters = "abcdefghij"
    for a in letters:
        for b in letters:
            encoder.encode(f"The hot, hot words q{a}{b}")
    assert [asked.count(p) for p in ("the", "hot", ",", "words")] == [1, 1, 1, 1]
    assert len(asked) == 104


def test_a_batch_asks_once_for_each_piece_in_any_case(library):
    encoder, asked = counted(2)
    texts = ["One, two; ONE two.", None, "two One!", "", "été ÉTÉ one"] * 3
    assert [np.frombuffer(i, "<u4").tolist() for i in encoder.encode_all(texts)] == [library(t) for t in texts]
    assert len(asked) == len(set(asked)) == 7


def test_batches_are_the_library(library):
    rnd, encoder = random.Random(3), WordEncoder(WORD, most=50)
    fixed = ["'s", "it's", "\"'s", "''s", "'sam 're'rx 'Ll", "1's22", "<|endoftext|> a", "a <| b", " ", "x" * 3000, "don't " * 500]
    for block in (1, 7, 40, 1 << 20):
        texts = fixed + ["".join(rnd.choices(rnd.choice((PLAIN, PLAIN, ALL)), k=rnd.choice((1, 3, 30, 90)))) for _ in range(300)]
        assert [np.frombuffer(i, "<u4").tolist() for i in encoder.encode_all(texts, block)] == [library(t) for t in texts]


@pytest.fixture
def batch_sizes():
    """Instead of an encoder: each text's only id is the number of texts encoded with it."""

    def encoder(path):
        return SimpleNamespace(encode_all=lambda texts: [np.array([len(texts)], "<u4").tobytes() for _ in texts])

    return encoder


def test_token_files_encode_a_batch_at_once(spark, monkeypatch, batch_sizes):
    monkeypatch.setattr(token_planes, "word_encoder", batch_sizes)
    docs = spark.createDataFrame([(i, "a b") for i in range(60)], "doc_id long, text string").coalesce(1)
    got = token_planes.read_token_files(token_planes.write_token_files(docs, WORD, 1)).collect()
    assert {r.n_tokens for r in got} == {2} and sum(1 / np.frombuffer(r.ids, "<u4")[0] for r in got) <= spark.sparkContext.defaultParallelism


def test_packing_encodes_a_batch_at_once(spark, monkeypatch, batch_sizes):
    monkeypatch.setattr(packing, "word_encoder", batch_sizes)
    docs = spark.createDataFrame([(i, "a b") for i in range(60)], "doc_id long, text string").coalesce(1)
    got = packing.cut_pieces(docs, WORD, 2, window=2, groups=3).collect()
    assert [(r.length, r.doc_tokens, *np.frombuffer(r.ids, "<u4")) for r in got] == [(2, 2, 60, 2)] * 60
