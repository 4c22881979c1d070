"""Words that are encoded as one text have the ids of each by itself."""

from __future__ import annotations

import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rosterflow.llm import token_ids
from tests.llm.conftest import prose

MODEL = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
ODD = ["", " ", "a", "x  y", " don't 're 's", "1st 2nd", "a<|endoftext|>b <|endoftext|> c", "é ß中 a\n\nb \tc", "#! -x' 'll", "w " * 40]


class Counted:
    """A tokenizer that counts the texts it gets."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def _ids(tokens: token_ids.Tokens, texts: list[str]) -> list[list[int]]:
    raw = [t.encode() for t in texts]
    at = np.concatenate([[0], np.cumsum(list(map(len, raw)))]).astype(np.int64)
    ids, first = tokens(np.frombuffer(b"".join(raw), np.uint8), at)
    return [ids[i:j].tolist() for i, j in zip(first[:-1], first[1:])]


def test_new_words_are_few_texts():
    r = random.Random(1)
    texts = [" ".join("".join(r.choice("abcdefgh") for _ in range(9)) for _ in range(100)) for _ in range(60)]
    tokens = token_ids.Tokens(MODEL)
    counted = tokens._tokenizer = Counted(tokens._tokenizer)
    assert _ids(tokens, texts) == [e.ids for e in counted.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert counted.texts < 600  # of 6,000 different words


@pytest.mark.parametrize("special", [False, True])
def test_odd_words_and_tokens(special, monkeypatch):
    monkeypatch.setattr(token_ids, "JOINED", 3)
    model = json.loads(MODEL)
    model["added_tokens"].append({"id": 50_300, "content": " of the", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False})
    for m in (MODEL, json.dumps(model)):
        plain = Tokenizer.from_str(m)
        plain.encode_special_tokens = not special
        texts = ODD + [prose(k, 50) + " of the of them" for k in range(9)]
        tokens = token_ids.Tokens(m, special)
        for _ in range(2):  # new words, then known ones
            assert _ids(tokens, texts) == [e.ids for e in plain.encode_batch_fast(texts, add_special_tokens=False)]


def test_a_full_table_begins_anew(monkeypatch):
    monkeypatch.setattr(token_ids, "KEPT", 20)
    plain = Tokenizer.from_str(MODEL)
    tokens = token_ids.Tokens(MODEL)
    for k in range(6):
        texts = [prose(k, 30), "y" * 300 + " z", prose(k + 1, 30)]
        assert _ids(tokens, texts) == [e.ids for e in plain.encode_batch_fast(texts, add_special_tokens=False)]


@pytest.mark.parametrize("seed", range(20))
def test_packed_ids_come_back(seed):
    r = np.random.default_rng(seed)
    ids = (np.uint64(1) << r.integers(0, 64 if seed % 2 else 17, r.integers(1, 400)).astype(np.uint64)) - r.integers(0, 2, 1).astype(np.uint64)
    assert (token_ids.unpack(*token_ids.pack(ids), len(ids)) == ids).all()
