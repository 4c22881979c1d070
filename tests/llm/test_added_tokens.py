"""Token ids against the library as the contract calls it: its default, special tokens included."""

from __future__ import annotations

import json
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rosterflow.llm import token_ids, words

FILE = public_tokenizers.path("byte_bpe_50k.json")
END = "<|endoftext|>"


def _texts(marks):
    r = random.Random(4)
    return ["".join(r.choice(marks) for _ in range(r.randint(0, 20))) for _ in range(2000)]


def _compare(model, texts):
    whole = Tokenizer.from_str(model)
    raw, at = words.utf8(pa.array(texts))
    ids, first = token_ids.Tokens(model, special=True)(raw, at)
    for k, text in enumerate(texts):
        assert ids[first[k] : first[k + 1]].tolist() == whole.encode(text or "", add_special_tokens=False).ids


def test_special_tokens_in_texts_are_those_of_the_library():
    with open(FILE, encoding="utf-8") as f:
        model = f.read()
    marks = [" ", "\n", "a", "B", "é", "7", "!", "'s", "'", "x", END, END, "<|endof", "text|>", "<", "|>", "中"]
    # the last two would make a token only together
    _compare(model, [*_texts(marks), f"end of page{END}next", END, END * 3, f" {END} ", f"a {END}\n\n{END} b", None, "", "a<|endof", "text|> b"])


@pytest.mark.parametrize("flag", [None, "lstrip", "rstrip", "single_word"])
def test_other_added_tokens_are_those_of_the_library(flag):
    with open(FILE, encoding="utf-8") as f:
        model = json.load(f)
    for k, content in enumerate(("<|end", "ab c", "é")):
        kind = {name: name == flag for name in ("single_word", "lstrip", "rstrip")}
        model["added_tokens"].append({"id": 50257 + k, "content": content, "normalized": False, "special": k != 1, **kind})
    _compare(json.dumps(model), _texts([" ", "\n", "a", "b", "c", "ab c", "é", END, "<|end", ".", "x"]))


def test_shards_with_special_tokens_in_texts(spark, tmp_path):
    texts = [f"end of page{END}next", None, "plain text", f"{END}", "after it"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    token_ids.write_token_shards(docs, FILE, str(tmp_path / "shards"), shard_chars=20)
    got = token_ids.documents_of(token_ids.read_token_shards(spark, str(tmp_path / "shards"))).orderBy("doc_id").collect()
    whole, start = Tokenizer.from_file(FILE), 0
    for row, text in zip(got, texts, strict=True):
        data = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(data) // 4, zlib.crc32(data))
        start += row.n_tokens
