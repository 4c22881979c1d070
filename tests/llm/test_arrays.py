"""The numpy parts against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rosterflow.llm import jaccard_join, language_id, linear, pieces, token_ids, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from(list(" \n\t\x0bab Zé中.7😀 　▁$")), max_size=40)), max_size=8)


def _words(texts, inside, fold=False):
    raw, at = words.utf8(pa.array(texts, pa.string()))
    return words.split(words.folded(raw) if fold else raw, at, inside)


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_words_are_those_of_the_patterns(texts):
    for inside, pattern in ((words.NOT_SPACE, r"[^\x20\x09-\x0D]+"), (words.ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        found = _words(texts, inside, fold=True)
        got = [[bytes(found.raw[found.start[p] : found.end[p]]).decode() for p in range(found.first[k], found.first[k + 1])] for k in range(len(texts))]
        lower = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in texts]
        assert got == [re.findall(pattern, t) for t in lower]


@given(TEXTS)
@settings(max_examples=100, deadline=None)
def test_equal_words_and_only_they_have_equal_hashes(texts):
    found = _words(texts, words.NOT_SPACE)
    by = {}
    for h, s, e in zip(found.hashes().tolist(), found.start, found.end):
        assert by.setdefault(h, bytes(found.raw[s:e])) == bytes(found.raw[s:e])
    assert len(by) == len(set(by.values()))


def test_runs_cover_all_texts_once():
    raw, at = words.utf8(pa.array(["ab" * k for k in (0, 1, 500, 3, 0, 70)] + [None]))
    spans = list(words.runs(at, 100))
    assert [i for i, _ in spans] + [7] == [0] + [j for _, j in spans]


def test_a_slice_and_chunks_of_an_array_are_read_from_their_place():
    array = pa.chunked_array([pa.array(["xx", "a b"]), pa.array([None, "c"])])
    raw, at = words.utf8(array.slice(1))
    assert raw.tobytes() == b"a bc" and at.tolist() == [0, 3, 3, 4]


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=300))
@settings(max_examples=200, deadline=None)
def test_simple8b_round_trip(ids):
    values = np.array(ids, np.uint64)
    packed, escapes = token_ids.pack(values)
    assert token_ids.unpack(packed, escapes, len(values)).tolist() == ids
    sizes = np.array([len(ids)])
    got, got_sizes = token_ids.from_block(token_ids.to_block(values, sizes))
    assert got.tolist() == ids and got_sizes.tolist() == [len(ids)]


def test_simple8b_packs_as_many_ids_as_fit():
    assert len(token_ids.pack(np.zeros(60, np.uint64))[0]) == 1
    assert len(token_ids.pack(np.full(8, 2**15 - 1, np.uint64))[0]) == 2
    assert len(token_ids.pack(np.full(4, 2**63, np.uint64))[0]) == 8


def test_broken_block_is_refused():
    with pytest.raises(ValueError):
        token_ids.from_block(token_ids.to_block(np.arange(9, dtype=np.uint64), np.array([9]))[:-8])


def test_byte_bpe_segments_encode_like_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        model = f.read()
    whole = Tokenizer.from_str(model)
    whole.encode_special_tokens = True
    r = random.Random(3)
    marks = [" ", " ", "\n", "\t", "a", "B", "é", " ", "　", "7", "!", "'s", "'", "中", "\r", "x", "<|endoftext|>", "\u0085", "😀"]
    texts = ["".join(r.choice(marks) for _ in range(r.randint(0, 25))) for _ in range(3000)] + [None, "", "word " * 3000]
    raw, at = words.utf8(pa.array(texts))
    ids, first = token_ids.Tokens(model)(raw, at)
    for k, text in enumerate(texts):
        assert ids[first[k] : first[k + 1]].tolist() == whole.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def model():
    return pieces.Model.load(pieces.tokenizer_path())


def test_pieces_restore_every_text(model, texts):
    cases = [*texts, " a", "  ", "a▁b", "▁", "\x00", "𐍈" * 200, "日本語　x"]
    encoder = pieces.Encoder(model)
    raw, at = words.utf8(pa.array(cases))
    back, ends = encoder.decode(*encoder.encode(raw, at))
    assert back.tobytes() == raw.tobytes() and ends.tolist() == at.tolist()


def test_segmentation_has_the_best_score(model):
    """Against the library's own unigram search over the same scores; equal sums may be split otherwise."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    file = proto.ModelProto()
    with open(pieces.tokenizer_path(), "rb") as f:
        file.ParseFromString(f.read())
    file.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    for piece, score in zip(file.pieces, model.score.tolist()):
        piece.score = score
    library = sentencepiece.SentencePieceProcessor(model_proto=file.SerializeToString())
    cases = ["Hello  world\n\tx 中𐍈é", " a", "the quick brown foxes jumped", "enentegege Scheidung", "", "x" * 150 + " y"]
    encoder = pieces.Encoder(model)
    raw, at = words.utf8(pa.array(cases))
    ids, first = encoder.encode(raw, at)
    for k, text in enumerate(cases):
        own, theirs = ids[first[k] : first[k + 1]], library.encode(text)
        assert own.tolist() == theirs or model.score[own].sum() == pytest.approx(model.score[theirs].sum(), abs=1e-3)


def test_single_and_joint_segmentation_agree(model):
    parts = [b"\xff" + w.encode() for w in ("understanding", "é中𐍈", "a", "zzzzqqqq", "naïveté")]
    for part, ids in zip(parts, model.segment(parts)):
        assert ids.tolist() == model._alone(part).tolist()


def test_double_array_finds_exactly_its_keys():
    r = random.Random(1)
    keys = sorted({bytes(r.choice(b"ab\x00\xff\x7f") for _ in range(r.randint(1, 6))) for _ in range(300)})
    trie = pieces.DoubleArray(keys)
    for key in keys + [b"ba\x01", b"zz", b"ab\xff\xff\xff\xff\xff"]:
        at = 0
        for b in key:
            to = int(trie.base[at]) + b + 1
            at = to if trie.check[to] == at else None
            if at is None:
                break
        value = -1 if at is None else int(trie.value[at])
        assert (keys[value] == key) if key in keys else value == -1


def test_automaton_parses_into_longest_matches():
    r = random.Random(5)
    reference = "".join(r.choice("abc") for _ in range(300))
    model = language_id.Automata.of({"one": reference, "two": "bcd" * 50})
    for text in ("abcabcabd", "dddd", "a", "".join(r.choice("abcd") for _ in range(200))):
        phrases, i = 1, 0
        while True:
            j = i
            while j < len(text) and text[i : j + 1] in reference:
                j += 1
            i = max(j, i) if j > i else i + 1
            if i >= len(text):
                break
            phrases += 1
        got = model.phrases([text])[0][0, 0]
        # a letter that the reference lacks ends the phrase before it, and is none itself
        assert abs(got - phrases) <= text.count("d") + 1 if "d" in text else got == phrases


def test_language_edge_cases():
    model = language_id.Automata.of({"b": "zwei drei vier", "a": "one two three"})
    names, score, _ = model.identify([None, "", "123 !?", "two", "drei", "ONE", "中", "q" * 5000])
    assert names[:3] == ["und"] * 3 and score[:3].tolist() == [0, 0, 0]
    assert names[3:6] == ["a", "b", "a"] and names[6] == "a"  # a tie goes to the first name
    assert ((0 <= score) & (score <= 1)).all()
    assert language_id.Automata.of({}).identify(["x", None])[0] == ["und", "und"]


def test_prefixes_of_similar_sets_share_a_key():
    """Sets of all sizes, with few or many frequent shingles, similar just enough."""
    r = np.random.Generator(np.random.PCG64(9))
    order = r.permutation(np.arange(1, 20_001, dtype=np.uint64) * np.uint64(2**40 + 7))
    for trial in range(400):
        n, n_rare_tokens = int(r.integers(1, 400)), int(r.integers(0, 60))
        pool = order[: 2 * n]
        a = set(r.choice(pool, n, replace=False).tolist())
        lost = int(r.integers(0, max(1, n // 4) + 1))
        b = set(list(a)[lost:]) | set(order[5000 : 5000 + int(r.integers(0, max(1, n // 4) + 1))].tolist())
        overlap = len(a & b)
        if not b or 100 * overlap < 75 * len(a | b):
            continue
        # the rarest pool tokens are rare in one global order
        place = {int(t): k for k, t in enumerate(order.tolist())}
        keys = []
        for own in (a, b):
            shared = sorted(own, key=place.get)
            n_rare = sum(place[t] < n_rare_tokens for t in shared)
            key, level = jaccard_join.prefix_keys(len(own), np.array(shared, np.uint64), n_rare)
            keys.append(set(key[level <= len(own) - overlap + 1].tolist()))
        assert keys[0] & keys[1], (trial, n, overlap)


def test_logistic_regression_separates_and_handles_one_class():
    r = np.random.Generator(np.random.PCG64(2))
    x = r.normal(size=(400, 5))
    y = (x[:, 0] - x[:, 1] > 0).astype(float)
    assert ((linear.fit(x, y).probability(x) > 0.5) == (y > 0)).mean() > 0.97
    only = linear.fit(x, np.ones(400))
    assert not only.weights.any() and only.probability(x).min() > 0.99
    assert len(linear.fit(np.zeros((0, 5)), np.zeros(0)).weights) == 5


def test_repeats_mark_all_and_later_ones():
    from rosterflow.llm.quality_rules import _repeats

    twice, earlier = _repeats(np.array([0, 0, 0, 1]), np.array([5, 6, 5, 5], np.uint64))
    assert twice.tolist() == [True, False, True, False] and earlier.tolist() == [False, False, True, False]
    assert Counter(twice.tolist()) == {True: 2, False: 2}
