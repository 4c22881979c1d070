"""Language identification by cross-parsing entropy.

For each language, a suffix automaton of labelled text knows all its substrings. A document
is parsed into phrases: each is the longest match that the automaton can read on from the
phrase's first letter. Text of the automaton's language has long matches, so few phrases.
With ``n`` letters of reference text, ``phrases * log2(n) / letters`` estimates the bits
per letter (Ziv and Merhav's cross-parsing); the language that needs fewest wins. A letter
that the reference lacks cannot be read from it and costs its number in the alphabet of all
languages besides, so a reference of a few letters is not cheap for texts it cannot spell.

Parsing runs in numpy on many pieces of texts at once, one letter a step: the automata are
tables in which a failed match already leads to the state after the first letter of the
next phrase. Long texts are cut into pieces of ``LANE`` letters, each of which begins a
phrase, in all languages alike, so whole texts are parsed and a very long one is not
slower a letter.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rosterflow.llm import words, work

#: The bound of the labelled sample: so many documents of each language (by hash of their
#: id), and so many letters of each document and of each language.
SAMPLE_DOCS = 200
SAMPLE_LETTERS_OF_DOC = 400
SAMPLE_LETTERS = 40_000
LANE = 256
BATCH_LANES = 2048
UNKNOWN = "und"

# Code points: 0 anything but a letter, 1 a letter that no reference text has, 2.. the others.
_GAP, _OTHER = 0, 1


def _letters() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


def _codes(texts: list[str], alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts as codes, lower-cased, runs of others as one gap; the texts' offsets."""
    lowered = [t.lower() for t in texts]
    ends = np.cumsum([len(t) for t in lowered], dtype=np.int64)
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = alphabet[points]
    keep = codes != _GAP
    keep[1:] |= codes[:-1] != _GAP
    at = np.concatenate([[0], ends])
    kept = np.concatenate([[0], np.cumsum(keep)])
    return codes[keep], kept[at]


@dataclass
class Automata:
    """All languages' automata as one table over states and codes; an entry is twice the next
    row's place, plus 1 where a phrase ends."""

    languages: list[str]
    alphabet: np.ndarray
    width: int
    table: np.ndarray
    roots: np.ndarray
    bits: np.ndarray  # of a phrase

    @classmethod
    def of(cls, samples: dict[str, str]) -> Automata:
        languages = sorted(samples)
        is_letter = _letters()
        seen = sorted({ord(c) for t in samples.values() for c in t.lower() if is_letter[ord(c)]})
        alphabet = is_letter.astype(np.uint16)
        alphabet[seen] = np.arange(2, 2 + len(seen))
        width = 2 + len(seen)
        tables, roots, bits, rows = [], [], [], 0
        for language in languages:
            codes, _ = _codes([samples[language]], alphabet)
            step = suffix_automaton(codes.tolist(), width)
            start = step[0].copy()  # a letter after a failed match begins a phrase at the root
            start[start < 0] = 0
            failed = step < 0
            target = np.where(failed, start[None, :], step)
            tables.append(((target + rows) * width * 2 + failed).astype(np.int64))
            roots.append(rows * width)
            rows += len(step)
            bits.append(np.log2(max(len(codes), 2)))
        kind = np.int32 if 2 * rows * width < 2**31 else np.int64
        table = np.concatenate(tables).ravel() if tables else np.empty(0)
        return cls(languages, alphabet, width, table.astype(kind), np.array(roots, kind), np.array(bits))

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(phrases by text and language, letters and gaps of each text, whether it has a letter,
        letters and gaps by text and language that the reference lacks)."""
        codes, at = _codes(texts, self.alphabet)
        size = np.diff(at)
        n_lanes = -(-size // LANE)
        text = np.repeat(np.arange(len(texts)), n_lanes)
        begin = at[text] + LANE * (np.arange(len(text)) - np.repeat(np.cumsum(n_lanes) - n_lanes, n_lanes))
        length = np.minimum(LANE, at[text + 1] - begin)
        order = np.argsort(-length, kind="stable")
        counts = np.zeros((len(text), len(self.languages)), np.int64)
        for i in range(0, len(order), BATCH_LANES):
            lanes = order[i : i + BATCH_LANES]
            counts[lanes] = self._parse(codes, begin[lanes], length[lanes])
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        np.add.at(out, text, counts)
        letters = np.concatenate([[0], np.cumsum(codes != _GAP)])
        return out, size, letters[at[1:]] > letters[at[:-1]], self._lacking(codes, at)

    def _lacking(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        lacks = np.array([self.table[r : r + self.width] & 1 for r in self.roots], bool)
        odd = np.flatnonzero(lacks.any(axis=0)[codes])  # most letters are in all references
        text, code = np.searchsorted(at, odd, "right") - 1, codes[odd]
        return np.column_stack([np.bincount(text[own[code]], minlength=len(at) - 1) for own in lacks])

    def _parse(self, codes: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Phrases of lanes, which come with falling lengths."""
        state = np.repeat(self.roots[:, None], len(begin), 1)
        count = np.ones((len(self.roots), len(begin)), self.table.dtype)
        active = np.searchsorted(-length, -np.arange(LANE), "left")
        for t in range(int(length[0])):
            k = int(active[t])
            entry = self.table[state[:, :k] + codes[begin[:k] + t]]
            count[:, :k] += entry & 1
            state[:, :k] = entry >> 1
        return count.T

    def identify(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, probability of it among all, bits per letter) of each text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        phrases, size, lettered, lacking = self.phrases([t or "" for t in texts])
        bits = phrases * self.bits + lacking * np.log2(self.width)
        best = np.argmin(bits, axis=1)
        with np.errstate(under="ignore"):
            score = 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
        return names, np.where(lettered, score, 0.0), np.where(lettered, bits.min(axis=1) / np.maximum(size, 1), 0.0)


def suffix_automaton(codes: list[int], width: int) -> np.ndarray:
    """The transitions of the automaton of all substrings, -1 where there is none."""
    step: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for c in codes:
        new = len(step)
        step.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if longest[q] == longest[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                longest.append(longest[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    out = np.full((len(step), width), -1, np.int64)
    for state, edges in enumerate(step):
        out[state, list(edges)] = list(edges.values())
    return out


def is_held_out(folds: int = 5):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0


def learn(labelled: DataFrame) -> Automata:
    """Automata from ``labelled (doc_id, text, lang)``: a sample of bounded size of each language.

    Rows with a null language or text, or without a letter, are not learnt from; nor are rows
    with a null ``doc_id`` in the registered query, as they are in no fold. The sample
    is the documents with the least hashes; ranks are limited before each shuffle, first
    in 64 parts of a language, so one that holds most rows is no single task. It is taken
    around each document's middle.
    """
    order = F.xxhash64("doc_id", "text")
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", order.alias("rank"))
    start = F.greatest(F.lit(1), F.floor((F.length("text") - SAMPLE_LETTERS_OF_DOC) / 2).cast("int"))
    rows = rows.select("lang", "rank", F.substring("text", start, F.lit(SAMPLE_LETTERS_OF_DOC)).alias("text"))
    for keys in (["lang", F.pmod("rank", F.lit(64))], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("rank", "text"))
        rows = rows.withColumn("place", place).where(F.col("place") <= SAMPLE_DOCS).drop("place")
    samples: dict[str, list[str]] = {}
    for row in rows.toArrow().sort_by([("lang", "ascending"), ("rank", "ascending"), ("text", "ascending")]).to_pylist():
        samples.setdefault(row["lang"], []).append(row["text"])
    return Automata.of({language: " ".join(texts)[:SAMPLE_LETTERS] for language, texts in samples.items()})


RESULTS = ["lang_pred", "score", "bits"]


def recognised(spark: SparkSession, automata: Automata) -> Callable[[Column], Column]:
    """A function of a text column to a struct of ``RESULTS``."""
    shared = spark.sparkContext.broadcast(automata)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Table]:
        model = shared.value
        for texts in batches:
            told: list[list] = [[], [], []]
            for i, j in words.runs(words.utf8(texts)[1]):
                for column, values in zip(told, model.identify(texts.slice(i, j - i).to_pylist())):
                    column.extend(values)
            yield pa.table([pa.array(c, t) for c, t in zip(told, (pa.string(), pa.float64(), pa.float64()))], RESULTS)

    return work.of_text(run, StructType.fromDDL("lang_pred string, score double, bits double"))


def predict(docs: DataFrame, automata: Automata) -> DataFrame:
    """``docs`` with ``lang_pred, score, bits``: the language, its probability among the learnt
    ones (0 to 1), and the bits per letter of its parse.

    A null text, or one without a letter, is ``und`` with score and bits 0; so is every text
    if no language was learnt. Texts of any length are parsed whole. Equal parses go to the
    first name. Columns of ``docs`` that bear a name of the results, in any case, are
    replaced. Rows are judged one by one.
    """
    return work.with_fields(docs, recognised(docs.sparkSession, automata)(F.col("text")), RESULTS)


def op1_cross_parsing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    automata = learn(docs.where(~is_held_out()))
    return predict(docs.select("doc_id", "text", is_held_out().alias("held_out")), automata).drop("text")
