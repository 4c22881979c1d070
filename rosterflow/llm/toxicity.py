"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other. The model of a category sees the text's
features and the probabilities of all categories before it. In training these are
out-of-fold predictions, so a later model learns how far earlier ones can be trusted on
text that they have not seen.

Features are whole words and beginnings of words (many languages build insults from a
stem), hashed. Spark counts in how many toxic and clean documents of the sample each
occurs; the most telling ones (chi-square) become the columns of the models. The categories
are the columns of the given labels: the model of ``toxic`` sees the probability of
``quality``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rosterflow.llm import linear, words, work

#: Bounds of the labelled sample, by hash of the id.
MOST_POSITIVE, MOST_NEGATIVE = 3000, 6000
N_FEATURES = 400
#: Bytes of the beginnings of words.
PREFIXES = (4, 5, 6, 7, 8, 10)
FOLDS = 5
LEAST = 0.5
#: Columns of the labels in the order of the chain; the last decides.
CATEGORIES = ("quality", "toxic")
LAST = "toxic"


def _features(raw: np.ndarray, at: np.ndarray) -> tuple[words.Words, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """The words, and (text, hash) of every feature of each."""
    found = words.split(words.folded(raw), at, words.ALPHANUMERIC)

    def each():
        of = words.RangeHashes(found.raw)
        yield found.text, of(found.start, found.end)
        for size in PREFIXES:
            longer = found.end - found.start > size
            start = found.start[longer]
            yield found.text[longer], words.mix(of(start, start + size) + np.uint64(1))

    return found, each()


def _matrix(raw: np.ndarray, at: np.ndarray, find: words.Lookup) -> np.ndarray:
    """Presence and rate of each chosen feature in each text."""
    n, k = len(at) - 1, len(find.keys)
    found, features = _features(raw, at)
    counts = np.zeros(n * k, np.int64)
    for text, hashes in features:
        which, place = find(hashes)
        counts += np.bincount(text[which] * k + place, minlength=n * k)
    counts = counts.reshape(n, k)
    rate = np.minimum(20 * counts / np.maximum(np.diff(found.first), 1)[:, None], 1)
    return np.concatenate([counts > 0, rate], axis=1, dtype=np.float32, casting="unsafe")


def sample(docs: DataFrame, labels: DataFrame, label: str = LAST, earlier: tuple[str, ...] = ()) -> DataFrame:
    """``text``, ``y`` (``label``, 0 or 1) and ``y_<k>`` (the ``earlier`` labels) of a bounded number of labelled documents of each class.

    The label of an id that is labelled twice is the more frequent one, 1 if even. Null
    ids and labels are left out; an earlier label that is missing is 0. Of an id's rows it
    has that of the least hash.
    """
    mostly = lambda c: F.coalesce(F.avg(F.col(c).cast("double")) >= 0.5, F.lit(False)).cast("int")
    more = [f"y_{k}" for k in range(len(earlier))]
    one = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(mostly(label).alias("y"), *(mostly(c).alias(n) for c, n in zip(earlier, more)))
    key = F.xxhash64("doc_id")
    chosen = one.where("y = 1").orderBy(key, "doc_id").limit(MOST_POSITIVE).unionByName(one.where("y = 0").orderBy(key, "doc_id").limit(MOST_NEGATIVE))
    # at most MOST_POSITIVE + MOST_NEGATIVE rows of numbers
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = rows.groupBy("doc_id", "y", *more).agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return one.select("doc_id", "text", "y", *more)


def choose_features(rows: DataFrame, n: int = N_FEATURES) -> np.ndarray:
    """The hashes of the ``n`` features that tell ``y`` best, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = words.utf8(batch["text"])
            y = batch["y"].to_numpy().astype(np.int64)
            for i, j in words.runs(at):
                _, features = _features(raw[at[i] : at[j]], at[i : j + 1] - at[i])
                text, value = (np.concatenate(c) for c in zip(*features))
                order = np.lexsort((text, value))
                text, value = text[order], value[order]
                new = np.ones(len(text), bool)
                new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
                value, first, count = np.unique(value[new], return_index=True, return_counts=True)
                positive = np.add.reduceat(y[i:j][text[new]], first) if len(first) else count
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(positive), pa.array(count - positive)], ["feature", "p", "q"])

    counts = rows.select("text", "y").mapInArrow(run, "feature long, p long, q long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    size = rows.groupBy().agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q")).first()
    n_pos, n_neg = float(size["p"] or 0), float(size["q"] or 0)
    if not n_pos or not n_neg:
        return np.empty(0, np.uint64)
    p, q = F.col("p"), F.col("q")
    absent_p, absent_q = F.lit(n_pos) - p, F.lit(n_neg) - q
    chi = (p * absent_q - q * absent_p) * (p * absent_q - q * absent_p) * (n_pos + n_neg) / ((p + q) * (absent_p + absent_q + 1) * n_pos * n_neg)
    best = counts.where(p + q >= 3).select("feature", F.round(chi, 6).alias("chi")).orderBy(F.desc("chi"), "feature").limit(n)
    return np.sort(best.toPandas()["feature"].to_numpy(np.int64).view(np.uint64))


@dataclass
class Chain:
    names: list[str]
    features: np.ndarray
    models: list[linear.Logistic]

    @classmethod
    def fit(cls, names: list[str], features: np.ndarray, x: np.ndarray, y: np.ndarray) -> Chain:
        """``y`` has a column for each category in order."""
        fold, models = linear.folds(len(x), FOLDS, seed=8), []
        for k in range(len(names)):
            models.append(linear.fit(x, y[:, k]))
            ahead = np.zeros(len(x))
            for f in range(FOLDS):
                ahead[fold == f] = linear.fit(x[fold != f], y[fold != f, k]).probability(x[fold == f])
            x = np.column_stack([x, ahead])
        return cls(names, features, models)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = []
        for model in self.models:
            out.append(model.probability(x))
            x = np.column_stack([x, out[-1]])
        return np.column_stack(out)


def _matrices(texts: pa.Array, find: words.Lookup) -> Iterator[np.ndarray]:
    """Features of all texts, some rows at a time."""
    raw, at = words.utf8(texts)
    for i, j in words.runs(at):
        for k in range(i, j, 500):
            m = min(j, k + 500)
            yield _matrix(raw[at[k] : at[m]], at[k : m + 1] - at[k], find)


def learn(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES) -> Chain:
    """A chain of the ``categories`` that ``labels (doc_id, ...)`` has, in this order."""
    names = [c for c in categories if c in labels.columns]
    rows = work.written(sample(docs, labels, names[-1], tuple(names[:-1])), "toxicity-sample")  # of bounded size, read three times
    features = choose_features(rows)
    targets = [*(f"y_{k}" for k in range(len(names) - 1)), "y"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = words.Lookup(features)
        for batch in batches:
            x = pa.array([r.tobytes() for part in _matrices(batch["text"], find) for r in part], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("doc_id", *targets)), x], ["doc_id", *targets, "x"])

    schema = "doc_id long, " + "".join(f"{c} int, " for c in targets) + "x binary"
    table = rows.select(F.col("doc_id").cast("long"), "text", *targets).mapInArrow(run, schema).orderBy("doc_id", "x").toArrow()
    x = np.frombuffer(b"".join(table["x"].to_pylist()), np.float32).reshape(table.num_rows, 2 * len(features))
    y = np.column_stack([table[c].to_numpy() for c in targets]).astype(float)
    return Chain.fit(names, features, x, y)


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` with the probability ``p_<category>`` of each category, and ``toxic``.

    ``toxic`` is true where the last probability is ``LEAST`` or more and the text has a
    feature at all: a null, empty or blank text, and any text when no feature was learnt,
    is not toxic. Texts of any length are read whole. Columns of ``docs`` that bear a name of
    the results, in any case, are replaced. Rows are scored one by one.
    """
    results = [*(f"p_{name}" for name in chain.names), LAST]
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Table]:
        model = shared.value
        find = words.Lookup(model.features)
        for texts in batches:
            parts = [(model.probabilities(x), x.any(axis=1) if x.shape[1] else np.zeros(len(x), bool)) for x in _matrices(texts, find)]
            p = np.concatenate([np.empty((0, len(model.names))), *(p for p, _ in parts)])
            some = np.concatenate([np.empty(0, bool), *(s for _, s in parts)])
            yield pa.table([*(pa.array(c) for c in p.T), pa.array((p[:, -1] >= LEAST) & some)], results)

    fields = StructType.fromDDL(", ".join([*(f"`{r}` double" for r in results[:-1]), f"{LAST} boolean"]))
    return work.with_fields(docs, work.of_text(run, fields)(F.col("text")), results)


def op8_classifier_chain(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))).drop("text")
