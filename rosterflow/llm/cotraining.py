"""Document quality by co-training.

Two views of a document have a classifier each: its *content*, as frequencies of hashed
three-byte sequences, and its *metadata*: source, language, length and layout (lines,
letter cases, digits, signs, white space). Labelled documents train both. In each round
each classifier labels the unlabelled documents of which it is surest, and these join the
other's training set. Each view is then calibrated on labelled rows that neither has seen,
and the two probabilities of a document are combined by adding up their evidence.

Labelled rows for training are a sample of bounded size (``LABELLED``). The documents that
the views label for each other are searched among all unlabelled ones: in each round Spark
scores every document with both models, and the surest of each view and class are brought
to the fit, at most ``PER_ROUND`` and one more of each view.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rosterflow.llm import linear, words, work

#: The bound of the labelled sample, by hash of the id.
LABELLED = 4000
CONTENT_BITS = 10
SOURCE_SLOTS, LANG_SLOTS = 32, 8
ROUNDS = 4
#: Documents that each view labels for the other in a round, and the least certainty for it.
PER_ROUND, SURE = 200, 0.95
CALIBRATION_FOLDS = 4
GOOD = 0.5

_KIND = np.zeros((256, 6), np.int64)  # upper, lower, digit, sign, space, line end
for _k, _chars in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", " \t\r\f\v", "\n")):
    _KIND[[ord(c) for c in _chars], _k] = 1
_LAYOUT = 4 + _KIND.shape[1]
#: Length of the metadata view.
_META = _LAYOUT + SOURCE_SLOTS + LANG_SLOTS


def _content(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The share of each hashed three-byte sequence in each text."""
    n, size = len(at) - 1, 1 << CONTENT_BITS
    if len(raw) < 3:
        return np.zeros((n, size), np.float32)
    wide = raw.astype(np.uint32)
    three = wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)
    slot = (three * np.uint32(2654435761)) >> np.uint32(32 - CONTENT_BITS)
    text = np.repeat(np.arange(n), np.diff(at))
    inside = text[:-2] == text[2:]
    counts = np.bincount(text[:-2][inside] * size + slot[inside], minlength=n * size).reshape(n, size)
    return (counts / np.maximum(np.diff(at) - 2, 1)[:, None]).astype(np.float32)


def _metadata(batch: pa.RecordBatch, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    n, size = len(at) - 1, np.diff(at)
    out = np.zeros((n, _META), np.float32)
    out[:, 0] = np.log1p(size)
    given = np.array([0 if v is None else max(int(v), 0) for v in batch["n_chars"].to_pylist()])
    out[:, 1] = np.log1p(given)
    for k in range(_KIND.shape[1]):
        sums = np.concatenate([[0], np.cumsum(_KIND[raw, k])])
        out[:, 2 + k] = (sums[at[1:]] - sums[at[:-1]]) / np.maximum(size, 1)
    found = words.split(raw, at, words.NOT_SPACE)
    hashes, n_words = found.hashes(), np.diff(found.first)
    again = (hashes[1:] == hashes[:-1]) & (found.text[1:] == found.text[:-1])
    out[:, _LAYOUT - 2] = np.bincount(found.text[1:][again], minlength=n) / np.maximum(n_words, 1)
    out[:, _LAYOUT - 1] = size / np.maximum(n_words, 1) / 100
    first = _LAYOUT
    for name, slots in (("source", SOURCE_SLOTS), ("lang", LANG_SLOTS)):
        slot = [0 if v is None else 1 + zlib.crc32(v.encode()) % (slots - 1) for v in batch[name].to_pylist()]
        out[np.arange(n), first + np.array(slot, np.int64)] = 1
        first += slots
    return out


def _views(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    raw, at = words.utf8(batch["text"])
    for i, j in words.runs(at):
        for k in range(i, j, 1000):
            m = min(j, k + 1000)
            part, own, offsets = batch.slice(k, m - k), raw[at[k] : at[m]], at[k : m + 1] - at[k]
            yield part, _content(own, offsets), _metadata(part, own, offsets)


def _labels(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, y`` of each labelled id. That of an id labelled twice is the more frequent one, 1 if even."""
    told = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    return told.groupBy("doc_id").agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("y"))


def sample(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """A bounded sample of the labelled ``docs`` with ``y``: of each chosen id the row of the least hash."""
    chosen = _labels(labels, label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    rows = docs.join(F.broadcast(chosen), "doc_id")  # at most LABELLED pairs of numbers
    columns = [c for c in docs.columns if c != "doc_id"]
    one = rows.groupBy("doc_id", "y").agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("row"))
    return one.select("doc_id", "row.*", "y")


#: Of one view and label: the features of documents in both views.
Found = tuple[list[np.ndarray], np.ndarray]


@dataclass
class CoTrained:
    """Two classifiers, their calibrations and the log odds of the labels."""

    models: list[linear.Logistic]
    scales: list[linear.Logistic]
    prior: float

    @classmethod
    def fit(cls, views: list[np.ndarray], y: np.ndarray, search: Callable[[list[linear.Logistic], int], list[Found]]) -> CoTrained:
        """``views`` and ``y`` of labelled rows. ``search(models, n_good)`` gives for each view the
        unlabelled documents it is surest of, and their labels; it finds a document in one round only."""
        held = linear.folds(len(y), CALIBRATION_FOLDS, seed=4) == 0
        seen, kept = np.flatnonzero(~held), np.flatnonzero(held)
        share = (y.sum() + 0.5) / (len(y) + 1)
        rows, told = [x[seen] for x in views], [y[seen], y[seen]]
        for _ in range(ROUNDS):
            models = [linear.fit(rows[v], told[v]) for v in (0, 1)]
            sure = search(models, max(1, round(PER_ROUND * share)))
            for v in (0, 1):  # each learns what the other is sure of
                found, label = sure[1 - v]
                rows[v], told[v] = np.concatenate([rows[v], found[v]]), np.concatenate([told[v], label])
            if not sum(len(label) for _, label in sure):
                break
        models = [linear.fit(rows[v], told[v]) for v in (0, 1)]
        scales = [linear.calibrate(models[v].logit(views[v][kept]), y[kept]) for v in (0, 1)]
        return cls(models, scales, float(np.log(share / (1 - share))))

    def score(self, views: list[np.ndarray]) -> np.ndarray:
        """(content, metadata, both) probabilities."""
        odds = [s.logit(m.logit(x)[:, None]) for m, s, x in zip(self.models, self.scales, views)]
        return np.column_stack([*(linear.sigmoid(o) for o in odds), linear.sigmoid(odds[0] + odds[1] - self.prior)])


_NEEDED = ("doc_id", "text", "lang", "source", "n_chars")


def _features(rows: DataFrame, *names: str) -> tuple[pa.Table, list[np.ndarray]]:
    """The columns ``names`` (long) of ``rows``, which are few, in order, and both views of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, content, metadata in _views(batch):
                packed = [pa.array([r.tobytes() for r in x], pa.binary()) for x in (content, metadata)]
                yield pa.RecordBatch.from_arrays([*(part[c] for c in names), *packed], [*names, "content", "metadata"])

    schema = ", ".join([*(f"{c} long" for c in names), "content binary, metadata binary"])
    table = rows.mapInArrow(run, schema).orderBy(*names, "metadata", "content").toArrow()
    widths = (1 << CONTENT_BITS, _META)
    return table, [np.frombuffer(b"".join(table[c].to_pylist()), np.float32).reshape(table.num_rows, w) for c, w in zip(("content", "metadata"), widths)]


class Search:
    """The surest of all unlabelled documents, each found in one round only.

    A document is an id, as its row of the least hash, or a row without an id. Of a round's
    table of logits, the surest of each view and class are taken by a distributed top-k.
    """

    def __init__(self, docs: DataFrame, labelled: DataFrame):
        columns = [c for c in _NEEDED if c != "doc_id"]
        self._docs = docs.select(F.col("doc_id").cast("long"), *columns, F.xxhash64(*columns).alias("tie"))
        self._labelled, self._used = labelled, []

    def logits(self, models: list[linear.Logistic]) -> DataFrame:
        """``doc_id, tie`` and the logits ``v0, v1`` of every unlabelled document."""
        shared = self._docs.sparkSession.sparkContext.broadcast(models)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, *views in _views(batch):
                    found = [pa.array(np.round(m.logit(x), 6)) for m, x in zip(shared.value, views)]
                    yield pa.RecordBatch.from_arrays([part["doc_id"], part["tie"], *found], ["doc_id", "tie", "v0", "v1"])

        rows = self._docs.mapInArrow(run, "doc_id long, tie long, v0 double, v1 double")
        own = F.when(F.col("doc_id").isNull(), F.col("tie")).alias("own")
        one = rows.groupBy("doc_id", own).agg(F.min("tie").alias("tie"), F.min_by("v0", "tie").alias("v0"), F.min_by("v1", "tie").alias("v1")).drop("own")
        return one.join(self._labelled.select("doc_id"), "doc_id", "left_anti")

    def __call__(self, models: list[linear.Logistic], n_good: int) -> list[Found]:
        spark, least = self._docs.sparkSession, float(np.log(SURE / (1 - SURE)))
        table = work.written(self.logits(models).where(F.greatest(F.abs("v0"), F.abs("v1")) >= least), "cotraining-logits")
        if self._used:
            used = spark.createDataFrame(self._used, "u_doc long, u_tie long")  # at most ROUNDS times those of a round
            table = table.join(F.broadcast(used), F.col("doc_id").eqNullSafe(F.col("u_doc")) & (F.col("tie") == F.col("u_tie")), "left_anti")
        parts = []
        for v in (0, 1):
            for label, sign, n in ((1, 1, n_good), (0, -1, max(1, PER_ROUND - n_good))):
                sure = F.col(f"v{v}") * sign
                best = table.where(sure >= least).orderBy(sure.desc(), "tie", "doc_id").limit(n)
                parts.append(best.select("doc_id", "tie", F.lit(v).alias("view"), F.lit(label).alias("label")))
        chosen = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).collect()
        keys = sorted({(r.doc_id, r.tie) for r in chosen}, key=lambda k: (k[0] is None, k))
        self._used += keys
        place, views = self._rows(keys)
        out = []
        for v in (0, 1):
            own = sorted((-r.label, place[r.doc_id, r.tie]) for r in chosen if r.view == v)
            at = np.array([k for _, k in own], np.int64)
            out.append(([x[at] for x in views], np.array([-label for label, _ in own], np.int64)))
        return out

    def _rows(self, keys: list[tuple[int | None, int]]) -> tuple[dict[tuple[int | None, int], int], list[np.ndarray]]:
        """The views of the documents ``keys``, and the place of each."""
        if not keys:
            return {}, [np.zeros((0, 1 << CONTENT_BITS), np.float32), np.zeros((0, _META), np.float32)]
        wanted = self._docs.sparkSession.createDataFrame(keys, "k_doc long, k_tie long")
        rows = self._docs.join(F.broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("k_doc")) & (F.col("tie") == F.col("k_tie")), "left_semi")
        columns = [c for c in _NEEDED if c != "doc_id"]
        one = rows.groupBy("doc_id", "tie").agg(*(F.first(c).alias(c) for c in columns))  # equal rows
        table, views = _features(one, "doc_id", "tie")
        return {(d, t): k for k, (d, t) in enumerate(zip(table["doc_id"].to_pylist(), table["tie"].to_pylist()))}, views


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality") -> CoTrained:
    """Both classifiers from ``docs (doc_id, text, lang, source, n_chars)`` and ``labels (doc_id, label)``."""
    docs = docs.select(*_NEEDED)
    table, views = _features(sample(docs, labels, label).withColumn("y", F.col("y").cast("long")), "doc_id", "y")
    y = table["y"].to_numpy().astype(np.int64)
    return CoTrained.fit(views, y, Search(docs, _labels(labels, label)))


def score(docs: DataFrame, model: CoTrained) -> DataFrame:
    """``docs`` with ``content_score, metadata_score, quality_score`` (0 to 1) and ``good``.

    Null texts count as empty; null metadata has a slot of its own; texts of any length are
    read whole. Without labels, or with labels of one class, all rows get the labels'
    smoothed share. Columns of ``docs`` that bear a name of the results, in any case, are
    replaced. Rows are scored one by one.
    """
    results = ["content_score", "metadata_score", "quality_score", "good"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Table]:
        for rows in batches:
            parts = [shared.value.score(views) for _, *views in _views(pa.RecordBatch.from_struct_array(rows))]
            p = np.concatenate([np.empty((0, 3)), *parts])
            yield pa.table([*(pa.array(c) for c in p.T), pa.array(p[:, 2] >= GOOD)], results)

    fields = StructType.fromDDL(", ".join([*(f"{r} double" for r in results[:3]), "good boolean"]))
    return work.with_fields(docs, work.of_text(run, fields)(F.struct("text", "source", "lang", "n_chars")), results)


def op4_co_training(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*_NEEDED)
    scored = score(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select("doc_id", "content_score", "metadata_score", "quality_score", "good")
