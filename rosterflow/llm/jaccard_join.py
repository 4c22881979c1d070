"""Near duplicates: documents whose word-shingle sets have a Jaccard similarity of 0.75 or more.

1. Shingles are counted over all documents (``tally``). A shingle that one set alone holds
   cannot be shared, so a set with fewer than 75 % of shared shingles has no partner; most
   documents end here. Equal sets are one class.
2. Token-combination prefixes. A set's shared shingles are ordered by how many sets hold
   them. Of ``n`` shingles, ``n - ceil(0.75 n)`` can be missing from a partner, so enough of
   the first shingles form a *prefix* that no partner can miss. Rare shingles are indexed
   one by one. Frequent ones are dealt into classes by hash, and each class is indexed by
   the combinations of ``K`` of its prefix shingles: a class of ``x`` has no combination left
   only when ``x - K + 1`` of it are missing, so the prefix is extended until
   ``rare + sum(x - K + 1) > n - ceil(0.75 n)``. Two prefixes with that property share a
   key. A set that is too small for it is indexed by single shingles too, among its like.
   The number of classes goes with the size of the set, which bounds the combinations by
   a small multiple of the prefix.
3. Verification. Sets that share a key are candidates. Components need no links within a
   component, so a key's sets are first compared with one pivot, twice; then pairs of sets
   that share a key but lie in different components are compared.
4. Crowded keys. Where more than ``CROWD`` sets of a key are still outside its largest
   component, its sets share a passage rather than a text. All such sets are indexed anew,
   among themselves: shingles that the same sets hold are one weighted *atom*, so that a
   passage counts once, and keys are combinations of ``k`` atoms of a prefix that no partner
   can miss, within bounds of length and position. ``k`` grows from 1 to ``MOST_K``: sets
   whose keys are no longer crowded are compared and leave. So do sets, with all others of
   their keys, that may have no more than ``k`` atoms in common with a partner, or have too
   many combinations of more. Nothing is left out.

Shingles are 64-bit hashes of words; sets are equal if the sizes and two sums over 64-bit
hashes are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.llm import tally, words, work
from rosterflow.llm.components import connected_components

SHINGLE_WORDS = 5
PERCENT = 75
#: Shingles in at most so many sets are rare.
RARE = 20
K = 2
PIVOT_ROUNDS = 2
#: Sets outside a key's largest component from which on they are indexed by atoms.
CROWD = 8
#: Atoms in a key, and keys of a set with two atoms or more each.
MOST_K, MOST_KEYS = 4, 256
_SETS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("set_id", pa.binary()), ("shared", pa.binary()), ("n_rare", pa.int32()), ("weight", pa.float64())])
_SETS_DDL = "doc_id long, text_key long, n long, set_id binary, shared binary, n_rare int, weight double"


def _least_overlap(n: int) -> int:
    return -(-PERCENT * n // 100)


def _block_sets(table: pa.Table, n_words: int):
    """Of a block: (text, shingle) by text, and each text's first shingle; texts with equal sets; set ids."""
    raw, at = words.utf8(table["text"])
    texts, values = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for i, j in words.runs(at):
        found = words.split(words.folded(raw[at[i] : at[j]]), at[i : j + 1] - at[i], words.NOT_SPACE)
        text, value = words.shingles(found, n_words)
        texts.append(text + i)
        values.append(value)
    text, value = np.concatenate(texts), np.concatenate(values)
    first = np.searchsorted(text, np.arange(len(at)))
    size = np.diff(first)
    full = np.flatnonzero(size)
    sums = np.zeros((len(size), 3), np.uint64)
    if len(full):
        for k, seed in enumerate((1, 2)):
            sums[full, k] = np.add.reduceat(words.mix(value + np.uint64(seed)), first[full])
    sums[:, 2] = size
    _, earliest = np.unique(sums, axis=0, return_index=True)
    head = np.zeros(len(size), bool)
    head[earliest] = True
    return text, value, first, head & (size > 0), sums


def shingle_sets(docs: DataFrame, n_words: int, block_chars: int) -> DataFrame:
    """``doc_id, text_key, n, set_id, shared, n_rare, weight`` of each row. ``shared``: the shingles that other
    sets hold too, rare ones first, for sets that can have a partner (one row of a block). ``weight``: how many sets hold a
    shingle of this one, on average."""
    docs = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key"))
    plan = tally.Plan.of(docs, block_chars, narrow=True)
    blocks = plan.blocks(docs)

    def keys(table: pa.Table):
        text, value, _, head, _ = _block_sets(table, n_words)
        return np.unique(plan.short(value[head[text]]), return_counts=True)

    def then(table: pa.Table, told: tally.Totals) -> pa.Table:
        text, value, first, head, ids = _block_sets(table, n_words)
        held = np.zeros(len(value), np.int64)
        own = head[text]
        held[own] = told.of(plan.short(value[own]))
        n_shared = np.bincount(text[held > 1], minlength=len(head))
        size = np.diff(first)
        shared: list[bytes | None] = [None] * len(head)
        n_rare = np.zeros(len(head), np.int32)
        for k in np.flatnonzero(head & (100 * n_shared >= PERCENT * size)):
            h, c = value[first[k] : first[k + 1]], held[first[k] : first[k + 1]]
            order = np.lexsort((h, c))
            order = order[c[order] > 1]
            shared[k] = h[order].astype("<u8").tobytes()
            n_rare[k] = int((c[order] <= RARE).sum())
        weight = np.bincount(text, held, len(head)) / np.maximum(size, 1)
        set_ids = pa.array([i.tobytes() if s else None for i, s in zip(ids, size)], pa.binary())
        return pa.table([table["doc_id"], table["text_key"], pa.array(size, pa.int64()), set_ids, pa.array(shared, pa.binary()), pa.array(n_rare, pa.int32()), pa.array(weight)], schema=_SETS)

    return tally.with_totals(blocks, tally.totals(blocks, keys, plan), keys, then, _SETS_DDL, plan)


@lru_cache(maxsize=64)
def _choices(n: int, k: int) -> np.ndarray:
    return np.array(list(combinations(range(n), k)), np.int64).reshape(-1, k)


def _band(n: int) -> int:
    return (max(n, 1).bit_length() - 1) // 2


def prefix_keys(n: int, shared: np.ndarray, n_rare: int, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """The index keys of a set of ``n`` shingles, of which other sets hold ``shared`` (in order).

    The level of a key is how many shingles of the set must be missing from a partner before
    the prefix has to hold that key. Two sets that overlap in ``o`` shingles share a key whose
    level is at most ``n - o + 1`` on both sides.
    """
    needed = len(shared) - _least_overlap(n) + 1
    if needed < 1:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    keys, levels = [], []
    # partners have up to n / 0.75 shingles; both sets of a pair use the classes of one band
    for band in {_band(n), _band(100 * n // PERCENT)}:
        seed = np.uint64(band * 8)
        rare = shared[: min(n_rare, needed)]
        keys.append(words.mix(rare + seed))
        levels.append(np.arange(len(rare)))
        rest = needed - len(rare)
        if not rest:
            continue
        often = shared[n_rare:]
        kind = (words.mix(often) % np.uint64(max(1, 4 ** (band + 1) // 32))).astype(np.int64)
        order = np.argsort(kind, kind="stable")
        begins = np.flatnonzero(np.diff(kind[order], prepend=-1))
        place = np.arange(len(often)) - np.repeat(begins, np.diff(begins, append=len(often)))
        counts = np.zeros(len(often), np.int64)
        counts[order] = place >= k - 1
        reach = np.cumsum(counts)
        last = int(np.searchsorted(reach, rest)) if len(reach) and reach[-1] >= rest else len(often)
        if last == len(often):
            keys.append(words.mix(shared[:needed] + seed + np.uint64(2)))
            levels.append(np.arange(needed))
        prefix = order[order <= last]
        for group in np.split(prefix, np.flatnonzero(np.diff(kind[prefix])) + 1):
            if len(group) >= k:
                chosen = group[_choices(len(group), k)]
                keys.append(words.mix(words.mix(often[chosen]).sum(axis=1) + seed + np.uint64(1)))
                at = chosen.max(axis=1)
                levels.append(len(rare) + reach[at] - counts[at])
    key, level = np.concatenate(keys), np.concatenate(levels) + 1 + n - len(shared)
    order = np.lexsort((level, key))
    key, level = key[order], level[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return key[new], level[new]


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, waiting, size = ["node", "key", "n", "level"], [], 0
    for batch in batches:
        for node, n, packed, n_rare in zip(*(batch[c].to_pylist() for c in ("node", "n", "shared", "n_rare"))):
            own, level = prefix_keys(n, np.frombuffer(packed, "<u8"), n_rare)
            waiting.append((np.full(len(own), node), own.view(np.int64), np.full(len(own), n), level))
            size += len(own)
            if size > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*waiting)], names)
                waiting, size = [], 0
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*waiting)], names)


def _can_link(n_a: str, level_a: str, n_b: str, level_b: str) -> Column:
    """Whether two sets that share such a key may link: their least overlap puts the key into both prefixes."""
    least = F.ceil(F.lit(PERCENT) * (F.col(n_a) + F.col(n_b)) / (100 + PERCENT))
    return (F.col(level_a) <= F.col(n_a) - least + 1) & (F.col(level_b) <= F.col(n_b) - least + 1)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that link."""
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("shared").alias(f"set_{side}")), side)
    pairs = pairs.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(batch[c].to_pylist() for c in ("n_a", "n_b", "set_a", "set_b"))):
                both = np.sort(np.concatenate([np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")]))
                overlap = int((both[1:] == both[:-1]).sum())
                keep.append(100 * overlap >= PERCENT * (n + m - overlap))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, n_words: int = SHINGLE_WORDS, block_chars: int = tally.BLOCK_CHARS) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, stays`` of each row of ``docs (doc_id, text)``.

    Words are `[^\\x20\\x09-\\x0D]+` of the text with A-Z lower-cased. A text with fewer than
    ``n_words`` words has its whole sequence as one shingle. Without words (null, empty or
    blank) the set is empty and links with nothing. Repeated rows and equal texts are in one
    component. A row without an id is in its component, whose id is the least that is
    there (null if none is). ``stays`` is true for the least id of a component (then the
    least ``text_key``, a hash of the text) and for empty sets; exactly repeated rows share
    it. Other columns are ignored; an empty table gives no rows.
    """
    rows = work.written(shingle_sets(docs, n_words, block_chars), "shingle-sets")
    held = rows.where("shared is not null").groupBy("set_id").agg(*(F.first(c).alias(c) for c in ("n", "shared", "n_rare", "weight")))
    # numbered from the most typical set on: the text that others are copies of comes before them
    sets = work.written(held.orderBy(F.desc("weight"), "set_id").withColumn("node", F.monotonically_increasing_id()), "set-classes")
    index = work.written(sets.select("node", "n", "shared", "n_rare").mapInArrow(_keys, "node long, key long, n long, level long"), "prefix-index")

    links, component = None, None
    for turn in range(PIVOT_ROUNDS + 1):
        label: Column = F.col("node")
        if component is not None:
            index, label = index.join(component, "node", "left"), F.coalesce("component", "node")
        index = index.select("node", "key", "n", "level", label.alias("label"))
        alive = index.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min_by("label", "node").alias("main")).where("lo < hi")
        index = work.written(index.join(alive.select("key", "main"), "key"), "prefix-index")
        if index.isEmpty():
            break
        if turn < PIVOT_ROUNDS:
            pairs = _with_pivot(index, turn)
        else:
            pairs = _across(index, sets)
        found = work.written(_verified(pairs.distinct(), sets), "links")
        links = found if links is None else links.unionByName(found)
        component = work.written(connected_components(links), "components")
        index = index.select("node", "key", "n", "level")

    named = rows
    if component is None:
        named = named.withColumn("class", F.col("set_id"))
    else:
        whole = sets.join(component, "node").select("set_id", F.col("component").cast("string").cast("binary").alias("whole"))
        named = named.join(whole, "set_id", "left").withColumn("class", F.coalesce("whole", "set_id"))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    least = named.where("class is not null").groupBy("class").agg(F.min(order).alias("least"))
    named = named.join(least, "class", "left").withColumn("full", F.col("n") > 0)
    component_id = F.when(F.col("full"), F.col("least.doc_id")).otherwise(F.col("doc_id"))
    stays = ~F.col("full") | (order == F.col("least"))
    return named.select("doc_id", "text_key", F.col("n").alias("n_shingles"), component_id.alias("component_id"), stays.alias("stays"))


def _with_pivot(index: DataFrame, turn: int) -> DataFrame:
    """Pairs of each key's pivot and its sets of other components: first the most typical set, later one outside its component."""
    named = F.struct("node", "label", "n", "level")
    if turn:
        pivot = index.where("label <> main").groupBy("key").agg(F.min_by(named, F.xxhash64("node", F.lit(turn))).alias("pivot"))
    else:
        pivot = index.groupBy("key").agg(F.min(named).alias("pivot"))
    pivot = pivot.select("key", *(F.col(f"pivot.{c}").alias(f"{c}_x") for c in ("node", "label", "n", "level")))
    return _pairs(index, pivot)


def _across(index: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of sets that share a key but not a component: those outside a key's largest component with all
    others, and where many are outside, the pairs that atoms find."""
    index = _with_outside(index.select("node", "key", "n", "level", "label"))
    index = work.written(index, "prefix-index")
    crowded = index.where(F.col("outside") > CROWD).select("node", "n", "label").distinct()
    crowded = work.written(crowded, "crowded-sets")
    index = index.join(crowded.select("node", F.lit(True).alias("crowded")), "node", "left").withColumn("crowded", F.col("crowded").isNotNull())
    few = index.where(F.col("outside") <= CROWD)
    pairs = _pairs(few, _named_x(few.where("label != main"), "crowded"), ~(F.col("crowded") & F.col("crowded_x")))
    if crowded.isEmpty():
        return pairs
    left = work.written(set_atoms(crowded, sets), "set-atoms")
    for k in range(1, MOST_K + 1):
        # written first: both sides of the join with the sizes of keys read them
        keyed = work.written(left.mapInArrow(partial(_atom_key_rows, k), "node long, key long, n long, level long, top boolean, label long"), "atom-keys")
        atoms = work.written(_with_outside(keyed).where("outside > 0"), "atom-index")
        onward = work.written(atoms.where(F.col("outside") > CROWD).where("not top").select("node").distinct(), "crowded-sets")
        # two sets that go on have more than k atoms in common if they link, so a later k compares them
        atoms = atoms.join(onward.select("node", F.lit(True).alias("goes")), "node", "left").withColumn("goes", F.col("goes").isNotNull())
        few, many = atoms.where(F.col("outside") <= CROWD), atoms.where(F.col("outside") > CROWD)
        pairs = pairs.unionByName(_pairs(few, _named_x(few.where("label != main"), "goes"), ~(F.col("goes") & F.col("goes_x"))))
        for some, others in ((many, many.where("label != main and top")), (many.where("top"), many.where("label != main and not top"))):
            pairs = pairs.unionByName(_pairs(some, _named_x(others)))
        if onward.isEmpty():
            break
        left = left.join(onward, "node", "left_semi")
    return pairs


def _with_outside(index: DataFrame) -> DataFrame:
    """``index`` with each key's ``main`` component and the number of sets ``outside`` it."""
    sizes = index.groupBy("key", "label").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("key").agg(F.max_by("label", "size").alias("main"), (F.sum("size") - F.max("size")).alias("outside"))
    return index.join(largest, "key")


def set_atoms(crowded: DataFrame, sets: DataFrame) -> DataFrame:
    """``node, n, label`` of the sets ``crowded`` and, as arrays, their atoms: ``sets`` that hold it, ``atom``, ``weight``."""
    chosen = sets.join(crowded.select("node"), "node", "left_semi").select("node", "shared")
    held = chosen.mapInArrow(_shingle_rows, "node long, shingle long")
    # an atom is named by the sets that hold it; what one set alone holds links nothing
    holders = (F.bit_xor(F.xxhash64("node", F.lit(k))) for k in (1, 2))
    named = held.groupBy("shingle").agg(F.count("*").alias("sets"), F.xxhash64(*holders).alias("atom")).where("sets > 1")
    weighed = held.join(named, "shingle").groupBy("node", "atom").agg(F.first("sets").alias("sets"), F.count("*").alias("weight"))
    listed = weighed.groupBy("node").agg(F.collect_list(F.struct("sets", "atom", "weight")).alias("atoms"))
    return crowded.join(listed, "node").select("node", "n", "label", *(F.col(f"atoms.{c}").alias(c) for c in ("sets", "atom", "weight")))


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for node, packed in zip(batch["node"].to_pylist(), batch["shared"].to_pylist()):
            own = np.frombuffer(packed, "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), node)), pa.array(own)], ["node", "shingle"])


def _prefix(weights: np.ndarray, missing: int, k: int) -> tuple[int, bool]:
    """The fewest first atoms of which ``k`` stay whatever atoms of at most the weight ``missing`` go; whether any do."""

    def stay(p: int) -> int:
        return p - int(np.searchsorted(np.cumsum(np.sort(weights[:p])), missing, side="right"))

    if stay(len(weights)) < k:
        return len(weights), False
    low, high = k, len(weights)
    while low < high:
        half = (low + high) // 2
        low, high = (low, half) if stay(half) >= k else (half + 1, high)
    return low, True


def atom_keys(n: int, sets: np.ndarray, atom: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Keys of ``k`` atoms and their levels, of a set of ``n`` shingles with these atoms, each held by ``sets`` sets.

    Sets with ``k`` or more common atoms share the key of their first ``k``, whose level on each
    side is one more than the shingles that are surely not common. The last value is true if
    the set has no keys of more atoms: it is not sure to share them with every partner, or
    has too many.
    """
    order = np.lexsort((atom, sets))
    atom, weight = atom[order].view(np.uint64), weight[order]
    own = n - int(weight.sum())
    missing = n - _least_overlap(n) - own
    if missing < 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), True
    p, _ = _prefix(weight, missing, k)
    chosen = _choices(p, k)
    key = words.mix(words.mix(atom[chosen]).sum(axis=1) + np.uint64(k))
    level = own + 1 + np.cumsum(weight)[chosen[:, -1]] - weight[chosen].sum(axis=1)
    longer, sure = _prefix(weight, missing, k + 1)
    return key, level, k == MOST_K or not sure or math.comb(longer, k + 1) > MOST_KEYS


def _atom_key_rows(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for node, n, label, *atoms in zip(*(batch[c].to_pylist() for c in ("node", "n", "label", "sets", "atom", "weight"))):
            key, level, top = atom_keys(n, *(np.array(a, np.int64) for a in atoms), k)
            same = [np.full(len(key), v, np.int64) for v in (node, n, label)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (same[0], key.view(np.int64), same[1], level, np.full(len(key), top), same[2])], ["node", "key", "n", "level", "top", "label"])


def _named_x(index: DataFrame, *more: str) -> DataFrame:
    return index.select("key", *(F.col(c).alias(f"{c}_x") for c in ("node", "label", "n", "level", *more)))


def _pairs(index: DataFrame, others: DataFrame, also: Column | None = None) -> DataFrame:
    near = (F.col("label") != F.col("label_x")) & _can_link("n", "level", "n_x", "level_x")
    pairs = index.join(others, "key").where(near if also is None else near & also)
    return pairs.select(F.least("node", "node_x").alias("a"), F.greatest("node", "node_x").alias("b"))


def op5_shingle_components(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")


SQL = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + {SHINGLE_WORDS - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE_WORDS - 2}, 2))) AS p FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {PERCENT} * (x.n + y.n - c)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM t UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id WHERE r.c < l.b)
SELECT t.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r.c) AS component_id FROM t LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY ALL
"""
