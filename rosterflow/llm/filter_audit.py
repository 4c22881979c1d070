"""What each filter of a corpus removes, alone and in every order of all filters.

Four filters look at one text. The fifth, copies, is an existential self-join: a left-semi
join on the hash, the exact text and a smaller doc_id marks the documents of which an
earlier one has the same text. The other side is reduced to the least id of each text by an
aggregate that is combined before its shuffle, so a text that a third of all documents have
is one row there, and its documents are rows that Spark can split. Hashes that one id alone
has leave before any text is joined.

The marked ids and the ids that fail the others are united, and rows become counts by
part and *combination* of failures: at most 32 a part. All orders follow from these.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm import work

FILTERS = "ABCDE"
MIN_WORDS = 50
#: Least percentage of distinct words; greatest percentage of capitals.
DISTINCT_PERCENT, CAPITAL_PERCENT = 65, 5
SIGNS = "[#$%&*|]"
_COPY = 1 << FILTERS.index("E")
_WORD = r"[^\x20\x09-\x0D]+"


def text_failures(text: Column) -> Column:
    """Bits of the filters A to D that ``text`` (not null) fails."""
    tokens = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [
        F.size(tokens) < MIN_WORDS,
        100 * F.size(F.array_distinct(tokens)) < DISTINCT_PERCENT * F.size(tokens),
        100 * capitals > CAPITAL_PERCENT * F.length(text),
        text.rlike(SIGNS),
    ]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def copies(docs: DataFrame, hashed: DataFrame) -> DataFrame:
    """The rows of ``docs (doc_id, hash, text, ...)`` whose text a smaller ``doc_id`` has too; ``hashed`` holds all ``(doc_id, hash)``."""
    shared = hashed.groupBy("hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("hash").hint("merge")  # the same join at every size
    some = work.written(docs.join(shared, "hash", "left_semi"), "suspected-copies")
    first = some.groupBy("hash", "text").agg(F.min("doc_id").alias("first"))
    a, b = some.alias("a"), first.alias("b")
    return a.join(b, (F.col("a.hash") == F.col("b.hash")) & (F.col("a.text") == F.col("b.text")) & (F.col("b.first") < F.col("a.doc_id")), "left_semi")


def _steps(spark: SparkSession) -> DataFrame:
    """``filter_order, step, bit, before`` of each step of each order; ``before``: bits of the filters applied already."""
    rows = []
    for order in itertools.permutations(range(len(FILTERS))):
        for step, k in enumerate(order):
            rows.append(("".join(FILTERS[i] for i in order), step + 1, 1 << k, sum(1 << i for i in order[:step])))
    return spark.createDataFrame(rows, "filter_order string, step int, bit int, before int")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, fails, n, good, toxic``: documents of each part by the bits of the filters that they fail."""
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("hash", F.xxhash64("text"))
    own = work.written(keyed.select("doc_id", "hash", "part", text_failures(F.col("text")).alias("fails")), "text-failures")
    marked = copies(keyed, own.select("doc_id", "hash")).select("doc_id", "hash", "part").distinct()
    both = own.withColumn("rows", F.lit(1).cast("long")).unionByName(marked.select("*", F.lit(_COPY).alias("fails"), F.lit(0).cast("long").alias("rows")))
    of_row = both.groupBy("doc_id", "hash", "part").agg(F.bit_or("fails").alias("fails"), F.sum("rows").alias("rows"))
    yes = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("long")).alias(c)
    label = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(yes("quality"), yes("toxic"))
    told = of_row.join(label, "doc_id", "left")
    total = lambda c: F.sum(F.col("rows") * F.coalesce(F.col(c), F.lit(0).cast("long")))
    return told.groupBy("part", "fails").agg(F.sum("rows").alias("n"), total("quality").alias("good"), total("toxic").alias("toxic"))


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of each part of ``docs (doc_id, text, source)`` at each step of each order of the filters.

    Filters: A under 50 words (`[^\\x20\\x09-\\x0D]+`), B few distinct words, C many capitals,
    D signs, E the text of a smaller ``doc_id``. ``kept``: documents that remain after the step;
    ``removed``: those it removes; ``redundant``: those failing its filter that went earlier;
    ``unique_fails``: those failing it alone; ``good_lost`` and ``toxic_lost``: those removed
    with ``labels (doc_id, quality, toxic)`` of 1; ``shapley``: what its filter removes, summed
    over all 120 orders (in which it comes first of ``k`` failed ones ``120 / k`` times).

    A null text is empty, so null and empty texts are copies of each other; a null source is
    the part ``''``. A row without an id is no copy and has no copies. Rows of one id are not
    copies of each other; repeated rows count each. A document is good (toxic) if any of its
    labels says so; labels without an id, and null ones, say nothing. Texts of any length are
    read whole. Other columns are ignored. An empty table has no parts and gives no rows.
    """
    found = combinations(docs, labels)
    steps = _steps(docs.sparkSession)
    asked = F.array(*(F.struct(F.lit(1 << k).alias("bit"), F.lit(b).alias("before")) for k in range(len(FILTERS)) for b in range(1 << len(FILTERS)) if not b >> k & 1))
    each = found.withColumn("ask", F.explode(asked)).select("part", "fails", "n", "good", "toxic", "ask.bit", "ask.before")
    has, gone = F.col("fails").bitwiseAND(F.col("bit")) > 0, F.col("fails").bitwiseAND(F.col("before")) > 0
    total = lambda where, what: F.sum(F.when(where, F.col(what)).otherwise(F.lit(0).cast("long")))
    orders = F.expr(f"cast({math.factorial(len(FILTERS))} div nullif(bit_count(fails), 0) as long)")
    measured = each.groupBy("part", "bit", "before").agg(
        total(~has & ~gone, "n").alias("kept"),
        total(has & ~gone, "n").alias("removed"),
        total(has & gone, "n").alias("redundant"),
        total(F.col("fails") == F.col("bit"), "n").alias("unique_fails"),
        total(has & ~gone, "good").alias("good_lost"),
        total(has & ~gone, "toxic").alias("toxic_lost"),
        F.sum(F.when(has, F.col("n") * orders).otherwise(F.lit(0).cast("long"))).alias("shapley"),
    )
    return measured.join(steps, ["bit", "before"]).drop("bit", "before").select("part", "filter_order", "step", *measured.columns[3:])


def op12_existential_copies(spark, sf_dir: str) -> DataFrame:
    return interactions(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM t GROUP BY text),
lab AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (CASE WHEN len(w) < {MIN_WORDS} THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < {DISTINCT_PERCENT} * len(w) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {CAPITAL_PERCENT} * length(text) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(text, '{SIGNS}') THEN 8 ELSE 0 END) + (CASE WHEN first < doc_id THEN 16 ELSE 0 END) AS fails
  FROM t JOIN firsts USING (text) LEFT JOIN lab USING (doc_id)),
x AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(c, bit)),
o AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM x a, x b, x c, x d, x e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[:step - 1]), 0)::INT AS before FROM o, range(1, 6) r(step)),
g AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
m AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN fails & (bit | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN fails & bit > 0 AND fails & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN fails & bit > 0 AND fails & before > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN fails = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN fails & bit > 0 AND fails & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN fails & bit > 0 AND fails & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM g, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM m
"""
