"""Roster-shaped views of the given tables, as DataFrames and as SQL text.

The DataFrame and the SQL form of each view say the same thing in the two languages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is asked for once, later reads reuse it."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _pick(value: Column, cases: dict[int, str], otherwise: str | None) -> Column:
    (first, label), *rest = cases.items()
    picked = F.when(value == first, F.lit(label))
    for number, label in rest:
        picked = picked.when(value == number, F.lit(label))
    return picked.otherwise(F.lit(otherwise).cast("string"))


def courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    suffix = _pick(
        key % 11,
        {0: "10", 1: "11", 2: "20", 3: "21", 4: "41", 5: "42", 6: "50", 7: "17", 8: "27", 9: "41V1"},
        "99",
    )
    rows = table(spark, sf_dir, "part")
    term, nrc = F.concat(F.lit("2026"), suffix), _text(key + 20000)
    size, part = F.lpad(_text("p_size"), 2, "0"), F.lpad(_text("p_partkey"), 4, "0")
    head = F.concat(F.lit("55"), size)
    return rows.select(F.concat_ws("-", head, part, term, nrc).alias("short_name"), nrc.alias("nrc"), term.alias("term"))


def _sold_courses(spark: SparkSession, sf_dir: str, items: DataFrame, cut: bool, tasks: int | None = None) -> DataFrame:
    """Line items of the parts that stand for a course, with its number and term.

    The given file has one row group, which one task reads; its rows are dealt by part
    before the text of the roster is built, so tasks grow in number and not in size, and a
    merge join with the courses needs no second shuffle. ``tasks`` deals them round robin
    over so many tasks instead, which decides the order of rows without a row number.
    """
    items = items.repartition(tasks) if tasks else items.repartition("l_partkey")
    listed = courses(spark, sf_dir)
    term = F.left("term", F.lit(6)) if cut else F.col("term")
    keyed = listed.select(
        (F.col("nrc").cast("bigint") - 20000).alias("pk"), F.col("nrc").alias("crosslist"), term.alias("term")
    )
    return items.join(keyed, F.col("pk") == F.col("l_partkey"))


def students(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """The student roster. Orders are joined with customers before line items are, so line items, the most rows, go through a join less.

    With ``tasks`` customers come last, as the order of rows without a row number follows from it.
    """
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    sold, of_order, of_buyer = _sold_courses(spark, sf_dir, items, True, tasks), F.col("l_orderkey") == F.col("o_orderkey"), F.col("o_custkey") == F.col("c_custkey")
    rows = sold.join(orders, of_order).join(people, of_buyer) if tasks else sold.join(orders.join(people, of_buyer), of_order)
    key = F.col("c_custkey")
    return rows.select(
        F.concat(F.lit("f"), _text(F.col("l_orderkey") % 3)).alias("src_file"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_no"),
        "term",
        _text(F.col("l_partkey") % 1000 + 30000).alias("section"),
        "crosslist",
        _text("c_custkey").alias("student_id"),
        _pick(key % 3, {0: "CC", 1: "TI"}, None).alias("doc_type"),
        F.when(key % 17 == 0, F.concat(F.lit("AB"), _text("c_custkey")))
        .otherwise(_text(key * 7919 + 10000000))
        .alias("doc_no"),
        F.when(key % 41 != 0, F.concat(F.lit("u"), _text("c_custkey"), F.lit("@example.org"))).alias("email"),
        F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" 3er ")).alias("first_name"),
        F.lit("o'neil-de la ñu").alias("last_name"),
        F.lit(None).cast("string").alias("enrol_code"),
        F.when(F.col("l_orderkey") % 37 == 0, F.lit(None).cast("string"))
        .when(F.col("l_returnflag") == "N", "Inscrito")
        .when(F.col("l_returnflag") == "A", "Cancelado")
        .otherwise("Eliminado")
        .alias("status"),
        F.col("l_shipdate").alias("activity_ts"),
        F.when(F.col("l_linestatus") == "O", "Y").otherwise("N").alias("paid"),
        _pick(key % 5, {0: "AP", 1: "BS", 2: "ZZ"}, None).alias("partner"),
        F.concat(F.lit("CC"), _text("c_nationkey")).alias("program_code"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    repeats = F.when(key % 50 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = table(spark, sf_dir, "customer").select("*", F.explode(repeats).alias("dup"))
    role = _pick(
        F.col("c_nationkey") % 8,
        {0: "135", 1: "136", 2: "137", 3: "138.0", 4: "143", 5: "150"},
        "110",
    )
    return rows.select(
        (key + F.col("dup") * F.lit(1000000000)).alias("row_no"),
        # a third of the directory is not in any roster
        _text(F.when(key % 3 == 0, key + 500000000).otherwise(key)).alias("user_name"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.when(F.col("dup") == 1, "150").otherwise(role).alias("org_role_id"),
        F.when(key % 4 == 0, "").otherwise(F.concat(F.lit("CC. "), _text("c_custkey"))).alias("org_defined_id"),
        F.concat(F.lit("u"), _text("c_custkey"), F.lit("@example.org")).alias("external_email"),
    )


def teachers(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"
    )
    staff = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    rows = _sold_courses(spark, sf_dir, items, cut=False).join(
        staff, F.col("l_suppkey") == F.col("s_suppkey")
    )
    key = F.col("s_suppkey")
    return rows.select(
        F.lit("f0").alias("src_file"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_no"),
        "term",
        _text(F.col("l_partkey") % 1000 + 30000).alias("section"),
        "crosslist",
        F.when(key % 23 == 0, "-")
        .when(key % 29 == 0, F.lit(None).cast("string"))
        .when(key % 2 == 0, F.concat(_text("s_suppkey"), F.lit(".0")))
        .otherwise(_text("s_suppkey"))
        .alias("teacher_id"),
        F.lit("CC").alias("doc_type"),
        _text(key * 104729 + 70000000).alias("doc_no"),
        F.concat(F.lit("t"), _text("s_suppkey"), F.lit("@example.org")).alias("email"),
        F.lower("s_name").alias("first_name"),
        F.lit("pérez gómez").alias("last_name"),
        F.col("l_shipdate").alias("activity_ts"),
    )


def coordinators(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    repeats = F.when(key % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = table(spark, sf_dir, "nation").select("*", F.explode(repeats).alias("dup"))
    return rows.select(
        (key + F.col("dup") * 100).alias("row_no"),
        F.concat(F.lit("CC"), _text("n_nationkey")).alias("cost_centre"),
        F.when(key % 11 == 3, "-")
        .when(F.col("dup") == 1, _text(key + 800000))
        .when(key % 7 == 0, "-")
        .when(key % 2 == 0, _text(key * 3 + 1))
        .otherwise(_text(key + 900000))
        .alias("coordinator_id"),
        F.col("n_name").alias("coordinator_name"),
        F.concat(F.lit("k"), _text("n_nationkey"), F.lit("@example.org")).alias("coordinator_email"),
    )


def course_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.col("page_id")
    home = F.concat(F.lit("  https://lms.example.org/home/"), _text(page * 10 + 20000), F.lit(" "))
    link = F.when(page % 6 == 0, F.col("url")).when(page % 13 == 5, F.lit(None).cast("string")).otherwise(home)
    return table(spark, sf_dir, "pages").select(page.alias("row_no"), link.alias("link"))


VIEWS_SQL = """
fx_courses AS (
  SELECT concat('55', lpad(cast(p_size AS VARCHAR), 2, '0'), '-', lpad(cast(p_partkey AS VARCHAR), 4, '0'), '-', term, '-', nrc) AS short_name,
         nrc, term
  FROM (SELECT p_partkey, p_size, cast(20000 + p_partkey AS VARCHAR) AS nrc,
               concat('2026', CASE p_partkey % 11 WHEN 0 THEN '10' WHEN 1 THEN '11' WHEN 2 THEN '20'
                 WHEN 3 THEN '21' WHEN 4 THEN '41' WHEN 5 THEN '42' WHEN 6 THEN '50' WHEN 7 THEN '17' WHEN 8 THEN '27'
                 WHEN 9 THEN '41V1' ELSE '99' END) AS term
        FROM part) t),
fx_students AS (
  SELECT concat('f', cast(l.l_orderkey % 3 AS VARCHAR)) AS src_file,
         l.l_orderkey * 10 + l.l_linenumber AS row_no,
         k.term6 AS term, cast(30000 + l.l_partkey % 1000 AS VARCHAR) AS section, k.nrc AS crosslist,
         cast(c.c_custkey AS VARCHAR) AS student_id,
         CASE c.c_custkey % 3 WHEN 0 THEN 'CC' WHEN 1 THEN 'TI' ELSE NULL END AS doc_type,
         CASE WHEN c.c_custkey % 17 = 0 THEN concat('AB', cast(c.c_custkey AS VARCHAR))
              ELSE cast(10000000 + c.c_custkey * 7919 AS VARCHAR) END AS doc_no,
         CASE WHEN c.c_custkey % 41 <> 0 THEN concat('u', cast(c.c_custkey AS VARCHAR), '@example.org') END AS email,
         concat(' ', lower(c.c_mktsegment), ' 3er ') AS first_name, 'o''neil-de la ñu' AS last_name,
         cast(NULL AS VARCHAR) AS enrol_code,
         CASE WHEN l.l_orderkey % 37 = 0 THEN NULL WHEN l.l_returnflag = 'N' THEN 'Inscrito' WHEN l.l_returnflag = 'A' THEN 'Cancelado' ELSE 'Eliminado' END AS status,
         l.l_shipdate AS activity_ts,
         CASE WHEN l.l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS paid,
         CASE c.c_custkey % 5 WHEN 0 THEN 'AP' WHEN 1 THEN 'BS' WHEN 2 THEN 'ZZ' ELSE NULL END AS partner,
         concat('CC', cast(c.c_nationkey AS VARCHAR)) AS program_code
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN (SELECT nrc, left(term, 6) AS term6, cast(nrc AS bigint) - 20000 AS pk FROM fx_courses) k
    ON k.pk = l.l_partkey),
fx_users AS (
  SELECT c_custkey + dup * 1000000000 AS row_no, cast(CASE WHEN c_custkey % 3 = 0 THEN c_custkey + 500000000 ELSE c_custkey END AS VARCHAR) AS user_name, c_name AS first_name, c_mktsegment AS last_name,
         CASE WHEN dup = 1 THEN '150' ELSE CASE c_nationkey % 8 WHEN 0 THEN '135' WHEN 1 THEN '136' WHEN 2 THEN '137'
           WHEN 3 THEN '138.0' WHEN 4 THEN '143' WHEN 5 THEN '150' ELSE '110' END END AS org_role_id,
         CASE WHEN c_custkey % 4 = 0 THEN '' ELSE concat('CC. ', cast(c_custkey AS VARCHAR)) END AS org_defined_id,
         concat('u', cast(c_custkey AS VARCHAR), '@example.org') AS external_email
  FROM customer CROSS JOIN (SELECT 0 AS dup UNION ALL SELECT 1 AS dup) d
  WHERE dup = 0 OR c_custkey % 50 = 1),
fx_teachers AS (
  SELECT 'f0' AS src_file, l.l_orderkey * 10 + l.l_linenumber AS row_no, k.term AS term,
         cast(30000 + l.l_partkey % 1000 AS VARCHAR) AS section, k.nrc AS crosslist,
         CASE WHEN s.s_suppkey % 23 = 0 THEN '-' WHEN s.s_suppkey % 29 = 0 THEN NULL
              WHEN s.s_suppkey % 2 = 0 THEN concat(cast(s.s_suppkey AS VARCHAR), '.0') ELSE cast(s.s_suppkey AS VARCHAR) END AS teacher_id,
         'CC' AS doc_type, cast(70000000 + s.s_suppkey * 104729 AS VARCHAR) AS doc_no,
         concat('t', cast(s.s_suppkey AS VARCHAR), '@example.org') AS email, lower(s.s_name) AS first_name,
         'pérez gómez' AS last_name, l.l_shipdate AS activity_ts
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN (SELECT nrc, term, cast(nrc AS bigint) - 20000 AS pk FROM fx_courses) k ON k.pk = l.l_partkey),
fx_coordinators AS (
  SELECT n_nationkey + dup * 100 AS row_no, concat('CC', cast(n_nationkey AS VARCHAR)) AS cost_centre,
         CASE WHEN n_nationkey % 11 = 3 THEN '-' WHEN dup = 1 THEN cast(800000 + n_nationkey AS VARCHAR) WHEN n_nationkey % 7 = 0 THEN '-'
              WHEN n_nationkey % 2 = 0 THEN cast(n_nationkey * 3 + 1 AS VARCHAR) ELSE cast(900000 + n_nationkey AS VARCHAR) END AS coordinator_id,
         n_name AS coordinator_name, concat('k', cast(n_nationkey AS VARCHAR), '@example.org') AS coordinator_email
  FROM nation CROSS JOIN (SELECT 0 AS dup UNION ALL SELECT 1 AS dup) d
  WHERE dup = 0 OR n_nationkey % 5 = 0),
fx_course_links AS (
  SELECT page_id AS row_no,
         CASE WHEN page_id % 6 = 0 THEN url WHEN page_id % 13 = 5 THEN NULL
              ELSE concat('  https://lms.example.org/home/', cast(20000 + page_id * 10 AS VARCHAR), ' ') END AS link
  FROM pages)
"""
