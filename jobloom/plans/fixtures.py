"""Job-shaped tables derived from the generic test tables.

The test tables hold no job titles and no ``/career/`` links, so the queries
derive them with fixed rules that DuckDB can repeat exactly (see the oracle SQL
in ``__spark_entry__``). Every derived table is a plan over a driver table and
grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.functions.urls import site_origin
from jobloom.operators.enrich import enrich

# ----------------------------------------------------------------- FIXED VALUES
# Title recipe: level[key % 9] + ' ' + role[key % 13], description extra[key % 6].
LEVELS = ["Senior", "Junior", "Lead", "Principal", "Staff", "Intern", "Head of", "VP", ""]
ROLES = ["Backend Engineer", "Product Manager", "UX Designer", "HR Business Partner",
         "Data Engineer (Python, SQL)", "Sales Manager", "QA Engineer II", "DevOps Engineer",
         "Accountant", "Motion Artist", "C++ Developer", "Full-Stack Developer",
         "International Partnerships"]
EXTRAS = ["", "5+ years experience", "3-5 years", "minimum 7yrs", "2 years of Kafka", "10 years"]
MESSAGE_ROWS = 50
MESSAGE_TOPIC = "jobs"
MESSAGE_PARTITIONS = 3
# ----------------------------------------------------------------- FIXED VALUES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: list[str], key) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def job_title(key) -> F.Column:
    return F.trim(F.concat(_pick(LEVELS, key), F.lit(" "), _pick(ROLES, key)))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``Index, Position title, job_description`` from ``part``."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("Index"), job_title(k).alias("Position title"), _pick(EXTRAS, k).alias("job_description"))


def document_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as the description of a job: ``Index = doc_id``."""
    k = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        k.alias("Index"), job_title(k).alias("Position title"), F.col("text").alias("job_description"))


def career_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` whose root-relative links are moved under ``/career/``."""
    return table(spark, sf_dir, "pages").select(
        "page_id", "url", F.replace(F.col("html"), F.lit('href="/'), F.lit('href="/career/')).alias("html"))


def page_sources(pages: DataFrame) -> DataFrame:
    """One listing source per distinct page origin: ``id = url = origin``."""
    o = site_origin(F.col("url"))
    return (pages.select(o.alias("origin")).filter(F.col("origin").isNotNull()).distinct()
            .select(F.col("origin").alias("id"), F.col("origin").alias("url"), "origin"))


def dirty_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job titles as scraped: padding, NBSP, a "View Position" label; every 7th upper
    case, every 11th with zero-width spaces, every 13th with a thin space."""
    j = jobs(spark, sf_dir)
    k, t = F.col("Index"), F.col("Position title")
    t = F.when(k % 11 == 0, F.replace(t, F.lit(" "), F.lit("\u200b "))).otherwise(t)
    t = F.when(k % 13 == 0, F.regexp_replace(t, "^([^ ]*) ", "$1\u2009")).otherwise(t)
    dirty = F.concat(F.lit("  "), t, F.lit("\u00a0 View Position "))
    dirty = F.when(k % 7 == 0, F.upper(dirty)).otherwise(dirty)
    return j.select(k.alias("id"), dirty.alias("title"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job records ``id, source, position_title, job_url``: URL of page ``id % n_pages``,
    every 5th without URL, every 17th with a ``mailto:`` URL. A job whose page does not exist keeps its row, without a URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    n_pages = max(1, pages.count())
    j = dirty_titles(spark, sf_dir).withColumn("page_id", F.col("id") % n_pages)
    k = F.col("id")
    url = (F.when(k % 5 == 0, F.lit(None).cast("string"))
           .when(k % 17 == 0, F.lit("mailto:x"))
           .otherwise(F.col("url")))
    return j.join(pages, "page_id", "left").select(
        k, F.concat(F.lit("src"), (k % 4).cast("string")).alias("source"),
        F.col("title").alias("position_title"), url.alias("job_url"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped rows: ``jobs`` packed 50 rows per Parquet payload, topic ``jobs``,
    partition = payload number % 3, offset = payload number; plus one message
    with a null value and one with an empty value."""
    from jobloom.plans.payload import pack_payloads

    k = F.col("Index")
    rows = jobs(spark, sf_dir).select(
        F.expr(f"Index div {MESSAGE_ROWS}").alias("batch_no"),
        (k % MESSAGE_ROWS + 1).alias("Index"), "Position title", "job_description")
    packed = pack_payloads(rows, ["batch_no"], ["Index", "Position title", "job_description"])
    payloads = packed.select(
        F.lit(MESSAGE_TOPIC).alias("topic"),
        (F.col("batch_no") % MESSAGE_PARTITIONS).cast("int").alias("partition"),
        F.col("batch_no").alias("offset"),
        F.encode(F.concat(F.lit("jobs-"), F.col("batch_no").cast("string")), "UTF-8").alias("key"),
        F.col("value"))
    n = jobs(spark, sf_dir).agg(F.max("Index").alias("m")).select(
        F.expr(f"m div {MESSAGE_ROWS}").alias("last"))
    empties = n.select(F.explode(F.array(
        F.struct((F.col("last") + 1).alias("offset"), F.lit(None).cast("binary").alias("value")),
        F.struct((F.col("last") + 2).alias("offset"), F.lit(b"").cast("binary").alias("value")))).alias("m")
    ).select(F.lit(MESSAGE_TOPIC).alias("topic"), F.lit(0).alias("partition"),
             F.col("m.offset").alias("offset"), F.lit(None).cast("binary").alias("key"), F.col("m.value"))
    return payloads.unionByName(empties)


def faulty_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched ``jobs`` with one fault per ``Index % 10``: 1 score 101, 2 score null,
    3 category Legal, 4 blank seniority, 5 changed title, 6 row missing, 7 padded category, 8 padded
    seniority; every 50th row comes twice."""
    e = enrich(jobs(spark, sf_dir))
    m = F.col("Index") % 10
    return (e.filter(m != 6).select(
        "Index",
        F.when(m == 5, F.concat(F.col("Position title"), F.lit(" (edited)"))).otherwise(
            F.col("Position title")).alias("Position title"),
        F.when(m == 1, F.lit(101)).when(m == 2, F.lit(None)).otherwise(
            F.col("complexity_score")).cast("int").alias("complexity_score"),
        F.when(m == 3, F.lit("Legal")).when(m == 7, F.concat(F.lit(" "), F.col("category"), F.lit(" ")))
        .otherwise(F.col("category")).alias("category"),
        F.when(m == 4, F.lit(" ")).when(m == 8, F.concat(F.lit(" "), F.col("seniority_level")))
        .otherwise(F.col("seniority_level")).alias("seniority_level"),
        F.explode(F.when(F.col("Index") % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
        .drop("copy"))
