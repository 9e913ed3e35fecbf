"""The registered queries: one per operator, each a plan over the test tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the oracle SQL of the same name (``oracle_sql.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.functions import text as TX
from jobloom.functions import urls as U
from jobloom.operators import extract as EX
from jobloom.operators import ordering as ORD
from jobloom.operators import sanitize as SAN
from jobloom.operators.enrich import enrich, score_parts, with_combined_text
from jobloom.plans import fixtures as FX
from jobloom.plans import produce as PR
from jobloom.operators import validate as VAL
from jobloom.operators.enrich import enrich_payload_rows
from jobloom.plans import payload as PL
from jobloom.sources import config as SRC
from jobloom.sources import messages as MSG
from jobloom.sources import pages as PG

BATCH_ROWS = 500  # several batches at test scale; the producer default is 2000
BODY_CAP = 8192  # a cap that some test pages exceed; the default is 15 MiB


# --------------------------------------------------------------------------- enrichment
def enrich_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCR-8 on titles only: the five enriched columns."""
    return enrich(FX.jobs(spark, sf_dir).drop("job_description"))


def enrich_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCR-8 with ``job_description`` (TXT-4 joins title and description)."""
    return enrich(FX.jobs(spark, sf_dir))


def complexity_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCR-1..5: the four signals and the score per job."""
    parts = score_parts(with_combined_text(FX.jobs(spark, sf_dir)))
    return enrich(parts, keep=["leadership", "explicit_years", "inferred_years", "skills"]).select(
        "Index", "leadership", "explicit_years", "inferred_years", "skills", "complexity_score")


def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCR-6 distribution."""
    return enrich(FX.jobs(spark, sf_dir)).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def seniority_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCR-7 distribution."""
    return enrich(FX.jobs(spark, sf_dir)).groupBy("seniority_level").agg(F.count(F.lit(1)).alias("n"))


def enrich_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCR-8 over whole documents as job descriptions (multi-language, long texts)."""
    return enrich(FX.document_jobs(spark, sf_dir))



# --------------------------------------------------------------------------- URL functions
def canonical_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL-1 on every page URL (null when not canonicalizable)."""
    return FX.table(spark, sf_dir, "pages").select("page_id", "url", U.canonical_url("url").alias("canonical_url"))


def strip_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL-2 on the query of every page URL."""
    q = U.split_url("url")["query"]
    return FX.table(spark, sf_dir, "pages").select(
        "page_id", q.alias("query"), U.strip_tracking(q).alias("kept_query"))


def site_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL-3 and URL-6 on every page URL."""
    return FX.table(spark, sf_dir, "pages").select(
        "page_id", U.site_origin("url").alias("origin"), U.listing_url_ok("url").alias("listing_ok"))


def job_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-2 and URL-5 on every anchor of the career pages."""
    a = EX.page_anchors(FX.career_pages(spark, sf_dir))
    return a.select("page_id", "pos", "href", U.is_job_href("href").alias("is_job_href"),
                    U.job_slug("href").alias("slug"))


def resolve_hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL-4 then URL-1: every anchor joined to its page origin, then canonical."""
    a = EX.page_anchors(FX.career_pages(spark, sf_dir))
    base = F.concat(U.site_origin("url"), F.lit("/"))
    return (a.select("page_id", "pos", "href", U.resolve_href(base, F.col("href")).alias("resolved"))
            .withColumn("canonical_url", U.canonical_url("resolved")))


# --------------------------------------------------------------------------- text functions
def normalize_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-1 once and three times (the producer applies it three times)."""
    t = FX.dirty_titles(spark, sf_dir)
    once = TX.normalize_title("title")
    return t.select("id", once.alias("title"),
                    TX.normalize_title(TX.normalize_title(once)).alias("title3"))


def title_from_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-2 on every /career/ slug found in the raw career pages."""
    slugs = F.regexp_extract_all("html", F.lit(EX.career_slug_pattern()), F.lit(1))
    return (FX.career_pages(spark, sf_dir).select("page_id", F.posexplode(slugs).alias("pos", "slug"))
            .withColumn("title", TX.title_from_slug("slug")))


def casefold_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-3 on the text of every anchor (German, French, Spanish words)."""
    a = EX.page_anchors(FX.table(spark, sf_dir, "pages"))
    return a.select("page_id", "pos", "text", TX.casefold("text").alias("folded"))


def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-5 key/topic/label rules on every page URL."""
    return FX.table(spark, sf_dir, "pages").select(
        "page_id", TX.safe_key(F.encode("url", "UTF-8")).alias("key_name"),
        TX.safe_topic("url").alias("topic_name"), TX.safe_label("url").alias("label"))


def blob_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXT-6 object names of the job messages, raw and enriched."""
    batches = FX.jobs(spark, sf_dir).select(F.expr(f"Index div {FX.MESSAGE_ROWS}").alias("offset")).distinct()
    m = batches.select(
        F.lit(FX.MESSAGE_TOPIC).alias("topic"), (F.col("offset") % FX.MESSAGE_PARTITIONS).cast("int").alias("partition"),
        "offset", F.encode(F.concat(F.lit("jobs "), F.col("offset").cast("string"), F.lit("!")), "UTF-8").alias("key"),
        F.timestamp_millis(F.lit(1735689600000) + F.col("offset") * 1001).alias("ts"))
    return m.select("offset", TX.blob_name("topic", "partition", "offset", "key", "ts").alias("raw_name"),
                    TX.blob_name("topic", "partition", "offset", "key", "ts", enriched=True,
                                 prefix="  pre/fix  ").alias("enriched_name"))



# --------------------------------------------------------------------------- extraction
def nonblank_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-1 flag per page."""
    return FX.table(spark, sf_dir, "pages").select("page_id", EX.nonblank(F.col("html")).alias("nonblank"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-2 with FLT-2..5: job anchors per page, first per URL, non-empty titles."""
    pages = EX.extract_pages(FX.career_pages(spark, sf_dir), include_slugs=False)
    return pages.select("page_id", F.inline("rows")).drop("phase")


def slug_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-3: unique /career/ slugs per page in first-seen order."""
    pages = EX.page_candidates(FX.career_pages(spark, sf_dir))
    return pages.select("page_id", F.inline(EX.unique_slugs(F.col("slugs"))))


def unseen_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-2: slug-scan jobs whose URL no anchor of the page claimed."""
    jobs = EX.extract_jobs(FX.career_pages(spark, sf_dir))
    return jobs.filter(F.col("phase") == 1).select("page_id", "pos", "position_title", "job_url")


def extract_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-3: all job rows of every page, anchors first then slugs."""
    return EX.extract_jobs(FX.career_pages(spark, sf_dir))


def extract_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-3, titles only: the titles of every page in the order they are found."""
    return EX.extract_titles(FX.career_pages(spark, sf_dir))


def extract_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-6: per-page counters and the short-page flag."""
    return EX.extract_metrics(FX.career_pages(spark, sf_dir))



# --------------------------------------------------------------------------- sources
def cap_body_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-2: page byte size and whether it is within the cap."""
    return PG.with_body_cap(FX.table(spark, sf_dir, "pages"), max_bytes=BODY_CAP).select(
        "page_id", "n_bytes", "accepted")


def rejected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-2: the pages over the byte cap, which a run lists and counts."""
    return PG.rejected_pages(FX.table(spark, sf_dir, "pages"), max_bytes=BODY_CAP).select("page_id", "url", "n_bytes")


def failed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-5: configured sources without an accepted page: here those whose pages are all over the cap."""
    pages = FX.table(spark, sf_dir, "pages")
    sources = pages.select(F.col("page_id").cast("string").alias("id"), "url")
    return SRC.sources_without_pages(PG.cap_body_size(pages, max_bytes=BODY_CAP), sources).select("id", "url")


def publish_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-4: one message for each source, in parts over the cap, published and read back."""
    from jobloom.sinks.kafka import publish

    path = _scratch(spark, "single")
    publish(PR.source_messages(_produce(spark, sf_dir).records, topic=FX.MESSAGE_TOPIC), sink_path=path)
    sent = spark.read.parquet(path)
    back = PL.unpack_payloads(sent, ["Index", "Position title"], keep=["topic", "key"])
    return back.select(F.regexp_replace(F.col("key").cast("string"), "-part-[0-9.]+$", "").alias("key"), "Index", "Position title")


def listing_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-6: every page URL as primary, with a merge list of repeats, blanks and its origin."""
    pages = FX.table(spark, sf_dir, "pages")
    extras = F.concat(F.lit(" "), F.col("url"), F.lit(" ,, "), U.site_origin("url"), F.lit(", "), F.col("url"))
    return SRC.listing_urls(pages, "url", extras, keep=["page_id"])


def source_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-4: a configuration entry for each page, some without id, with an id, with a given origin or with a URL that is no listing's: as validated rows."""
    k = F.col("page_id")
    entries = FX.table(spark, sf_dir, "pages").select(
        k.alias("pos"), F.when(k % 3 == 1, F.concat(F.lit(" p"), k.cast("string"))).when(k % 3 == 2, F.lit("")).alias("id"),
        F.when(k % 7 == 0, F.lit("ftp://old.test/")).otherwise(F.concat(F.lit("  "), F.col("url"), F.lit("\t"))).alias("url"),
        F.when(k % 4 == 0, F.lit("https://given.test:81//")).alias("origin"))
    return SRC.source_rows(entries)


def attach_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-5 / JN-1: career pages joined to their source (one source per origin)."""
    pages = FX.career_pages(spark, sf_dir).withColumn("origin", U.site_origin("url"))
    return SRC.attach_source(pages, FX.page_sources(pages), on="origin").select("page_id", "source")


def _sources(pages: DataFrame) -> DataFrame:
    return FX.page_sources(pages).withColumn("pos", F.col("id"))


def source_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-2: job rows of all sources, tagged with their source."""
    pages = FX.career_pages(spark, sf_dir)
    return PR.gather_records(pages, _sources(pages)).select(
        "source", "page_id", "phase", "pos", "position_title", "job_url")


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-7: clean rows per source."""
    pages = FX.career_pages(spark, sf_dir)
    recs = PR.clean_records(PR.gather_records(pages, _sources(pages)))
    return recs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------- keep-first, order
def sanitize_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-4: re-normalized records, first per canonical URL / nourl / bad-URL key."""
    recs = SAN.sanitize_records(FX.records(spark, sf_dir), order="id")
    return recs.select("id", "source", "position_title", "job_url")


def dedupe_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-5 + WIN-1: title-only output, first per case-folded title, numbered A-Z."""
    return PR.titles_output(FX.dirty_titles(spark, sf_dir), order="id")


def _clean_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PR.clean_records(FX.records(spark, sf_dir), order=["id"])


def global_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT-1 + WIN-1: cleaned records numbered 1..n by case-folded title (two-pass)."""
    n = ORD.global_index(_clean_records(spark, sf_dir),
                         ORD.title_sort_key("position_title", "job_url", "source", "id"), index_col="Index")
    return n.select("Index", F.col("position_title").alias("Position title"))


def batch_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-2: the same order cut into batches, Index restarting per batch."""
    n = ORD.global_index(_clean_records(spark, sf_dir),
                         ORD.title_sort_key("position_title", "job_url", "source", "id"), index_col="rn")
    return ORD.batch_index(n, BATCH_ROWS).select("batch_no", "Index",
                                                  F.col("position_title").alias("Position title"))


# --------------------------------------------------------------------------- producer
def _produce(spark: SparkSession, sf_dir: str) -> PR.ProduceResult:
    pages = FX.career_pages(spark, sf_dir)
    return PR.produce(pages, _sources(pages), rows_per_batch=BATCH_ROWS)


def produce_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer, merged output (SNK-1): pages -> jobs -> clean x2 -> Index, Position title."""
    return _produce(spark, sf_dir).merged


def produce_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer, batched payloads (WIN-2, SNK-2, SNK-3): one message per batch."""
    msgs = PR.messages(_produce(spark, sf_dir).batches, topic=FX.MESSAGE_TOPIC)
    return msgs.select("batch_no", F.col("key").cast("string").alias("key"), "n_rows")



# --------------------------------------------------------------------------- messages and payloads
COORDS = ["topic", "partition", "offset"]


def unpack_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-9 after SNK-2: rows read back from the Parquet payload of every message."""
    rows = PL.unpack_payloads(FX.messages(spark, sf_dir), ["Index", "Position title", "job_description"])
    return rows.select(*COORDS, "Index", "Position title", "job_description")


def payload_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footer-only row count per message (null when the value is not Parquet)."""
    return PL.payload_row_counts(FX.messages(spark, sf_dir))


def nonempty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-6: messages with a value."""
    return MSG.nonempty_messages(FX.messages(spark, sf_dir)).select(*COORDS)


def max_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIM-1: the first 10 non-empty messages in (partition, offset) order."""
    return MSG.first_messages(FX.messages(spark, sf_dir), 10).select(*COORDS)


def enrich_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCR-9 per message: unpack, enrich (title + description), keep coordinates."""
    rows = PL.unpack_payloads(FX.messages(spark, sf_dir))
    return enrich_payload_rows(rows, COORDS).drop("enriched_before")


def payload_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3: byte size of every page body as a payload, and whether it fits the default message cap and the
    least cap that can be set."""
    pages = FX.table(spark, sf_dir, "pages").select("page_id", F.repeat(F.col("html"), F.lit(10)).cast("binary").alias("value"))
    least = PL.with_size_check(pages, limit=1).withColumnRenamed("fits", "fits_least").drop("n_bytes")
    return PL.with_size_check(least).select("page_id", "n_bytes", "fits", "fits_least")


def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-8 / JN-3: every failed check of a faulty enrichment against the producer rows."""
    producer = FX.jobs(spark, sf_dir).select("Index", "Position title")
    return VAL.violations(producer, FX.faulty_enriched(spark, sf_dir))


def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-8: failed rows per check."""
    return violations(spark, sf_dir).groupBy("rule_no", "rule").agg(F.count(F.lit(1)).alias("n"))


def _message_files(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, DataFrame]:
    """A scratch folder, and the job messages with all columns of the Kafka row shape."""
    rows = FX.messages(spark, sf_dir).withColumn("timestamp", F.lit(None).cast("timestamp"))
    return _scratch(spark, name), rows


def consume_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-1..6: the streaming consumer over the job messages (file stream with the Kafka
    row shape), enrichment on, stored per message and read back."""
    from jobloom.streaming.consumer import ConsumerConfig, consume

    base, rows = _message_files(spark, sf_dir, "consume_stream")
    rows.write.parquet(f"{base}/in")
    cfg = ConsumerConfig(output_path=f"{base}/out", checkpoint_path=f"{base}/ckpt",
                         failures_path=f"{base}/failures", enrich=True)
    consume(spark, MSG.read_messages(spark, path=f"{base}/in"), cfg)
    out = spark.read.parquet(cfg.output_path)
    return out.select("topic", "partition", "offset", "Index", "Position title",
                      "complexity_score", "category", "seniority_level")


def consume_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-6, STR-2: a run over a part of the messages, then one with a new checkpoint over all of them in several batches: each is stored once."""
    from jobloom.streaming.consumer import ConsumerConfig, consume

    base, rows = _message_files(spark, sf_dir, "consume_redelivered")
    rows.filter("offset % 3 <> 1").write.parquet(f"{base}/first")
    rows.repartition(3, "offset").write.parquet(f"{base}/all")
    for run, files in (("first", None), ("all", 1)):
        cfg = ConsumerConfig(output_path=f"{base}/out", checkpoint_path=f"{base}/ckpt-{run}", enrich=False)
        consume(spark, MSG.read_messages(spark, path=f"{base}/{run}", max_files_per_trigger=files), cfg)
    return spark.read.parquet(cfg.messages_path).groupBy(*COORDS).agg(F.count(F.lit(1)).alias("copies"))


def consume_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIM-1, STR-5: a run that stops after a quarter of the messages and, restarted, after half of them: the first ones in order."""
    from jobloom.streaming.consumer import ConsumerConfig, consume

    base, rows = _message_files(spark, sf_dir, "consume_bounded")
    rows.coalesce(1).write.parquet(f"{base}/in")
    half = MSG.nonempty_messages(spark.read.parquet(f"{base}/in")).count() // 2
    for most in (half // 2, half):
        cfg = ConsumerConfig(output_path=f"{base}/out", checkpoint_path=f"{base}/ckpt", enrich=False, max_messages=most)
        consume(spark, MSG.read_messages(spark, path=f"{base}/in"), cfg)
    return spark.read.parquet(cfg.messages_path).select(*COORDS)


def failure_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-8, STR-3: every fifth message is no payload: the consumer stops, stores nothing, and records each of them."""
    from jobloom.streaming.consumer import ConsumerConfig, PayloadError, process_batch

    base, rows = _message_files(spark, sf_dir, "failure_records")
    broken = rows.withColumn("value", F.when((F.col("offset") % 5 == 0) & (F.octet_length("value") > 0), F.lit(b"no payload")).otherwise(F.col("value")))
    cfg = ConsumerConfig(output_path=f"{base}/out", failures_path=f"{base}/failures")
    try:
        process_batch(broken, cfg)
    except PayloadError:
        pass
    return spark.read.parquet(cfg.failures_path).select("kind", *COORDS, "error_type")


# --------------------------------------------------------------------------- reads, writes, SQL API
def _scratch(spark: SparkSession, name: str) -> str:
    from jobloom.session import scratch_path

    return scratch_path(spark, name)


def read_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1: pages read with only the needed columns."""
    pages = PG.read_pages(spark, f"{sf_dir.rstrip('/')}/pages.parquet")
    return pages.select("page_id", "url", F.length("html").alias("n_chars"))


def decode_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-3: page bodies as UTF-8 bytes decoded back with replacement of bad bytes."""
    pages = FX.table(spark, sf_dir, "pages")
    decoded = PG.decode_body(F.encode("html", "UTF-8"))
    return pages.select("page_id", F.length(decoded).alias("n_chars"), (decoded == F.col("html")).alias("same"))


def decode_charsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-3: page bodies in four encodings in one call: plain UTF-8, UTF-16 known by its byte order mark, UTF-16 as declared, and UTF-8 with a
    byte order mark in front and a bad byte at the end."""
    k = F.col("page_id") % 4
    body = (F.when(k == 0, F.encode("html", "UTF-8")).when(k == 1, F.concat(F.lit(b"\xff\xfe"), F.encode("html", "UTF-16LE")))
            .when(k == 2, F.encode("html", "UTF-16BE")).otherwise(F.concat(F.lit(b"\xef\xbb\xbf"), F.encode("html", "UTF-8"), F.lit(b"\xff"))))
    pages = FX.table(spark, sf_dir, "pages").select("page_id", "html", body.alias("body"), F.when(k == 2, F.lit("UTF-16BE")).alias("declared"))
    text = PG.decode_body(F.col("body"), F.col("declared"), detect=True)
    return pages.select("page_id", "html", text.alias("text")).select(
        "page_id", F.length("text").alias("n_chars"), (F.col("text") == F.col("html")).alias("same"), F.endswith("text", F.lit("\ufffd")).alias("replaced"))


def write_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1: the producer's merged output written as Parquet and read back."""
    path = _scratch(spark, "merged")
    PR.write_merged(_produce(spark, sf_dir).merged, path)
    return spark.read.parquet(path)


def publish_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-4: batched payload messages published (to a Parquet sink here) and read back."""
    from jobloom.sinks.kafka import publish

    path = _scratch(spark, "published")
    publish(PR.messages(_produce(spark, sf_dir).batches, topic=FX.MESSAGE_TOPIC), sink_path=path)
    sent = spark.read.parquet(path)
    counts = PL.payload_row_counts(sent.withColumn("offset", F.lit(0).cast("long"))
                                   .withColumn("partition", F.lit(0)), keep=("topic", "key"))
    return counts.select("topic", F.col("key").cast("string").alias("key"), "n_rows")


def land_raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-7: raw pages kept under storage-safe labels (page origin), read back as counts."""
    path = _scratch(spark, "raw_pages")
    pages = FX.table(spark, sf_dir, "pages").withColumn("host", U.site_origin("url"))
    PG.land_raw_pages(pages, path, label="host")
    return spark.read.parquet(path).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def sql_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UDF-1: the scorers as SQL functions in a SQL query."""
    from jobloom.functions.scoring import register_sql_functions

    register_sql_functions(spark)
    with_combined_text(FX.jobs(spark, sf_dir)).createOrReplaceTempView("jobloom_jobs")
    return spark.sql("""
        SELECT Index, leadership_kw_score(combined_text) AS leadership,
               max_years(combined_text) AS explicit_years,
               inferred_years_if_missing(combined_text) AS inferred_years,
               count_skills(combined_text) AS skills,
               job_category(combined_text) AS category, job_seniority(combined_text) AS seniority_level
        FROM jobloom_jobs""")


def produce_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: listing pages -> jobs -> clean -> numbered batches -> Parquet payloads ->
    unpacked and enriched rows, as the producer and the enriching consumer do."""
    msgs = PR.messages(_produce(spark, sf_dir).batches, topic=FX.MESSAGE_TOPIC)
    rows = PL.unpack_payloads(msgs, ["Index", "Position title"], keep=["batch_no"])
    return enrich_payload_rows(rows, ["batch_no"]).drop("enriched_before")


REGISTRY = {
    "enrich_titles": enrich_titles,
    "enrich_descriptions": enrich_descriptions,
    "complexity_parts": complexity_parts,
    "category_counts": category_counts,
    "seniority_counts": seniority_counts,
    "enrich_documents": enrich_documents,
    "canonical_urls": canonical_urls,
    "strip_tracking": strip_tracking,
    "site_origins": site_origins,
    "job_slugs": job_slugs,
    "resolve_hrefs": resolve_hrefs,
    "normalize_titles": normalize_titles,
    "title_from_slugs": title_from_slugs,
    "casefold_texts": casefold_texts,
    "safe_names": safe_names,
    "blob_names": blob_names,
    "nonblank_pages": nonblank_pages,
    "page_links": page_links,
    "slug_scan": slug_scan,
    "unseen_slugs": unseen_slugs,
    "extract_jobs": extract_jobs,
    "extract_titles": extract_titles,
    "extract_metrics": extract_metrics,
    "cap_body_size": cap_body_size,
    "rejected_pages": rejected_pages,
    "failed_sources": failed_sources,
    "publish_single": publish_single,
    "listing_urls": listing_urls,
    "source_entries": source_entries,
    "attach_source": attach_source,
    "source_records": source_records,
    "run_counts": run_counts,
    "sanitize_records": sanitize_records,
    "dedupe_titles": dedupe_titles,
    "global_index": global_index,
    "batch_index": batch_index,
    "produce_merged": produce_merged,
    "produce_batches": produce_batches,
    "unpack_payloads": unpack_payloads,
    "payload_row_counts": payload_row_counts,
    "nonempty_messages": nonempty_messages,
    "max_messages": max_messages,
    "enrich_payloads": enrich_payloads,
    "payload_sizes": payload_sizes,
    "violations": violations,
    "validation_summary": validation_summary,
    "consume_stream": consume_stream,
    "consume_redelivered": consume_redelivered,
    "consume_bounded": consume_bounded,
    "failure_records": failure_records,
    "produce_enriched": produce_enriched,
    "read_pages": read_pages,
    "decode_body": decode_body,
    "decode_charsets": decode_charsets,
    "write_merged": write_merged,
    "publish_messages": publish_messages,
    "land_raw_pages": land_raw_pages,
    "sql_scores": sql_scores,
}
