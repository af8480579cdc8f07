"""Stages on tables in the shape of a staging: what the corpus selects, publishes and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.text import DIRTY_TOKENS
from lexmill.operators import publish, select, versions
from lexmill.plans import stages
from lexmill.queries.base import Registry
from lexmill.queries.relational import PUBLISHED, judged_documents, published_documents
from lexmill.session import table
from lexmill.sources.records import read_checksums
from lexmill.storage import shared_path, stored

query = Registry()

#: Children are pages, of the document of their number; their text is in one of three fields, or in none.
FIELDS = ("source_html_lawbox", "source_xml_harvard", "source_html")
STAGED_SQL = PUBLISHED + rf""",
    child AS (SELECT page_id AS opinion_id, page_id AS cluster_id, html, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, CASE page_id % 4 WHEN 0 THEN '{FIELDS[0]}' WHEN 1 THEN '{FIELDS[1]}' WHEN 2 THEN '{FIELDS[2]}' END AS field FROM pages),
    corpus AS (SELECT c.*, v, field IS NOT NULL AND (contains(html, '■') OR regexp_matches(lower(html), '(^|[^\p{{L}}\p{{N}}_])({"|".join(DIRTY_TOKENS)})($|[^\p{{L}}\p{{N}}_])')) AS dirty FROM child c JOIN pub p ON p.cluster_id = c.cluster_id WHERE dedup_role = 'canonical' AND v BETWEEN 2 AND 18)
"""


def children(spark: SparkSession, d: str) -> DataFrame:
    field = lambda n: F.when(F.col("page_id") % 4 == n, F.col("html")).alias(FIELDS[n])
    return table(spark, d, "pages").select(
        F.col("page_id").alias("opinion_id"), F.col("page_id").alias("cluster_id"), F.lit("lead").alias("type"), F.lit(None).cast("string").alias("author"), F.lit(False).alias("is_ocr_extracted"), F.lit(1).alias("ordering_key"),
        field(0), field(1), F.coalesce(field(2), F.lit("")).alias(FIELDS[2]), *[F.lit(None).cast("string").alias(c) for c in stages.LONGEST if c not in FIELDS],
    )


def staging(spark: SparkSession, d: str) -> str:
    """Writes the staged tables and returns their folder."""
    root = shared_path(spark, "staging")
    published, kids = stored(published_documents(spark, d), "published"), children(spark, d)
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("cluster_id"), "source", "lang")
    cite = F.struct(F.col("source").alias("reporter"), F.col("lang").alias("volume"), F.lit("1").alias("page"), F.lit(1).alias("type"))
    parents = judged_documents(spark, d).select("cluster_id", "case_name", "us_volume", "us_page", "us_cite", F.lit("1801-02-03").alias("date_filed"), "scdb_id")
    parents = parents.join(docs, "cluster_id").withColumn("citations", F.when(F.col("cluster_id") % 2 == 0, F.array(cite, cite)).otherwise(F.array(cite))).withColumn("declared_ids", F.array().cast("array<long>")).drop("source", "lang")
    resolved = published.where("dedup_role IS NOT NULL").select("cluster_id", "us_volume", "dedup_role", "dup_of", "dup_method")
    chosen = stored(select.select_sources(select.corpus_children(kids, resolved)), "chosen")
    title = F.regexp_extract("text", "<title>([^<]*)</title>", 1)
    cleaned = select.read_chosen(kids, chosen).where("text IS NOT NULL").select("opinion_id", title.alias("clean_text"), F.lit(None).cast("string").alias("ocr_suspect"), F.lit(1).alias("clean_version"))
    cleaned = stored(cleaned, "cleaned")
    tables = {
        "stg_clusters": parents, "stg_opinions": kids, "stg_cluster_scope": judged_documents(spark, d).select("cluster_id", "is_scotus", "evidence"), "stg_cluster_dedup": resolved, "stg_opinion_source": chosen, "stg_opinion_clean": cleaned,
        "stg_page_break": cleaned.select("opinion_id", F.lit(1).alias("ordinal"), F.lit("1").alias("page_label"), F.lit(0).cast("long").alias("char_offset"), F.lit("").alias("anchor")), "stg_meta": publish.meta(spark, {"from": "tables"}),
    }
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}")
    return root


@query(STAGED_SQL + """
    SELECT c.opinion_id, cluster_id, field AS chosen_source, dirty AS is_ocr_dirty, CASE WHEN field IS NOT NULL THEN length(html) END AS n_chars FROM corpus c
""")
def corpus_selection(spark: SparkSession, d: str) -> DataFrame:
    """The children of the corpus with the field that is chosen for each, and its text's length."""
    resolved = published_documents(spark, d).where("dedup_role IS NOT NULL")
    kids = children(spark, d)
    chosen = select.select_sources(select.corpus_children(kids, resolved))
    texts = select.read_chosen(kids, chosen).select("opinion_id", F.length("text").cast("long").alias("n_chars"))
    return chosen.join(texts, "opinion_id").select("opinion_id", "cluster_id", "chosen_source", "is_ocr_dirty", "n_chars")


@query(STAGED_SQL + """
    SELECT cluster_id, length(html) AS n_chars, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, us_volume FROM
      (SELECT p.cluster_id, CAST(v AS INTEGER) AS us_volume, CASE WHEN field IS NOT NULL THEN html END AS html FROM pub p LEFT JOIN child c ON c.cluster_id = p.cluster_id WHERE is_scotus = 1)
""")
def scope_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Records in scope with the longest text of their children."""
    scope = judged_documents(spark, d).where("is_scotus = 'true'").select("cluster_id", "us_volume")
    texts = children(spark, d).select("cluster_id", "opinion_id", F.nullif(select.longest_text(stages.LONGEST), F.lit("")).alias("text"))
    rows = scope.join(select.longest_child(texts, "cluster_id", "opinion_id", "text"), "cluster_id", "left")
    return rows.select("cluster_id", F.length("text").cast("long").alias("n_chars"), F.regexp_extract("text", "<title>([^<]*)</title>", 1).alias("title"), "us_volume")


@query(STAGED_SQL + """
    SELECT c.opinion_id, c.cluster_id, k.field AS chosen_source, CAST(dirty AS INTEGER) AS is_ocr_dirty,
      CASE WHEN k.field IS NOT NULL THEN k.title END AS clean_text, CASE WHEN k.field IS NOT NULL THEN 1 END AS clean_version
    FROM child c LEFT JOIN corpus k ON k.opinion_id = c.opinion_id
""")
def published_opinions(spark: SparkSession, d: str) -> DataFrame:
    """Every child as it is published, from staged tables."""
    staged = publish.staged_tables(spark, staging(spark, d))
    rows = publish.publish_children(staged["stg_opinions"], staged["stg_opinion_source"], staged["stg_opinion_clean"])
    return rows.select("opinion_id", "cluster_id", "chosen_source", "is_ocr_dirty", "clean_text", "clean_version")


@query(STAGED_SQL + """,
    s AS (SELECT corpus_status AS k, count(*) AS n FROM pub GROUP BY 1), names(k) AS (VALUES ('included'), ('outside_volume'), ('duplicate'), ('not_scotus'))
    SELECT 'n_clusters_' || k AS key, CAST(coalesce(n, 0) AS VARCHAR) AS value FROM names LEFT JOIN s USING (k)
    UNION ALL SELECT 'n_clusters_total', CAST(count(*) AS VARCHAR) FROM pub
    UNION ALL SELECT 'n_decisions', CAST(count(*) AS VARCHAR) FROM pub WHERE corpus_status = 'included'
    UNION ALL SELECT 'n_opinions', CAST(count(*) AS VARCHAR) FROM child
    UNION ALL SELECT 'n_corpus_opinions', CAST(count(field) AS VARCHAR) FROM corpus
    UNION ALL SELECT 'n_review_ledger_folds', '0'
    UNION ALL SELECT 'n_citations', CAST(count(*) AS VARCHAR) FROM pub
    UNION ALL SELECT 'n_citation_dupes_dropped', CAST(count(*) FILTER (WHERE cluster_id % 2 = 0) AS VARCHAR) FROM pub
    UNION ALL SELECT 'n_page_breaks', CAST(count(field) AS VARCHAR) FROM corpus
    UNION ALL SELECT 'n_ocr_suspects', '0'
""")
def published_counts(spark: SparkSession, d: str) -> DataFrame:
    """The counts of a set that is built and committed from staged tables, read back from what was published."""
    target = shared_path(spark, "published-set")
    publish.build(spark, staging(spark, d), target)
    return versions.table(spark, target, "meta").where(F.col("key").startswith("n_")).select("key", "value")


@query("SELECT 'd/' || doc_id || '.txt' AS path, sha256(coalesce(text, '')) AS sha256 FROM documents")
def ledger_lines(spark: SparkSession, d: str) -> DataFrame:
    """A ledger of checksums, written as lines and read again."""
    path = shared_path(spark, "ledger")
    rows = table(spark, d, "documents").select(F.concat_ws("  ", F.sha2(F.coalesce("text", F.lit("")), 256), F.concat(F.lit("d/"), F.col("doc_id").cast("string"), F.lit(".txt"))).alias("value"))
    rows.write.text(path)
    return read_checksums(spark, path)
