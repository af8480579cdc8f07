"""Hierarchies, classification, status, selection, reports and snapshots over the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.functions import records as R
from lexmill.functions import text as X
from lexmill.operators import classify, clean, hierarchy, publish, select, snapshots, unpivot
from lexmill.operators.keyed import lookup
from lexmill.plans.checks import suite
from lexmill.queries.base import Registry
from lexmill.session import table
from lexmill.storage import stored

query = Registry()

# --- hierarchy ------------------------------------------------------------------------------


@query("""
    SELECT o_orderkey, CAST(count(DISTINCT l_linenumber) AS BIGINT) AS n_children
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
""")
def hierarchy_child_counts(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return hierarchy.child_counts(table(spark, d, "orders").select("o_orderkey"), lines, "o_orderkey", "l_orderkey", "l_linenumber")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def hierarchy_childless(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").join(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def hierarchy_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Documents as children, labels as their parents."""
    return hierarchy.orphans(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), "doc_id", "doc_id").select("doc_id", "source")


@query("""
    WITH asked AS (SELECT conv_id, unnest(range(0, max(turn) + 2)) AS turn FROM conversations GROUP BY conv_id)
    SELECT conv_id, turn FROM asked a WHERE NOT EXISTS (SELECT 1 FROM conversations c WHERE c.conv_id = a.conv_id AND c.turn = a.turn)
""")
def hierarchy_undelivered(spark: SparkSession, d: str) -> DataFrame:
    """Each conversation declares its turns and one more; the one more was never delivered."""
    turns = table(spark, d, "conversations").select("conv_id", "turn")
    declared = turns.groupBy("conv_id").agg(F.sequence(F.lit(0).cast("long"), F.max("turn") + 1).alias("declared"))
    ids = turns.select(F.struct("conv_id", "turn").alias("child"))
    parents = declared.select("conv_id", F.transform("declared", lambda t: F.struct(F.col("conv_id").alias("conv_id"), t.alias("turn"))).alias("declared"))
    return hierarchy.undelivered(parents, ids, "conv_id", "declared", "child").select("conv_id", "child.turn")


@query("""
    SELECT doc_id, nullif(source, 'src0') AS source, CASE WHEN regexp_matches(text, '[^ \\t\\n\\r]') THEN text END AS text,
           nullif(substr(lang, 1, 4), '') AS lang_prefix
    FROM documents
""")
def null_normalise(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.nullif("source", F.lit("src0")).alias("source"), X.blank_to_null("text").alias("text"), X.year_of("lang").alias("lang_prefix"))


@query("""
    SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'assistant') AS first_answer, CAST(min(turn) FILTER (WHERE role = 'assistant') AS BIGINT) AS at_turn
    FROM conversations GROUP BY conv_id
""")
def first_match_in_array(spark: SparkSession, d: str) -> DataFrame:
    """The first element of an array that meets a condition."""
    turns = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    first = F.get(F.filter("t", lambda x: x["role"] == "assistant"), F.lit(0))
    return turns.select("conv_id", first["text"].alias("first_answer"), first["turn"].alias("at_turn"))


@query("""
    SELECT o_orderkey, CAST(o_orderkey % 30 AS INTEGER) AS us_volume, CAST(o_custkey AS VARCHAR) AS us_page,
           CAST(o_orderkey % 30 AS VARCHAR) || ' U.S. ' || CAST(o_custkey AS VARCHAR) AS us_cite, o_orderkey AS linked_id
    FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL SELECT o_orderkey, NULL, NULL, NULL, o_orderkey FROM orders WHERE o_orderkey % 3 <> 0
""")
def citation_parse(spark: SparkSession, d: str) -> DataFrame:
    """The first usable citation of a list made from orders, and the id in a URL."""
    num = F.col("o_orderkey")
    c = lambda reporter, volume, page: F.struct(reporter.alias("reporter"), volume.alias("volume"), page.alias("page"), F.lit(1).alias("type"))
    volume = F.concat(F.lit("0"), (num % 30).cast("string"))
    own = F.when(num % 3 == 0, c(F.lit("U.S."), volume, F.col("o_custkey").cast("string"))).otherwise(c(F.lit("U.S."), F.lit("x2"), F.lit("5")))
    cites = F.array(c(F.lit("U.S. LEXIS"), F.lit("9"), F.lit("1")), c(F.lit("U.S."), F.lit("4"), F.lit(" ")), own)
    url = F.concat(F.lit("https://host/api/orders/"), num.cast("string"), F.lit("/"))
    rows = table(spark, d, "orders").select("o_orderkey", R.first_citation(cites).alias("c"), R.id_in_url(url).alias("linked_id"))
    return rows.select("o_orderkey", F.col("c.volume").alias("us_volume"), F.col("c.page").alias("us_page"), F.col("c.cite").alias("us_cite"), "linked_id")


@query("""
    SELECT o_orderkey, CAST(len(list_distinct(list_filter(p, lambda x: x > 3))) AS INTEGER) AS n_declared, CAST(list_sum(p) AS BIGINT) AS sum_declared, types FROM
      (SELECT o_orderkey, [o_orderkey, o_custkey, 3] AS p, o_orderstatus || ';' || o_orderpriority AS types FROM orders)
""")
def cleaned_references(spark: SparkSession, d: str) -> DataFrame:
    """Ids in lists of URLs, and citations without the fields that a server sets anew."""
    url = lambda c: F.concat(F.lit("https://host/o/"), c.cast("string"), F.lit("/"))
    cite = lambda kind: F.struct(F.lit("U.S.").alias("reporter"), F.lit("1").alias("volume"), F.lit("2").alias("page"), kind.alias("type"), F.current_timestamp().alias("date_created"))
    rows = table(spark, d, "orders").select(
        "o_orderkey", R.declared_children(F.array(url(F.col("o_orderkey")), url(F.col("o_custkey")), F.lit("/o/3"))).alias("ids"), R.clean_citations(F.array(cite(F.col("o_orderstatus")), cite(F.col("o_orderpriority")))).alias("c")
    )
    total = F.aggregate("ids", F.lit(0).cast("long"), lambda a, x: a + x)
    kept = F.size(F.array_distinct(F.filter("ids", lambda x: x > 3)))
    return rows.select("o_orderkey", kept.alias("n_declared"), total.alias("sum_declared"), F.array_join(F.transform("c", lambda x: x["type"]), ";").alias("types"))


@query("SELECT doc_id, coalesce(CAST(quality AS VARCHAR), 'None') AS volume, coalesce(CAST(toxic AS VARCHAR), 'None') AS page FROM documents LEFT JOIN labels USING (doc_id)")
def citation_text(spark: SparkSession, d: str) -> DataFrame:
    """Values as text, with the published word for those that are absent."""
    rows = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return rows.select("doc_id", R.text_or_none("quality").alias("volume"), R.text_or_none("toxic").alias("page"))


@query("""
    SELECT p_partkey, trim(p_name) AS case_name_full, nullif(p_type, 'SMALL') AS attorneys, NULL::VARCHAR AS judges FROM part
""")
def meta_fields(spark: SparkSession, d: str) -> DataFrame:
    """Short fields, stripped, blank as null; rows without any are left out."""
    padded = table(spark, d, "part").select("p_partkey", F.concat(F.lit(" \t"), "p_name", F.lit(" \n")).alias("case_name_full"), F.when(F.col("p_type") == "SMALL", " ").otherwise(F.col("p_type")).alias("attorneys"), F.lit(" ").alias("judges"))
    return unpivot.meta_rows(padded, "p_partkey")


@query("""
    SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS ordinal, CAST(turn AS VARCHAR) AS page_label, turn * 7 AS char_offset, left(text, 20) AS anchor FROM conversations
""")
def break_rows(spark: SparkSession, d: str) -> DataFrame:
    """Page breaks of texts as rows of their own."""
    one = F.struct(
        F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).alias("ordinal"), F.col("turn").cast("string").alias("page_label"), (F.col("turn") * 7).alias("char_offset"), F.substring("text", 1, 20).alias("anchor")
    )
    texts = table(spark, d, "conversations").select("conv_id", one.alias("b")).groupBy("conv_id").agg(F.collect_list("b").alias("page_breaks"))
    return clean.page_breaks(texts, "conv_id")


@query("""
    WITH t AS (SELECT conv_id, turn, text FROM conversations)
    SELECT conv_id, arg_max(text, row(coalesce(length(text), 0), -turn)) AS text FROM t GROUP BY conv_id
""")
def longest_child(spark: SparkSession, d: str) -> DataFrame:
    """The longest text of each parent; of equally long ones the first child's."""
    return select.longest_child(table(spark, d, "conversations"), "conv_id", "turn", "text")


# --- classification -------------------------------------------------------------------------


def judged_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents in the shape of records: made-up volumes, pages and identifiers, labels as ledger. The
    source is the caption; what is said of whole texts uses their hash.

    Texts are read once, for the hash; the rest of a plan works on narrow rows.
    """
    docs = table(spark, d, "documents")
    records = docs.select(
        F.col("doc_id").alias("cluster_id"), F.col("source").alias("case_name"), (F.col("doc_id") % 24).cast("int").alias("us_volume"),
        ((F.col("doc_id") * 7) % 900).cast("string").alias("us_page"), F.when(F.col("doc_id") % 11 != 0, F.lit("cited")).alias("us_cite"), F.when(F.col("doc_id") % 3 == 0, F.col("lang")).alias("scdb_id"),
        F.coalesce(F.sha2("text", 256), F.lit("")).alias("text_hash"),  # texts that are null are equal
    )
    ledger = table(spark, d, "labels").where("toxic = 1").select(F.col("doc_id").alias("cluster_id"), F.when(F.col("quality") == 1, "keep").otherwise("drop").alias("disposition"))
    return classify.scope(records, ledger)


# The evidence strings and tells in this SQL are those that the rules give.
JUDGED = """
    WITH r AS (
      SELECT doc_id AS cluster_id, lower(source) AS name, doc_id % 24 AS v, (doc_id * 7) % 900 AS p, doc_id % 11 <> 0 AS cited, doc_id % 3 = 0 AS known,
             CASE WHEN toxic = 1 THEN CASE WHEN quality = 1 THEN 'keep' ELSE 'drop' END END AS disposition
      FROM documents LEFT JOIN labels USING (doc_id)),
    t AS (SELECT *, concat_ws(';', CASE WHEN starts_with(name, 'respublica') OR contains(name, 'commonwealth') THEN 'respublica/commonwealth' END,
      CASE WHEN starts_with(name, 'united states v') THEN 'us_criminal_caption' END, CASE WHEN contains(name, 'lessee') THEN 'lessee_ejectment' END,
      CASE WHEN v = 2 AND p < 401 THEN 'page_before_scotus_start' END) AS tells FROM r),
    j AS (SELECT cluster_id, v, CASE
      WHEN disposition = 'keep' THEN 'true|human_review' WHEN disposition = 'drop' THEN 'false|human_review'
      WHEN NOT cited THEN 'false|no_us_reports_cite' WHEN v < 2 OR v > 19 THEN 'false|out_of_scope_volume'
      WHEN v >= 5 THEN CASE WHEN known THEN 'true|scotus_reporter+scdb' ELSE 'true|scotus_only_reporter' END
      WHEN known THEN 'true|scdb_id' WHEN tells = '' THEN 'false|dallas_not_in_scdb' ELSE 'false|dallas_not_in_scdb:' || tells END AS x, tells FROM t)
"""


@query(JUDGED + """
    SELECT cluster_id, split_part(x, '|', 1) AS is_scotus, split_part(x, '|', 2) AS evidence, CASE WHEN split_part(x, '|', 1) = 'true' THEN 'keep' ELSE 'drop' END AS proposed FROM j
""")
def rule_classify(spark: SparkSession, d: str) -> DataFrame:
    return judged_documents(spark, d).select("cluster_id", "is_scotus", "evidence", "proposed")


@query("""
    SELECT doc_id, concat_ws(';', CASE WHEN contains(lower(text), 'license') THEN 'license' END, CASE WHEN starts_with(lower(text), 'the ') THEN 'article' END,
           CASE WHEN n_chars < 500 AND lang <> 'en' THEN 'short_foreign' END) AS tells FROM documents
""")
def rule_tells(spark: SparkSession, d: str) -> DataFrame:
    low = F.lower("text")
    named = [(low.contains("license"), "license"), (low.startswith("the "), "article"), ((F.col("n_chars") < 500) & (F.col("lang") != "en"), "short_foreign")]
    return table(spark, d, "documents").select("doc_id", classify.tells(named).alias("tells"))


@query("""
    WITH k AS (SELECT o_orderkey, max(o_orderstatus) AS s, count(DISTINCT l_linenumber) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey)
    SELECT CASE WHEN n = 0 THEN 'childless' WHEN s = 'F' THEN 'closed' ELSE 'open' END AS status, count(*) AS n_orders, CAST(sum(n) AS BIGINT) AS n_children FROM k GROUP BY 1
""")
def status_partition(spark: SparkSession, d: str) -> DataFrame:
    """Children are counted per order, a three-way status follows, and its parts are counted."""
    orders, lines = table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    counted = hierarchy.child_counts(orders, lines, "o_orderkey", "l_orderkey", "l_linenumber")
    status = F.when(F.col("n_children") == 0, "childless").when(F.col("o_orderstatus") == "F", "closed").otherwise("open")
    return counted.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n_orders"), F.sum("n_children").alias("n_children"))


def published_documents(spark: SparkSession, d: str) -> DataFrame:
    """Judged documents, with exact copies as duplicates of the smallest id in scope."""
    judged = stored(judged_documents(spark, d), "judged")
    texts = judged.where("is_scotus = 'true'").select("cluster_id", F.col("text_hash").alias("h"))
    first = texts.groupBy("h").agg(F.min("cluster_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    resolved = lookup(texts, first, "h", "copies", judged.count()).select(
        "cluster_id", F.when(F.col("cluster_id") == F.col("first"), "canonical").otherwise("duplicate").alias("dedup_role"),
        F.when(F.col("cluster_id") != F.col("first"), F.col("first")).alias("dup_of"), F.when(F.col("cluster_id") != F.col("first"), F.lit("text")).alias("dup_method"),
    )
    parents = judged.select("cluster_id", "case_name", "us_volume", "us_page", "us_cite", "scdb_id")
    return publish.publish_parents(parents, judged.select("cluster_id", "is_scotus", "evidence"), resolved)


PUBLISHED = JUDGED + """,
    f AS (SELECT j.*, d.text, d.source, d.n_chars, starts_with(x, 'true') AS kept, CASE WHEN starts_with(x, 'true') THEN min(cluster_id) OVER (PARTITION BY d.text, starts_with(x, 'true')) END AS first
          FROM j JOIN documents d ON d.doc_id = cluster_id),
    pub AS (SELECT cluster_id, source AS case_name, text, v, CASE WHEN kept THEN 1 ELSE 0 END AS is_scotus, CASE WHEN kept THEN CASE WHEN first = cluster_id THEN 'canonical' ELSE 'duplicate' END END AS dedup_role,
          CASE WHEN kept AND first <> cluster_id THEN first END AS dup_of,
          CASE WHEN NOT kept THEN 'not_scotus' WHEN first <> cluster_id THEN 'duplicate' WHEN v BETWEEN 2 AND 18 THEN 'included' ELSE 'outside_volume' END AS corpus_status FROM f)
"""


@query(PUBLISHED + "SELECT cluster_id, case_name, CAST(v AS INTEGER) AS us_volume, is_scotus, dedup_role, dup_of, CASE WHEN dup_of IS NOT NULL THEN 'text' END AS dup_method, corpus_status FROM pub")
def publish_clusters(spark: SparkSession, d: str) -> DataFrame:
    return published_documents(spark, d).select("cluster_id", "case_name", "us_volume", "is_scotus", "dedup_role", "dup_of", "dup_method", "corpus_status")


@query(PUBLISHED + """
    SELECT count(*) AS total, count(*) FILTER (WHERE corpus_status = 'included') AS included, count(*) FILTER (WHERE corpus_status = 'outside_volume') AS outside_volume,
      count(*) FILTER (WHERE corpus_status = 'duplicate') AS duplicate, count(*) FILTER (WHERE corpus_status = 'not_scotus') AS not_scotus,
      count(*) = count(*) FILTER (WHERE corpus_status IN ('included', 'outside_volume', 'duplicate', 'not_scotus')) AS conserved FROM pub
""")
def status_conservation(spark: SparkSession, d: str) -> DataFrame:
    parts = [F.count_if(F.col("corpus_status") == s).alias(s) for s in publish.STATUSES]
    row = published_documents(spark, d).agg(F.count(F.lit(1)).alias("total"), *parts)
    return row.withColumn("conserved", sum((F.col(s) for s in publish.STATUSES), F.lit(0)) == F.col("total"))


@query(PUBLISHED + "SELECT a.cluster_id, a.dup_of, b.case_name AS canonical_case_name FROM pub a JOIN pub b ON b.cluster_id = a.dup_of WHERE a.corpus_status = 'duplicate'")
def duplicate_view(spark: SparkSession, d: str) -> DataFrame:
    return publish.duplicates(published_documents(spark, d)).select("cluster_id", "dup_of", "canonical_case_name")


@query(PUBLISHED + "SELECT count(*) AS textless FROM pub p WHERE corpus_status = 'included' AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = p.cluster_id AND l.quality = 1)")
def textless(spark: SparkSession, d: str) -> DataFrame:
    """Corpus records without a child that has a text; labels of quality stand for texts."""
    texts = table(spark, d, "labels").where("quality = 1").select(F.col("doc_id").alias("cluster_id"))
    return publish.decisions(published_documents(spark, d)).join(texts, "cluster_id", "left_anti").agg(F.count(F.lit(1)).alias("textless"))


@query(PUBLISHED + """
    SELECT * FROM (SELECT 'scope_unrecognized' AS name, count(*) FILTER (WHERE is_scotus IS NULL) AS violations FROM pub
      UNION ALL SELECT 'status_impossible', count(*) FILTER (WHERE corpus_status IS NULL) FROM pub
      UNION ALL SELECT 'duplicate_incomplete', count(*) FILTER (WHERE dedup_role = 'duplicate' AND dup_of IS NULL) FROM pub
      UNION ALL SELECT 'duplicate_target_not_canonical', count(*) FROM pub a LEFT JOIN pub b ON b.cluster_id = a.dup_of WHERE a.dedup_role = 'duplicate' AND b.dedup_role IS DISTINCT FROM 'canonical'
      UNION ALL SELECT 'fields_on_non_duplicate', count(*) FILTER (WHERE dedup_role IS DISTINCT FROM 'duplicate' AND dup_of IS NOT NULL) FROM pub
      UNION ALL SELECT 'parent_repeated', count(*) FROM (SELECT cluster_id FROM pub GROUP BY 1 HAVING count(*) > 1)
      UNION ALL SELECT 'label_orphans', count(*) FROM labels WHERE doc_id NOT IN (SELECT cluster_id FROM pub)
      UNION ALL SELECT 'long_texts', count(*) FROM documents WHERE n_chars > 20000)
""")
def integrity_suite(spark: SparkSession, d: str) -> DataFrame:
    parents = published_documents(spark, d)
    labels, docs = table(spark, d, "labels"), table(spark, d, "documents")
    extra = {"label_orphans": labels.join(parents.select(F.col("cluster_id").alias("doc_id")), "doc_id", "left_anti"), "long_texts": docs.where("n_chars > 20000")}
    return suite(publish.violations(parents) | extra)


def published_turns(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    """Published tables made of the corpus: conversations are children of the documents of their number,
    turns are their page breaks, and words of the second turn's end are suspect spots."""
    parents = stored(published_documents(spark, d), "published")
    turns = table(spark, d, "conversations")
    children = turns.groupBy(F.col("conv_id").alias("opinion_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), " ").alias("clean_text"))
    children = stored(children.select("opinion_id", F.col("opinion_id").alias("cluster_id"), "clean_text", F.lit(1).alias("clean_version")), "children")
    citations = table(spark, d, "labels").select(F.col("doc_id").alias("cluster_id"))
    breaks = turns.select(F.col("conv_id").alias("opinion_id"), (F.col("turn") * 100).alias("char_offset"))
    spots = table(spark, d, "pages").select(F.col("page_id").alias("opinion_id"), F.lit(0).cast("long").alias("char_offset"))
    return parents, children, citations, breaks, spots


@query(PUBLISHED + """,
    ch AS (SELECT conv_id AS id, string_agg(text, ' ' ORDER BY turn) AS t FROM conversations GROUP BY 1),
    spots AS (SELECT page_id AS id, 0 AS place FROM pages), breaks AS (SELECT conv_id AS id, turn * 100 AS place FROM conversations)
    SELECT * FROM (SELECT 'scope_unrecognized' AS name, count(*) FILTER (WHERE is_scotus IS NULL) AS violations FROM pub
      UNION ALL SELECT 'status_impossible', count(*) FILTER (WHERE corpus_status IS NULL) FROM pub
      UNION ALL SELECT 'duplicate_incomplete', count(*) FILTER (WHERE dedup_role = 'duplicate' AND dup_of IS NULL) FROM pub
      UNION ALL SELECT 'duplicate_target_not_canonical', count(*) FROM pub a LEFT JOIN pub b ON b.cluster_id = a.dup_of WHERE a.dedup_role = 'duplicate' AND b.dedup_role IS DISTINCT FROM 'canonical'
      UNION ALL SELECT 'fields_on_non_duplicate', count(*) FILTER (WHERE dedup_role IS DISTINCT FROM 'duplicate' AND dup_of IS NOT NULL) FROM pub
      UNION ALL SELECT 'parent_repeated', count(*) FROM (SELECT cluster_id FROM pub GROUP BY 1 HAVING count(*) > 1)
      UNION ALL SELECT 'opinion_orphans', count(*) FROM ch WHERE id NOT IN (SELECT cluster_id FROM pub)
      UNION ALL SELECT 'citation_orphans', count(*) FROM labels WHERE doc_id NOT IN (SELECT cluster_id FROM pub)
      UNION ALL SELECT 'break_orphans', 0
      UNION ALL SELECT 'suspect_orphans', count(*) FROM spots WHERE id NOT IN (SELECT id FROM ch)
      UNION ALL SELECT 'break_offsets', count(*) FROM breaks JOIN ch USING (id) WHERE place > length(t)
      UNION ALL SELECT 'suspect_offsets', count(*) FROM spots JOIN ch USING (id) WHERE place > length(t)
      UNION ALL SELECT 'clean_versions', 0
      UNION ALL SELECT 'empty_strings', count(*) FROM ch WHERE t = ''
      UNION ALL SELECT 'status_recomputed', 0)
""")
def published_integrity(spark: SparkSession, d: str) -> DataFrame:
    """Every rule across published tables, with how many rows break it."""
    return suite(publish.integrity(*published_turns(spark, d)))


@query("""
    WITH p AS (SELECT conv_id, max(text) FILTER (WHERE role = 'assistant' AND turn < 3) AS a, max(text) FILTER (WHERE role = 'system') AS s, max(text) FILTER (WHERE role = 'user') AS u FROM conversations GROUP BY 1)
    SELECT conv_id, CASE WHEN s <> '' THEN 'system' WHEN a <> '' THEN 'assistant' WHEN u <> '' THEN 'user' END AS chosen, coalesce(s, a, u) AS text FROM p
""")
def source_priority(spark: SparkSession, d: str) -> DataFrame:
    turn = lambda role, more=None: F.max(F.when((F.col("role") == role) & (F.lit(True) if more is None else more), F.col("text"))).alias(role)
    wide = table(spark, d, "conversations").groupBy("conv_id").agg(turn("system"), turn("assistant", F.col("turn") < 3), turn("user"))
    fields = ("system", "assistant", "user")
    return wide.select("conv_id", select.chosen_name(fields).alias("chosen"), select.chosen_text(fields).alias("text"))


@query("""
    SELECT l_orderkey, l_linenumber, arg_min(l_returnflag, k) AS l_returnflag, arg_min(l_quantity, k) AS l_quantity FROM
      (SELECT *, row(l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS k FROM lineitem)
    GROUP BY l_orderkey, l_linenumber
""")
def citation_first_wins(spark: SparkSession, d: str) -> DataFrame:
    """Equal keys collapse to the first row of a stated order."""
    order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    return publish.first_of_equal(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], order).select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")


@query("""
    SELECT p_partkey, p_name FROM part
    WHERE p_name ILIKE 'RED%' AND p_size BETWEEN 5 AND 40 AND p_type IN ('ECONOMY', 'SMALL', 'STANDARD') AND p_brand IS DISTINCT FROM 'Brand#2' AND p_retailprice IS NOT NULL
      AND EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey)
""")
def predicates(spark: SparkSession, d: str) -> DataFrame:
    """Pattern, range, list, null-safe and existence predicates; all but the last reach the scan."""
    parts = table(spark, d, "part").where(
        F.col("p_name").ilike("RED%") & F.col("p_size").between(5, 40) & F.col("p_type").isin("ECONOMY", "SMALL", "STANDARD") & ~F.col("p_brand").eqNullSafe("Brand#2") & F.col("p_retailprice").isNotNull()
    )
    return parts.join(table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_semi").select("p_partkey", "p_name")


@query("""
    SELECT c_custkey, c_mktsegment, CAST(count(o_orderkey) AS BIGINT) AS n_orders, sum(o_totalprice) AS total
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_mktsegment
""")
def parents_with_sums(spark: SparkSession, d: str) -> DataFrame:
    """Parents with count and sum of their children, the sum null where there are none."""
    sums = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("o_orderkey").alias("n_orders"), F.sum("o_totalprice").alias("total"))
    rows = table(spark, d, "customer").select("c_custkey", "c_mktsegment").join(sums, "c_custkey", "left")
    return rows.select("c_custkey", "c_mktsegment", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), "total")


# --- reports --------------------------------------------------------------------------------


@query("SELECT lang AS status, count(*) AS n FROM documents GROUP BY lang")
def report_partition(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy(F.col("lang").alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT (SELECT count(*) FROM documents) AS documents, (SELECT count(*) FROM labels) AS labels, (SELECT count(*) FROM pages) AS pages, (SELECT count(DISTINCT conv_id) FROM conversations) AS conversations")
def report_totals(spark: SparkSession, d: str) -> DataFrame:
    names = ("documents", "labels", "pages", "conversations")
    one = lambda name: table(spark, d, name).agg((F.count_distinct("conv_id") if name == "conversations" else F.count(F.lit(1))).alias("n")).select(F.lit(name).alias("name"), "n")
    counts = reduce(DataFrame.unionByName, map(one, names))
    return counts.agg(*[F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in names])


@query("""
    SELECT CASE WHEN n_chars < 1000 THEN 'short' WHEN n_chars < 3000 THEN 'middle' ELSE 'long' END AS era, count(*) AS n, min(n_chars) AS first_size FROM documents GROUP BY 1
""")
def report_coverage(spark: SparkSession, d: str) -> DataFrame:
    era = F.when(F.col("n_chars") < 1000, "short").when(F.col("n_chars") < 3000, "middle").otherwise("long")
    return table(spark, d, "documents").groupBy(era.alias("era")).agg(F.count(F.lit(1)).alias("n"), F.min("n_chars").alias("first_size"))


@query("SELECT doc_id, CAST(length(text) AS INTEGER) AS chars FROM documents ORDER BY chars DESC, doc_id LIMIT 5")
def report_topk_longest(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.length("text").alias("chars")).orderBy(F.desc("chars"), "doc_id").limit(5)


@query("SELECT doc_id, CAST(length(text) AS INTEGER) AS chars FROM documents ORDER BY chars, doc_id LIMIT 5")
def report_topk_shortest(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.length("text").alias("chars")).orderBy("chars", "doc_id").limit(5)


@query("""
    SELECT o_orderdate, o_orderkey, (SELECT sum(l_quantity) FROM lineitem WHERE l_orderkey = o_orderkey) AS quantity FROM orders ORDER BY o_orderdate, o_orderkey
""")
def report_chronological(spark: SparkSession, d: str) -> DataFrame:
    """Every parent by date, with a sum over its children, null where it has none."""
    sums = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("quantity"))
    return table(spark, d, "orders").select("o_orderdate", "o_orderkey").join(sums, "o_orderkey", "left").select("o_orderdate", "o_orderkey", "quantity").orderBy("o_orderdate", "o_orderkey")


@query("SELECT count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders, count(*) AS rows FROM lineitem")
def report_distinct(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_orderkey").alias("orders"), F.count(F.lit(1)).alias("rows"))


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS stored, count(DISTINCT o_orderkey) = count(*) AS unique_ids FROM orders GROUP BY 1")
def yearly_manifest(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year"))
    return orders.agg(F.count(F.lit(1)).alias("stored"), (F.count_distinct("o_orderkey") == F.count(F.lit(1))).alias("unique_ids"))


# --- long form ------------------------------------------------------------------------------

PART_KINDS = ("p_name", "p_brand", "p_type")
LONG_FORM = """
    WITH u AS (SELECT p_partkey, unnest([{'kind': 'p_name', 'ord': 0, 't': p_name}, {'kind': 'p_brand', 'ord': 1, 't': nullif(p_brand, 'Brand#11')}, {'kind': 'p_type', 'ord': 2, 't': p_type}], recursive := true) FROM part),
    x AS (SELECT * FROM u WHERE t IS NOT NULL AND t <> '')
"""


def part_texts(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").withColumn("p_brand", F.when(F.col("p_brand") == "Brand#11", " ").otherwise(F.col("p_brand")))
    return unpivot.long_form(parts, "p_partkey", PART_KINDS)


@query(LONG_FORM + "SELECT p_partkey, kind, CAST(ord AS INTEGER) AS ord, CAST(length(t) AS BIGINT) AS char_count, t AS raw_text FROM x")
def unpivot_text(spark: SparkSession, d: str) -> DataFrame:
    return part_texts(spark, d)


@query(LONG_FORM + "SELECT kind, count(*) AS n, count(DISTINCT p_partkey) AS n_records FROM x GROUP BY kind")
def kind_counts(spark: SparkSession, d: str) -> DataFrame:
    return part_texts(spark, d).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("p_partkey").alias("n_records"))


@query(LONG_FORM + "SELECT p_partkey, string_agg(kind, ';' ORDER BY ord) AS kinds, CAST(sum(length(t)) AS BIGINT) AS total_chars FROM x GROUP BY p_partkey")
def manifest_kinds(spark: SparkSession, d: str) -> DataFrame:
    return unpivot.kinds_manifest(part_texts(spark, d), "p_partkey")


@query(PUBLISHED + "SELECT cluster_id, coalesce(dup_of, cluster_id) AS canonical_cluster_id FROM pub")
def canonical_pointer(spark: SparkSession, d: str) -> DataFrame:
    return unpivot.canonical_pointers(published_documents(spark, d))


@query(PUBLISHED + """
    SELECT count(DISTINCT coalesce(p.dup_of, p.cluster_id)) FILTER (WHERE c.corpus_status = 'included') AS reached_resolved,
           count(DISTINCT p.cluster_id) FILTER (WHERE p.corpus_status = 'included') AS reached_naive
    FROM labels l JOIN pub p ON p.cluster_id = l.doc_id JOIN pub c ON c.cluster_id = coalesce(p.dup_of, p.cluster_id)
""")
def auxiliary_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Corpus records that auxiliary rows (labels) reach by their own id, and through duplicates."""
    parents = published_documents(spark, d)
    rows = table(spark, d, "labels").select(F.col("doc_id").alias("cluster_id"))
    own = parents.select("cluster_id", F.col("corpus_status").alias("own_status"), F.coalesce("dup_of", "cluster_id").alias("canonical"))
    heads = parents.select(F.col("cluster_id").alias("canonical"), F.col("corpus_status").alias("head_status"))
    both = rows.join(own, "cluster_id").join(heads, "canonical")
    return both.agg(
        F.count_distinct(F.when(F.col("head_status") == "included", F.col("canonical"))).alias("reached_resolved"),
        F.count_distinct(F.when(F.col("own_status") == "included", F.col("cluster_id"))).alias("reached_naive"),
    )


# --- snapshots ------------------------------------------------------------------------------


@query("SELECT CAST(doc_id AS VARCHAR) AS path, sha256(text) AS sha256 FROM documents")
def sha_ledger(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("path"), F.encode("text", "UTF-8").alias("content"))
    return snapshots.checksums(files)


@query("""
    SELECT CAST(doc_id AS VARCHAR) AS path, CASE WHEN doc_id % 10 = 0 THEN 'missing' WHEN doc_id % 10 = 1 THEN 'not in ledger' ELSE 'hash mismatch' END AS reason
    FROM documents WHERE doc_id % 10 IN (0, 1, 2)
""")
def ledger_verify(spark: SparkSession, d: str) -> DataFrame:
    """A ledger against files of which some are gone, some are new and some have changed."""
    ledger = sha_ledger(spark, d)
    n = F.col("path").cast("long") % 10
    files = ledger.where(n != 0).withColumn("sha256", F.when(n == 2, F.sha2("sha256", 256)).otherwise(F.col("sha256")))
    return snapshots.verify(files, ledger.where(n != 1))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 8 = 0 THEN 'only_a' WHEN o_orderkey % 8 = 1 THEN 'only_b' WHEN o_orderkey % 8 = 2 THEN 'substantive' ELSE 'volatile' END AS status
    FROM orders WHERE o_orderkey % 8 < 4
""")
def snapshot_diff(spark: SparkSession, d: str) -> DataFrame:
    """Two readings of orders as JSON: records gone, new, changed, and changed in server fields alone."""
    n = F.col("o_orderkey") % 8
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    reading = lambda status, stamp: F.to_json(F.struct("o_custkey", status.alias("status"), stamp.alias("date_modified")))
    a = orders.where(n != 1).select("o_orderkey", reading(F.col("o_orderstatus"), F.lit("t1")).alias("record"))
    b = orders.where(n != 0).select("o_orderkey", reading(F.when(n == 2, F.lit("?")).otherwise(F.col("o_orderstatus")), F.when(n.isin(2, 3), F.lit("t2")).otherwise(F.lit("t1"))).alias("record"))
    return snapshots.diff(a, b, "o_orderkey")


@query("SELECT key, value FROM (VALUES ('pipeline_version', '2.0'), ('staging_documents', (SELECT CAST(count(*) AS VARCHAR) FROM documents)), ('staging_labels', (SELECT CAST(count(*) AS VARCHAR) FROM labels))) AS m(key, value)")
def meta_lineage(spark: SparkSession, d: str) -> DataFrame:
    staged = report_totals(spark, d).select("documents", "labels").unpivot([], ["documents", "labels"], "key", "value").withColumn("value", F.col("value").cast("string"))
    return publish.meta(spark, {"pipeline_version": publish.PIPELINE_VERSION}, staged)

