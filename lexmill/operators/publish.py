"""The published set: tables, views, counts, provenance and the rules that it has to meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.records import text_or_none
from lexmill.operators.clean import page_breaks, suspect_rows
from lexmill.operators.search import inverted_index, read_blocks, rows_of, write_index
from lexmill.operators.versions import Draft, current, table
from lexmill.plans.checks import IntegrityError, enforce

# Staged tables with the stage that makes each; the volumes of the corpus; the version.
REQUIRED = {
    "stg_clusters": "materialize", "stg_opinions": "materialize", "stg_cluster_scope": "scope", "stg_cluster_dedup": "dedup",
    "stg_opinion_source": "reselect", "stg_opinion_clean": "clean", "stg_page_break": "clean", "stg_meta": "materialize",
}
FIRST_VOLUME, LAST_VOLUME = 2, 18
PIPELINE_VERSION = "2.0"
STATUSES = ("included", "outside_volume", "duplicate", "not_scotus")


def scope_flag(value: Column | str) -> Column:
    """'true' and 'false' as 1 and 0; null for anything else, which ``violations`` reports."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value == "true", 1).when(value == "false", 0)


def corpus_status(flag: Column, role: Column, volume: Column, first: int = FIRST_VOLUME, last: int = LAST_VOLUME) -> Column:
    """The terminal status: each record has one, and null stands for an impossible combination."""
    canonical = (flag == 1) & (role == "canonical") & volume.isNotNull()
    return (
        F.when((flag == 0) & role.isNull(), "not_scotus")
        .when((flag == 1) & (role == "duplicate"), "duplicate")
        .when(canonical & volume.between(first, last), "included")
        .when(canonical, "outside_volume")
    )


def publish_parents(parents: DataFrame, scope: DataFrame, resolved: DataFrame) -> DataFrame:
    """Every parent with its verdicts and terminal status."""
    rows = parents.join(scope.select("cluster_id", F.col("is_scotus").alias("scope_"), F.col("evidence").alias("scope_evidence")), "cluster_id")
    rows = rows.join(resolved.select("cluster_id", "dedup_role", "dup_of", "dup_method"), "cluster_id", "left")
    rows = rows.withColumn("is_scotus", scope_flag("scope_"))
    return rows.withColumn("corpus_status", corpus_status(F.col("is_scotus"), F.col("dedup_role"), F.col("us_volume"))).drop("scope_")


def row_rules() -> dict[str, Column]:
    """Rules that a published parent breaks by itself."""
    duplicate = F.coalesce(F.col("dedup_role") == "duplicate", F.lit(False))
    return {
        "scope_unrecognized": F.col("is_scotus").isNull(),
        "status_impossible": F.col("corpus_status").isNull(),
        "duplicate_incomplete": duplicate & (F.col("dup_of").isNull() | F.col("dup_method").isNull()),
        "fields_on_non_duplicate": ~duplicate & (F.col("dup_of").isNotNull() | F.col("dup_method").isNotNull()),
    }


def joined_rules(parents: DataFrame) -> dict[str, DataFrame]:
    """Rules that take several parents, each as the rows that break it."""
    roles = parents.select(F.col("cluster_id").alias("dup_of"), F.col("dedup_role").alias("target_role"))
    targets = parents.where((F.col("dedup_role") == "duplicate") & F.col("dup_of").isNotNull()).join(roles, "dup_of", "left")
    return {
        "duplicate_target_not_canonical": targets.where(~F.col("target_role").eqNullSafe("canonical")),
        "parent_repeated": parents.groupBy("cluster_id").count().where("count > 1"),
    }


def violations(parents: DataFrame) -> dict[str, DataFrame]:
    """Rules over published parents, each as the rows that break it."""
    return {k: parents.where(rule) for k, rule in row_rules().items()} | joined_rules(parents)


def publish_citations(parents: DataFrame) -> DataFrame:
    """Citations of each parent; of equal ones the first, with its type."""
    every = parents.select("cluster_id", F.posexplode("citations").alias("pos", "c"))
    every = every.select("cluster_id", "pos", F.col("c.reporter").alias("reporter"), text_or_none("c.volume").alias("volume"), text_or_none("c.page").alias("page"), F.col("c.type").alias("type"))
    return first_of_equal(every, ["cluster_id", "reporter", "volume", "page"], ["pos"]).drop("pos")


def first_of_equal(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row of each key: the first by ``order``. Pre-aggregated, so a hot key is no burden."""
    rest = [c for c in rows.columns if c not in key]
    picked = rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r_"))
    return picked.select(*key, *[F.col(f"r_.{c}").alias(c) for c in rest]).select(*rows.columns)


def publish_children(children: DataFrame, selected: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Every child; text only where it was cleaned, and null rather than empty."""
    rows = children.join(selected.select("opinion_id", "chosen_source", F.col("is_ocr_dirty").cast("int").alias("is_ocr_dirty")), "opinion_id", "left")
    rows = rows.join(cleaned.select("opinion_id", "clean_text", "clean_version"), "opinion_id", "left")
    return rows.select("opinion_id", "cluster_id", "type", "author", F.col("is_ocr_extracted").cast("int").alias("is_ocr_extracted"), "ordering_key", "chosen_source", "is_ocr_dirty", "clean_text", "clean_version")


def counts(parents: DataFrame, children: DataFrame, declared_citations: DataFrame, citations: DataFrame, breaks: DataFrame, spots: DataFrame) -> dict[str, int]:
    """Counts of the published set; the parts of the partition sum to its total."""
    of_status = {r[0]: r[1] for r in parents.groupBy("corpus_status").count().collect()}
    total = sum(of_status.values())
    found = {"n_clusters_total": total} | {f"n_clusters_{s}": of_status.get(s, 0) for s in STATUSES}
    if sum(of_status.get(s, 0) for s in STATUSES) != total:
        raise IntegrityError("the statuses don't sum to the total")
    n_children, n_texts = children.agg(F.count(F.lit(1)), F.count("clean_text")).first()
    every, kept = declared_citations.agg(F.sum(F.size("citations"))).first()[0] or 0, citations.count()
    return found | {
        "n_decisions": decisions(parents).count(), "n_opinions": n_children, "n_corpus_opinions": n_texts, "n_review_ledger_folds": parents.where("dup_method = 'human_review'").count(),
        "n_citations": kept, "n_citation_dupes_dropped": every - kept, "n_page_breaks": breaks.count(), "n_ocr_suspects": spots.count(),
    }


def decisions(parents: DataFrame) -> DataFrame:
    """The corpus: what later work reads."""
    return parents.where("corpus_status = 'included'")


def duplicates(parents: DataFrame, name: str = "case_name", cite: str = "us_cite") -> DataFrame:
    """Duplicates with their canonical record's name and citation."""
    head = parents.select(F.col("cluster_id").alias("dup_of"), F.col(name).alias("canonical_case_name"), F.col(cite).alias("canonical_us_cite"))
    return parents.where("corpus_status = 'duplicate'").join(head, "dup_of")


def meta(spark: SparkSession, values: dict[str, object], staged: DataFrame | None = None) -> DataFrame:
    """``key, value`` rows, all text: given values, and the staging's own under ``staging_``."""
    rows = spark.createDataFrame(sorted((k, None if v is None else str(v)) for k, v in values.items()), "key string, value string")
    return rows if staged is None else rows.unionByName(staged.select(F.concat(F.lit("staging_"), "key").alias("key"), "value"))


def staged_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The staged tables under ``root``; raises and names the stages to run if some are absent."""
    fs = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    there = {k: fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{k}")) for k in REQUIRED}
    if not all(there.values()):
        raise IntegrityError("staged tables are missing: " + ", ".join(f"{k} (run stage {REQUIRED[k]})" for k, x in there.items() if not x))
    return {k: spark.read.parquet(f"{root}/{k}") for k in REQUIRED}


def build(spark: SparkSession, staging: str, target: str, values: dict[str, object] | None = None) -> dict[str, int]:
    """Publishes the set as a new version under ``target`` and registers its views; returns its counts.

    A table's counts and the rules that a row can break by itself are observed as it is written; rules that
    take a join follow. A set that breaks any isn't committed, and the version before it stays.
    """
    staged = staged_tables(spark, staging)
    draft = Draft(spark, target)
    parents = publish_parents(staged["stg_clusters"], staged["stg_cluster_scope"], staged["stg_cluster_dedup"])
    of_status = {f"n_clusters_{s}": F.count_if(F.col("corpus_status") == s) for s in STATUSES}
    seen = draft.write(
        "clusters", parents.drop("citations", "declared_ids"), n_clusters_total=F.count(F.lit(1)), **of_status, n_decisions=F.count_if(F.col("corpus_status") == "included"),
        n_review_ledger_folds=F.count_if(F.col("dup_method") == "human_review"), **{k: F.count_if(rule) for k, rule in row_rules().items()},
    )
    if bad := [(k, seen[k]) for k in row_rules() if seen[k]]:
        raise IntegrityError(", ".join(f"{k}: {n} rows" for k, n in bad))
    enforce(joined_rules(draft.read("clusters")))
    cleaned = staged["stg_opinion_clean"]
    declared = Observation()
    cited = staged["stg_clusters"].observe(declared, F.sum(F.size("citations")).alias("n"))
    draft.write("citations", publish_citations(cited))
    texts = draft.write("opinions", publish_children(staged["stg_opinions"], staged["stg_opinion_source"], cleaned), n_opinions=F.count(F.lit(1)), n_corpus_opinions=F.count("clean_text"))
    draft.write("page_breaks", staged["stg_page_break"])
    draft.write("ocr_suspects", suspect_rows(cleaned))
    rows = {k: t["rows"] for k, t in draft.tables.items()}
    found = {k: n for k, n in seen.items() if k not in row_rules()} | texts | {"n_citations": rows["citations"], "n_citation_dupes_dropped": (declared.get["n"] or 0) - rows["citations"], "n_page_breaks": rows["page_breaks"], "n_ocr_suspects": rows["ocr_suspects"]}
    if sum(found[k] for k in of_status) != found["n_clusters_total"]:
        raise IntegrityError("the statuses don't sum to the total")
    write_index(inverted_index(draft.read("opinions").where("clean_text IS NOT NULL"), "opinion_id", "clean_text"), draft.path("opinions_fts"), "opinion_id")
    draft.write("meta", meta(spark, {"pipeline_version": PIPELINE_VERSION} | (values or {}) | found, staged["stg_meta"]))
    draft.commit()
    register(spark, target)
    return found


def register(spark: SparkSession, target: str) -> None:
    """Views of the last committed set."""
    for name in ("clusters", "citations", "opinions", "page_breaks", "ocr_suspects", "meta"):
        table(spark, target, name).createOrReplaceTempView(name)
    rows_of(read_blocks(spark, index_path(spark, target)), "opinion_id").createOrReplaceTempView("opinions_fts")
    decisions(spark.table("clusters")).createOrReplaceTempView("scotus_decisions")
    duplicates(spark.table("clusters")).createOrReplaceTempView("duplicate_clusters")


def index_path(spark: SparkSession, target: str) -> str:
    """Where the index of the last committed set is, for ``search.find``."""
    return f"{target}/v={current(spark, target)['version']}/opinions_fts"


def integrity(parents: DataFrame, children: DataFrame, citations: DataFrame, breaks: DataFrame, spots: DataFrame) -> dict[str, DataFrame]:
    """Rules across the published tables, each as the rows that break it."""
    texts = children.select("opinion_id", F.length("clean_text").alias("n"))
    inside = lambda rows: rows.join(texts, "opinion_id").where((F.col("char_offset") < 0) | (F.col("char_offset") > F.col("n")))
    status = corpus_status(F.col("is_scotus"), F.col("dedup_role"), F.col("us_volume"))
    versions = children.where("clean_text IS NOT NULL").agg(F.count_distinct("clean_version").alias("n")).where("n > 1")
    blanks = [parents.where(F.col(c) == "").select("cluster_id") for c in ("case_name_full", "scdb_id", "us_cite") if c in parents.columns]
    empty = blanks[0]
    for b in blanks[1:]:
        empty = empty.union(b)
    return violations(parents) | {
        "opinion_orphans": children.join(parents, "cluster_id", "left_anti"),
        "citation_orphans": citations.join(parents, "cluster_id", "left_anti"),
        "break_orphans": breaks.join(children, "opinion_id", "left_anti"),
        "suspect_orphans": spots.join(children, "opinion_id", "left_anti"),
        "break_offsets": inside(breaks), "suspect_offsets": inside(spots), "clean_versions": versions,
        "empty_strings": empty.union(children.where("clean_text = ''").select("opinion_id")),
        "status_recomputed": parents.where(~F.col("corpus_status").eqNullSafe(status)),
    }


__all__ = ["build", "counts", "integrity", "page_breaks", "publish_children", "publish_citations", "publish_parents"]
