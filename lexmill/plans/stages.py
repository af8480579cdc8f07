"""Stages over a staging folder, one per call: ``python -m lexmill.plans.stages STAGE ...``."""

from __future__ import annotations

import argparse
import datetime
import subprocess
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill import config
from lexmill.functions.text import plain_words, shingles, year_of
from lexmill.operators import classify, clean, hierarchy, publish, reconcile, resolve, select, unpivot
from lexmill.plans import reports
from lexmill.plans.checks import IntegrityError
from lexmill.sources import archive, records, rest
from lexmill.storage import stored

LONGEST = tuple(f"source_{k}" for k in hierarchy.TEXT_FIELDS)


def timestamp() -> str:
    return datetime.datetime.now(datetime.UTC).isoformat(timespec="seconds")


def commit() -> str:
    """The working tree's commit, or nothing outside of one."""
    done = subprocess.run(["git", "rev-parse", "HEAD"], capture_output=True, text=True, check=False)
    return done.stdout.strip()


def materialize(spark: SparkSession, raw: str, staging: str) -> dict[str, int]:
    """Raw records to linked parents and children; drops whatever was staged before."""
    parents = hierarchy.normalize_parents(records.read_records(spark, f"{raw}/clusters", records.PARENT))
    children = hierarchy.normalize_children(records.read_records(spark, f"{raw}/opinions", records.CHILD))
    parents, children = stored(parents, "parents"), stored(children, "children")
    linked = hierarchy.link(parents, children)
    records.reset(spark, staging)
    out = records.write_stage(linked, staging, "stg_clusters"), records.write_stage(children, staging, "stg_opinions")
    found = {"n_clusters": out[0].count(), "n_opinions": out[1].count()}
    records.write_stage(publish.meta(spark, found | {"built_at": timestamp(), "git_commit": commit()}), staging, "stg_meta")
    return found


def scope(spark: SparkSession, staging: str, ledger: str) -> dict[str, int]:
    judged = classify.scope(spark.read.parquet(f"{staging}/stg_clusters"), records.read_scope_ledger(spark, ledger))
    columns = ["cluster_id", "us_cite", "us_volume", "us_page", "case_name", "is_scotus", "evidence", "proposed"]
    return tally(records.write_stage(judged.select(*columns), staging, "stg_cluster_scope"), "is_scotus")


def candidates(spark: SparkSession, staging: str) -> DataFrame:
    """Records in scope with the shingles of their longest text; of equally long ones the first child's."""
    kept = spark.read.parquet(f"{staging}/stg_cluster_scope").where("is_scotus = 'true'").select("cluster_id")
    parents = spark.read.parquet(f"{staging}/stg_clusters").join(kept, "cluster_id")
    texts = spark.read.parquet(f"{staging}/stg_opinions").select("cluster_id", "opinion_id", select.longest_text(LONGEST).alias("text"))
    longest = select.longest_child(texts, "cluster_id", "opinion_id", "text")
    rows = parents.join(longest, "cluster_id", "left").withColumn("words", plain_words("text"))
    return rows.select("cluster_id", "us_volume", "us_page", "case_name", "scdb_id", year_of("date_filed").alias("year"), shingles("words").alias("shingles"))


def dedup(spark: SparkSession, staging: str, ledger: str) -> dict[str, int]:
    rows = stored(candidates(spark, staging), "candidates")
    return tally(records.write_stage(resolve.resolve(rows, records.read_pair_ledger(spark, ledger)), staging, "stg_cluster_dedup"), "dedup_role")


def validate(spark: SparkSession, staging: str, key: str, report: str) -> str:
    resolved = spark.read.parquet(f"{staging}/stg_cluster_dedup").where("dedup_role = 'canonical'")
    summary, detail = reconcile.reconcile(records.read_answer_key(spark, key), resolved)
    summary, detail = records.write_stage(summary, staging, "stg_validate_volume"), records.write_stage(detail, staging, "stg_validate_detail")
    records.write_csv(summary.orderBy("volume"), report, ("volume", "n_keep", "n_reference", "n_matched", "n_missing", "n_extra"))
    return "\n".join(reconcile.format_report(summary, detail))


def reselect(spark: SparkSession, staging: str) -> dict[str, int]:
    children = select.corpus_children(spark.read.parquet(f"{staging}/stg_opinions"), spark.read.parquet(f"{staging}/stg_cluster_dedup"))
    return tally(records.write_stage(select.select_sources(children), staging, "stg_opinion_source"), "chosen_source")


def clean_texts(spark: SparkSession, staging: str) -> dict[str, int]:
    texts = select.read_chosen(spark.read.parquet(f"{staging}/stg_opinions"), spark.read.parquet(f"{staging}/stg_opinion_source"))
    cleaned = stored(clean.clean(texts), "cleaned")
    breaks = records.write_stage(clean.page_breaks(cleaned), staging, "stg_page_break")
    out = records.write_stage(cleaned.select("opinion_id", "clean_text", "ocr_suspect", "clean_version"), staging, "stg_opinion_clean")
    return {"texts": out.count(), "page_breaks": breaks.count(), "with_suspects": out.where("ocr_suspect IS NOT NULL").count()}


def load(spark: SparkSession, staging: str, target: str) -> dict[str, int]:
    return publish.build(spark, staging, target, {"built_at": timestamp(), "git_commit": commit()})


def auxiliary(spark: SparkSession, raw: str, labels: str, target: str) -> dict[str, int]:
    """Auxiliary texts of the corpus, resolved to canonical records, and a manifest of their kinds.

    Without the labels nothing says which records are in the corpus, so their absence raises.
    """
    if not records.exists(spark, labels):
        raise IntegrityError(f"no labels of the corpus at {labels}: publish it first")
    known = records.read_csv(spark, labels, ("cluster_id", "bucket", "dedup_role", "dup_of"))
    known = known.select(F.col("cluster_id").cast("long"), "bucket", "dedup_role", F.nullif("dup_of", F.lit("")).cast("long").alias("dup_of"))
    pointers = unpivot.canonical_pointers(known)
    texts, metas, found = unpivot.build(records.read_array(spark, raw, records.AUXILIARY), pointers)
    texts.write.mode("overwrite").parquet(f"{target}/cluster_text")
    metas.write.mode("overwrite").parquet(f"{target}/cluster_meta")
    publish.meta(spark, found).write.mode("overwrite").parquet(f"{target}/meta")
    manifest = unpivot.kinds_manifest(texts, "cluster_id").join(known, "cluster_id").join(pointers, "cluster_id").orderBy("cluster_id")
    records.write_csv(manifest, f"{target}/manifest", ("cluster_id", "bucket", "dedup_role", "canonical_cluster_id", "kinds", "total_chars"))
    return found


def tally(rows: DataFrame, column: str) -> dict[str, int]:
    return {str(r[0]): r[1] for r in rows.groupBy(column).count().orderBy(column).collect()}


def extract(raw: str, parent_url: str, child_url: str, after: str, before: str) -> dict:
    """Mirrors an API's records between two dates; what is there already isn't fetched again."""
    client = rest.Client(headers=config.headers(config.api_token()))
    manifest = rest.extract(client, parent_url, child_url, after, before, Path(raw), timestamp(), commit())
    if manifest["wider_than_run"]:
        print(f"the mirror is wider than this run: {manifest['wider_than_run']} of {manifest['n_clusters']} records lie outside its dates")
    return manifest


def mirror_gaps(spark: SparkSession, raw: str) -> tuple[DataFrame, DataFrame]:
    """Declared children that the mirror lacks, and children without a parent there."""
    parents = hierarchy.normalize_parents(records.read_records(spark, f"{raw}/clusters", records.PARENT))
    children = hierarchy.normalize_children(records.read_records(spark, f"{raw}/opinions", records.CHILD))
    return hierarchy.undelivered(parents, children, "cluster_id", "declared_ids", "opinion_id"), hierarchy.orphans(children, parents, "cluster_id", "cluster_id").select("opinion_id", "cluster_id")


def show_gaps(spark: SparkSession, raw: str) -> int:
    """Prints what a mirror lacks, line by line; returns how many lines."""
    n = 0
    for what, rows in zip(("undelivered", "orphan"), mirror_gaps(spark, raw), strict=True):
        for row in rows.orderBy(*rows.columns).toLocalIterator():
            print(what, *row)
            n += 1
    return n


def show_report(spark: SparkSession, target: str) -> list[str]:
    """Prints the report pack over the last published set; returns its sections."""
    publish.register(spark, target)
    for name in reports.SECTIONS:
        print(name)
        rows = reports.report(spark, name)
        print("", *rows.columns, sep=" | ")
        for row in rows.toLocalIterator():
            print("", *["" if x is None else x for x in row], sep=" | ")
    return list(reports.SECTIONS)


STAGES = {
    "extract": lambda s, a: extract(a.raw, a.url, a.children, a.after, a.before),
    "package-mirror": lambda s, a: archive.package(Path(a.raw), Path(a.target), Path(a.ledger)),
    "fetch-mirror": lambda s, a: archive.fetch(a.url, Path(a.raw), Path(a.ledger), Path(a.target)),
    "materialize": lambda s, a: materialize(s, a.raw, a.staging),
    "scope": lambda s, a: scope(s, a.staging, a.ledger),
    "dedup": lambda s, a: dedup(s, a.staging, a.ledger),
    "validate": lambda s, a: validate(s, a.staging, a.key, a.target),
    "reselect": lambda s, a: reselect(s, a.staging),
    "clean": lambda s, a: clean_texts(s, a.staging),
    "load": lambda s, a: load(s, a.staging, a.target),
    "apparatus": lambda s, a: auxiliary(s, a.raw, a.ledger, a.target),
    "report": lambda s, a: show_report(s, a.target),
    "gaps": lambda s, a: show_gaps(s, a.raw),
}


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("stage", choices=STAGES)
    for name in ("raw", "staging", "ledger", "key", "target", "url", "children", "after", "before"):
        parser.add_argument(f"--{name}", default="")
    found = parser.parse_args(args)
    from lexmill.session import build_session

    print(STAGES[found.stage](build_session(), found))


if __name__ == "__main__":
    main()
