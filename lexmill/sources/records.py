"""Raw records, ledgers and answer keys as DataFrames, and tables back to files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lexmill.functions.records import contract_violations
from lexmill.plans.checks import IntegrityError

TEXT, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()


def schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


CITATION = schema(reporter=TEXT, volume=TEXT, page=TEXT, type=INT, date_created=TEXT, date_modified=TEXT)
PARENT = schema(
    id=LONG, case_name=TEXT, case_name_full=TEXT, date_filed=TEXT, citations=T.ArrayType(CITATION), scdb_id=TEXT, source=TEXT,
    citation_count=INT, precedential_status=TEXT, sub_opinions=T.ArrayType(TEXT),
)
CHILD = schema(
    id=LONG, cluster_id=LONG, cluster=TEXT, type=TEXT, author_str=TEXT, extracted_by_ocr=T.BooleanType(), ordering_key=INT, html_lawbox=TEXT, xml_harvard=TEXT,
    html=TEXT, html_columbia=TEXT, html_anon_2020=TEXT, html_with_citations=TEXT, plain_text=TEXT,
)
AUXILIARY = schema(
    id=LONG, case_name_full=TEXT, attorneys=TEXT, judges=TEXT, syllabus=TEXT, headnotes=TEXT, summary=TEXT, headmatter=TEXT, arguments=TEXT,
    disposition=TEXT, history=TEXT, procedural_history=TEXT,
)
# Keys that records must have, and the kinds of some.
CONTRACTS = {
    "cluster": (("id", "case_name", "date_filed", "citations", "source", "sub_opinions"), {"id": "integer", "citations": "array", "sub_opinions": "array"}),
    "opinion": (("id", "cluster", "type"), {"id": "integer"}),
}


def read_records(spark: SparkSession, path: str, kind: T.StructType) -> DataFrame:
    """One record per JSON file under ``path``; a file that is no record of this kind raises."""
    return spark.read.schema(kind).option("multiLine", True).option("mode", "FAILFAST").json(f"{path}/*.json")


def read_array(spark: SparkSession, path: str, kind: T.StructType) -> DataFrame:
    """Records of one JSON file that holds an array of them."""
    return spark.read.schema(kind).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """``name, record``: each JSON file's name and text."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.decode("content", "UTF-8").alias("record"))


def check_contract(raw: DataFrame, entity: str) -> DataFrame:
    """``name, violation`` of raw records that break the contract of ``entity``."""
    required, kinds = CONTRACTS[entity]
    return raw.select("name", F.explode(contract_violations("record", required, kinds)).alias("violation"))


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_csv(spark: SparkSession, path: str, columns: tuple[str, ...], ordered: bool = False) -> DataFrame:
    """A CSV file with a header, or a folder of them, all text; what isn't there is an empty table. ``ordered``
    adds ``row``, by which rows are in order."""
    if not exists(spark, path):
        empty = spark.createDataFrame([], schema(**dict.fromkeys(columns, TEXT)))
        return empty.withColumn("row", F.struct(F.lit("").alias("file"), F.lit(0).cast("long").alias("line"))) if ordered else empty
    found = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return found.select(*[F.col(c) if c in found.columns else F.lit(None).cast("string").alias(c) for c in columns], *([row_order().alias("row")] if ordered else []))


def row_order() -> Column:
    """A row's place in a CSV file or a folder of them: files by path, and rows as they stand in one. A file
    with line breaks inside values is read by one task, in which the ids of rows rise."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))


def read_scope_ledger(spark: SparkSession, path: str) -> DataFrame:
    """``cluster_id, disposition, row``; rows without an id are skipped, the last row of an id counts.

    Dispositions other than keep and drop have no effect.
    """
    rows = read_csv(spark, path, ("cluster_id", "disposition"), ordered=True)
    rows = rows.where(F.coalesce("cluster_id", F.lit("")) != "")
    kept = rows.groupBy(F.col("cluster_id").cast("long").alias("cluster_id")).agg(F.max_by(F.trim(F.coalesce("disposition", F.lit(""))), "row").alias("disposition"))
    return kept


def read_pair_ledger(spark: SparkSession, path: str) -> DataFrame:
    """``cluster_id, dup_of`` of reviewed pairs; malformed rows raise."""
    from lexmill.operators.resolve import read_ledger

    return read_ledger(read_csv(spark, path, ("cluster_id", "dup_of", "disposition")))


def read_answer_key(spark: SparkSession, path: str) -> DataFrame:
    """``us_volume, page, name, year, ord``; the volume is the column ``rep_vol``."""
    if not exists(spark, path):
        raise IntegrityError(f"no answer key at {path}")
    rows = read_csv(spark, path, ("rep_vol", "page", "name", "year"), ordered=True)
    order = Window.partitionBy("rep_vol").orderBy("row")
    return rows.select(F.col("rep_vol").cast("int").alias("us_volume"), "page", "name", "year", F.row_number().over(order).alias("ord"))


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """``path, sha256`` of a ledger with two spaces between hash and path; blank lines are skipped."""
    parts = F.split(F.trim("value"), "  ", 2)
    return spark.read.text(path).where(F.trim("value") != "").select(parts[1].alias("path"), parts[0].alias("sha256"))


def write_csv(df: DataFrame, path: str, columns: tuple[str, ...]) -> None:
    """A folder with one CSV file: a header, columns in order, missing ones and nulls empty."""
    shown = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])
    shown.coalesce(1).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Records as JSON lines, keys in alphabetical order, nulls kept."""
    df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def write_stage(df: DataFrame, root: str, name: str) -> DataFrame:
    """A stage's table under ``root``, written anew and reread."""
    df.write.mode("overwrite").parquet(f"{root}/{name}")
    return df.sparkSession.read.parquet(f"{root}/{name}")


def reset(spark: SparkSession, root: str) -> None:
    """Deletes all staged tables, so that none of an earlier build survives."""
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
