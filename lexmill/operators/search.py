"""Full-text search over an inverted index, of rows or of stored blocks of postings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.text import fold_tokens

#: Parts of a stored index; a query reads those of its terms.
BUCKETS = 256
#: Ids that one block of postings spans, and how many numbers of blocks a scan is given as a filter.
BLOCK_IDS, FEW_BLOCKS = 4096, 1000


def inverted_index(texts: DataFrame, key: str, text: str, terms: list[str] | None = None) -> DataFrame:
    """``term, key, n``: how often a text has each term, diacritics and case folded; of ``terms`` alone,
    if they are given, so that a single query counts no others."""
    tokens = fold_tokens(text)
    if terms is not None:
        tokens = F.filter(tokens, lambda t: t.isin(*terms))
    found = texts.where(F.col(text).isNotNull()).select(key, F.explode(tokens).alias("term"))
    return found.groupBy("term", key).agg(F.count(F.lit(1)).alias("n"))


def bucket(term, buckets: int = BUCKETS):
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def postings(index: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, term, block, first, last, offsets, counts``: the texts of each term in blocks of ``BLOCK_IDS`` ids, by their
    offsets from the block's start, which take few bits. A term of a third of all texts is many blocks, none of them long."""
    place = F.pmod(key, F.lit(BLOCK_IDS)).cast("int")
    found = index.groupBy("term", ((F.col(key) - place) / BLOCK_IDS).cast("long").alias("block")).agg(F.array_sort(F.collect_list(F.struct(place.alias("o"), F.col("n").cast("int").alias("n")))).alias("p"))
    start = F.col("block") * BLOCK_IDS
    return found.select(
        bucket(F.col("term"), buckets).alias("bucket"), "term", "block", (start + F.get("p", F.lit(0))["o"]).alias("first"), (start + F.element_at("p", -1)["o"]).alias("last"),
        F.transform("p", lambda x: x["o"]).alias("offsets"), F.transform("p", lambda x: x["n"]).alias("counts"),
    )


def write_index(index: DataFrame, path: str, key: str, generation: int = 0, buckets: int = BUCKETS) -> None:
    """Stores an index: blocks of postings by buckets of terms, sorted, and how many texts each term has.

    New texts go to a ``generation`` of their own beside the earlier ones. Written again, a generation is replaced.
    """
    rows = postings(index, key, buckets).repartition("bucket").sortWithinPartitions("bucket", "term", "block")
    rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/blocks/generation={generation}")
    stored = index.sparkSession.read.parquet(f"{path}/blocks/generation={generation}")
    terms = stored.groupBy("bucket", "term").agg(F.sum(F.size("offsets")).alias("n_texts"), F.count("*").alias("n_blocks"))
    terms.repartition("bucket").sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/terms/generation={generation}")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", f"{path}/blocks").parquet(f"{path}/blocks")


def rows_of(blocks: DataFrame, key: str) -> DataFrame:
    """``term, key, n``: blocks as the index that they were made of."""
    each = blocks.select("term", "block", F.explode(F.arrays_zip("offsets", "counts")).alias("p"))
    return each.select("term", (F.col("block") * BLOCK_IDS + F.col("p.offsets")).alias(key), F.col("p.counts").cast("long").alias("n"))


def of_terms(rows: DataFrame, terms: list[str], buckets: int) -> DataFrame:
    """The rows of some terms, from their buckets alone."""
    row = rows.sparkSession.range(1).select(*[bucket(F.lit(t), buckets) for t in terms]).first()
    return rows.where(F.col("bucket").isin(*set(row)) & F.col("term").isin(*terms))


def find_all(spark: SparkSession, path: str, query: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Keys of the texts in a stored index that have every term of ``query``.

    The term of the fewest texts comes first; of the others only the blocks are read in which the terms before have
    texts: if those are few, their numbers go to the scan as a filter.
    """
    nothing = spark.createDataFrame([], f"{key} long")
    terms = query_terms(spark, query)
    if not terms:
        return nothing
    known = of_terms(spark.read.option("basePath", f"{path}/terms").parquet(f"{path}/terms"), terms, buckets).groupBy("term").agg(F.sum("n_texts").alias("n"), F.sum("n_blocks").alias("blocks")).collect()
    if len(known) < len(terms):
        return nothing
    order = sorted(known, key=lambda r: (r.n, r.term))
    blocks = of_terms(read_blocks(spark, path), terms, buckets)
    side = lambda t, name: blocks.where(F.col("term") == t).select("generation", "block", F.col("offsets").alias(name))
    found = side(order[0].term, "held")
    near = [r.block for r in found.select("block").distinct().collect()] if len(order) > 1 and order[0].blocks <= FEW_BLOCKS else None
    for r in order[1:]:
        other = side(r.term, "other")
        other = other if near is None else other.where(F.col("block").isin(*near))
        found = found.join(other, ["generation", "block"]).select("generation", "block", F.array_intersect("held", "other").alias("held")).where(F.size("held") > 0)
    return found.select("block", F.explode("held").alias("o")).select((F.col("block") * BLOCK_IDS + F.col("o")).alias(key))


def find(spark: SparkSession, path: str, query: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Keys of the texts in a stored index that match terms, or one of several alternatives separated by OR."""
    return reduce(DataFrame.union, [find_all(spark, path, q, key, buckets) for q in query.split(" OR ")]).distinct()


def query_terms(spark: SparkSession, query: str) -> list[str]:
    """Terms of a query, folded like those of the index; OR between alternatives is none."""
    row = spark.range(1).select(fold_tokens(F.lit(query.replace(" OR ", " "))).alias("t")).first()
    return list(dict.fromkeys(row.t))


def match_all(index: DataFrame, query: str, key: str) -> DataFrame:
    """Keys of texts that have every term of ``query``, in any order."""
    terms = query_terms(index.sparkSession, query)
    return index.where(F.col("term").isin(*terms)).groupBy(key).agg(F.count_distinct("term").alias("n_")).where(F.col("n_") == len(terms)).select(key)


def match_any(index: DataFrame, queries: list[str], key: str) -> DataFrame:
    """Keys of texts that match at least one of ``queries``."""
    found = [match_all(index, q, key) for q in queries]
    out = found[0]
    for x in found[1:]:
        out = out.union(x)
    return out.distinct()


def match(index: DataFrame, query: str, key: str) -> DataFrame:
    """A query of terms, which all have to match, and alternatives separated by OR."""
    return match_any(index, query.split(" OR "), key)
