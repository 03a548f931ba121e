"""The corpus pipeline: documents go through five operators, one stage after another.

Each stage takes all rows that the one before it kept and returns the columns of documents, but for the last,
which returns the packed pieces. The first stage gives rows with a null id a number of their own, from NAMELESS on, so
that rules and joins can tell them apart; the last one takes it away again. Rows that share an id share its fate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapledger.llm import line_dedup, mixing, ngram_join, packing, quality
from lapledger.llm.queries import tokenizer
from lapledger.llm.tables import Shelf

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Ids from here on stand for null ones; of a group of copies a document with an id of its own stays.
NAMELESS = 1 << 62


def named(docs: DataFrame) -> DataFrame:
    """All rows with ids, written where some had none, so that their numbers stay the same."""
    if docs.filter("doc_id is null").isEmpty():
        return docs
    number = F.lit(NAMELESS) + F.monotonically_increasing_id()
    return Shelf(docs.sparkSession, "named").put(docs.select(*COLUMNS).withColumn("doc_id", F.coalesce("doc_id", number)), "docs")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    docs = named(docs)
    rated = quality.judged(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rejected = rated.filter(~F.col("kept")).select(F.col("id").alias("doc_id"))
    return docs.select(*COLUMNS).join(rejected, "doc_id", "left_anti")


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat earlier ones or nearly do."""
    cleaned = line_dedup.without_repeats(docs.select(*COLUMNS))
    return cleaned.withColumn("n_chars", F.length("text").cast("long"))


def unique_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (80 % of their five-word shingles) the document with the smallest id."""
    found = ngram_join.similar(docs, width=5, percent=80)
    copies = found.filter(F.col("id") != F.col("component_id")).select(F.col("id").alias("doc_id")).distinct()
    return docs.select(*COLUMNS).join(copies, "doc_id", "left_anti")


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them. Rows that share an id share its copies, rounded down."""
    taken = mixing.mixed(docs).groupBy(F.col("id").alias("doc_id")).agg(F.floor(F.sum("copies") / F.count(F.lit(1))).alias("copies"))
    taken = taken.filter("copies > 0").withColumnRenamed("doc_id", "taken_id")
    rows = docs.select(*COLUMNS).join(taken, F.col("doc_id").eqNullSafe(F.col("taken_id")))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(*COLUMNS)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    packed = packing.packed(docs, tokenizer()).withColumnsRenamed({"id": "doc_id", "crc": "ids_crc32"})
    return packed.withColumn("doc_id", F.when(F.col("doc_id") < NAMELESS, F.col("doc_id")))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", unique_lines),
    ("n-gram Jaccard join", unique_documents),
    ("mixing sources to target weights", mixed_sources),
    ("best-fit packing", packed_sequences),
]
#: Thresholds from labels, components, balanced sampling and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder before the next stage reads it."""
    shelf = Shelf(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = shelf.put(stage(spark, docs, sf_dir), f"stage-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
