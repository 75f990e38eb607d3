"""The training-data pipeline: stages applied to ``documents`` one after another.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps,
with the columns of ``documents``; the last returns one row of digests for each.
SQL has no language profiles, so there is no SQL for the whole run; the stages
are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfmart.llm import decontaminate, language, ngram_join, pieces, sketch, substrings, text
from perfmart.llm.components import saved
from perfmart.session import scratch_path

#: Cosine below which a text is taken for no known language.
LEAST_SCORE = 0.05


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents go that have no letter, or whose n-grams are no
    closer to any language than chance (cosine under ``LEAST_SCORE``)."""
    text.bound_batches(spark)
    training = docs.where(language.fold(F.col("doc_id"), 3) != 1).select("text", "lang")
    found = language.predict(docs, language.prototypes(training))
    return found.where((F.col("lang_pred") != language.UND) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: five-word shingles, similarity 0.8; of each linked
    group the smallest id stays (so do texts without words, and rows without an
    id).  Where an id has several texts, each is judged for itself, and of the
    texts of the smallest id one stays; equal rows stay or go together."""
    found = ngram_join.linked_rows(docs.select(F.col("doc_id").alias("id"), "text"), 5, 80, one_node=False)
    gone = saved(found.where(~F.col("first")).select("id", "tag").distinct(), "near-copies")
    kept = sketch.without_ids(docs, "doc_id", gone.where(F.col("tag").isNull()).select("id"))
    odd = saved(gone.where(F.col("tag").isNotNull()).select(F.col("id").alias("__id"), F.col("tag").alias("__tag")), "near-copies-of-repeated-ids")
    if odd.isEmpty():
        return kept
    return kept.join(odd, (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__tag")), "left_anti")


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: words of repeated 50-word windows go; a document that
    loses all its words goes, too.  n_chars follows the text."""
    found = substrings.without_repeats(docs)
    changed = F.col("removed") > 0
    columns = [F.when(changed, F.col("rest")).otherwise(F.col("row.text")).alias("text") if c == "text"
               else F.when(changed, F.length("rest").cast("bigint")).otherwise(F.col("row.n_chars")).alias("n_chars") if c == "n_chars"
               else F.col(f"row.`{c}`") for c in docs.columns]
    return found.where(~changed | (F.col("removed") < F.col("words"))).select(*columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: contaminated documents go.  Rows are judged one
    by one: ids may be null or repeated; a null or wordless text stays, and an
    empty benchmark contaminates nothing."""
    found = decontaminate.contamination(docs, text.table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.where(~decontaminate.contaminated()).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: token counts and digests of the remaining documents, one row
    for each (repeated rows and null ids included); a null text is empty."""
    return pieces.digests(pieces.piece_ids(docs.select("doc_id", "text"), pieces.model_path(), carry=["doc_id"]))


STAGES = [
    ("language", keep_known_language),
    ("near_copies", keep_one_of_near_copies),
    ("substrings", drop_repeated_passages),
    ("decontaminate", drop_contaminated),
    ("sentencepiece", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
