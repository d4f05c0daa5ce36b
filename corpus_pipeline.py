"""Corpus preparation: quality, near duplicates, benchmark leaks, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes
each stage's rows as Parquet in the shared checkpoint folder and reads them
again for the next one, so a lost executor never repeats an earlier stage.

In every stage texts are read whole, columns beside ``doc_id`` and ``text`` pass
through untouched whatever their names, and an empty table gives an empty one.
Rows, not ids, are documents: null and repeated ids are allowed, and each row is
judged by its own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm.decontaminate import find_leaks
from tessera.llm.ngram_join import ngram_jaccard_classes
from tessera.llm.pii_feistel import pseudonymise
from tessera.llm.quality_gam import keep_quality, train_quality
from tessera.llm.queries import KEY
from tessera.llm.sentencepiece_codec import encode_documents
from tessera.operators.staging import stage_table


def _free(docs: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _with_row(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` and the column that tells its rows apart: ``doc_id``, or, if an id
    is null or repeats, a number for each row of a staged copy."""
    odd = docs.groupBy("doc_id").agg(F.count("*").alias("c")).filter("c > 1 or doc_id is null")
    if odd.isEmpty():
        return docs, "doc_id"
    row = _free(docs, "row")
    return stage_table(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-rows"), row


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.3. The model is fitted on the
    labelled rows of ``documents``. Null and empty texts are scored as empty ones;
    equal texts score alike, so they stay or go together."""
    labelled = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train_quality(labelled, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return keep_quality(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id,
    or, where ids are null or repeat, the first row by number. Documents without
    words are near nothing and stay."""
    rows, row = _with_row(docs)
    classes = ngram_jaccard_classes(rows, id_col=row).filter("component_id <> doc_id").select(F.col("doc_id").alias(row))
    return rows.join(classes, row, "left_anti").select(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item. Null and empty texts leak none;
    rows with an equal or no id are tested one by one."""
    rows, row = _with_row(docs)
    leaks = find_leaks(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=row).select(F.col("doc_id").alias(row)).distinct()
    return rows.join(leaks, row, "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data; ``n_chars`` counts the new
    text (null if it is null). Equal values get equal pseudonyms in every row."""
    found = _free(docs, "n_pseudonyms")
    out = pseudonymise(docs, KEY, found_col=found).drop(found)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, round_trip) of every document; null and empty texts have no ids."""
    return encode_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: The quality model and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
