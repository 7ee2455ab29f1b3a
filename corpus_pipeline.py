"""The corpus pipeline: stages over ``documents``, each written and read again.

Toxic documents go, one document of each group of near copies stays, documents
with benchmark passages go, sources are mixed to their weights, and the rest is
written as token files. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortloom.llm import toxicity
from cohortloom.llm.decontamination import drop_contaminated
from cohortloom.llm.mixing import mix
from cohortloom.llm.near_dedup import keep_one_per_group
from cohortloom.llm.queries import END_ID, TOXIC_FROM, TOXIC_LEARN_FROM, tokenizer_path
from cohortloom.llm.token_files import read_token_files, write_token_files
from cohortloom.llm.workspace import Workspace, delete_path, read_table

#: Near duplicates share at least so many per cent of their five-word shingles.
NEAR_PERCENT = 80
#: A leak is a document with at least so many per cent of an item's five-word shingles.
LEAK_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of op5, by a model of their own labels."""
    settings = toxicity.FtrlSettings()
    labels = read_table(spark, sf_dir, "labels")
    rows = toxicity.training_rows(docs, labels, TOXIC_LEARN_FROM, settings.max_rows)
    return toxicity.drop_toxic(docs, toxicity.fit(rows, settings), TOXIC_FROM)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    with Workspace(spark, "pipeline-near") as work:
        return keep_one_per_group(work, docs, NEAR_PERCENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    with Workspace(spark, "pipeline-leaks") as work:
        return drop_contaminated(work, docs, read_table(spark, sf_dir, "benchmark"), LEAK_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that their sources come near their weights."""
    return mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is read back from the token files: id, first token, tokens, checksum of each document."""
    with Workspace(spark, "pipeline-tokens") as work:
        return read_token_files(write_token_files(work, docs, tokenizer_path(spark, "word_bpe_49k.json"), END_ID))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_files", token_files),
]

#: The toxicity stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; what a stage wrote goes when the next has ended."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        written = Workspace(spark, f"pipeline-{name}")
        docs = written.result(stage(spark, docs, sf_dir))
        if before is not None:
            delete_path(spark, before.kept)
        before = written
    return docs
