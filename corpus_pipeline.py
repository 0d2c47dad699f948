"""From raw documents to token ids: quality rules, near-duplicates, secrets, mix, encoding.

Each stage reads what the one before has written, as Parquet in the shared folder, and
works on all of it. All but the last return the columns of documents.
"""

from pyspark.sql import DataFrame, SparkSession

from larder.llm import bpe, mixing, quality_rules, secret_scan, simhash_dedup
from larder.llm.common import passing_tables, remove, shared_folder, ship, stage, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a stratum's cutoffs reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document of least doc_id stays."""
    ship(spark)
    return simhash_dedup.keep_first(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reported spans are masked in the text."""
    return secret_scan.mask(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows come as often, and with as many of their words, as the mix takes them."""
    ship(spark)
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each row that the mix took, and whether they give back its text."""
    ship(spark)
    return bpe.encoded(docs)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources", mixture),
    ("BPE encoding and decoding", encode),
]

# SQL has neither the hash of the fingerprints nor the tokenizer's merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encoded rows of all stages in turn.

    Each stage's own tables go when its output is written, and that output when the next one's
    is. What the last stage reads stays in the shared folder, as its result is a plan.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for _, step in STAGES[:-1]:
        folder = shared_folder(spark)
        with passing_tables(spark):
            docs = stage(step(spark, docs, sf_dir), folder)
        if before:
            remove(spark, before)
        before = folder
    return STAGES[-1][1](spark, docs, sf_dir)
