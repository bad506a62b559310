"""Corpus pipeline: quality, near duplicates, test items, mixture, token records.

Each stage takes the documents that the stage before kept. All but the last give
documents; the last writes the token records and gives what it read back of them.

Null and empty texts have no word, so the classifier rejects them. Rows with a null id
are judged by their text alone and stay through the near-duplicate stage. Of rows that
repeat an id, the classifier judges each; those of one group of near duplicates leave one
row, and an id that stays has one row behind that stage. Empty tables pass as empty
tables. The mixture repeats blocks of sources that end early. Further columns of
``documents`` are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordmill.llm import decontaminate, near_duplicates, quality_classifier, source_mix, token_records
from recordmill.llm.queries import table, word_vocabulary
from recordmill.llm.shared import DOCUMENT, settle
from recordmill.session import release, settled_tables


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    return quality_classifier.accepted(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group of near duplicates (five words, 0.8)."""
    return near_duplicates.deduplicated(docs)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the schedule; blocks of sources that end early come again."""
    return source_mix.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Framed token ids, read back from the files."""
    return token_records.token_records(docs, word_vocabulary())


STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", without_near_duplicates),
    ("benchmark decontamination", without_test_items),
    ("mixing sources to target weights", mixed_sources),
    ("token-ID / binary output", token_output),
]

#: The classifier is fitted and the searches are hashed, which SQL can't say; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again; what a stage wrote on the way is deleted behind it."""
    docs = table(spark, sf_dir, "documents").select(*DOCUMENT)
    begun = settled_tables()
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
        release(spark, begun, newest=1)
    return STAGES[-1][1](spark, docs, sf_dir)
