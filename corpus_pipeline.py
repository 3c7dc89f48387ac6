"""The cleaning pipeline over ``documents``: five stages, each written as Parquet and reread.

toxicity -> exact dedup -> n-gram Jaccard join -> benchmark decontamination -> best-fit packing.
The first four drop rows and keep all columns; the last returns packed pieces.
"""

from __future__ import annotations

from landfall.llm.common import saved
from landfall.llm.exact import exact_dedup
from landfall.llm.jaccard import without_near_copies
from landfall.llm.leaks import decontaminated
from landfall.llm.packing import pack_documents, public_vocabulary
from landfall.llm.severity import acceptable, fit_severity


def toxicity(spark, docs, sf_dir):
    """Documents whose chance of a toxic grade is below one half; fitted on ``labels``."""
    return acceptable(docs, fit_severity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact(spark, docs, sf_dir):
    """One of equal texts, the smallest doc_id."""
    return exact_dedup(docs)


def near(spark, docs, sf_dir):
    """One of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return without_near_copies(docs, words=5, percent=80)


def decontamination(spark, docs, sf_dir):
    """Documents without any ten-word window of a benchmark item."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark, docs, sf_dir):
    """Pieces of at most 4096 tokens with their place in a packed sequence."""
    return pack_documents(docs, public_vocabulary(), with_ids=False).drop("ids")


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact),
    ("ngram_jaccard_join", near),
    ("decontamination", decontamination),
    ("best_fit_packing", packing),
]
ORACLE_SQL = None  # the first stage is a trained model; tests/llm compares the others with brute force


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
