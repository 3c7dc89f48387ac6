"""Held-out accuracy of the trained models on the given tables."""

import os
import random

import pytest
from pyspark.sql import functions as F

from landfall.llm import langid, severity

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = langid.op8_language_id(spark, SF).where("held_out").join(docs.where("lang IS NOT NULL"), "doc_id")
    right, n = found.agg(F.count_if(F.expr("lang_pred = lang")), F.count(F.lit(1))).first()
    assert n >= 40 and right >= 0.97 * n


def test_an_unlearned_language_is_rejected_more(spark, documents):
    """The model learns all but one language; texts of that one are accepted less often than the others'."""
    languages = [r.lang for r in documents.where("lang IS NOT NULL").groupBy("lang").count().orderBy("lang").collect()]
    unknown = languages[0]
    model = langid.fit(documents.where(F.col("lang") != unknown))
    assert unknown not in model.languages
    rng = random.Random(3)
    noise = [(-1 - i, "".join(rng.choice("qxzwvkjQXZ ") for _ in range(300))) for i in range(60)]
    given = documents.select("doc_id", "text").unionByName(spark.createDataFrame(noise, "doc_id long, text string"))
    found = langid.identify(given, model).join(documents.select("doc_id", "lang"), "doc_id", "left")
    share = F.avg(F.col("accepted").cast("int"))
    learned = found.where(F.col("lang") != unknown).agg(share).first()[0]
    other = found.where(F.col("lang") == unknown).agg(share).first()[0]
    strange = found.where("doc_id < 0").agg(share).first()[0]
    assert learned >= 0.95 and other <= learned - 0.2 and strange <= 0.5


def test_toxic_flags_of_held_out_documents(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = severity.fit_severity(documents, labels.where("doc_id % 4 <> 2"))
    held = severity.score_severity(documents, model).join(labels.where("doc_id % 4 = 2 AND toxic IS NOT NULL"), "doc_id")
    right, n = held.agg(F.count_if((F.col("p_toxic") >= 0.5) == (F.col("toxic") == 1)), F.count(F.lit(1))).first()
    assert n >= 20 and right >= 0.9 * n
