"""Repeated rows do not fill the samples that models are fitted on."""

from pyspark.sql import functions as F

from tallymark.llm import pu_quality
from tallymark.llm.language_id import _sampled


def repeated(spark):
    copies = spark.range(900).select(F.lit(1).cast("long").alias("doc_id"), F.lit("one text of words").alias("text"))
    others = spark.range(100, 140).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    return copies.union(others).withColumn("lang", F.lit("en"))


def test_copies_of_a_row_are_fitted_on_once(spark, monkeypatch):
    docs = repeated(spark)
    assert len(_sampled(docs, F.col("lang"), 2000, "doc_id", "text")) == 41
    sizes, made = [], pu_quality._rows

    def noted(*args):
        out = made(*args)
        sizes.append(len(out))
        return out

    monkeypatch.setattr(pu_quality, "_rows", noted)
    trusted = docs.filter("doc_id < 120").select("doc_id").distinct()
    assert pu_quality.fit_quality_model(docs, trusted) is not None
    assert sizes == [21, 41]
