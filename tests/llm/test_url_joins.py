"""Joins of the URL models keep what grows out of the driver."""

from pyspark.sql import functions as F

from tallybeam.llm import urls


def test_no_growing_side_of_the_models_is_broadcast(spark, monkeypatch):
    pages = spark.range(300).select(F.col("id").alias("page_id"), F.concat(F.lit("http://www.example."), F.element_at(F.array(F.lit("com/en/"), F.lit("net/es/"), F.lit("org/de/")), (F.col("id") % 3 + 1).cast("int")), F.xxhash64("id").cast("string")).alias("url"))
    plans, keep = {}, urls.materialise

    def materialise(df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, name)

    monkeypatch.setattr(urls, "materialise", materialise)
    assert urls.judge(pages).count() == 300
    growing = [*plans["url-probabilities"], *plans["url-gram-scores"]]
    assert len(growing) == urls.ORDER + 2 and all("SortMergeJoin" in p and "BroadcastHashJoin" not in p for p in growing)
    assert plans["scored-urls"][0].count("SortMergeJoin") == 2 and plans["scored-urls"][0].count("BroadcastHashJoin") == 2
