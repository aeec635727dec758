import os

import pytest
from pyspark.sql import functions as F

from talkmill.llm import mixing
from talkmill.llm.tokens import vocabulary_path

pytestmark = pytest.mark.skipif(not os.path.exists(vocabulary_path()), reason="no vocabulary")


def docs(spark, sizes, start=0):
    rows, i = [], start
    for source, n in sizes.items():
        for j in range(n):
            rows.append((i, "palavra " * (3 + j % 9), source, 1.0))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string, tokens double")


def targets(spark, rows):
    return spark.createDataFrame(rows, "source string, target_share double, max_repeats int")


def test_shares_caps_and_epochs(spark):
    d = docs(spark, {"big": 3000, "small": 100, "none_wanted": 50})
    mixed, report = mixing.mix(d, targets(spark, [("big", 0.6, 1), ("small", 0.2, 5), ("gone", 0.2, 3)]))
    rep = {r["source"]: r for r in report.collect()}
    assert abs(rep["big"]["share"] - 0.75) < 0.01 and abs(rep["small"]["share"] - 0.25) < 0.01 and rep["gone"]["share"] == 0 and rep["none_wanted"]["tokens"] == 0
    assert rep["small"]["epochs"] == 5 and mixed.where("source = 'small'").agg(F.max("copies")).first()[0] == 5
    assert mixed.where("source = 'big'").agg(F.max("copies")).first()[0] == 1
    assert mixed.select("doc_id").distinct().count() == mixed.count()


def test_cut_equals_a_full_sort(spark):
    d = docs(spark, {"a": 700, "b": 300})
    t = targets(spark, [("a", 0.5, 2), ("b", 0.5, 2)])
    mixed, _ = mixing.mix(d, t, total_tokens=3000)
    sized = mixing.sized(d).toPandas()
    for source in "ab":
        own = sized[sized.source == source].sort_values(["key", "doc_id"])
        want = set(own.doc_id[own.n_tokens.cumsum() <= 1500])
        assert {r["doc_id"] for r in mixed.where(F.col("source") == source).collect()} == want


def test_heavier_documents_come_first(spark):
    d = docs(spark, {"a": 2000}).withColumn("w", F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.1))
    mixed, _ = mixing.mix(d.select("doc_id", "text", "source", "w"), targets(spark, [("a", 1.0, 1)]), total_tokens=4000, weight=F.col("w"))
    even = mixed.where("doc_id % 2 = 0").count()
    assert even > 0.75 * mixed.count()


def test_same_at_any_partitioning(spark):
    d, t = docs(spark, {"a": 300, "b": 100}), targets(spark, [("a", 0.7, 1), ("b", 0.3, 2)])
    one, other = mixing.mix(d.repartition(7), t)[0], mixing.mix(d.coalesce(1), t)[0]
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_nulls_repeats_and_empty(spark):
    t = targets(spark, [("a", 1.0, 2), (None, 0.5, 1)])
    rows = [(1, None, "a"), (2, "", "a"), (3, "x y", "a"), (3, "x y", "a"), (None, "z", "a"), (5, "q", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS n_tokens", "2 AS key", "3 AS bucket", "4 AS copies")
    mixed, report = mixing.mix(d, t)
    assert sorted(str(r["doc_id"]) for r in mixed.collect()) == ["3", "3", "None"] and {r["copies"] for r in mixed.collect()} == {2}
    assert mixing.mix(d.where("false"), t)[0].count() == 0
    assert mixing.mix(d, t.where("false"))[0].count() == 0


@pytest.mark.parametrize("weight", [1.0, 0.05, 1e-6])
def test_low_weights_crowd_no_task_and_equal_a_full_sort(spark, monkeypatch, weight):
    rows = [(i // 2, f"palavra {i} do texto", "a", "x") for i in range(3000)] + [(9000 + i, "curto", "b", "x") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, key string")
    targets = spark.createDataFrame([("a", 0.9, 1), ("b", 0.1, 1)], "source string, target_share double, max_repeats int")
    every = {}
    for leaf in (10**9, 25):
        monkeypatch.setattr(mixing, "LEAF", leaf)
        monkeypatch.setattr(mixing, "BUCKETS", 16)
        w = F.when(F.col("doc_id") % 7 == 0, 1.0).otherwise(weight)
        docs = mixing.sized(df, w)
        plan = mixing.budgets(docs, targets)
        if leaf == 25:
            cut = {r["source"]: r for r in mixing._cuts(docs, plan).collect()}["a"]
            assert docs.where((F.col("source") == "a") & F.col("key").between(cut["lo"], cut["hi"])).count() <= 25
        every[leaf] = sorted((r["doc_id"], r["n_tokens"], r["copies"]) for r in mixing.mix(df, targets, weight=w)[0].collect())
    assert every[25] == every[10**9] and 0 < len(every[25]) < 3040


def test_report_is_what_the_mixture_holds(spark):
    d = "/root/testdata/sf0.001"
    documents, targets = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/mix_targets.parquet")
    mixed, report = mixing.mix(documents, targets)
    mixed.createOrReplaceTempView("mixed_p8")
    want = spark.sql("SELECT source, sum(n_tokens * copies) AS tokens, count(*) AS n_used, sum(n_tokens * copies) / (SELECT sum(n_tokens * copies) FROM mixed_p8) AS share FROM mixed_p8 GROUP BY source")
    got = {r["source"]: r for r in report.collect()}
    for r in want.collect():
        assert (got[r["source"]]["tokens"], got[r["source"]]["n_used"]) == (r["tokens"], r["n_used"]) and abs(got[r["source"]]["share"] - r["share"]) < 1e-12
    assert sum(g["tokens"] for g in got.values()) == sum(r["tokens"] for r in want.collect())
