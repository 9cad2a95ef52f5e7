import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SMALL
from verdance.llm import quality_model as Q


def read(spark, name, sf="/root/testdata/sf0.01"):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def test_held_out_accuracy(spark):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    rows = Q.score(docs, Q.train(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows)
    assert len(rows) > 100 and right >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_held_out_labels_are_not_used(spark):
    docs, labels = read(spark, "documents", SMALL), read(spark, "labels", SMALL)
    turned = labels.withColumn("quality", F.when(Q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    same = lambda m: (m.base, m.leaf.tolist())
    assert same(Q.train(docs, labels)) == same(Q.train(docs, turned))


def test_trees_equal_a_walk_node_by_node():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(500, 6))
    y = (x[:, 1] * x[:, 2] > 0.2).astype(float)
    model = Q.grow(x, y, trees=12)
    inner = model.feature.shape[1]
    for row, margin in zip(x[:50], model.margins(x[:50])):
        total = model.base
        for t in range(12):
            at = 0
            while at < inner:
                at = 2 * at + (2 if row[model.feature[t, at]] > model.threshold[t, at] else 1)
            total += model.leaf[t, at - inner]
        assert abs(total - margin) < 1e-9
    assert np.mean((model.scores(x) >= 0.5) == y) > 0.95


def test_one_label_or_none_gives_a_constant(spark, docs_of):
    docs = docs_of(["a b", "c"])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in Q.score(docs, Q.train(docs, none)).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(9)] + [(None, 0), (0, None), (1, 7)], "doc_id long, quality int")
    assert len({r.score for r in Q.score(docs, Q.train(docs, ones)).collect()}) == 1


def test_awkward_rows_and_clashing_names(spark, awkward):
    model = Q.train(read(spark, "documents", SMALL), read(spark, "labels", SMALL))
    rows = Q.score(awkward.selectExpr("*", "1 AS score", "'x' AS held_out"), model).collect()
    assert len(rows) == 14 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    kept = Q.keep_good(awkward.withColumn("score", F.lit(1)), model)
    assert kept.columns == [*awkward.columns, "score"] and kept.count() <= 14
    assert Q.score(awkward.limit(0), model).count() == 0
