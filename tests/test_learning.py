"""Models fitted on weighted rows against models fitted on all rows."""

from __future__ import annotations

import itertools
import threading

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Observation, functions as F

from millrace.ml import features, models, search
from millrace.plans import learning

col = F.col


class Copies:
    """Lines and orders repeated with shifted keys."""

    def __init__(self, spark, sf_dir: str, n: int):
        copies = spark.range(n).select(col("id").alias("copy"))
        self.spark = spark
        self.lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").crossJoin(copies).withColumn("l_orderkey", col("l_orderkey") + col("copy") * 100_000).drop("copy")
        self.orders = spark.read.parquet(f"{sf_dir}/orders.parquet").crossJoin(copies).withColumn("o_orderkey", col("o_orderkey") + col("copy") * 100_000).drop("copy")


def points(spark):
    """Rows of few kinds, with labels that depend on them."""
    rows = spark.range(4000).select((col("id") % 7).cast("double").alias("a"), (col("id") % 5).cast("double").alias("b"), col("id").alias("k"),
                                    (F.pmod(F.xxhash64("id"), F.lit(7)) < col("id") % 7).cast("double").alias("label"))
    return rows.withColumn("worth", col("a") * 10 + col("b") * col("a") + F.pmod(F.xxhash64("k"), F.lit(9)))


def test_weighed_rows_give_the_logistic_model_of_all_rows(spark):
    rows, gather = points(spark), features.assembled(["a", "b"], "features")
    alike = gather.transform(features.weighed(rows, ["a", "b", "label"]))
    assert alike.count() < 100 and alike.agg(F.sum("weight")).first()[0] == 4000
    plain = models.logistic(100).fit(gather.transform(rows))
    weighted = models.logistic(100, weightCol="weight").fit(alike)
    assert list(weighted.coefficients) == pytest.approx(list(plain.coefficients), rel=1e-3)
    curve = BinaryClassificationEvaluator(weightCol="weight").evaluate(weighted.transform(alike))
    assert curve == pytest.approx(BinaryClassificationEvaluator().evaluate(plain.transform(gather.transform(rows))), rel=1e-9)


def test_rows_that_models_see_do_not_grow_with_copies(spark, sf_dir):
    sizes = []
    for n in (20, 40):
        train, test = learning.prepared_alike(Copies(spark, sf_dir, n), fold=learning.dealt(5, "l_orderkey", "l_linenumber"))
        sizes.append((train.count(), train.agg(F.sum("weight")).first()[0] + test.agg(F.sum("weight")).first()[0]))
    assert sizes[1][0] < 1.5 * sizes[0][0] and sizes[1][1] == 2 * sizes[0][1]


def test_weighed_values_keep_squared_errors_and_splits(spark):
    rows, gather = points(spark), features.assembled(["a", "b"], "features")
    alike = gather.transform(features.weighed_values(rows, ["a", "b"], "worth"))
    assert alike.count() <= 70
    plain = models.boosted_regressor("worth", maxIter=3).fit(gather.transform(rows))
    weighted = models.boosted_regressor("worth", maxIter=3, weightCol="weight").fit(alike)
    errors = [RegressionEvaluator(labelCol="worth", metricName=m).evaluate(plain.transform(gather.transform(rows))) for m in ("rmse", "r2")]
    scores = models.regression_scores(weighted.transform(alike), "worth", "weight")
    assert [scores["rmse"], scores["r2"]] == pytest.approx(errors, rel=1e-9)


def test_orders_that_are_alike_do_not_grow_with_copies(spark, sf_dir):
    sizes = []
    for n in (1, 3):
        train, test = learning.price_rows_alike(Copies(spark, sf_dir, n), ["month", "lines"], 70)
        sizes.append((train.count() + test.count(), train.agg(F.sum("weight")).first()[0] + test.agg(F.sum("weight")).first()[0]))
    assert sizes[1][0] < 1.5 * sizes[0][0] and sizes[1][1] == 3 * sizes[0][1]


def test_packed_rows_are_all_rows_in_the_parts_they_fill(spark):
    rows = points(spark).repartition(8)
    packed = features.packed(rows, 1500)
    assert packed.rdd.getNumPartitions() == 3 and sorted(packed.collect()) == sorted(rows.collect())
    assert features.packed(rows.where("a < 0")).rdd.getNumPartitions() <= 1
    train, _ = learning.prepared_alike(Lines(spark))
    assert train.rdd.getNumPartitions() == 1


class Lines:
    """A table of lines of few kinds."""

    def __init__(self, spark):
        self.spark = spark
        self.lineitem = spark.range(2000).selectExpr(
            "id div 4 as l_orderkey", "int(id % 4) as l_linenumber", "if(id % 3 = 0, 'A', 'N') as l_returnflag", "if(id % 2 = 0, 'F', 'O') as l_linestatus",
            "double(id % 7 + 1) as l_quantity", "0.05 as l_discount", "0.02 as l_tax", "double((id % 7 + 1) * (1400 + id % 5 * 50)) as l_extendedprice").repartition(8)


def test_folds_side_by_side_find_what_folds_in_turn_find(spark):
    train = features.assembled(["a", "b"], "features").transform(points(spark).withColumn("fold", learning.dealt(3, "k"))).coalesce(1).cache()
    gbt, evaluator = models.boosted_regressor("worth"), RegressionEvaluator(labelCol="worth", metricName="rmse")
    grid = models.depth_grid(gbt, (1, 2), (1, 3))
    turns = CrossValidator(estimator=gbt, estimatorParamMaps=grid, evaluator=evaluator, numFolds=3, foldCol="fold").fit(train)
    for ahead in (False, True):
        found = models.inside_pipeline([], gbt, grid, evaluator, 3, train, 6, "fold", ahead).stages[-1]
        assert found.avgMetrics == pytest.approx(turns.avgMetrics, rel=1e-9) and found.stdMetrics == pytest.approx(turns.stdMetrics, rel=1e-6)
        assert found.bestModel.toDebugString.split("\n", 1)[1] == turns.bestModel.toDebugString.split("\n", 1)[1]
    train.unpersist()


def test_models_of_all_folds_are_fitted_at_the_same_time(spark):
    """Fits wait for each other: six of them, of three folds and two points."""
    together, calls = threading.Barrier(6, timeout=60), itertools.count()

    class Waits(LogisticRegression):
        def fit(self, dataset, params=None):
            if next(calls) < 6:
                together.wait()
            return super().fit(dataset, params)

    train = features.assembled(["a", "b"], "features").transform(points(spark).withColumn("fold", learning.dealt(3, "k"))).coalesce(1)
    lr = Waits(labelCol="label", featuresCol="features")
    best = models.cross_validated(lr, models.logistic_grid(lr, (0.1, 1.0), (0.0,), (2,)), BinaryClassificationEvaluator(), 3, train, 6, fold="fold")
    assert len(best.avgMetrics) == 2 and not together.broken


def test_search_in_pipeline_fits_the_whole_grid(spark, sf_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(models, "inside_pipeline", lambda stages, gbt, grid, evaluator, folds, *a, **b: seen.append((folds, grid)) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        learning.l10_search_in_pipeline(Copies(spark, sf_dir, 1))
    [(folds, grid)] = seen
    assert folds == 3 and sorted(sorted((p.name, v) for p, v in x.items()) for x in grid) == [
        [("maxDepth", d), ("maxIter", n)] for d in (2, 5) for n in (10, 100)]


def test_sequential_search_scores_each_kind_of_held_lines_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(search, "validated", lambda estimator, fit, held, evaluator: seen.append((fit, held)) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        learning.l12_sequential_search(Lines(spark))
    [(fit, held)] = seen
    kinds = [df.select(*learning.SEEN).distinct().count() for df in (fit, held)]
    assert held.count() == kinds[1] and fit.count() > 2 * kinds[0]
    slot = F.pmod(col("l_orderkey") * 7919 + 11, F.lit(100))
    lines = [Lines(spark).lineitem.where(side).count() for side in (slot < 50, (slot >= 50) & (slot < 70))]
    assert [df.agg(F.sum("weight")).first()[0] for df in (fit, held)] == lines
    assert fit.rdd.getNumPartitions() == held.rdd.getNumPartitions() == 1


def test_logistic_models_score_after_the_session_has_observed_a_query(spark):
    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).collect()
    rows = features.assembled(["a", "b"], "features").transform(points(spark))
    assert seen.get == {"n": 3} and models.area_under_curve(models.logistic(2).fit(rows).transform(rows)) > 0.5
