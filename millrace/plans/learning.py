"""Queries that fit and score models on the raw tables."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from millrace.ml import features, models, search
from millrace.operators.relational import match
from millrace.plans.streams import collected
from millrace.registry import Tables, query
from millrace.streaming import messages

col = F.col
NUMBERS = ["l_quantity", "l_discount", "l_tax"]


def line_rows(t: Tables) -> DataFrame:
    """Order lines with text and number features; the label is whether the line is dear."""
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", *NUMBERS, "l_extendedprice",
                             F.when(col("l_extendedprice") / col("l_quantity") > 1500, "dear").otherwise("cheap").alias("cost"))


def by_key(df: DataFrame, key: str, share: int) -> tuple[DataFrame, DataFrame]:
    """Repeatable split by an integer key: a key is always on the same side."""
    slot = F.pmod(F.col(key) * 7919 + 11, F.lit(100))
    return df.where(slot < share), df.where(slot >= share)


def prepared(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = line_rows(t)
    model = features.mixed_features(["l_returnflag", "l_linestatus"], NUMBERS, "cost").fit(rows)
    return by_key(model.transform(rows), "l_orderkey", 70)


#: what a model of the lines sees, and how many rows stand for lines that are alike, so that a random part of the rows leaves
#: out some of these lines and not all
SEEN, PIECES = ["l_returnflag", "l_linestatus", *NUMBERS, "cost"], 4


def dealt(n: int, *key: str, seed: int = 0) -> Column:
    """Repeatable number below ``n`` by a hash of a row's key."""
    return F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(n)).cast("int")


def prepared_alike(t: Tables, **deals: Column) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`prepared`, those that are alike as one with a weight; features are fitted on all lines."""
    rows = line_rows(t)
    model = features.mixed_features(["l_returnflag", "l_linestatus"], NUMBERS, "cost").fit(rows)
    train, test = by_key(rows, "l_orderkey", 70)
    return model.transform(features.packed(features.weighed(train, SEEN, **deals))), model.transform(features.weighed(test, SEEN))


@query
def l1_string_index(t: Tables):
    return features.indexed(t.orders, ["o_orderpriority"]).groupBy("o_orderpriority").agg(
        F.max("o_orderpriority_idx").alias("idx"), F.count("*").alias("n"))


@query
def l2_l3_l5_features(t: Tables):
    """Size and sum of the assembled vectors per category."""
    rows = line_rows(t)
    out = features.mixed_features(["l_returnflag", "l_linestatus"], NUMBERS, "cost").fit(rows).transform(rows)
    v = vector_to_array("features")
    ones = F.aggregate(F.slice(v, 1, F.size(v) - 3), F.lit(0.0), lambda a, x: a + x)
    return out.select("l_returnflag", F.size(v).alias("size"), ones.alias("ones")).groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.max("size").alias("size"), F.sum("ones").alias("ones"))


@query
def l4_vector_index(t: Tables):
    stages = features.category_indexed(["p_size", "p_retailprice"])
    model = Pipeline(stages=stages).fit(t.part)
    v = vector_to_array("features")
    return model.transform(t.part).select("p_partkey", v[0].alias("size_feature"), v[1].alias("price_feature"))


@query
def l6_l11_logistic(t: Tables):
    """Held-out lines per label, and whether the area under the curve on them is well above chance."""
    train, test = prepared(t)
    scored = models.logistic().fit(train).transform(test)
    auc = models.area_under_curve(scored)
    return scored.groupBy("cost").agg(F.count("*").alias("n"), F.lit(auc > 0.6).alias("above_chance"))


@query
def l7_t13_boosted_stream(t: Tables):
    """A fitted classifier applied to a stream of fixed-length vectors."""
    schema = t.spark.read.parquet(f"{t.sf_dir}/embeddings.parquet").schema
    size = len(t.embeddings.select("embedding").first()["embedding"])

    def vectors(df: DataFrame) -> DataFrame:
        return df.select("vec_id", array_to_vector(col("embedding").cast("array<double>")).alias("vec"), (col("label") % 2).cast("double").alias("label"))

    stages = [features.sized("vec", size), features.assembled(["vec"], "features"), models.boosted_classifier()]
    model = Pipeline(stages=stages).fit(vectors(t.embeddings))
    live = vectors(messages.table_stream(t.spark, t.sf_dir, "embeddings", schema))
    scored = collected(model.transform(live).select("vec_id", "label", "prediction"), t, "scored")
    # no worse than always giving the more frequent label
    sums = scored.agg(F.count_if(col("label") == col("prediction")).alias("right"), F.greatest(
        F.count_if(col("label") == 1), F.count_if(col("label") == 0)).alias("constant"))
    return scored.groupBy("label").agg(F.count("*").alias("n"), F.count_distinct("vec_id").alias("vectors"),
                                       F.lit(bool(sums.select(col("right") >= col("constant")).first()[0])).alias("beats_constant"))


def price_rows(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", F.month("o_orderdate").alias("month"), F.year("o_orderdate").alias("year"), "o_orderpriority")
    lines = t.lineitem.groupBy(col("l_orderkey").alias("k")).agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("units"),
                                                                F.sum("l_extendedprice").alias("worth"))
    return match(o, lines, o_orderkey="k")


def price_rows_alike(t: Tables, columns: list[str], share: int, **deals: Column) -> tuple[DataFrame, DataFrame]:
    """Orders that are alike in some columns as weighted rows, by the sides of :func:`by_key`; the tables are read once."""
    slot = F.pmod(col("o_orderkey") * 7919 + 11, F.lit(100))
    rows = features.packed(features.weighed_values(price_rows(t), columns, "worth", train=slot < share, **deals))
    return rows.where("train"), rows.where("not train")


def squared_error(guess: Column, label: str) -> Column:
    return F.sqrt(F.sum(F.pow(col(label) - guess, 2) * col("weight")) / F.sum("weight"))


def regression_report(train: DataFrame, scored: DataFrame, label: str, per: str) -> DataFrame:
    """Held-out rows, and whether the predictions are at least a third better than the mean of the training rows and no
    more than a quarter worse than a plain rate (training total of the label by total of ``per``); rows have a ``weight``."""
    worth, units, n = (F.sum(c * col("weight")) for c in (col(label), col(per), F.lit(1)))
    known = train.agg((worth / n).alias("mean"), (worth / units).alias("rate")).first()
    scores = models.regression_scores(scored, label, "weight")
    mean, rate = (squared_error(guess, label) for guess in (F.lit(known["mean"]), col(per) * known["rate"]))
    better = (scores["rmse"] <= 2 * mean / 3) & F.lit(scores["r2"] > 0.5)
    return scored.agg(F.sum("weight").cast("bigint").alias("n"), better.alias("better_than_mean"), (scores["rmse"] <= 1.25 * rate).alias("near_plain_rate"))


@query
def l8_boosted_regression(t: Tables):
    columns = ["month", "year", "lines", "units"]
    train, test = price_rows_alike(t, columns, 70)
    model = Pipeline(stages=features.category_indexed(columns) + [models.boosted_regressor("worth", weightCol="weight")]).fit(train)
    return regression_report(train, model.transform(test), "worth", "units")


@query
def l9_forest_regression(t: Tables):
    """Worth of an order from its lines, units and priority."""
    train, test = by_key(features.indexed(price_rows(t), ["o_orderpriority"]).withColumn("weight", F.lit(1.0)), "o_orderkey", 80)
    stages = [features.assembled(["o_orderpriority_idx", "lines", "units"], "features")]
    model = Pipeline(stages=stages + [models.forest_regressor("worth")]).fit(train)
    return regression_report(train, model.transform(test), "worth", "units")


@query
def l10_grid_search(t: Tables):
    """Every point of the 27-point grid, five folds: whether its mean area under the curve is no worse than chance."""
    train, _ = prepared_alike(t, fold=dealt(5, "l_orderkey", "l_linenumber"))
    lr = models.logistic(weightCol="weight")
    best = models.cross_validated(lr, models.logistic_grid(lr), BinaryClassificationEvaluator(weightCol="weight"), 5, train.cache(), parallelism=12, fold="fold")
    train.unpersist()
    return models.grid_scores(t.spark, best).select("params", (col("metric") > 0.49).alias("no_worse_than_chance"))


@query
def l10_search_in_pipeline(t: Tables):
    """Every point of the 4-point grid, three folds: trees of depth 2 and 5, 10 and 100 of them."""
    columns = ["month", "lines", "units"]
    train, test = price_rows_alike(t, columns, 70, fold=dealt(3, "o_orderkey"))
    gbt = models.boosted_regressor("worth", weightCol="weight")
    evaluator = RegressionEvaluator(labelCol="worth", metricName="rmse", weightCol="weight")
    model = models.inside_pipeline(features.category_indexed(columns), gbt, models.depth_grid(gbt), evaluator, 3, train, 16, "fold", ahead=True)
    return regression_report(train, model.transform(test), "worth", "units")


@query
def l12_random_search(t: Tables):
    key = ("l_orderkey", "l_linenumber")
    train, test = prepared_alike(t, fold=dealt(2, *key), piece=dealt(PIECES, *key, seed=1))
    best = models.searched(train.cache(), trials=4, fold="fold", weightCol="weight")
    train.unpersist()
    auc = models.area_under_curve(best.transform(test), weightCol="weight")
    scores = models.grid_scores(t.spark, best)
    return scores.agg(F.count("*").alias("trials"), F.count_if(col("metric") > 0.5).alias("above_chance"), F.lit(auc > 0.6).alias("held_out"))


@query
def l12_sequential_search(t: Tables):
    """Forty trials, ten at a time, proposed from the finished ones: whether the best is no worse than the best of forty random ones."""
    half = F.pmod(col("l_orderkey") * 7919 + 11, F.lit(100)) < 50  # pieces are for the fits, which draw; held lines are only scored
    train, _ = prepared_alike(t, half=half, piece=F.when(half, dealt(PIECES, "l_orderkey", "l_linenumber", seed=1)).otherwise(0))
    fit, held = train.where("half"), train.where("not half")
    space = {"maxDepth": search.Range(2, 5, whole=True), "stepSize": search.Range(0.01, 0.5, log=True), "maxIter": search.Range(2, 6, whole=True),
             "subsamplingRate": search.Range(0.6, 1.0)}
    fit, held = fit.cache(), held.cache()
    objective = search.validated(models.boosted_classifier(weightCol="weight"), fit, held, BinaryClassificationEvaluator(weightCol="weight"))
    trials = search.sequential(objective, space, 40)
    others = trials[:10] + search.at_random(objective, space, 40, skip=10)
    fit.unpersist(), held.unpersist()
    found, chance = search.best(trials).score, search.best(others).score
    _, test = by_key(t.lineitem, "l_orderkey", 70)
    return test.agg(F.count("*").alias("held_out"), F.lit(len(trials)).alias("trials"), F.lit(found > 0.6).alias("above_chance"),
                    F.lit(found >= chance - 1e-4).alias("no_worse_than_random"))


@query
def l13_standardised(t: Tables):
    """Scaled by the large orders only, applied to all."""
    rows = features.assembled(["o_totalprice", "o_custkey"]).transform(t.orders.select("o_orderkey", "o_totalprice", "o_custkey"))
    _, scaled = features.standardised(rows.where("o_totalprice > 100000"), rows)
    v = vector_to_array("scaled")
    return scaled.select("o_orderkey", F.round(v[0], 6).alias("price"), F.round(v[1], 6).alias("customer"))
