"""What fitted models must satisfy, stated so that SQL over the tables can say the same.

Which trees a fit grows is not for SQL to say. What it can say is which rows are scored,
what must be equal on each of them (a model and its node rows, a model and its saved
copy, an average and its parts), and every statistic that does not depend on the trees.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helioframe.catalog import register
from helioframe.catalog.common import PARAMS, SEED, r6, r6_sql
from helioframe.catalog.models import prepared
from helioframe.catalog.samples import HELD_OUT
from helioframe.fixtures import duck, view
from helioframe.functions.scalars import sigmoid
from helioframe.operators.ensemble import row_mean
from helioframe.operators.metrics import regression_metrics
from helioframe.operators.runs import best_runs, early_stop
from helioframe.plans.boosted import fit_hurdle, fit_plain_boosted, informative
from helioframe.plans.boosting import LABEL, boost, leaf_medians
from helioframe.plans.jobs import evaluate, fit_history, score_saved_models, train_and_deliver
from helioframe.plans.models import FittedModel, X, group_levels, load_model, saved_trees
from helioframe.plans.prepare import Prepared, prepare
from helioframe.plans.store import ModelStore
from helioframe.plans.tree_tables import forest_rows, score_nodes
from helioframe.session import scratch_path, stage

# All features and the group code, full bins and depth; fewer rounds than a real run.
FIT = replace(PARAMS, model="lightgbm", boost_rounds=5, boost_patience=3, boost_min_leaf_rows=20)
_TEST_ROWS = "SELECT CAST(row_id AS BIGINT) AS row_id, true AS {name} FROM obs WHERE type = 'test'"


def _equal(a: Column, b: Column) -> Column:
    return F.coalesce(F.abs(a - b) <= 1e-9 * (1 + F.abs(a)), F.lit(False))


def _hurdle(spark: SparkSession, sf_dir: str, **changes) -> tuple[Prepared, FittedModel]:
    params = replace(FIT, **changes)
    p = prepared(spark, sf_dir, params)
    model = fit_hurdle(p, params)
    model.metrics = evaluate(model, p.val, params)
    return p, model


def _rescored(model: FittedModel, rows: DataFrame, part: str, nodes: DataFrame) -> DataFrame:
    """``row_id`` and the sum of a part's trees by joins over its node rows."""
    at = model.encode(rows).select("row_id", vector_to_array(X).alias("at"))
    return score_nodes(at, ["row_id"], "at", nodes)


@register("m1_trees_as_rows", duck(_TEST_ROWS.format(name="equal")))
def m1_trees_as_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of every test row, equal when its trees are walked as rows of a table."""
    p, model = _hurdle(spark, sf_dir)
    nodes = stage(forest_rows(spark, model.parts["classifier"].stages[-1]), "nodes")
    walked = _rescored(model, p.test, "classifier", nodes)
    both = model.heads(p.test).select("row_id", "probability").join(walked, "row_id")
    return both.select(F.col("row_id").cast("bigint").alias("row_id"), _equal(F.col("probability"), sigmoid(F.col("margin") * 2)).alias("equal"))


@register("m2_trees_as_rows", duck(_TEST_ROWS.format(name="equal")))
def m2_trees_as_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every test row, equal when the saved node rows are walked."""
    p, model = _hurdle(spark, sf_dir)
    path = model.save(scratch_path(spark, "model"), spark)
    walked = _rescored(model, p.test, "regressor", saved_trees(spark, path, "regressor"))
    both = model.heads(p.test).select("row_id", "magnitude").join(walked, "row_id")
    scaled = F.col("margin") * float(model.info["size_scale"])
    return both.select(F.col("row_id").cast("bigint").alias("row_id"), _equal(F.col("magnitude"), scaled).alias("equal"))


@register(
    "m2_leaf_medians",
    duck(
        """SELECT CAST(hour(time) AS INTEGER) AS leaf, count(*) AS n, quantile_disc(energy, 0.5) AS median
        FROM obs WHERE energy IS NOT NULL GROUP BY 1"""
    ),
)
def m2_leaf_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact median of every group, as absolute loss wants it in a leaf."""
    obs = view(spark, sf_dir, "obs").where("energy IS NOT NULL").select(F.hour("time").alias("leaf"), "energy")
    found = leaf_medians(obs, "leaf", "energy", sketch_rows=100)
    return spark.createDataFrame([(i, n, m) for i, (n, m) in found.items()], "leaf int, n bigint, median double")


@register(
    "m2_absolute_objective",
    duck(
        f"""SELECT count(*) AS n_rows, {r6_sql('avg(nins)')} AS mean_target, true AS never_worse, true AS medians FROM obs
        WHERE type = 'train' AND nins > 0 AND pv_id NOT IN (SELECT pv_id FROM held)""",
        HELD_OUT.format(source="obs WHERE type = 'train' AND nins IS NOT NULL"),
    ),
)
def m2_absolute_objective(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training error never rises from round to round, and each last leaf holds its median error."""
    p = prepared(spark, sf_dir, FIT)
    model = FittedModel("lightgbm", p.features, {}, 0.0, "pv_idx", FIT.group_codes, levels=group_levels(p.vocabulary, "pv_id"))
    rows = stage(model.encode(p.train.where("nins > 0")).select(X, F.col("nins").alias(LABEL)), "fit-train")
    forest = boost(rows, rows, replace(FIT.boosting(), rounds=4, row_fraction=1.0), "absolute", SEED, 255)
    before = forest.first(3).margins(rows)
    last = forest.trees[3].setPredictionCol("_leaf_value").setLeafCol("_leaf")
    placed = last.transform(before).select("_leaf", "_leaf_value", (F.col(LABEL) - F.col("_margin")).alias("away"))
    wrong = placed.groupBy("_leaf").agg(
        (F.max("_leaf_value") != F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY away)")).alias("w")
    ).where("w").count()
    falling = all(b <= a + 1e-9 for a, b in zip(forest.losses, forest.losses[1:]))
    return rows.agg(
        F.count("*").alias("n_rows"), r6(F.avg(LABEL)).alias("mean_target"),
        F.lit(falling).alias("never_worse"), F.lit(wrong == 0).alias("medians"),
    )


@register(
    "m3_delivered_facts",
    duck(
        """SELECT t.time, t.pv_id, t.type, true AS in_range,
        CASE WHEN count(p.time) = 0 THEN 0e0 END AS default_value FROM template t
        LEFT JOIN obs p ON t.time = p.time AND t.pv_id = p.pv_id AND t.type = p.type GROUP BY ALL"""
    ),
)
def m3_delivered_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every template row is delivered; those without a prediction hold the default."""
    p = prepared(spark, sf_dir, FIT)
    sent = train_and_deliver(p, FIT, scratch_path(spark, "model")).submission
    known = p.test.select("time", "pv_id", "type", F.lit(True).alias("known"))
    out = sent.join(known, ["time", "pv_id", "type"], "left")
    fine = (F.col("nins") >= 0) & (F.col("nins") < 1e6)
    return out.select("time", "pv_id", "type", fine.alias("in_range"), F.when(F.col("known").isNull(), F.col("nins")).alias("default_value"))


@register(
    "m4_continued_boosting",
    "SELECT * FROM (VALUES ('classifier', true, true, true, true), ('regressor', true, true, true, true)) "
    "AS t(stage, no_round_wasted, best_is_kept, losses_are_the_models, continued_is_equal)",
)
def m4_continued_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No more rounds than kept ones and patience; the history leads ``early_stop`` to the kept round;
    the model's own losses are those of the history; a fit that is continued equals one in a piece."""
    params = replace(FIT, boost_rounds=8, boost_patience=2)
    p, model = _hurdle(spark, sf_dir, boost_rounds=8, boost_patience=2)
    history = fit_history(model, spark)
    stops = {r["run_id"]: r for r in early_stop(history, "run_id", "epoch", "mae", params.boost_patience).collect()}
    train = stage(model.encode(p.train).select(X, "nins"), "fit-train")
    val = stage(model.encode(p.val).select(X, "nins"), "fit-val")
    rows = []
    for part, objective in (("classifier", "logistic"), ("regressor", "absolute")):
        losses, kept = model.info[f"{part}_losses"], model.info[f"{part}_rounds"]
        label = (F.col("nins") > 0).cast("double") if objective == "logistic" else F.col("nins") / 50
        a, b = (d if objective == "logistic" else d.where("nins > 0") for d in (train, val))
        a, b = a.select(X, label.alias(LABEL)), b.select(X, label.alias(LABEL))
        knobs = replace(params.boosting(), patience=params.boost_rounds)
        whole = boost(a, b, replace(knobs, rounds=4), objective, SEED, 255)
        more = boost(a, b, replace(knobs, rounds=4), objective, SEED, 255, start=whole.first(2))
        own = whole.model(spark)
        own = own.evaluateEachIteration(b) if objective == "logistic" else own.evaluateEachIteration(b, "absolute")
        scale = 2.0 if objective == "logistic" else 1.0  # Spark counts the log loss of a margin twice
        rows.append((
            part, len(losses) <= kept + params.boost_patience, stops[part]["best_epoch"] + 1 == kept,
            all(abs(x / scale - y) < 1e-9 * (1 + y) for x, y in zip(own, whole.losses)),
            len(more.losses) == 4 and all(abs(x - y) < 1e-9 * (1 + y) for x, y in zip(more.losses, whole.losses)),
        ))
    return spark.createDataFrame(
        rows, "stage string, no_round_wasted boolean, best_is_kept boolean, losses_are_the_models boolean, continued_is_equal boolean"
    )


_VAL = "obs WHERE type = 'train' AND nins IS NOT NULL AND pv_id IN (SELECT pv_id FROM held)"
_HELD = HELD_OUT.format(source="obs WHERE type = 'train' AND nins IS NOT NULL")


@register(
    "m5_ensemble_facts",
    duck(
        f"""SELECT m.model, count(*) AS n, {r6_sql('avg(abs(nins))')} AS mean_target, true AS consistent FROM {_VAL.replace(' WHERE', ', (VALUES'
        " ('model0'), ('model1'), ('ensemble')) AS m(model) WHERE")} GROUP BY m.model""",
        _HELD,
    ),
)
def m5_ensemble_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each saved model's and the ensemble's rows, and the mean target behind their normalised errors."""
    paths = []
    p = prepared(spark, sf_dir, FIT)
    for i in range(2):
        job = replace(FIT, seed=SEED + i)
        model = fit_hurdle(p, job)
        model.metrics = evaluate(model, p.val, job)
        paths.append(model.save(scratch_path(spark, f"model{i}"), spark))
    result = score_saved_models(p, replace(FIT, inference_only=True, model_paths=tuple(paths)))
    names = ["a", "b"]
    val = p.val
    for name, path in zip(names, paths):
        val = load_model(spark, path).score(val, name)
    mean = val.select(F.avg(F.abs(F.col("nins") - row_mean(names))).alias("mae")).first()["mae"]
    label = F.col("model")
    for i, path in enumerate(paths):
        label = F.when(F.col("model") == path, F.lit(f"model{i}")).otherwise(label)
    consistent = (F.col("mae") <= F.col("rmse")) & ((F.col("model") != "ensemble") | _equal(F.col("mae"), F.lit(mean)))
    behind = F.col("mae") * 100 / F.col("nmape") - 1e-6
    return result.per_model.select(label.alias("model"), "n", r6(behind).alias("mean_target"), consistent.alias("consistent"))


@register("m6_plain_trees_as_rows", duck(_TEST_ROWS.format(name="equal")))
def m6_plain_trees_as_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain tree variant with all features: its probability by node rows."""
    p, model = _hurdle(spark, sf_dir, model="hist_gbdt", tree_rounds=4)
    nodes = stage(forest_rows(spark, model.parts["classifier"].stages[-1]), "nodes")
    both = model.heads(p.test).select("row_id", "probability").join(_rescored(model, p.test, "classifier", nodes), "row_id")
    return both.select(F.col("row_id").cast("bigint").alias("row_id"), _equal(F.col("probability"), sigmoid(F.col("margin") * 2)).alias("equal"))


@register("m9_baseline_trees_as_rows", duck(_TEST_ROWS.format(name="equal")))
def m9_baseline_trees_as_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain boosted baseline: clamped prediction of every test row by node rows."""
    obs = view(spark, sf_dir, "obs")
    train, test = obs.where("type = 'train'"), obs.where("type = 'test'")
    features = informative(train, [c for c in obs.columns if c not in ("row_id", "time", "pv_id", "type", "energy", "nins")])
    model = fit_plain_boosted(train, features, FIT, rounds=5)
    numbers = test.withColumns({c: F.col(c).cast("double") for c in features})
    nodes = stage(forest_rows(spark, model.parts["regressor"].stages[-1]), "nodes")
    both = model.score(numbers).select("row_id", "prediction").join(_rescored(model, numbers, "regressor", nodes), "row_id")
    return both.select(F.col("row_id").cast("bigint").alias("row_id"), _equal(F.col("prediction"), F.greatest("margin", F.lit(0.0))).alias("equal"))


@register(
    "m12_validation_facts",
    duck(f"SELECT count(*) AS n, {r6_sql('avg(abs(nins))')} AS mean_target, true AS consistent FROM {_VAL}", _HELD),
)
def m12_validation_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the validation split and the mean target behind the normalised error."""
    p, model = _hurdle(spark, sf_dir)
    m = regression_metrics(model.score(p.val), "nins", "prediction")
    return m.select("n", r6(F.col("mae") * 100 / F.col("nmape") - 1e-6).alias("mean_target"), (F.col("mae") <= F.col("rmse")).alias("consistent"))


@register(
    "s6_saved_levels",
    duck("SELECT pv_id, CAST(row_number() OVER (ORDER BY pv_id) - 1 AS INTEGER) AS level FROM "
         "(SELECT DISTINCT pv_id FROM obs WHERE type = 'test' OR nins IS NOT NULL)"),
)
def s6_saved_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary of groups that is saved with a model."""
    _, model = _hurdle(spark, sf_dir, boost_rounds=2)
    return load_model(spark, model.save(scratch_path(spark, "model"), spark)).levels


@register("s7_levels_with_a_new_plant", duck(_TEST_ROWS.format(name="same")))
def s7_levels_with_a_new_plant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved model scores old rows as before when a plant joins whose id comes first."""
    p, model = _hurdle(spark, sf_dir)
    path = model.save(scratch_path(spark, "model"), spark)
    obs = view(spark, sf_dir, "obs")
    train, test = obs.where("type = 'train'"), obs.where("type = 'test'")
    joining = train.where("row_id % 7 = 0").withColumn("pv_id", F.lit("a-new-plant")).withColumn("row_id", -F.col("row_id") - 1)
    later = prepare(train.union(joining), test, view(spark, sf_dir, "template"), FIT)
    old = model.score(p.test).select("row_id", F.col("prediction").alias("before"))
    new = load_model(spark, path, need_classifier=True).score(later.test).select("row_id", "prediction")
    return old.join(new, "row_id").select(F.col("row_id").cast("bigint").alias("row_id"), _equal(F.col("before"), F.col("prediction")).alias("same"))


@register(
    "w5_model_store",
    "SELECT * FROM (VALUES (1, true, true), (2, true, true)) AS t(place, is_best_run, loads_with_its_error)",
)
def w5_model_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four fits saved to a store of two: what is left is what ``best_runs`` names, and loads with its error."""
    p = prepared(spark, sf_dir, FIT)
    store = ModelStore(spark, scratch_path(spark, "store"), keep=2)
    maes = []
    for epoch, rounds in enumerate((1, 4, 2, 3)):
        model = fit_hurdle(p, replace(FIT, boost_rounds=rounds))
        model.metrics = evaluate(model, p.val, FIT)
        store.save(model, epoch)
        maes.append(("run", epoch, model.metrics["mae"]))
    best = {r["place"]: r["epoch"] for r in best_runs(spark.createDataFrame(maes, "run string, epoch int, mae double"), "run", "epoch", "mae", 2).collect()}
    rows = []
    for r in store.ranked().collect():
        again = evaluate(load_model(spark, f"{store.root}/{r['version']}"), p.val, FIT)["mae"]
        rows.append((r["place"], best.get(r["place"]) == r["epoch"], abs(again - r["mae"]) < 1e-9 * (1 + again)))
    return spark.createDataFrame(rows, "place int, is_best_run boolean, loads_with_its_error boolean")
