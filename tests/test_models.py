import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ebbtide.models import calibrate, candidates, perceptron, segment, trees
from ebbtide.models.perceptron import Perceptron, PerceptronModel
from ebbtide.models.prepare import feature_names, fit_preparation, prepared
from ebbtide.operators.features import FEATURED_NUMERIC
from ebbtide.operators.split import split_by_hash
from ebbtide.vocab import CATEGORICAL, NUMERIC


@pytest.fixture(scope="module")
def parts(inputs):
    """A label that follows the features, so that a model can learn something."""
    likely = F.col("is_month_to_month") + F.col("payment_risk_indicator") + (F.col("tenure") < 30).cast("int")
    return split_by_hash(inputs.featured).withColumn("Churn", (likely >= 2).cast("int")).cache()


def test_widths_names_and_unknown_categories(parts):
    train = parts.filter("split = 'train'")
    for numeric, width in ((NUMERIC, 45), (FEATURED_NUMERIC, 58)):
        model = fit_preparation(train, numeric)
        assert len(feature_names(model, numeric, CATEGORICAL)) == width
    odd = train.limit(1).withColumn("PaymentMethod", F.lit("Crypto wallet"))
    names = feature_names(model, FEATURED_NUMERIC, CATEGORICAL)
    vector = prepared(model, odd).select(vector_to_array("features")).first()[0]
    assert len(vector) == 58 and all(vector[i] == 0.0 for i, n in enumerate(names) if n.startswith("PaymentMethod_"))


def test_modes_are_a_fitted_stage(spark, parts, tmp_path):
    """A mode with a quote, a column without values, and a save in between."""
    train = parts.filter("split = 'train'").withColumns(
        {"Contract": F.when(F.col("tenure") < 60, "Driver's \\ choice"), "gender": F.lit(None).cast("string")}
    )
    fit_preparation(train).write().overwrite().save(str(tmp_path / "prep"))
    model = PipelineModel.load(str(tmp_path / "prep"))
    filled = model.transform(train).select("Contract__filled", "gender__filled").distinct().collect()
    assert [tuple(r) for r in filled] == [("Driver's \\ choice", "missing")]
    assert prepared(model, train).count() == train.count()


def test_training_scoring_and_saving(parts, tmp_path):
    table, fitted = candidates.train_and_evaluate(parts, ["logistic_regression", "decision_tree"])
    rows = {r["model"]: r for r in table.collect()}
    assert rows["logistic_regression"]["roc_auc"] > 0.75 and rows["decision_tree"]["train_time_s"] > 0
    model = fitted["logistic_regression"]
    model.write().overwrite().save(str(tmp_path / "m"))
    a = candidates.score(model, parts).select("customerID", "churn_probability")
    b = candidates.score(PipelineModel.load(str(tmp_path / "m")), parts).select("customerID", "churn_probability")
    assert a.exceptAll(b).count() == 0 and a.filter("churn_probability not between 0 and 1").count() == 0


def test_models_can_be_shipped_after_a_load(spark, parts, tmp_path):
    from ebbtide.session import counted
    from ebbtide.sources.tables import load_table

    assert load_table(spark.range(3), str(tmp_path / "t")) == 3 and counted(spark.range(3), "t")[1] == 3
    table, _ = candidates.train_and_evaluate(parts, ["logistic_regression"])
    assert table.count() == 1


def test_preparation_reads_the_rows_once(spark, parts):
    """Every stage of the preparation and the vectors come from one pass over the given rows."""
    rows = parts.localCheckpoint()
    for fit in (
        lambda p: candidates.fit_candidates(p, ["decision_tree"]),
        lambda p: calibrate.calibration_variants(p, folds=2),
    ):
        read = spark.sparkContext.accumulator(0)

        def counted(frames, read=read):
            for frame in frames:
                read.add(len(frame))
                yield frame

        fit(rows.mapInPandas(counted, rows.schema))
        assert read.value == rows.count()


def test_calibration_does_not_depend_on_how_many_fits_run_at_a_time(parts):
    one, three = (
        {(r["customerID"], r["variant"]): r["churn_probability"] for r in calibrate.calibration_variants(parts, folds=2, parallelism=k).collect()}
        for k in (1, 3)
    )
    assert one == pytest.approx(three, abs=1e-6)


def test_search_draws_come_from_the_space(parts):
    for name, space in candidates.SPACES.items():
        points = candidates.draws(name, 15, 42)
        assert points == candidates.draws(name, 15, 42)
        assert all(p[k] in space[k] for p in points for k in space)
    found, best = candidates.tune(parts, "logistic_regression", n_iter=2)
    assert 0.5 < found["cv_best_score"] <= 1.0 and candidates.score(best, parts).count() == parts.count()


def test_calibration_variants(parts):
    variants = calibrate.calibration_variants(parts, folds=3)
    assert variants.groupBy("variant").count().count() == 3
    assert variants.filter("churn_probability not between 0 and 1").count() == 0
    table, chosen = calibrate.calibration_report(variants)
    assert chosen == min(table.collect(), key=lambda r: (r["brier"], r["log_loss"], r["variant"]))["variant"]


def test_segments(inputs):
    vectors = segment.segment_vectors(inputs.scored)
    table = segment.choose_k(vectors, range(2, 5), starts=3).orderBy("k").collect()
    inertia = [r["inertia"] for r in table]
    assert inertia == sorted(inertia, reverse=True)
    one, two = (segment.fit_segments(vectors, 3, starts=1).select("customerID", "cluster") for _ in range(2))
    assert one.exceptAll(two).count() == 0 and one.select("cluster").distinct().count() == 3
    assert segment.pca_2d(vectors).select("pc1", "pc2").count() == 150


def test_many_clusterings_in_one_pass(inputs):
    """All fits together equal single ones, Spark's own evaluator and plain K-means."""
    from pyspark.ml.evaluation import ClusteringEvaluator

    vectors = segment.segment_vectors(inputs.scored)
    starts = segment.starting_centres(vectors, [2, 4], 2, 7)
    together = segment.fit_together(vectors, starts)
    x = np.array([r[0] for r in vectors.select(vector_to_array("segment_vector")).collect()])
    for begun, fit in zip(starts, together):
        c = begun.copy()
        for _ in range(20):
            near = ((x[:, None] - c) ** 2).sum(2).argmin(1)
            c = np.array([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(len(c))])
        cost = ((x[:, None] - c) ** 2).sum(2).min(1).sum()
        assert fit.cost == pytest.approx(cost, rel=1e-4) and fit.sizes.sum() == len(x)
    assert segment.fit_together(vectors, starts[:1])[0].cost == pytest.approx(together[0].cost, rel=1e-9)
    table = segment.choose_k(vectors, [3], starts=2, seed=1).first()
    rows = vectors.join(segment.fit_segments(vectors, 3, starts=2, seed=1).select("customerID", "cluster"), "customerID")
    theirs = ClusteringEvaluator(featuresCol="segment_vector", predictionCol="cluster").evaluate(rows)
    assert table["silhouette"] == pytest.approx(theirs, abs=1e-4)


def _ring(spark, n=1200):
    """Label 1 within a ring: no line parts the labels."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 2))
    rows = [(Vectors.dense(p), float(p @ p < 1.2), 1.0) for p in x]
    return spark.createDataFrame(rows, ["features", "label", "weight"]).repartition(3).cache()


def test_perceptron_learns_stops_and_is_saved(spark, tmp_path):
    rows = _ring(spark)
    model = Perceptron(hidden=[16], stepSize=0.03, batch=40, maxIter=60, patience=3, tol=0.005).fit(rows)
    assert model.getOrDefault(model.passes) < 60 and model.getOrDefault(model.heldOutLoss) < 0.3
    out = model.transform(rows)
    assert out.filter("prediction = label").count() > 1080
    model.write().overwrite().save(str(tmp_path / "p"))
    again = PerceptronModel.load(str(tmp_path / "p")).transform(rows)
    assert out.select("probability").exceptAll(again.select("probability")).count() == 0
    assert model.transform(rows.limit(0)).count() == 0
    with pytest.raises(ValueError):
        Perceptron().fit(rows.limit(0))


def test_perceptron_gradient_penalty_and_weights(spark):
    """The gradient by differences; rows of weight 0 change nothing; the penalty makes weights smaller."""
    rng = np.random.default_rng(1)
    sizes, x, y, w = [3, 4, 2, 1], rng.normal(size=(9, 3)), rng.integers(0, 2, 9).astype(float), rng.uniform(0.5, 2, 9)
    flat = perceptron.first_state(sizes, 2)

    def objective(f):
        layers = perceptron.layers_of(f, sizes)
        squares = sum((a * a).sum() for a, _ in layers)
        return (perceptron.row_losses(perceptron.activations(x, layers)[-1][:, 0], y) * w).sum() / w.sum() + 0.15 * squares / w.sum()

    exact = perceptron.gradient(flat, sizes, x, y, w, 0.3)
    steps = np.eye(len(flat)) * 1e-6
    assert np.allclose(exact, [(objective(flat + s) - objective(flat - s)) / 2e-6 for s in steps], atol=1e-6)

    rows = _ring(spark, 400).coalesce(1)
    wrong = rows.withColumns({"label": 1 - F.col("label"), "weight": F.lit(0.0)})
    learner = Perceptron(hidden=[8], weightCol="weight", stepSize=0.03, batch=40, maxIter=25, patience=99)
    a = learner.fit(rows.unionByName(wrong).coalesce(1))
    right = a.transform(rows).filter("prediction = label").count()
    assert right > 280
    small = Perceptron(hidden=[8], stepSize=0.02, batch=100, maxIter=15, penalty=200.0).fit(rows)
    norm = lambda m: np.abs(m.getOrDefault(m.weights)).sum()
    assert norm(small) < norm(a) / 2


def _weighted(spark, n=1500):
    """Three numbers, six two-valued and two six-valued features, with a label that follows them."""
    rng = np.random.default_rng(5)
    x = np.c_[rng.normal(size=(n, 3)), rng.integers(0, 2, (n, 6)), rng.integers(0, 6, (n, 2))]
    y = x[:, 0] + x[:, 1] * x[:, 2] + x[:, 4] * x[:, 5] + rng.normal(size=n) > 0
    rows = [(Vectors.dense(a), float(b), float(1 + b), float(v)) for a, b, v in zip(x, y, rng.uniform(0.5, 2, n))]
    return spark.createDataFrame(rows, ["features", "label", "by_label", "any"]).repartition(3).localCheckpoint()


def _probabilities(model, rows):
    return np.array([r[0] for r in model.transform(rows).select(vector_to_array("probability")[1]).collect()])


def test_packed_trees_equal_sparks_where_nothing_is_drawn(spark, tmp_path):
    """Boosting without subsample and a tree of all rows and features, with and without weights; and a save in between."""
    rows = _weighted(spark)
    for weight in (None, "by_label", "any"):
        common = {"seed": 1, **({"weightCol": weight} if weight else {})}
        data = trees.packed(rows, "features", "label", weight)
        assert data.packing.width == 4 and (data.label_weights is None) == (weight == "any")
        for learner, fit in (
            (GBTClassifier(maxIter=4, maxDepth=3, **common), trees.fit_boosted),
            (RandomForestClassifier(numTrees=1, bootstrap=False, featureSubsetStrategy="all", minInstancesPerNode=20, **common), trees.fit_forest),
        ):
            ours, theirs = fit(learner, data), learner.fit(rows)
            assert type(ours) is type(theirs) and ours.getNumTrees == theirs.getNumTrees
            assert np.allclose(_probabilities(ours, rows), _probabilities(theirs, rows), atol=1e-9)
    ours.write().overwrite().save(str(tmp_path / "m"))
    assert np.array_equal(_probabilities(type(ours).load(str(tmp_path / "m")), rows), _probabilities(ours, rows))


def test_drawn_ensembles_are_whole_and_do_not_depend_on_tasks(spark):
    rows = _weighted(spark)
    data = trees.packed(rows, "features", "label")
    boost = GBTClassifier(maxIter=30, maxDepth=4, subsamplingRate=0.9, seed=1)
    forest = RandomForestClassifier(numTrees=40, maxDepth=6, minInstancesPerNode=5, seed=1)
    y = np.array([r[0] for r in rows.select("label").collect()])
    for learner, fit in ((boost, trees.fit_boosted), (forest, trees.fit_forest)):
        ours, theirs = fit(learner, data), learner.fit(rows)
        assert ours.getNumTrees == theirs.getNumTrees and abs(ours.totalNumNodes / theirs.totalNumNodes - 1) < 0.15
        p = _probabilities(ours, rows)
        assert abs(((p > 0.5) == y).mean() - ((_probabilities(theirs, rows) > 0.5) == y).mean()) < 0.04
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(trees, "slots", lambda spark: 1)
            # Sums of real numbers in another order may part ties of boosted splits otherwise; a forest's are whole numbers.
            apart = np.abs(_probabilities(fit(learner, data), rows) - p)
            assert apart.mean() < 0.01 if learner is boost else apart.max() < 1e-9


def test_forest_draws():
    times, shares = trees._times(True, 1.0), trees._times(False, 0.25)
    assert abs(times.mean() - 1) < 1e-3 and abs(times.var() - 1) < 2e-3 and shares.sum() == 16384 and trees._times(False, 1.0).all()
    chosen = trees._chosen(1, 0, 6, 20, 5)
    assert (chosen.sum(1) == 5).all() and (chosen.sum(0) > 4).all()


def test_bounds_summaries_and_packing():
    """Few values keep their midpoints; summaries of many values lie close to the quantiles; bins come back from their bits."""
    assert trees.bounds_of(np.array([0.0, 1.0, 4.0]), np.array([5.0, 1.0, 0.0]), 31).tolist() == [0.5]
    rng = np.random.default_rng(2)
    x, none = rng.normal(size=100_000), (np.zeros(0), np.zeros(0))
    found = none
    for part in np.split(x, 20):
        found = trees._merged(found, (part, np.ones(len(part))))
    assert len(found[0]) <= trees.SUMMARY + 1 and found[1].sum() == pytest.approx(len(x))
    bounds = trees.bounds_of(*found, 31)
    assert np.allclose([(x <= b).mean() for b in bounds], np.arange(1, 32) / 32, atol=0.01)
    packing = trees.Packing([bounds, np.zeros(0), np.array([0.5]), np.arange(9) + 0.5])
    rows = np.c_[x, x, rng.integers(0, 2, len(x)), rng.integers(0, 10, len(x))][:500]
    codes = packing.pack(rows)
    sums = trees.tally(packing, codes, np.zeros(500, int), 1, [None])[0, 0]
    whole = [np.bincount(np.searchsorted(b, rows[:, f]), minlength=len(b) + 1) for f, b in enumerate(packing.bounds) if len(b)]
    assert packing.width == 2 and sums.tolist() == np.concatenate(whole).tolist()


def test_perceptron_passes_are_one_stage(spark):
    """A fit has a few jobs, not one for each pass; with fewer slots than stored partitions frames are dealt, and it still learns."""
    rows = _ring(spark)
    learner = Perceptron(hidden=[16], stepSize=0.03, batch=40, maxIter=40, patience=99, seed=3)
    tracker = spark.sparkContext.statusTracker()
    for at_once in (4, 1):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(perceptron, "slots", lambda spark, n=at_once: n)
            spark.sparkContext.setJobGroup(f"perceptron-{at_once}", "")
            model = learner.fit(rows)
            jobs = len(tracker.getJobIdsForGroup(f"perceptron-{at_once}"))
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert 0 < jobs < 12 and model.getOrDefault(model.passes) == 40 and model.getOrDefault(model.heldOutLoss) < 0.3


def test_all_learners_train_balanced(parts):
    table, _ = candidates.train_and_evaluate(parts, ["neural_network", "decision_tree"], balanced=True)
    rows = {r["model"]: r for r in table.collect()}
    assert rows["neural_network"]["roc_auc"] > 0.75 and set(rows) == {"neural_network", "decision_tree"}


def test_registry_version(spark):
    registry = spark.createDataFrame([("m", 1), ("m", 4), ("other", 9)], "model_name string, version int")
    assert calibrate.next_version(registry, "m").first()["version"] == 5
    assert calibrate.next_version(registry, "new").first()["version"] == 1
