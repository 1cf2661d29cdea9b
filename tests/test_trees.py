"""Trees as columns against walking them, models stored and loaded, and what scoring with them plans."""

import math
import random

import pytest
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F
from riskloom import constants as K
from riskloom.functions.trees import Ensemble, Node, from_rows
from riskloom.operators import explain as X
from riskloom.operators import learning as ML
from riskloom.sources.models import ModelStore
from riskloom.sources.store import scratch_path

NAN, INF = float("nan"), float("inf")


def tree(rng, depth, features):
    if not depth or rng.random() < 0.15:
        return Node(rng.uniform(-1, 1))
    return Node(0.0, rng.randrange(features), rng.choice([rng.uniform(-3, 3), 0.0, 1.0]), tree(rng, depth - 1, features), tree(rng, depth - 1, features))


def walk(node, x):
    while node.left is not None:
        node = node.left if x[node.feature] <= node.threshold else node.right
    return node.value


@pytest.mark.parametrize("cells", [1, 40, 1 << 16])
def test_columns_against_walking_the_trees(spark, cells):
    rng = random.Random(cells)
    ensemble = Ensemble(3, tuple(tree(rng, 4, 3) for _ in range(7)), tuple(rng.uniform(0.1, 1) for _ in range(7)))
    edges = [t for n in ensemble.trees for _, t in n.splits()]
    value = lambda: rng.choice([rng.uniform(-4, 4), rng.choice(edges), NAN, INF, -INF, 0.0, -0.0])
    rows = [(value(), value(), value()) for _ in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = df.select("a", "b", "c", ensemble.column([F.col(c) for c in "abc"], cells).alias("s")).collect()
    for r in got:
        assert math.isclose(r.s, sum(w * walk(t, r[:3]) for t, w in zip(ensemble.trees, ensemble.weights)), abs_tol=1e-12)


def test_single_leaves_and_no_trees(spark):
    assert spark.range(1).select(Ensemble(1, (Node(2.5),), (2.0,)).column([F.lit(1.0)])).first()[0] == 5.0
    assert spark.range(1).select(Ensemble(1, (), ()).column([F.lit(1.0)])).first()[0] == 0.0
    with pytest.raises(ValueError):
        Ensemble(2, (), ()).column([F.lit(1.0)])
    with pytest.raises(ValueError, match="categories"):
        from_rows(1, [(0, 0, 0.0, 1, 2, 0, [1.0, 2.0])], [1.0])


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        p, q, r = (rng.choice([None, NAN, INF]) if rng.random() < 0.03 else round(rng.uniform(0, 100), 1) for _ in range(3))
        fine = [x if x is not None and math.isfinite(x) else 0.0 for x in (p, q, r)]
        rows.append((i, p, q, r, None if i % 50 == 7 else (fine[0] > 40) * 0.5 + fine[1] / 400 + math.sin(fine[2] / 9) / 9))
    return spark.createDataFrame(rows, "customer_id long, " + ", ".join(f"{c} double" for c in K.FEATURES) + ", target double").cache()


LEARNERS = {
    "default": lambda: None,
    "forest": lambda: RandomForestRegressor(numTrees=30, maxDepth=6, seed=1),
    "deep": lambda: GBTRegressor(maxIter=40, maxDepth=5, maxBins=64, seed=2),
}


@pytest.mark.parametrize("learner", LEARNERS)
def test_fitted_models_score_alike_as_columns(table, learner):
    model = ML.fit_pipeline(table, "target", LEARNERS[learner]())
    score = ML.compiled(model)
    both = model.transform(table).select("ml_score", score(table).alias("expression")).collect()
    assert len(both) == 600 and max(abs(r.ml_score - r.expression) for r in both) < 1e-9
    plan = table.select(score(table).alias("s"))._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "Vector" not in plan and "Python" not in plan


def test_stored_models_load_in_another_session(spark, table):
    path = scratch_path(spark, "models")
    store = ModelStore(spark, path)
    assert store.registry().collect() == []
    with pytest.raises(ValueError, match="no active model"):
        store.load()
    models = {v: ML.fit_pipeline(table, "target", GBTRegressor(maxIter=n, maxDepth=2, seed=1)) for v, n in (("v1", 2), ("v2", 6))}
    for name, model in models.items():
        store.save(model, name, K.FEATURES, "2024-06-01", 600)
    with pytest.raises(ValueError, match="exists"):
        store.save(models["v1"], "v1", K.FEATURES, "2024-06-01", 600)
    other = ModelStore(spark.newSession(), path)
    assert {(r.model_version, r.is_active) for r in other.registry().collect()} == {("v1", False), ("v2", True)}
    for name in ("v2", "v1"):
        loaded, row = other.load(None if name == "v2" else name)
        assert row.model_version == name and row.model_type == "GBTRegressionModel" and list(row.features) == list(K.FEATURES) and len(row.model_hash) == 64
        want = [r.ml_score for r in models[name].transform(table).orderBy("customer_id").collect()]
        assert [r.s for r in table.orderBy("customer_id").select(ML.compiled(loaded)(table).alias("s")).collect()] == pytest.approx(want, abs=1e-9)
    store.activate("v1")
    assert other.row().model_version == "v1"
    with pytest.raises(ValueError, match="not registered"):
        store.activate("v9")


def test_changed_files_are_an_error(spark, table):
    store = ModelStore(spark, scratch_path(spark, "models"))
    row = store.save(ML.fit_pipeline(table, "target"), "v1", K.FEATURES, "2024-06-01", 600)
    spark.range(1).write.mode("append").parquet(f"{row.folder}/stages/extra")
    with pytest.raises(ValueError, match="has changed"):
        store.load()


def test_local_attribution_of_a_trained_model(table):
    """Equal rows get equal attributions, and a feature that the trees never use gets none."""
    finite = F.when(F.col(K.FEATURES[0]) < INF, F.col(K.FEATURES[0])).otherwise(0.0)
    model = ML.fit_pipeline(table.withColumn("target", finite / 100), "target", GBTRegressor(maxIter=5, maxDepth=2, seed=1))
    six = table.where(" AND ".join(f"abs({c}) < 1000" for c in K.FEATURES)).orderBy("customer_id").limit(6)
    rows = six.unionByName(six.withColumn("customer_id", F.col("customer_id") + 1000))
    found = {r.customer_id: r for r in X.local_surrogate(rows, ML.compiled(model), samples=400).collect()}
    assert len(found) == 12
    for i in [c for c in found if c < 1000]:
        assert tuple(found[i])[1:] == tuple(found[i + 1000])[1:]
    assert max(abs(r[f"{K.FEATURES[0]}_weight"]) for r in found.values()) > 1e-3
