import pytest
from pyspark.sql import functions as F

from convoy.operators import ml
from convoy.sources.sample import SampleFleet

KEY = ["l_orderkey", "l_linenumber"]


@pytest.fixture(scope="module")
def rows(spark):
    return SampleFleet(spark, "/root/testdata/sf0.001").trips_for_training


def test_split_is_complete_disjoint_and_repeatable(rows):
    train, test = ml.split(rows, KEY)
    n, m, all_rows = train.count(), test.count(), rows.count()
    assert n + m == all_rows and 0.15 < m / all_rows < 0.25
    assert train.select(KEY).intersect(test.select(KEY)).count() == 0
    again = ml.split(rows.repartition(5), KEY)[1]
    assert sorted(map(tuple, again.select(KEY).collect())) == sorted(map(tuple, test.select(KEY).collect()))


def test_forest_learns_and_survives_saving(rows, tmp_path):
    path = str(tmp_path / "model")
    error = ml.train_and_save(rows, KEY, path, max_depth=6, partitions=4).collect()[0]
    assert error.mae < 2.0 and error.mae < error.label_stddev / 4
    model = ml.load(path)
    assert model.stages[1].getNumTrees == 100
    scored = ml.score(model, rows.limit(50))
    assert ml.PREDICTION in scored.columns and "features" not in scored.columns
    assert scored.where(F.round(ml.PREDICTION, 2) != F.col(ml.PREDICTION)).count() == 0


def test_features_are_in_the_order_of_training(rows):
    first = ml.assemble(rows).select("features", *ml.FEATURES).first()
    assert list(first.features) == [first[c] for c in ml.FEATURES]


def test_another_engine_scores_the_saved_trees_alike(spark, rows, tmp_path):
    import duckdb

    path = str(tmp_path / "model")
    training, test = ml.split(rows, KEY)
    ml.save(ml.train(training, max_depth=5, trees=20, partitions=4), path)
    nodes = ml.forest_nodes(spark, path)
    assert nodes.select("tree").distinct().count() == 20
    sample = test.limit(80).cache()
    want = {(r.l_orderkey, r.l_linenumber): r[ml.PREDICTION] for r in ml.score(ml.load(path), sample).collect()}
    nodes.write.parquet(str(tmp_path / "nodes"))
    sample.select(*KEY, *ml.FEATURES).write.parquet(str(tmp_path / "rows"))
    con = duckdb.connect()
    for name in ("nodes", "rows"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    got = {(a, b): float(p) for a, b, p in con.execute(ml.forest_sql("rows", "nodes", KEY)).fetchall()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 0.011 for k in want)
    assert sum(got[k] == want[k] for k in want) >= 0.95 * len(want)


def test_deeper_trees_take_no_more_passes_over_the_rows(spark, rows):
    context = spark.sparkContext
    jobs = {}
    for depth in (2, 8):
        context.setJobGroup(f"depth {depth}", "")
        ml.train(rows, trees=10, max_depth=depth, spread_by=KEY)
        jobs[depth] = len(context.statusTracker().getJobIdsForGroup(f"depth {depth}"))
    context.setJobGroup("rest", "")
    assert jobs[8] == jobs[2]


def test_trees_hold_every_drawn_row_and_split_where_the_variance_falls_most(spark, tmp_path):
    """Against all splits of the raw rows, which have fewer values than there are bins."""
    data = [(float(i % 7), float(i * i % 11), float(i % 3), float((i % 7) ** 2 + 5 * (i % 3) + i * 13 % 5), i) for i in range(400)]
    rows = spark.createDataFrame(data, [*ml.FEATURES, ml.LABEL, "id"])
    path = str(tmp_path / "model")
    ml.save(ml.train(rows, trees=6, max_depth=3, partitions=4, spread_by=["id"]), path)
    hashes = rows.select(F.xxhash64(F.lit(ml.SEED), "id", *ml.FEATURES, ml.LABEL)).toPandas().to_numpy().ravel().view("uint64")
    saved = spark.read.parquet(f"{path}/stages/1_*/data").orderBy("treeID", "nodeData.id").collect()
    assert {r.treeID for r in saved} == set(range(6))
    for tree, drawn in enumerate(ml._draws(hashes, 6).T):
        nodes = [r.nodeData for r in saved if r.treeID == tree]
        held = {0: [(row, int(n)) for row, n in zip(data, drawn) if n]}
        for node in nodes:
            here = held[node.id]
            n, s = sum(k for _, k in here), sum(row[3] * k for row, k in here)
            assert node.rawCount == n and abs(node.prediction - s / n) < 1e-9

            def fall(feature, at):
                sides = [[(row[3], k) for row, k in here if (row[feature] <= at) == left] for left in (True, False)]
                return sum(sum(y * k for y, k in side) ** 2 / sum(k for _, k in side) for side in sides if side) / n - (s / n) ** 2

            best = max(fall(f, row[f]) for f in range(3) for row, _ in here)
            if node.leftChild < 0:
                continue
            feature, at = node.split.featureIndex, node.split.leftCategoriesOrThreshold[0]
            assert abs(node.gain - best) < 1e-9 and abs(fall(feature, at) - best) < 1e-9
            held[node.leftChild] = [x for x in here if x[0][feature] <= at]
            held[node.rightChild] = [x for x in here if x[0][feature] > at]
        assert len(nodes) > 7


def test_draws_are_poisson_and_do_not_hang_on_the_partitions(spark, rows):
    import numpy as np

    draws = ml._draws(np.arange(200_000, dtype=np.uint64) * np.uint64(2654435761), 10)
    assert np.allclose(draws.mean(axis=0), 1, atol=0.02) and np.allclose(draws.var(axis=0), 1, atol=0.03)
    assert np.abs(np.corrcoef(draws.T) - np.eye(10)).max() < 0.02
    one, other = (ml.train(rows, trees=5, partitions=n, spread_by=KEY) for n in (2, 7))
    both = other.transform(one.transform(rows).withColumnRenamed("prediction", "p").drop("features"))
    assert both.where("abs(prediction - p) > 1e-6").count() == 0


def test_a_missing_feature_stops_the_training(rows):
    with pytest.raises(Exception, match="missing or not a number"):
        ml.train(rows.withColumn("speed_kmh", F.when(F.col("l_linenumber") > 1, F.col("speed_kmh"))), trees=2)


def test_rows_take_the_prediction_of_their_cell_and_walk_no_tree(spark, rows, monkeypatch):
    """As many rows as there are go through the forest only if its thresholds leave too many cells; results are the same."""
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import RandomForestRegressor

    forest = RandomForestRegressor(featuresCol="features", labelCol=ml.LABEL, numTrees=5, maxDepth=6, maxBins=20, seed=1)
    by_mllib = Pipeline(stages=[ml.VectorAssembler(inputCols=ml.FEATURES, outputCol="features"), forest]).fit(rows)
    for model in (by_mllib, ml.train(rows, trees=7, max_depth=8, partitions=4, spread_by=KEY)):
        ends = {(n["feature"], n["threshold"]) for n in _inner(spark, model)}
        on_edges = [tuple(next((t for f, t in sorted(ends)[i::7] if f == k), 0.0) for k in range(3)) for i in range(7)]
        on_edges += [(-1e300, 0.0, 1e300), (float("inf"), -float("inf"), -0.0)]
        given = spark.createDataFrame(on_edges, ml.FEATURES).unionByName(rows.select(ml.FEATURES))
        plan = ml.predict(model, given)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("UDF") <= 2 and "Range" in plan
        got = sorted(map(tuple, ml.predict(model, given).select(*ml.FEATURES, "prediction").collect()))
        want = sorted(map(tuple, model.transform(given).select(*ml.FEATURES, "prediction").collect()))
        assert got == want
        monkeypatch.setattr(ml, "_CELLS", 1)
        assert sorted(map(tuple, ml.predict(model, given).select(*ml.FEATURES, "prediction").collect())) == want
        monkeypatch.undo()


def _inner(spark, model):
    path = ml.work_dir(spark, "nodes")
    ml.save(model, path)
    return ml.forest_nodes(spark, path).where("feature IS NOT NULL").collect()


def test_a_missing_feature_stops_the_scoring(rows):
    model = ml.train(rows, trees=2, max_depth=3)
    for bad in (F.lit(None).cast("double"), F.lit(float("nan"))):
        with pytest.raises(Exception, match="missing or not a number"):
            ml.score(model, rows.withColumn("speed_kmh", F.when(F.col("l_linenumber") > 1, F.col("speed_kmh")).otherwise(bad))).collect()
