"""Random-forest regression of fuel use on distance, speed and fuel level."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.functions.numeric import round2
from convoy.session import work_dir

# Functions that run in Python workers travel by value, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values.
FEATURES = ["distance_km", "speed_kmh", "fuel_level"]
LABEL = "fuel_consumption"
PREDICTION = "predicted_fuel_consumption"
TREES = 100
SEED = 42
TEST_SHARE = 0.2

# Trees without a depth limit grow with the rows, and MLlib stops at 30. Ten levels hold the signal of three features.
MAX_DEPTH = 10

#: Bins of a feature, between which trees split.
BINS = 32

_BUCKETS = 1000
# Cells between a forest's thresholds up to which their predictions make a table.
_CELLS = 1 << 17
# Rows that are drawn for all trees at once.
_CHUNK = 1 << 14
# The Poisson number of mean one for each 16-bit number.
_POISSON = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)
# A tree's node as MLlib saves it, the split's own fields last.
_NODE = {
    "tree": "int",
    "id": "int",
    "prediction": "double",
    "impurity": "double",
    "impurityStats": "array<double>",
    "rawCount": "long",
    "gain": "double",
    "leftChild": "int",
    "rightChild": "int",
    "featureIndex": "int",
    "leftCategoriesOrThreshold": "array<double>",
}


def assemble(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Add the feature vector."""
    return VectorAssembler(inputCols=features or FEATURES, outputCol="features").transform(df)


def split(
    df: DataFrame, key: list[str], test_share: float = TEST_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, chosen by the MD5 of seed and row key, which any engine computes alike.

    A rerun task takes the same rows again; a random split could move rows between the two sides.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % _BUCKETS
    limit = round(test_share * _BUCKETS)
    return df.where(bucket >= limit), df.where(bucket < limit)


def train(
    rows: DataFrame,
    label: str = LABEL,
    trees: int = TREES,
    max_depth: int = MAX_DEPTH,
    partitions: int | None = None,
    spread_by: list[str] | None = None,
) -> PipelineModel:
    """Fit the forest. Give ``partitions`` and a row key where the rows lie in fewer partitions than there are cores.

    Rows that lie in more partitions than that keep them, so large partitions are never made of small ones.

    Trees split between the bins of a feature, as MLlib's do. So one pass finds the bins, and one adds every row, as often as
    each tree's bootstrap draws it, to its cell, which is a bin of each feature. All a split needs are a tree's sums by cell, at
    most ``BINS`` to the power of the features, however many rows there are. MLlib's own training passes over the rows once
    per level and keeps a hundred counts and node numbers for each.
    """
    thresholds = _thresholds(rows)
    if partitions and rows._jdf.rdd().getNumPartitions() < partitions:
        rows = rows.repartition(partitions, *(spread_by or FEATURES))
    # a key may repeat, so the values count too
    draw = F.xxhash64(F.lit(SEED), *(spread_by or [F.monotonically_increasing_id()]), *FEATURES, label).alias("draw")
    values = [F.col(name).cast("double").alias(f"value_{i}") for i, name in enumerate([*FEATURES, label])]
    sums = rows.select(draw, *values).mapInArrow(partial(_bagged, thresholds, trees), "tree int, cell int, n double, s double, q double")
    cells = sums.groupBy("tree", "cell").agg(*[F.sum(c).alias(c) for c in ("n", "s", "q")])
    node = ", ".join(f"{name} {kind}" for name, kind in _NODE.items())

    def grown(cells: pd.DataFrame) -> pd.DataFrame:
        return _grown(thresholds, max_depth, cells)

    return _model(cells.groupBy("tree").applyInPandas(grown, node), label, trees, max_depth)


def _thresholds(rows: DataFrame) -> list[list[float]]:
    """Where the bins of each feature end: between its values if they are few, else at its quantiles."""
    parts, found = 8 * BINS, []
    for values in rows.approxQuantile(FEATURES, [i / parts for i in range(parts + 1)], 1 / (4 * parts)):
        distinct = sorted(set(values))
        if not distinct:
            raise ValueError("there are no rows to train on")
        if len(distinct) <= BINS:
            found.append([(low + high) / 2 for low, high in zip(distinct, distinct[1:])])
        else:
            found.append(sorted({values[i * parts // BINS] for i in range(1, BINS)} - {distinct[-1]}))
    return found


def _draws(rows: np.ndarray, trees: int) -> np.ndarray:
    """How often each tree's bootstrap draws each row: Poisson numbers of mean one, from 16 bits of a hash of row and tree."""
    blocks = np.arange(1, -(-trees // 4) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = rows[:, None] + blocks
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return _POISSON[(mixed ^ (mixed >> np.uint64(31))).view(np.uint16)[:, :trees]]


def _bagged(thresholds: list[list[float]], trees: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a partition as sums by tree and cell: of draws, of drawn labels and of their squares."""
    shape = [len(ends) + 1 for ends in thresholds]
    size = math.prod(shape)
    sums = np.zeros((trees, 3, size))
    for batch in batches:
        for start in range(0, batch.num_rows, _CHUNK):
            draw, *columns = (c.to_numpy(zero_copy_only=False) for c in batch.slice(start, _CHUNK).columns)
            *features, label = columns
            if any(np.isnan(values).any() for values in features) or not np.isfinite(label).all():
                raise ValueError("a feature or label is missing or not a number")
            places = [np.searchsorted(ends, values) for ends, values in zip(thresholds, features)]
            cells = np.ravel_multi_index(places, shape)
            for total, times in zip(sums, np.ascontiguousarray(_draws(draw.view(np.uint64), trees).T)):
                value = times.astype(np.float64)
                for k in range(3):
                    total[k] += np.bincount(cells, value, size)
                    value *= label
    for tree, total in enumerate(sums):
        cells = np.flatnonzero(total[0])
        columns = [np.full(len(cells), tree, np.int32), cells.astype(np.int32), *total[:, cells]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["tree", "cell", "n", "s", "q"])


def _grown(thresholds: list[list[float]], max_depth: int, cells: pd.DataFrame) -> pd.DataFrame:
    """One tree from its cells. Every node splits where the variance falls most; ids ascend from a node to its children."""
    places = np.unravel_index(cells["cell"].to_numpy(), [len(ends) + 1 for ends in thresholds])
    stats = cells[["n", "s", "q"]].to_numpy()
    nodes: list[list] = []

    def grow(here: np.ndarray, depth: int) -> None:
        n, s, q = stats[here].sum(axis=0)
        node, number = [len(nodes), s / n, max(0.0, q / n - (s / n) ** 2), [n, s, q], int(n), -1.0, -1, -1, -1, []], len(nodes)
        nodes.append(node)
        # a smaller fall of the variance, or difference between two falls, is rounding; of such equals the first is taken
        least, best, split = 1e-12 * q / n, 0.0, None
        for feature, ends in enumerate(thresholds) if depth < max_depth else ():
            counts, totals = (np.bincount(places[feature][here], stats[here, i], len(ends) + 1).cumsum()[:-1] for i in (0, 1))
            apart = np.flatnonzero((counts > 0) & (counts < n))
            if apart.size:
                left, total = counts[apart], totals[apart]
                gains = (total**2 / left + (s - total) ** 2 / (n - left) - s**2 / n) / n
                if gains.max() > best + least:
                    best, split = gains.max(), (feature, int(apart[(gains >= gains.max() - least).argmax()]))
        if split is None:
            return
        lower = places[split[0]][here] <= split[1]
        node[5:] = [best, number + 1, None, split[0], [thresholds[split[0]][split[1]]]]
        grow(here[lower], depth + 1)
        node[7] = len(nodes)
        grow(here[~lower], depth + 1)
        if len(nodes) == number + 3 and nodes[-1][1] == nodes[-2][1]:
            del nodes[number + 1 :]
            node[5:] = [-1.0, -1, -1, -1, []]

    grow(np.arange(len(stats)), 0)
    grown = pd.DataFrame(nodes, columns=list(_NODE)[1:])
    grown.insert(0, "tree", cells["tree"].iloc[0])
    return grown


def _model(nodes: DataFrame, label: str, trees: int, max_depth: int) -> PipelineModel:
    """The grown trees as an MLlib model. MLlib makes forests by training or loading only, so one of bare roots is saved, its
    nodes are replaced, and it is loaded."""
    spark = nodes.sparkSession
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol=label,
        predictionCol="prediction",
        numTrees=trees,
        maxDepth=max_depth,
        featureSubsetStrategy="all",
        maxBins=BINS,
        seed=SEED,
    )
    # as many rows as make an empty bootstrap, which has no root, out of the question
    bare = spark.range(64).select(*[F.lit(0.0).alias(name) for name in [*FEATURES, label]])
    model = Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(bare)
    path = work_dir(spark, "forest")
    save(model, path)
    split = F.struct("featureIndex", "leftCategoriesOrThreshold", F.lit(-1).alias("numCategories")).alias("split")
    data = F.struct(*list(_NODE)[1:9], split).alias("nodeData")
    nodes.select(F.col("tree").alias("treeID"), data).write.mode("overwrite").parquet(f"{path}/stages/1_{model.stages[1].uid}/data")
    return load(path)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``rows`` with the forest's ``prediction``, the same that ``model.transform`` gives each of them.

    A forest tells rows apart only by the side of its thresholds on which their features lie. With up to ``_CELLS`` cells
    between the thresholds, it walks its trees once for each cell, and every row takes the prediction of its own cell.
    """
    features, spark = model.stages[0].getInputCols(), rows.sparkSession
    path = work_dir(spark, "forest")
    save(model, path)
    ends = [[] for _ in features]
    for found in forest_nodes(spark, path).where("feature IS NOT NULL").select("feature", "threshold").distinct().collect():
        ends[found["feature"]].append(found["threshold"])
    shape = [len(thresholds) + 1 for thresholds in ends]
    if math.prod(shape) > _CELLS:
        return model.transform(rows).drop("features")
    key, number, values, place = "_cell", F.col("id"), [], F.lit(0)
    for name, thresholds, size in zip(reversed(features), reversed(ends), reversed(shape)):
        # a threshold lies in the cell below it
        inside = F.array(*[F.lit(end) for end in [*sorted(thresholds), math.inf]])
        values.append(F.element_at(inside, (number % size + 1).cast("int")).alias(name))
        number = F.floor(number / size)
    for name, thresholds, size in zip(features, ends, shape):
        place = place * size + _place(F.col(name).cast("double"), sorted(thresholds), 0, size - 1)
    cells = model.transform(spark.range(math.prod(shape)).select(F.col("id").cast("int").alias(key), *values)).select(key, "prediction")
    missing = F.greatest(*[F.col(name).isNull() | F.isnan(F.col(name).cast("double")) for name in features])
    place = F.when(missing, F.raise_error(F.lit("a feature is missing or not a number"))).otherwise(place)
    return rows.withColumn(key, place).join(cells, key, "left").drop(key)


def _place(value: Column, ends: list[float], low: int, high: int) -> Column:
    """How many of the sorted ``ends`` lie below a value, known to be from ``low`` to ``high``: a binary search."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(value <= ends[middle], _place(value, ends, low, middle)).otherwise(_place(value, ends, middle + 1, high))


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with the predicted fuel consumption, two decimals."""
    return predict(model, rows).withColumn(PREDICTION, round2(F.col("prediction"))).drop("prediction")


def mean_absolute_error(model: PipelineModel, rows: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: the number of test rows, the mean absolute error and, to compare, the labels' standard deviation."""
    off = F.abs(F.col("prediction") - F.col(label))
    return predict(model, rows).agg(
        F.count(F.lit(1)).alias("test_rows"), F.avg(off).alias("mae"), F.stddev_pop(label).alias("label_stddev")
    )


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def forest_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The trees of a saved model as a table, for other engines to score with: a row per node, a leaf without a feature.

    Columns: tree, node, feature (its place in ``FEATURES``), threshold, left_node, right_node, prediction.
    """
    node, inner = F.col("nodeData"), F.col("nodeData.leftChild") >= 0
    return spark.read.parquet(f"{path}/stages/1_*/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        F.when(inner, node["split"]["featureIndex"]).alias("feature"),
        F.when(inner, F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(inner, node["leftChild"]).alias("left_node"),
        F.when(inner, node["rightChild"]).alias("right_node"),
        node["prediction"].alias("prediction"),
    )


def forest_sql(rows: str, nodes: str, key: list[str], features: list[str] | None = None) -> str:
    """SQL that scores a table of rows with a table of ``forest_nodes``: the key and the mean of all trees, two decimals."""
    names, keys = features or FEATURES, ", ".join(key)
    value = " ".join(f"WHEN {i} THEN w.{name}" for i, name in enumerate(names))
    return f"""WITH RECURSIVE walk AS (
        SELECT r.*, n.tree, n.node, n.feature, n.threshold, n.left_node, n.right_node, n.prediction
        FROM {rows} r JOIN {nodes} n ON n.node = 0
        UNION ALL
        SELECT {", ".join(f"w.{c}" for c in [*key, *names])},
            n.tree, n.node, n.feature, n.threshold, n.left_node, n.right_node, n.prediction
        FROM walk w JOIN {nodes} n ON n.tree = w.tree
            AND n.node = CASE WHEN CASE w.feature {value} END <= w.threshold THEN w.left_node ELSE w.right_node END
        WHERE w.feature IS NOT NULL
    )
    SELECT {keys}, round(CAST(avg(prediction) AS DECIMAL(38, 8)), 2) AS {PREDICTION}
    FROM walk WHERE feature IS NULL GROUP BY {keys}"""


def train_and_save(
    rows: DataFrame, key: list[str], path: str, max_depth: int = MAX_DEPTH, partitions: int | None = None
) -> DataFrame:
    """Train on the training share, save the model and return its error on the test share."""
    training, test = split(rows, key)
    save(train(training, max_depth=max_depth, partitions=partitions, spread_by=key), path)
    return mean_absolute_error(load(path), test)
