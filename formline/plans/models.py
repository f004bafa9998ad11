"""Training, selecting and scoring models on tables with ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PCA, Imputer, OneHotEncoder, PCAModel, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit, TrainValidationSplitModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from formline.functions.numbers import round_half_up
from formline.operators.joins import null_safe_join
from formline.operators.matching import with_scalar
from formline.operators.ordered import Running, over_ordered
from formline.operators.quality import QualityError, assert_unique
from formline.sources.incremental import upsert
from formline.sources.tables import overwrite

#: Fits of a search that run side by side, so that one's last tasks leave no core idle.
FITS_AT_ONCE = 4
NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def split_columns(df: DataFrame, deny: Sequence[str] = ()) -> dict[str, list[str]]:
    """Usable columns by kind: numeric, boolean, categorical."""
    kinds: dict[str, list[str]] = {"numeric": [], "boolean": [], "categorical": []}
    for name, dtype in df.dtypes:
        if name in deny:
            continue
        if dtype.startswith(NUMERIC):
            kinds["numeric"].append(name)
        elif dtype in ("boolean", "string"):
            kinds["boolean" if dtype == "boolean" else "categorical"].append(name)
    return kinds


def trainable(df: DataFrame, game: str, usage: str, above: float = 500) -> DataFrame:
    return df.filter(F.col(game).isNotNull() & (F.col(usage) > above))


def scorable(df: DataFrame, game: str, usage: str, above: float = 300) -> DataFrame:
    return df.filter(F.col(game).isNull() & (F.col(usage) > above))


def booleans_as_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def feature_stages(
    numeric: Sequence[str], one_hot: Sequence[str] = (), ordinal: Sequence[str] = (), output: str = "features"
) -> list:
    """Mean imputation and standardization of numbers, one-hot columns, ordinal
    codes whose unseen values get a code of their own, in one vector. Numbers
    alone are that vector once scaled; nothing is copied into another."""
    indexed = [*one_hot, *ordinal]
    stages = [
        Imputer(inputCols=list(numeric), outputCols=[f"_i_{c}" for c in numeric], strategy="mean"),
        VectorAssembler(inputCols=[f"_i_{c}" for c in numeric], outputCol="_numbers"),
        StandardScaler(inputCol="_numbers", outputCol="_scaled" if indexed else output, withMean=True, withStd=True),
    ]
    if not indexed:
        return stages
    stages.append(
        StringIndexer(inputCols=indexed, outputCols=[f"_x_{c}" for c in indexed], handleInvalid="keep", stringOrderType="alphabetAsc")
    )
    parts = ["_scaled", *[f"_x_{c}" for c in ordinal]]
    if one_hot:
        stages.append(
            OneHotEncoder(inputCols=[f"_x_{c}" for c in one_hot], outputCols=[f"_h_{c}" for c in one_hot], handleInvalid="keep")
        )
        parts += [f"_h_{c}" for c in one_hot]
    stages.append(VectorAssembler(inputCols=parts, outputCol=output))
    return stages


def vector_names(df: DataFrame, vector: str = "features") -> list[str]:
    """Names of the slots of an assembled vector, from its metadata; a vector
    whose slots have none gets them from its own name and their places."""
    known = df.schema[vector].metadata["ml_attr"]
    if "attrs" not in known:
        return [f"{vector}_{i}" for i in range(known["num_attrs"])]
    slots = [a for kind in known["attrs"].values() for a in kind]
    return [a.get("name", str(a["idx"])) for a in sorted(slots, key=lambda a: a["idx"])]


def select_features(prepared: DataFrame, label: str, k: int, must_have: Sequence[int] = (), seed: int = 7) -> VectorSlicer:
    """A slicer to the k vector slots of highest forest importance, together
    with protected slots."""
    forest = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=20, maxDepth=6, seed=seed)
    importances = forest.fit(prepared).featureImportances.toArray()
    ranked = sorted(range(len(importances)), key=lambda i: (-importances[i], i))
    chosen = sorted(list(dict.fromkeys([*must_have, *ranked]))[: max(k, len(set(must_have)))])
    return VectorSlicer(inputCol="features", outputCol="selected", indices=[int(i) for i in chosen])


def rank_features(df: DataFrame, label: str, features: Sequence[str], k: int, must_have: Sequence[str] = (), bins: int = 32) -> DataFrame:
    """``feature, score, place, chosen``: numeric features by what their best split explains of the label.

    A feature's values are cut into bins at its quantiles, and one aggregation over
    (feature, bin) gives the label's count and sums, from which every split between
    bins follows: the score is the share of the label's squared deviation, over
    all rows, that the best split takes away. Rows where a feature is null are left
    out of its score but not of the total, so a feature known for few rows scores
    little. ``must_have`` come first, then the highest scores, names breaking ties;
    the first k (all of ``must_have`` at least) are chosen. Quantiles are exact up
    to about a million rows and within a millionth beyond. A row without a label
    isn't used.
    """
    y = F.col(label).cast("double")
    rows = df.filter(F.col(label).isNotNull()).select(y.alias("_y"), *[F.col(c).cast("double").alias(c) for c in features])
    cuts = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    edges = rows.agg(*[F.percentile_approx(c, cuts, 1_000_000).alias(c) for c in features], (F.var_pop("_y") * F.count(F.lit(1))).alias("_total")).first()
    pairs = [
        F.struct(F.lit(c).alias("feature"), _bin(F.col(c), edges[c] or []).alias("bin"))
        for c in features
    ]
    placed = rows.select("_y", F.explode(F.array(*pairs)).alias("_p")).select("_y", "_p.feature", "_p.bin").filter("bin IS NOT NULL")
    sums = placed.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("s"))
    upto = Window.partitionBy("feature").orderBy("bin")
    whole = Window.partitionBy("feature")
    n, s, left, low = F.sum("n").over(whole), F.sum("s").over(whole), F.sum("n").over(upto), F.sum("s").over(upto)
    splits = sums.select("feature", n.alias("n"), s.alias("s"), left.alias("nl"), low.alias("sl"))  # bins rows a feature
    rest = F.col("s") - F.col("sl")
    gain = F.expr("sl * sl / nl") + F.try_divide(rest * rest, F.col("n") - F.col("nl")) - F.expr("s * s / n")
    best = splits.groupBy("feature").agg(F.max(F.when(F.col("nl") < F.col("n"), gain)).alias("_gain"))
    names = df.sparkSession.createDataFrame([(c,) for c in features], "feature string").join(best, "feature", "left")
    scored = names.withColumn("score", F.round(F.coalesce(F.try_divide(F.col("_gain"), F.lit(edges["_total"])), F.lit(0.0)), 6))
    order = Window.orderBy(~F.col("feature").isin(list(must_have)), F.col("score").desc(), "feature")  # a row a feature
    placed = scored.select("feature", "score", F.row_number().over(order).alias("place"))
    return placed.withColumn("chosen", F.col("place") <= max(k, len(set(must_have))))


def _bin(value: Column, edges: Sequence[float]) -> Column:
    """How many edges lie below a value; null for null."""
    if not edges:
        return F.lit(None).cast("int")
    return F.when(value.isNotNull(), F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda e: e < value)))


def write_ranked_tables(rows: DataFrame, ranked: DataFrame, keys: Sequence[str], path: str, widths: Sequence[int], current: str | None = None) -> None:
    """Feature tables of the best ``widths`` features, all in one pass over the rows.

    ``ranked`` is a result of ``rank_features``. A row is written once for each
    width, below a folder of that width, with its features by name. Keys must be
    unique; ``current`` names tables of an earlier run, whose rows are kept where
    the new rows lack their key. ``path`` is another folder, so a failed write
    leaves the current tables whole.
    """
    names = [r.feature for r in ranked.orderBy("place").collect()]  # a row a feature
    tables = [
        F.struct(F.lit(w).alias("width"), F.create_map(*[x for c in names[:w] for x in (F.lit(c), F.col(c).cast("double"))]).alias("features")) for w in widths
    ]
    new = assert_unique(rows, keys).select(*keys, F.explode(F.array(*tables)).alias("_t")).select(*keys, "_t.width", "_t.features")
    if current is not None:
        new = upsert(rows.sparkSession.read.parquet(current).select(*new.columns), new, [*keys, "width"])
    overwrite(new, path, ["width"])


def read_ranked_table(spark: SparkSession, path: str, width: int) -> DataFrame:
    """One of the tables; only its folder is read."""
    return spark.read.parquet(path).filter(F.col("width") == width).drop("width")


def explained_shares(df: DataFrame, columns: Sequence[str], share: float = 0.95) -> DataFrame:
    """``component, share, so_far, kept``: what the principal components of standardized columns explain.

    One pass takes means and deviations, a second sums the columns' products, each
    task its own matrix (columns x columns), which are added up cell by cell. Only
    that matrix comes to the driver. The fewest components that explain ``share``
    are kept. Rows with a null in a column aren't used; a constant column explains
    nothing.
    """
    import numpy as np

    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    basics = rows.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)], *[F.stddev_pop(c).alias(f"d{i}") for i, c in enumerate(columns)], F.count(F.lit(1)).alias("n")).first()
    k = len(columns)
    means = np.array([basics[f"m{i}"] or 0.0 for i in range(k)])
    spread = np.array([basics[f"d{i}"] or 0.0 for i in range(k)])

    def moments(batches):
        import pyarrow as pa

        total = np.zeros((k, k))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            x = np.divide(x - means, spread, out=np.zeros_like(x), where=spread > 0)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k, dtype=np.int32)), pa.array(total.ravel())], ["cell", "v"])

    cells = rows.mapInArrow(moments, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()  # columns squared
    matrix = np.zeros(k * k)
    for cell in cells:
        matrix[cell.cell] = cell.v / max(1, basics["n"])
    values = np.linalg.eigvalsh(matrix.reshape(k, k))[::-1].clip(0)
    shares = values / values.sum() if values.sum() > 0 else values
    before = np.concatenate([[0.0], np.cumsum(shares)[:-1]])
    out = [(i + 1, float(v), float(b + v), bool(b < share - 1e-12)) for i, (v, b) in enumerate(zip(shares, before, strict=True))]
    return df.sparkSession.createDataFrame(out, "component int, share double, so_far double, kept boolean")


def pca_for_variance(prepared: DataFrame, share: float = 0.95, source: str = "features") -> tuple[PCAModel, VectorSlicer]:
    """All components, fitted once, and a slicer to the fewest that explain
    ``share`` (output ``reduced``). The size comes from the vector's metadata."""
    size = len(vector_names(prepared, source))
    model = PCA(k=size, inputCol=source, outputCol="components").fit(prepared)
    explained, k = 0.0, 0
    for value in model.explainedVariance.toArray():
        k, explained = k + 1, explained + float(value)
        if explained >= share - 1e-12:
            break
    return model, VectorSlicer(inputCol="components", outputCol="reduced", indices=list(range(k)))


def write_feature_tables(prepared: DataFrame, label: str, keys: Sequence[str], root: str, sizes: Sequence[int] = (50, 100, 200)) -> dict[int, str]:
    """One keyed feature table per feature count."""
    paths = {}
    for k in sizes:
        slicer = select_features(prepared, label, k)
        paths[k] = f"{root.rstrip('/')}/features_{k}"
        overwrite(slicer.transform(prepared).select(*keys, "selected"), paths[k])
    return paths


def hash_split(df: DataFrame, keys: Sequence[str], parts: dict[str, int] | None = None, alias: str = "part") -> DataFrame:
    """Repeatable split by a hash of the key; parts give percentages."""
    parts = parts or {"train": 60, "validate": 20, "test": 20}
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    place = F.conv(F.substring(digest, 1, 7), 16, 10).cast("long") % 100
    return df.withColumn(alias, _by_share(place, parts))


def time_split(df: DataFrame, date: str, parts: dict[str, int] | None = None, alias: str = "part") -> DataFrame:
    """Split along time by the percent rank of the date. Rows of one date share
    the rank, so it is taken over per-date counts, never over the rows."""
    parts = parts or {"train": 60, "validate": 20, "test": 20}
    counts = df.groupBy(date).agg(F.count(F.lit(1)).alias("_n"))
    before = Running("_before", F.col("_n"), "sum", strict=True)
    placed = with_scalar(over_ordered(counts, [], [date], [before]), df.agg(F.count(F.lit(1)).alias("_all")))
    share = F.try_divide(F.coalesce(F.col("_before"), F.lit(0)) * 100.0, F.col("_all") - 1)
    ranked = placed.select(date, F.coalesce(share, F.lit(0.0)).alias("_place"))
    joined = null_safe_join(df, ranked, [date], "left")
    return joined.select(*df.columns, _by_share(F.col("_place"), parts).alias(alias))


def _by_share(place: Column, parts: dict[str, int]) -> Column:
    chain, upper = None, 0
    names = list(parts)
    for name in names[:-1]:
        upper += parts[name]
        chain = F.when(place < upper, name) if chain is None else chain.when(place < upper, name)
    return chain.otherwise(names[-1])


def search(
    train: DataFrame, label: str, features: str = "features", metric: str = "rmse", parallelism: int = 4, trees: int = 20, seed: int = 7
) -> tuple[str, TrainValidationSplitModel]:
    """Grids over boosted trees, a forest and a linear model; the name and the
    search result of the best family on a held-out quarter."""
    evaluator = RegressionEvaluator(labelCol=label, metricName=metric)
    gbt = GBTRegressor(featuresCol=features, labelCol=label, maxIter=trees, seed=seed)
    forest = RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=trees, seed=seed)
    linear = LinearRegression(featuresCol=features, labelCol=label)
    grids = {
        "boosted": (gbt, ParamGridBuilder().addGrid(gbt.maxDepth, [3, 5]).addGrid(gbt.stepSize, [0.05, 0.1]).build()),
        "forest": (forest, ParamGridBuilder().addGrid(forest.maxDepth, [5, 8]).build()),
        "linear": (linear, ParamGridBuilder().addGrid(linear.regParam, [0.0, 0.1]).addGrid(linear.elasticNetParam, [0.0, 0.5]).build()),
    }
    results = {}
    for name, (estimator, grid) in grids.items():
        tuning = TrainValidationSplit(
            estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, trainRatio=0.75, parallelism=parallelism, seed=seed
        )
        results[name] = tuning.fit(train)
    best = max if evaluator.isLargerBetter() else min
    winner = best(results, key=lambda n: best(results[n].validationMetrics))
    return winner, results[winner]


def deal_rows(rows: DataFrame, keys: Sequence[str], path: str, folds: int = 3) -> DataFrame:
    """The rows with their ``fold`` (f0, f1, ...), written by fold below ``path`` and read back, so that a fit reads its folds only.

    A row's fold is a hash of its keys, so it depends neither on order nor on a
    seed. The plan of the rows runs once, in this write.
    """
    parts = {f"f{i}": 100 // folds for i in range(folds - 1)}
    parts[f"f{folds - 1}"] = 100 - sum(parts.values())
    dealt = hash_split(rows, keys, parts, "fold")
    overwrite(dealt, path, ["fold"])
    return rows.sparkSession.read.schema(dealt.schema).parquet(path)


def cross_predictions(
    rows: DataFrame, label: str, keys: Sequence[str], candidates: dict, path: str, folds: int = 3, dealt: bool = False
) -> DataFrame:
    """Every candidate's predictions for rows that it wasn't fitted on: ``candidate, fold, keys, label, prediction``, written below ``path``.

    The rows are written by fold beside ``path``, unless they are ``dealt``: what
    ``deal_rows`` gave for as many folds. ``candidates`` are estimators by name;
    each is fitted once for each fold, on the others, a few fits at a time, and its
    predictions are written to a folder of its own, which a repeated fit overwrites.
    """
    spark, root = rows.sparkSession, path.rstrip("/")
    if not dealt:
        rows = deal_rows(rows, keys, f"{root}-rows", folds)

    def told(task):
        name, fold = task
        model = candidates[name].fit(rows.filter(F.col("fold") != fold))
        predicted = model.transform(rows.filter(F.col("fold") == fold)).select(*keys, F.col(label).cast("double").alias("label"), "prediction")
        overwrite(predicted, f"{root}/candidate={name}/fold={fold}")

    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        list(pool.map(inheritable_thread_target(spark)(told), [(name, f"f{i}") for name in candidates for i in range(folds)]))
    return spark.read.parquet(path)


def candidate_errors(predictions: DataFrame, metric: str = "rmse") -> DataFrame:
    """``candidate, n, rmse, mae, best`` of written predictions; the least error is best, the first name among equals."""
    error = F.col("label") - F.col("prediction")
    errors = predictions.groupBy("candidate").agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae")
    )
    order = Window.orderBy(F.col(metric), "candidate")  # a row a candidate
    return errors.withColumn("best", F.row_number().over(order) == 1)


def refit_and_keep(estimator, rows: DataFrame, path: str) -> PipelineModel:
    """The estimator fitted on all rows, and written for other jobs."""
    model = (estimator if isinstance(estimator, Pipeline) else Pipeline(stages=[estimator])).fit(rows)
    model.write().overwrite().save(path)
    return model


def load_kept(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def refit_on_all(result: TrainValidationSplitModel, rows: DataFrame):
    """The winning estimator with its winning parameters, fitted on all rows."""
    metrics = result.validationMetrics
    best = max if result.getEvaluator().isLargerBetter() else min
    chosen = metrics.index(best(metrics))
    return result.getEstimator().fit(rows, result.getEstimatorParamMaps()[chosen])


def fit(rows: DataFrame, label: str, numeric: Sequence[str], one_hot=(), ordinal=(), estimator=None) -> PipelineModel:
    """Feature stages and an estimator fitted together."""
    estimator = estimator or GBTRegressor(featuresCol="features", labelCol=label, maxIter=10, maxDepth=4, seed=7)
    return Pipeline(stages=[*feature_stages(numeric, one_hot, ordinal), estimator]).fit(rows)


def score(model, df: DataFrame, alias: str = "predicted", keep: Sequence[str] | None = None) -> DataFrame:
    """Predictions in place: no row is matched by position."""
    return model.transform(df).select(*(keep or df.columns), F.col("prediction").alias(alias))


def regression_metrics(df: DataFrame, label: str, prediction: str, digits: int = 4) -> DataFrame:
    """One row: n, MSE, RMSE, MAE and R², each under its own name."""
    rows = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    error = F.col(label).cast("double") - F.col(prediction).cast("double")
    mse = F.avg(error * error)
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        round_half_up(mse, digits).alias("mse"),
        round_half_up(F.sqrt(mse), digits).alias("rmse"),
        round_half_up(F.avg(F.abs(error)), digits).alias("mae"),
        round_half_up(1 - F.try_divide(mse, F.var_pop(F.col(label).cast("double"))), digits).alias("r2"),
    )


def evaluate(df: DataFrame, label: str, metrics: Sequence[str] = ("mse", "rmse", "mae", "r2")) -> dict[str, float]:
    evaluator = RegressionEvaluator(labelCol=label)
    return {m: evaluator.evaluate(df, {evaluator.metricName: m}) for m in metrics}


def assert_enough(df: DataFrame, rows: int) -> DataFrame:
    """Raise when a training set has fewer than ``rows`` rows."""
    if df.limit(rows).count() < rows:
        raise QualityError(f"fewer than {rows} training rows")
    return df
