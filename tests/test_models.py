"""Feature stages, selection, search and scoring on small rows."""

import random

import pytest
from conftest import rows_of
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from formline.operators.quality import QualityError
from formline.plans import models
from formline.sources import tables


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    data = []
    for i in range(300):
        a, b = rng.uniform(0, 10), rng.uniform(0, 1)
        team = "ABC"[i % 3]
        data.append((i, i if i % 5 else None, a if i % 7 else None, b, team, i % 2 == 0, 3 * a + (5 if team == "A" else 0) + b))
    return spark.createDataFrame(data, "id int, game int, a double, b double, team string, home boolean, y double")


def test_columns_by_kind(rows):
    kinds = models.split_columns(rows, deny=["id", "game", "y"])
    assert kinds == {"numeric": ["a", "b"], "boolean": ["home"], "categorical": ["team"]}


def test_usage_filters(rows):
    assert models.trainable(rows, "game", "a", 5).filter("game is null or a <= 5").count() == 0
    assert models.scorable(rows, "game", "a", 5).filter("game is not null or a <= 5").count() == 0


def test_selection_pca_and_tables(spark, rows, tmp_path):
    ready = models.booleans_as_numbers(rows, ["home"])
    prepared = Pipeline(stages=models.feature_stages(["a", "b", "home"], one_hot=["team"])).fit(ready).transform(ready)
    names = models.vector_names(prepared)
    assert len(names) == prepared.first()["features"].size
    slicer = models.select_features(prepared, "y", 2, must_have=[1])
    assert slicer.getIndices() == [0, 1]
    model, slicer = models.pca_for_variance(prepared, 0.95)
    kept = slicer.getIndices()
    explained = model.explainedVariance.toArray()
    assert kept == list(range(len(kept))) and sum(explained[: len(kept)]) >= 0.95 > sum(explained[: len(kept) - 1])
    assert slicer.transform(model.transform(prepared)).first()["reduced"].size == len(kept)
    whole, every = models.pca_for_variance(prepared, 1.0)
    assert sum(whole.explainedVariance.toArray()[: len(every.getIndices())]) == pytest.approx(1.0)
    paths = models.write_feature_tables(prepared, "y", ["id"], str(tmp_path), sizes=[2, 3])
    assert {k: spark.read.parquet(p).first()["selected"].size for k, p in paths.items()} == {2: 2, 3: 3}


def test_search_refit_and_score(rows):
    stages = Pipeline(stages=models.feature_stages(["a", "b"], one_hot=["team"], ordinal=[])).fit(rows)
    prepared = stages.transform(rows)
    name, result = models.search(prepared, "y", trees=3, parallelism=4)
    assert name in ("boosted", "forest", "linear")
    scored = models.score(models.refit_on_all(result, prepared), prepared, keep=["id", "y"])
    assert scored.count() == 300
    measured = models.evaluate(scored.withColumnRenamed("predicted", "prediction"), "y")
    own = models.regression_metrics(scored, "y", "predicted").first()
    assert own.rmse == pytest.approx(measured["rmse"], abs=1e-3) and own.mse == pytest.approx(measured["mse"], abs=1e-3)
    assert own.r2 == pytest.approx(measured["r2"], abs=1e-3) and own.mae == pytest.approx(measured["mae"], abs=1e-3)


def test_features_by_their_best_split(spark):
    """Scores against a loop over all splits between bins; nulls, a constant and a feature without values."""
    import numpy as np

    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 3)).round(2)
    y = np.where(x[:, 1] > 0.3, 5.0, 1.0) + 0.1 * x[:, 0]
    rows = [(float(t), float(a), float(b), None if i % 4 else float(c), 1.0, None) for i, (t, (a, b, c)) in enumerate(zip(y, x, strict=True))]
    df = spark.createDataFrame([*rows, (None, 9.0, 9.0, 9.0, 1.0, 1.0)], "y double, a double, b double, c double, same double, none double")
    got = {r.feature: r for r in models.rank_features(df, "y", ["a", "b", "c", "same", "none"], 2, must_have=["same"], bins=8).collect()}

    def best(values, labels):
        edges = np.sort(values)[[int(np.ceil(len(values) * i / 8)) - 1 for i in range(1, 8)]]
        total = ((y - y.mean()) ** 2).sum()
        sse = lambda v: ((v - v.mean()) ** 2).sum() if len(v) else 0.0
        return max((sse(labels) - sse(labels[values <= e]) - sse(labels[values > e])) / total for e in edges)

    known = np.arange(500) % 4 == 0
    for name, want in (("a", best(x[:, 0], y)), ("b", best(x[:, 1], y)), ("c", best(x[known, 2], y[known])), ("same", 0), ("none", 0)):
        assert got[name].score == pytest.approx(want, abs=2e-6), name
    assert [n for n in sorted(got, key=lambda n: got[n].place)][:2] == ["same", "b"]
    assert {n for n in got if got[n].chosen} == {"same", "b"}


def test_feature_tables_of_all_widths_in_one_pass(spark, rows, tmp_path):
    ranked = spark.createDataFrame([("b", 1), ("a", 2)], "feature string, place int")
    models.write_ranked_tables(rows.filter("id < 200"), ranked, ["id"], f"{tmp_path}/v1", [1, 2])
    more = rows.filter("id >= 150").withColumn("b", F.lit(-1.0))
    models.write_ranked_tables(more, ranked, ["id"], f"{tmp_path}/v2", [1, 2], current=f"{tmp_path}/v1")
    for width, names in ((1, {"b"}), (2, {"a", "b"})):
        found = models.read_ranked_table(spark, f"{tmp_path}/v2", width)
        assert found.count() == 300 and set(found.first().features) == names
        assert found.filter("features['b'] = -1").count() == 150
    with pytest.raises(QualityError):
        models.write_ranked_tables(rows.unionByName(rows), ranked, ["id"], f"{tmp_path}/v3", [1])


def test_explained_shares(spark, rows):
    """As the eigenvalues of the correlation matrix; rows with nulls and constant columns."""
    import numpy as np

    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 4)) @ rng.normal(size=(4, 4)) * 100 + 1e6
    df = spark.createDataFrame([*([*map(float, r), 3.0] for r in x), [None, 1.0, 1.0, 1.0, 3.0]], "a double, b double, c double, d double, e double")
    got = models.explained_shares(df.repartition(5), ["a", "b", "c", "d"], 0.9).orderBy("component").collect()
    want = np.linalg.eigvalsh(np.corrcoef(x.T))[::-1] / 4
    assert [r.share for r in got] == pytest.approx(want.tolist(), abs=1e-9)
    assert [r.kept for r in got] == [bool(b < 0.9) for b in np.concatenate([[0], np.cumsum(want)[:-1]])]
    constant = models.explained_shares(df, ["a", "e"]).orderBy("component").collect()
    assert [(round(r.share, 6), r.kept) for r in constant] == [(1.0, True), (0.0, False)]
    assert [r.share for r in models.explained_shares(df.limit(0), ["a", "b"]).collect()] == [0.0, 0.0]


def test_candidates_of_several_families(spark, rows, tmp_path):
    """The winner and its error, taken again from the written predictions; the kept model predicts as the fitted one."""
    from pyspark.ml.regression import GBTRegressor, LinearRegression

    stages = models.feature_stages(["a", "b"])
    candidates = {
        "boosted": Pipeline(stages=[*stages, GBTRegressor(featuresCol="features", labelCol="y", maxIter=2, seed=1)]),
        "linear": Pipeline(stages=[*stages, LinearRegression(featuresCol="features", labelCol="y")]),
    }
    told = models.cross_predictions(rows, "y", ["id"], candidates, f"{tmp_path}/p")
    assert told.groupBy("candidate").count().filter("count = 300").count() == 2
    assert told.groupBy("id", "candidate").count().filter("count > 1").count() == 0
    errors = {r.candidate: r for r in models.candidate_errors(told).collect()}
    frame = told.toPandas()
    own = {c: float((((g.label - g.prediction) ** 2).mean()) ** 0.5) for c, g in frame.groupby("candidate")}
    assert {c: errors[c].rmse for c in own} == pytest.approx(own)
    winner = min(own, key=lambda c: (own[c], c))
    assert [c for c in errors if errors[c].best] == [winner]
    again = models.cross_predictions(rows.orderBy(F.desc("id")), "y", ["id"], {"linear": candidates["linear"]}, f"{tmp_path}/q")
    folds = {r.id: r.fold for r in told.filter("candidate = 'linear'").collect()}
    assert {r.id: r.fold for r in again.collect()} == folds
    model = models.refit_and_keep(candidates[winner], rows, f"{tmp_path}/m")
    models.refit_and_keep(candidates[winner], rows, f"{tmp_path}/m")
    assert rows_of(models.score(model, rows, keep=["id"])) == rows_of(models.score(models.load_kept(f"{tmp_path}/m"), rows, keep=["id"]))


def test_unseen_code_gets_its_own(spark, rows):
    model = Pipeline(stages=models.feature_stages(["a"], ordinal=["team"])).fit(rows)
    new = rows.limit(1).withColumn("team", F.lit("Z"))
    assert model.transform(new).first()["_x_team"] == 3.0


def test_splits(rows):
    split = models.hash_split(rows, ["id"])
    assert rows_of(split, "id", "part") == rows_of(models.hash_split(rows.orderBy(F.desc("id")), ["id"]), "id", "part")
    timed = models.time_split(rows, "id", {"early": 50, "late": 50})
    assert rows_of(timed.groupBy("part").agg(F.max("id"), F.count("*"))) == [("early", 149, 150), ("late", 299, 150)]
    with pytest.raises(QualityError):
        models.assert_enough(rows, 301)


def test_feature_table_create_or_merge(spark, rows, tmp_path):
    first = tables.create_or_merge(spark, rows.filter("id < 5").select("id", "b"), None, str(tmp_path / "v1"), ["id"])
    assert first.count() == 5
    more = rows.filter("id between 3 and 7").select("id", F.lit(9.0).alias("b"))
    merged = tables.create_or_merge(spark, more, str(tmp_path / "v1"), str(tmp_path / "v2"), ["id"])
    assert merged.count() == 8 and merged.filter("b = 9.0").count() == 5


def test_fits_read_rows_written_by_fold(spark, tmp_path):
    line = {"linear": models.LinearRegression(featuresCol="features", labelCol="y")}
    assembled = models.VectorAssembler(inputCols=["x"], outputCol="features").transform(spark.range(60).selectExpr("id", "double(id % 7) AS x", "double(id % 7) * 3 AS y"))
    told = models.cross_predictions(assembled, "y", ["id"], line, f"{tmp_path}/p")
    assert told.count() == 60 and sorted(p.name for p in tmp_path.glob("p-rows/fold=*")) == ["fold=f0", "fold=f1", "fold=f2"]
    assert told.filter("abs(prediction - label) > 1e-6").isEmpty()


def test_numbers_alone_are_scaled_into_the_vector(spark, rows):
    """One vector step less for every row of every pass, the same values."""
    import numpy as np

    prepared = Pipeline(stages=models.feature_stages(["a", "b"])).fit(rows).transform(rows)
    assert [type(s).__name__ for s in models.feature_stages(["a", "b"])] == ["Imputer", "VectorAssembler", "StandardScaler"]
    assert models.vector_names(prepared) == ["features_0", "features_1"]
    frame = rows.toPandas()[["a", "b"]].astype(float)
    frame = frame.fillna(frame.mean())
    want = ((frame - frame.mean()) / frame.std()).to_numpy()
    assert np.allclose([r.features.toArray() for r in prepared.orderBy("id").collect()], want)


def test_rows_dealt_once_serve_the_search_and_the_refit(spark, tmp_path):
    """The plan of the rows runs once; equal and missing keys stay; the predictions are those of rows dealt by the search itself."""
    ran = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            ran.add(batch.num_rows)
            yield batch

    data = [(i // 2 if i % 9 else None, float(i % 7), float(i % 7) * 3 + i % 2) for i in range(90)]
    plain = spark.createDataFrame(data, "id int, x double, y double")
    line = {"line": Pipeline(stages=[*models.feature_stages(["x"]), models.LinearRegression(featuresCol="features", labelCol="y", solver="normal")])}
    dealt = models.deal_rows(plain.mapInArrow(counted, plain.schema), ["id"], f"{tmp_path}/rows")
    told = models.cross_predictions(dealt, "y", ["id"], line, f"{tmp_path}/p", dealt=True)
    model = models.refit_and_keep(line["line"], dealt, f"{tmp_path}/m")
    assert models.score(model, dealt).count() == 90 and ran.value == 90
    assert not (tmp_path / "p-rows").exists()
    own = models.cross_predictions(plain, "y", ["id"], line, f"{tmp_path}/q")
    digits = lambda df: rows_of(df, "candidate", "fold", "id", "label", F.round("prediction", 6))
    assert digits(told) == digits(own) and told.count() == 90


def test_ml_refit_writes_its_rows_once(spark, tmp_path):
    """One table of rows by fold below the checkpoint folder, which the search, the refit and the scores read."""
    from pathlib import Path

    from formline.plans import star
    from formline.session import checkpoint_dir

    orders = [(k, k % 5, "O" if k % 4 == 0 else "F", 100.0 * (k % 6) + k) for k in range(1, 61)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(k, float(k % 6 + n), 100.0 * (k % 6), 0.05) for k in range(1, 61) for n in range(k % 3 + 1)]
    spark.createDataFrame(lines, "l_orderkey long, l_quantity double, l_extendedprice double, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, 10.0 * k) for k in range(5)], "c_custkey long, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    root = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = set(root.glob("training-*"))
    found = star.QUERIES["ml_refit"](spark, str(tmp_path))
    made = sorted(p.name for t in set(root.glob("training-*")) - before for p in t.iterdir())
    assert made == ["model", "predictions", "rows"]
    assert found.count() == 45 and found.filter("same").count() == 45
