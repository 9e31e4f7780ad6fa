import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tablelab.operators import penalty_path


def frame(spark, n=240, p=5, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p)) * np.array([1.0, 10.0, 0.1, 3.0, 1.0]) + 2.0
    x[:, 4] = 7.0  # no deviation
    y = (x[:, 0] + 0.2 * x[:, 1] - 5 * x[:, 2] + rng.normal(size=n) > -7.6).astype(float)
    return spark.createDataFrame([(i, float(v), Vectors.dense(r)) for i, (v, r) in enumerate(zip(y, x))], ["id", "label", "features"])


def test_path_equals_direct_fits(spark):
    df = frame(spark)
    rows = penalty_path.folded_rows(df, "label", "id", "features", 3)
    path = penalty_path.fit_path(rows, 3, [0.5, 0.005], tolerance=1e-6)
    folded = penalty_path.with_folds(df.withColumn("y", F.col("label")), "y", "id", 3).cache()
    for f in (0, 2, 3):
        part = folded.where(F.col("fold") != f)
        for i, penalty in enumerate(path.penalties):
            direct = LogisticRegression(regParam=penalty, elasticNetParam=0.0, tol=1e-12, maxIter=500).fit(part)
            assert path.coefficients[f, i] == pytest.approx(direct.coefficients.toArray(), rel=1e-3, abs=1e-5)
            assert path.intercepts[f, i] == pytest.approx(direct.intercept, rel=1e-3, abs=1e-4)


def test_areas_of_the_path_count_pairs_of_rows_left_out(spark):
    df = frame(spark, n=90)
    rows = penalty_path.folded_rows(df, "label", "id", "features", 3)
    path = penalty_path.fit_path(rows, 3, n_penalties=4)
    assert len(path.penalties) == 4 and path.penalties == sorted(path.penalties, reverse=True)
    got = {r["penalty_no"]: r for r in penalty_path.path_scores(rows, path).collect()}
    held = [(r["fold"], r["y"], np.asarray(r["x"])) for r in rows.collect()]
    for i in range(4):
        areas = []
        for f in range(3):
            scores = [(y, x @ path.coefficients[f, i] + path.intercepts[f, i]) for g, y, x in held if g == f]
            up, down = [s for y, s in scores if y], [s for y, s in scores if not y]
            areas.append(np.mean([(a > b) + (a == b) / 2 for a in up for b in down]))
        assert got[i]["folds"] == 3 and got[i]["auc"] == pytest.approx(np.mean(areas))


def test_all_asked_rows_are_scored_and_bad_input_is_refused(spark):
    df = frame(spark, n=60)
    some = df.withColumn("label", F.when(F.col("id") % 4 != 0, F.col("label")))
    scored, board = penalty_path.cv_ridge(some, df.drop("label"), "label", "id", folds=3, n_penalties=3)
    assert scored.where("probability between 0 and 1").count() == 60 and board.count() == 3
    rows = penalty_path.folded_rows(df.where("label = 1"), "label", "id", "features", 3)
    with pytest.raises(ValueError):
        penalty_path.fit_path(rows, 3)
    with pytest.raises(ValueError):
        penalty_path.fit_path(rows.limit(0), 3)
