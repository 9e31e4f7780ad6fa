"""Best items by bounds against all products."""

from __future__ import annotations

import numpy as np
import pytest

from tablelab.operators import recommend, top_scores


def _frame(spark, x):
    return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id int, features array<float>").repartition(4)


@pytest.mark.parametrize("chunk_bytes", [top_scores.CHUNK_BYTES, 40_000])
def test_lists_equal_all_products(spark, chunk_bytes):
    draw = np.random.default_rng(1)
    v = (draw.normal(size=(3000, 5)) * draw.pareto(2.0, size=(3000, 1))).astype("float32")
    v[100:200] = v[100]  # equal scores go by id
    u = draw.normal(size=(60, 5)).astype("float32")
    u[3] = 0
    found = {r["user"]: r for r in top_scores.best_items(_frame(spark, u), _frame(spark, v), 5, chunk_bytes).collect()}
    scores = u.astype(float) @ v.astype(float).T
    assert len(found) == 60
    for i in range(60):
        order = np.lexsort((np.arange(3000), -scores[i]))[:5]
        assert np.allclose(found[i]["scores"], scores[i][order])
        assert found[i]["items"] == order.tolist()
    assert sum(r["scored"] for r in found.values()) < 0.7 * 60 * 3000


def test_few_items_negative_scores_and_no_items(spark):
    u, v = np.ones((2, 2), dtype="float32"), -np.ones((3, 2), dtype="float32")
    for row in top_scores.best_items(_frame(spark, u), _frame(spark, v), 5).collect():
        assert row["items"] == [0, 1, 2] and row["scores"] == [-2.0] * 3
    empty = top_scores.best_items(_frame(spark, u), _frame(spark, v).limit(0), 5).collect()
    assert [r["items"] for r in empty] == [[], []]


def test_model_lists_equal_those_of_the_library(spark):
    draw = np.random.default_rng(2)
    rows = [(int(a), int(b), float(c)) for a, b, c in zip(draw.integers(0, 40, 600), draw.integers(0, 90, 600), draw.integers(1, 9, 600))]
    ratings = spark.createDataFrame(rows, "user int, item int, rating double").dropDuplicates(["user", "item"])
    model = recommend.fit_als(ratings, rank=4, iterations=2)
    ours = {(r["user"], r["place"]): (r["item"], r["score"]) for r in recommend.top_items(model, ratings, 5).collect()}
    theirs = {(r["user"], i + 1): (x["item"], x["rating"]) for r in model.recommendForUserSubset(ratings, 5).collect() for i, x in enumerate(r["recommendations"])}
    assert ours.keys() == theirs.keys()
    assert all(abs(ours[at][1] - theirs[at][1]) < 1e-5 for at in ours)
    assert sum(ours[at][0] == theirs[at][0] for at in ours) > 0.99 * len(ours)


def test_a_pass_sorts_few_products_and_holds_few_at_a_time(monkeypatch):
    import pandas as pd

    draw = np.random.default_rng(3)
    v, u = draw.normal(size=(4096, 8)), draw.normal(size=(3000, 8))
    order = np.argsort(-np.sqrt((v * v).sum(axis=1)))
    lengths = np.sqrt((v[order] ** 2).sum(axis=1))
    chunk = type("Sent", (), {"value": (order.astype("int32"), v[order], lengths[:: top_scores.BLOCK_ITEMS])})
    batch = pd.DataFrame({"user": range(3000), "u": list(u), "items": [[]] * 3000, "scores": [[]] * 3000, "scored": 0, "finished": False})
    sizes, plain = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys, **o: (sizes.append(np.size(keys[0])), plain(keys, **o))[1])
    out = next(top_scores._pass(chunk, 5)(iter([batch])))
    monkeypatch.undo()
    assert max(sizes) <= 16 * top_scores.GROUP_USERS  # 3,000 users x 517 when whole blocks were sorted
    scores = u @ v.T
    for i in range(0, 3000, 97):
        assert out["items"][i].tolist() == np.argsort(-scores[i])[:5].tolist()
