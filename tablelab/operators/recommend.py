"""Implicit-feedback recommendation: ratings, baselines, negatives, per-user AUC, factor models."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import product

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import after_first, before_first, hash_bucket, safe_int, split_fields
from ..session import release, stage
from .evaluate import mean_user_auc
from .ordered import row_positions, running_totals
from .relational import lookup_or_same
from .top_scores import best_items

Scorer = Callable[[DataFrame], DataFrame]


def parse_listens(lines: DataFrame) -> DataFrame:
    """``user item count`` text lines → typed columns."""
    parts = split_fields(F.col("value"), " ", "user", "item", "count")
    typed = lines.select(*parts).select(*[safe_int(F.col(c)).alias(c) for c in ("user", "item", "count")])
    return typed.dropna()


def parse_artists(lines: DataFrame) -> DataFrame:
    """``id<TAB>name``; rows without a name or with a malformed id are dropped."""
    v = F.col("value")
    parsed = lines.select(safe_int(before_first(v, "\t")).alias("id"), after_first(v, "\t").alias("name"))
    return parsed.filter("id is not null and name <> ''")


def parse_aliases(lines: DataFrame) -> DataFrame:
    """``bad<TAB>good``; rows with an empty first field are dropped."""
    parts = split_fields(F.col("value"), "\t", "bad_id", "good_id")
    return lines.select(*parts).select(*[safe_int(F.col(c)).alias(c) for c in ("bad_id", "good_id")]).dropna()


def build_ratings(listens: DataFrame, alias: DataFrame) -> DataFrame:
    """Canonical item ids, one row ``user, item, rating`` per pair."""
    canonical = lookup_or_same(listens, "item", alias, "bad_id", "good_id")
    return canonical.groupBy("user", "item").agg(F.sum("count").cast("double").alias("rating"))


def hash_split(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """About 70 % training and 30 % validation, by hashed pair."""
    valid = hash_bucket([(F.col("user"), 7919), (F.col("item"), 104_729)], 0, 10) >= 7
    return ratings.filter(~valid), ratings.filter(valid)


def history_names(ratings: DataFrame, names: DataFrame, user: int) -> DataFrame:
    """Names of the items one user has rated."""
    mine = ratings.filter(F.col("user") == user).select(F.col("item").alias("id")).distinct()
    return names.join(mine, "id", "left_semi")


def popularity_scorer(train: DataFrame) -> Scorer:
    """Score of an item = its total rating; 0 for items the training part lacks."""
    totals = train.groupBy("item").agg(F.sum("rating").alias("total"))

    def score(pairs: DataFrame) -> DataFrame:
        return pairs.join(totals, "item", "left").withColumn("score", F.coalesce("total", F.lit(0.0))).drop("total")

    return score


def als_scorer(model: ALSModel) -> Scorer:
    def score(pairs: DataFrame) -> DataFrame:
        return model.transform(pairs).withColumn("score", F.col("prediction").cast("double")).drop("prediction")

    return score


def negative_items(positives: DataFrame, items: DataFrame, seed: int = 17) -> DataFrame:
    """For each user as many items outside their positives as they have positives, duplicates allowed.

    Nothing is rejected and retried: a user with P positives out of M items has M - P others, and each
    positive row draws one of those by number. The r-th other item sits at position r + c, where c
    counts the positives whose own position minus rank is at most r. Those counts come from one
    running total over draws and positives. Users who own every item get no negatives.
    """
    numbered = row_positions(items.select("item").distinct(), [], ["item"], "idx").withColumn("idx", F.col("idx") - 1)
    numbered = stage(numbered, "items")
    m = numbered.count()
    pos = stage(positives.select("user", "item").distinct().join(numbered, "item"), "positives")
    ranked = row_positions(pos, ["user"], ["idx"], "rank")
    sizes = pos.groupBy("user").agg(F.count("*").alias("p"))
    gaps = ranked.select("user", (F.col("idx") - F.col("rank") + 1).alias("at"), F.lit(0).alias("draw"), "idx")
    free = F.lit(m) - F.col("p")
    drawn = pos.join(sizes, "user").filter(free > 0).select(
        "user",
        F.pmod(F.col("user").cast("bigint") * 31 + F.col("item").cast("bigint") * 7919 + seed * 104_729, free).alias("at"),
        F.lit(1).alias("draw"),
        "idx",
    )
    # Positives come before draws at the same number; the item behind each row makes rows distinct.
    counted = running_totals(gaps.union(drawn), ["user"], ["at", "draw", "idx"], {"below": 1 - F.col("draw")}, staged=True)
    hits = counted.filter("draw = 1").select("user", (F.col("at") + F.col("below")).alias("idx"))
    return hits.join(numbered, "idx").select("user", "item")


def auc_of_scorer(positives: DataFrame, negatives: DataFrame, scorer: Scorer) -> DataFrame:
    """Mean over users of the share of correctly ordered (positive, negative) pairs."""
    both = positives.select("user", "item", F.lit(True).alias("positive")).union(
        negatives.select("user", "item", F.lit(False).alias("positive"))
    )
    return mean_user_auc(scorer(both), "user", "score", "positive")


def fit_als(train: DataFrame, rank: int = 10, iterations: int = 5, reg: float = 0.01, alpha: float = 1.0, seed: int = 7) -> ALSModel:
    als = ALS(
        rank=rank, maxIter=iterations, regParam=reg, alpha=alpha, implicitPrefs=True, seed=seed,
        userCol="user", itemCol="item", ratingCol="rating", coldStartStrategy="drop",
    )
    return als.fit(train)


def top_items(model: ALSModel, users: DataFrame, k: int = 5) -> DataFrame:
    """k best items per user, one row each: ``user, place, item, score, scored``.

    Items are offered by falling length of their factors until no other one can reach the k-th score; ``scored`` is
    the number of items the user was compared with. Users the model does not know have no rows.
    """
    asked = users.select(F.col("user").alias("id")).distinct()
    best = best_items(model.userFactors.join(asked, "id"), model.itemFactors, k)
    return best.select("user", F.posexplode(F.arrays_zip("items", "scores")).alias("place", "r"), "scored").select(
        "user", (F.col("place") + 1).alias("place"), F.col("r.items").alias("item"), F.col("r.scores").cast("float").alias("score"), "scored"
    )


def named_lists(recs: DataFrame, names: DataFrame) -> DataFrame:
    """One text per user: recommended names in order, comma separated."""
    j = recs.join(names, recs.item == names.id)
    ordered = F.sort_array(F.collect_list(F.struct("place", "name")))
    return j.groupBy("user").agg(F.array_join(F.transform(ordered, lambda s: s["name"]), ", ").alias("names"))


def als_grid(
    train: DataFrame,
    valid: DataFrame,
    negatives: DataFrame,
    ranks: Sequence[int] = (10, 50),
    regs: Sequence[float] = (1.0,),
    alphas: Sequence[float] = (1.0, 40.0),
    iterations: int = 10,
) -> DataFrame:
    """Leaderboard of factor-model settings by mean per-user AUC, best first.

    Every setting reads ``train`` and ``valid`` again, so hand over stored tables or parts of them. What a fit has shuffled
    and kept is let go of before the next one.
    """
    rows, spark = [], train.sparkSession
    negatives = stage(negatives, "negatives")
    release(spark)
    for rank, reg, alpha in product(ranks, regs, alphas):
        model = fit_als(train, rank, iterations, reg, alpha)
        auc = auc_of_scorer(valid, negatives, als_scorer(model)).first()["mean_auc"]
        rows.append((rank, float(reg), float(alpha), auc))
        del model
        release(spark)
    release(spark, negatives)
    return spark.createDataFrame(rows, "rank int, reg double, alpha double, mean_auc double").orderBy(F.col("mean_auc").desc())
