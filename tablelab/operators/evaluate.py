"""Quality measures computed from counts and running totals, never from pairs or collected groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import default_slices, row_positions, running_totals


def pair_wins(df: DataFrame, keys: Sequence[str], score: str, positive: str) -> DataFrame:
    """Per key, how many (positive, negative) pairs the positive wins, ties and all pairs.

    Rows are first counted per (key, score). The running number of negatives below a score then
    gives the wins of all positives at that score at once.
    """
    p = F.col(positive).cast("boolean")
    counts = df.groupBy(*keys, score).agg(F.count_if(p).alias("__p"), F.count_if(~p).alias("__n"))
    ranked = running_totals(counts, keys, [score], {"__upto": F.col("__n")}, staged=True)
    grouped = ranked.groupBy(*keys) if keys else ranked.groupBy()
    return grouped.agg(
        F.sum(F.col("__p") * (F.col("__upto") - F.col("__n"))).alias("correct"),
        F.sum(F.col("__p") * F.col("__n")).alias("ties"),
        F.sum("__p").alias("positives"),
        F.sum("__n").alias("negatives"),
    ).filter("positives > 0 and negatives > 0").withColumn("total", F.col("positives") * F.col("negatives"))


def user_auc(df: DataFrame, user: str, score: str, positive: str) -> DataFrame:
    """Share of a user's pairs where the positive scores strictly higher; users lacking a side drop out."""
    return pair_wins(df, [user], score, positive).select(user, (F.col("correct") / F.col("total")).alias("auc"))


def mean_user_auc(df: DataFrame, user: str, score: str, positive: str) -> DataFrame:
    return user_auc(df, user, score, positive).agg(F.avg("auc").alias("mean_auc"), F.count("*").alias("users"))


def binary_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve of a whole table, ties counted half."""
    w = pair_wins(df, [], score, label)
    return w.select(((F.col("correct") + F.col("ties") / 2) / F.col("total")).alias("auc"))


def log_loss(df: DataFrame, probability: str, label: str, eps: float = 1e-15) -> DataFrame:
    p = F.least(F.greatest(F.col(probability), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label).cast("double")
    return df.agg((-F.avg(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("logloss"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Long confusion matrix: label, prediction, n."""
    return df.groupBy(label, prediction).agg(F.count("*").alias("n"))


def class_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy, weighted precision, weighted recall and weighted F1 from the confusion counts."""
    counts = confusion(df, label, prediction)
    hits = F.sum(F.when(F.col("side") == "both", F.col("n")).otherwise(0))
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(F.col(label).cast("double").alias("c"), F.lit("label").alias("side"), "n"),
                F.struct(F.col(prediction).cast("double").alias("c"), F.lit("guess").alias("side"), "n"),
                F.struct(
                    F.col(label).cast("double").alias("c"),
                    F.lit("both").alias("side"),
                    F.when(F.col(label).cast("double") == F.col(prediction).cast("double"), F.col("n")).otherwise(0).alias("n"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    per = sides.groupBy("c").agg(
        hits.alias("tp"),
        F.sum(F.when(F.col("side") == "label", F.col("n")).otherwise(0)).alias("actual"),
        F.sum(F.when(F.col("side") == "guess", F.col("n")).otherwise(0)).alias("guessed"),
    )
    precision = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("guessed").cast("double")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("actual").cast("double")), F.lit(0.0))
    per = per.withColumns({"p": precision, "r": recall})
    f1 = F.coalesce(F.try_divide(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), F.lit(0.0))
    n = F.sum("actual")
    return per.agg(
        (F.sum("tp") / n).alias("accuracy"),
        (F.sum(F.col("p") * F.col("actual")) / n).alias("weighted_precision"),
        (F.sum(F.col("r") * F.col("actual")) / n).alias("weighted_recall"),
        (F.sum(f1 * F.col("actual")) / n).alias("f1"),
    )


def stratified_folds(df: DataFrame, label: str, key: str, hashed: Column, k: int, modulus: int, out: str = "fold") -> DataFrame:
    """Fold 0..k-1 per row, every label spread evenly over the folds (sizes differ by at most one).

    Rows of a label are numbered in the order of ``hashed`` (evenly spread below ``modulus``), then
    cut into k runs. Labels are few and large, so the numbering is sliced.
    """
    keyed = df.withColumn("__h", hashed)
    n = default_slices(df)
    cuts = {"__h": [modulus * i / n for i in range(1, n)], key: []}
    ranked = row_positions(keyed, [label], ["__h", key], "__pos", cuts=cuts)
    sizes = df.groupBy(label).agg(F.count("*").alias("__size"))
    small, extra = F.floor(F.col("__size") / k), F.col("__size") % k
    head = extra * (small + 1)
    fold = F.when(F.col("__pos") <= head, F.floor((F.col("__pos") - 1) / (small + 1))).otherwise(
        extra + F.floor(F.try_divide((F.col("__pos") - 1 - head).cast("double"), small.cast("double")))
    )
    return ranked.join(sizes, label).withColumn(out, fold.cast("int")).drop("__h", "__pos", "__size")


def cluster_profile(df: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    return df.groupBy(cluster, label).agg(F.count("*").alias("n")).orderBy(cluster, F.col("n").desc(), label)


def cluster_entropy(df: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """Size-weighted mean over clusters of the label entropy (natural logarithm)."""
    cells = df.groupBy(cluster, label).agg(F.count("*").alias("n"))
    per = cells.groupBy(cluster).agg(
        F.sum("n").alias("size"), F.sum(F.col("n") * F.ln(F.col("n").cast("double"))).alias("nlogn")
    )
    # size * H = size * ln(size) - sum(n * ln(n))
    weighted = F.col("size") * F.ln(F.col("size").cast("double")) - F.col("nlogn")
    return per.agg((F.sum(weighted) / F.sum("size")).alias("entropy"))
