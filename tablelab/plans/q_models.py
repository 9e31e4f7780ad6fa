"""Registered queries: clustering, anomalies, features, model quality, classifiers."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler, VectorIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..functions.scalars import hash_bucket
from ..operators import anomaly as A
from ..operators import evaluate as V
from ..operators import features as P
from ..operators import models as M
from ..operators import penalty_path, sampling
from ..operators import text as T
from ..operators.relational import count_by, pivot_counts
from ..operators.text import style_features
from ..session import cached, stage
from . import fixtures as X
from .fixtures import load
from .q_text import _vocab as vocabulary_frame

QUERIES: dict = {}
ORACLES: dict = {}


def register(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


# --- clustering with fixed centres -----------------------------------------------------------------

# Test centres on the scaled traffic columns.
CENTRES = [[0.5, 0.5, 0.2, 0.5], [2.5, 2.0, 1.0, 1.0], [4.5, 4.0, 1.8, 1.5], [1.0, 3.0, 0.5, 1.8], [4.0, 1.0, 1.5, 0.3], [3.0, 2.5, 0.1, 1.9]]
SCALE = [10.0, 20_000.0, 0.05, 0.04]


def _assigned(spark, sf):
    t = X.traffic(spark, sf)
    scaled = [F.col(c) / s for c, s in zip(X.TRAFFIC_NUMERIC, SCALE)]
    return A.assign_nearest(t, scaled, CENTRES)


_DIST = "least(" + ", ".join(
    "{'d': " + " + ".join(f"pow({c} / {s}::DOUBLE - {v}::DOUBLE, 2)" for c, s, v in zip(X.TRAFFIC_NUMERIC, SCALE, centre)) + f", 'c': {i}}}"
    for i, centre in enumerate(CENTRES)
) + ")"
_TRAFFIC = f"""traffic AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus, o_orderpriority, l_returnflag AS label
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey), best AS (SELECT *, {_DIST} AS b FROM traffic),
assigned AS (SELECT *, CAST(b.c AS INTEGER) AS cluster, b.d AS sqdist FROM best)"""


@register("SELECT l_returnflag AS label, count(*) AS n FROM lineitem GROUP BY 1")
def label_counts(spark, sf):
    l = load(spark, sf, "lineitem").select(F.col("l_returnflag").alias("label"))
    return count_by(l, "label").orderBy(F.col("n").desc())


@register(f"WITH {_TRAFFIC} SELECT l_quantity, l_extendedprice, cluster, round(sqdist, 6) AS sqdist FROM assigned")
def nearest_centroid(spark, sf):
    return _assigned(spark, sf).select("l_quantity", "l_extendedprice", "cluster", F.round("sqdist", 6).alias("sqdist"))


@register(f"WITH {_TRAFFIC} SELECT cluster, label, count(*) AS n FROM assigned GROUP BY 1, 2")
def cluster_label_profile(spark, sf):
    return V.cluster_profile(_assigned(spark, sf))


@register(f"""WITH {_TRAFFIC}, c AS (SELECT cluster, label, count(*) AS n FROM assigned GROUP BY 1, 2),
p AS (SELECT cluster, n, n / sum(n) OVER (PARTITION BY cluster) AS p, sum(n) OVER () AS total FROM c)
SELECT round(sum(-n / total * ln(p)), 6) AS entropy FROM p""")
def cluster_entropy(spark, sf):
    return V.cluster_entropy(_assigned(spark, sf)).select(F.round("entropy", 6).alias("entropy"))


@register(f"""WITH {_TRAFFIC} SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus, o_orderpriority, label FROM assigned
  WHERE sqdist >= (SELECT min(sqdist) FROM (SELECT sqdist FROM assigned ORDER BY 1 DESC LIMIT 100))""")
def anomalies_top(spark, sf):
    return A.anomalies(_assigned(spark, sf), [*X.TRAFFIC_NUMERIC, *X.TRAFFIC_STRINGS, "label"])


# --- feature transforms ----------------------------------------------------------------------------


@register("""SELECT l_orderkey, round(l_quantity / (SELECT stddev_samp(l_quantity) FROM lineitem), 6) AS l_quantity,
  round(l_tax / (SELECT stddev_samp(l_tax) FROM lineitem), 6) AS l_tax FROM lineitem""")
def std_scaled(spark, sf):
    s = P.scale_by_stdev(load(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_tax"), ["l_quantity", "l_tax"])
    return s.withColumns({c: F.round(c, 6) for c in ("l_quantity", "l_tax")})


_TYPES = ["ECONOMY", "STANDARD", "PROMO", "SMALL", "MEDIUM", "LARGE"]


@register("""SELECT p_partkey, list_position(['ECONOMY', 'STANDARD', 'PROMO', 'SMALL', 'MEDIUM', 'LARGE'], p_type) - 1 AS "type",
  CASE WHEN p_size <= 10 THEN 0 WHEN p_size <= 30 THEN 1 ELSE -1 END AS size_class FROM part""".replace(
    "list_position(['ECONOMY', 'STANDARD', 'PROMO', 'SMALL', 'MEDIUM', 'LARGE'], p_type) - 1",
    "CAST(coalesce(list_position(['ECONOMY', 'STANDARD', 'PROMO', 'SMALL', 'MEDIUM', 'LARGE'], p_type), 0) - 1 AS INTEGER)",
))
def unonehot(spark, sf):
    """Two groups of 0/1 columns folded back into one index column each."""
    p = load(spark, sf, "part")
    hot = {f"type_{i}": (F.col("p_type") == v).cast("double") for i, v in enumerate(_TYPES)}
    hot |= {"size_0": (F.col("p_size") <= 10).cast("double"), "size_1": F.col("p_size").between(11, 30).cast("double")}
    groups = {"type": [f"type_{i}" for i in range(len(_TYPES))], "size_class": ["size_0", "size_1"]}
    return P.merge_one_hot(p.select("p_partkey", *[c.alias(n) for n, c in hot.items()]), groups)


_INDEX = """idx AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS i FROM part GROUP BY 1)"""


@register(f"""WITH {_INDEX} SELECT p_partkey, p_type, CAST(i AS INTEGER) AS type_index FROM part JOIN idx USING (p_type)""")
def string_index(spark, sf):
    return P.frequency_index(load(spark, sf, "part").select("p_partkey", "p_type"), "p_type", "type_index")


@register(f"""WITH {_INDEX} SELECT p_partkey, array_to_string(list_transform(range(0, 5), lambda k: CASE WHEN k = i THEN '1' ELSE '0' END), '') AS hot
  FROM part JOIN idx USING (p_type)""")
def one_hot_sql(spark, sf):
    p = P.frequency_index(load(spark, sf, "part").select("p_partkey", "p_type"), "p_type", "i")
    text = F.array_join(F.transform(P.one_hot(F.col("i"), 6), lambda v: v.cast("int").cast("string")), "")
    return p.select("p_partkey", text.alias("hot"))


# A fixed 4 x 3 projection; ``projection_matrix`` draws one from a seed.
_MATRIX = [[0.6, 0.0, 0.8], [0.0, 1.0, 0.0], [-0.8, 0.6, 0.0], [0.36, 0.48, 0.8]]
_PROJ = ", ".join(
    "round(" + " + ".join(f"{c} * {row[j]}::DOUBLE" for c, row in zip(X.TRAFFIC_NUMERIC, _MATRIX)) + f", 6) AS p{j}" for j in range(3)
)


@register(f"SELECT l_orderkey, l_linenumber, {_PROJ} FROM lineitem")
def random_projection(spark, sf):
    p = P.project(load(spark, sf, "lineitem"), X.TRAFFIC_NUMERIC, _MATRIX, ["p0", "p1", "p2"])
    return p.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in ("p0", "p1", "p2")])


# --- quality measures ------------------------------------------------------------------------------

_RULE = """scored AS (SELECT doc_id, toxic, quality, n_chars % 101 AS s, CAST(n_chars % 7 < 3 AS INTEGER) AS guess
  FROM labels JOIN documents USING (doc_id))"""


def _scored(spark, sf):
    """Labels next to a fixed rule on the text length, standing in for a model's output."""
    d = load(spark, sf, "documents").select("doc_id", "n_chars")
    j = load(spark, sf, "labels").join(d, "doc_id")
    return j.withColumns({"s": F.col("n_chars") % 101, "guess": (F.col("n_chars") % 7 < 3).cast("int")})


@register(f"""WITH {_RULE} SELECT toxic, count(*) FILTER (guess = 0) AS "0", count(*) FILTER (guess = 1) AS "1" FROM scored GROUP BY 1""")
def confusion_pivot(spark, sf):
    return pivot_counts(_scored(spark, sf), "toxic", "guess", [0, 1])


@register(f"""WITH {_RULE} SELECT toxic, guess, count(*) AS n FROM scored GROUP BY 1, 2""")
def confusion_long(spark, sf):
    return V.confusion(_scored(spark, sf), "toxic", "guess")


@register(f"""WITH {_RULE}, c AS (SELECT k, count(*) FILTER (toxic = k AND guess = k) AS tp, count(*) FILTER (toxic = k) AS a,
  count(*) FILTER (guess = k) AS g FROM scored, (VALUES (0), (1)) v(k) GROUP BY 1), m AS (SELECT *, tp / nullif(g, 0) AS p, tp / nullif(a, 0) AS r FROM c)
SELECT round(sum(tp) / sum(a), 6) AS accuracy, round(sum(p * a) / sum(a), 6) AS weighted_precision, round(sum(r * a) / sum(a), 6) AS weighted_recall,
  round(sum(2 * p * r / (p + r) * a) / sum(a), 6) AS f1 FROM m""")
def class_metrics(spark, sf):
    m = V.class_metrics(_scored(spark, sf), "toxic", "guess")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@register(f"""WITH {_RULE} SELECT round(avg(CASE WHEN p.s > n.s THEN 1.0 WHEN p.s = n.s THEN 0.5 ELSE 0.0 END), 6) AS auc
  FROM (SELECT s FROM scored WHERE toxic = 1) p, (SELECT s FROM scored WHERE toxic = 0) n""")
def binary_auc(spark, sf):
    return V.binary_auc(_scored(spark, sf), "s", "toxic").select(F.round("auc", 6).alias("auc"))


@register(f"""WITH {_RULE} SELECT round(-avg(CASE WHEN toxic = 1 THEN ln((s + 1) / 103.0) ELSE ln(1 - (s + 1) / 103.0) END), 6) AS logloss FROM scored""")
def log_loss(spark, sf):
    s = _scored(spark, sf).withColumn("p", (F.col("s") + 1) / 103.0)
    return V.log_loss(s, "p", "toxic").select(F.round("logloss", 6).alias("logloss"))


@register(f"""SELECT doc_id, toxic, CAST(ntile(10) OVER (PARTITION BY toxic
  ORDER BY {X.hash_sql('doc_id * 7919::BIGINT + 3 * 104729::BIGINT', 1_000_003)}, doc_id) - 1
  AS INTEGER) AS fold FROM labels""")
def stratified_folds(spark, sf):
    l = load(spark, sf, "labels").select("doc_id", "toxic")
    return M.with_folds(l, "toxic", "doc_id", 10)


@register(f"""SELECT CASE WHEN h < 800 THEN 'train' WHEN h < 900 THEN 'valid' ELSE 'test' END AS part, count(*) AS n FROM
  (SELECT {X.hash_sql('o_orderkey * 7919::BIGINT + 5 * 104729::BIGINT', 1_000)} AS h FROM orders) GROUP BY 1""")
def hashed_split(spark, sf):
    o = load(spark, sf, "orders")
    parts = sampling.hashed_split(o, [(F.col("o_orderkey"), 7919)], [0.8, 0.1, 0.1], 5)
    named = [p.select(F.lit(n).alias("part")) for n, p in zip(("train", "valid", "test"), parts)]
    return count_by(named[0].union(named[1]).union(named[2]), "part")


@register(f"""SELECT o_custkey FROM (SELECT DISTINCT o_custkey, {X.hash_sql('o_custkey * 7919::BIGINT + 2222 * 104729::BIGINT', 1_000_003)} AS h FROM orders)
  ORDER BY h, o_custkey LIMIT 200""")
def key_sample(spark, sf):
    return sampling.key_sample(load(spark, sf, "orders"), "o_custkey", 200)


# --- stochastic or iterative: rows only ------------------------------------------------------------


@register()
def bernoulli_sample(spark, sf):
    return sampling.bernoulli(load(spark, sf, "lineitem"), 0.05, 7)


@register()
def random_draws(spark, sf):
    return sampling.random_draws(load(spark, sf, "customer").select("c_custkey"), 7)


@register()
def random_split_sizes(spark, sf):
    parts = sampling.random_split(load(spark, sf, "orders"), [0.8, 0.1, 0.1], 7)
    counts = [p.agg(F.count("*").alias("n")).withColumn("part", F.lit(i)) for i, p in enumerate(parts)]
    return counts[0].union(counts[1]).union(counts[2])


@register()
def partition_sampler(spark, sf):
    """About as many unseen items per user as positives; the draw needs no per-partition generator state."""
    from ..operators.recommend import build_ratings, hash_split, negative_items

    r = build_ratings(X.raw_listens(spark, sf), X.aliases(spark, sf))
    neg = negative_items(hash_split(r)[1], r, seed=99)
    return count_by(neg, "user")


@register()
def kmeans_fit(spark, sf):
    """Mixed columns encoded, scaled and clustered; cluster sizes by label."""
    return V.cluster_profile(A.cluster_bounded(X.traffic(spark, sf), X.TRAFFIC_NUMERIC, X.TRAFFIC_STRINGS, k=180, iterations=40))


@register()
def kmeans_default(spark, sf):
    """Numeric columns only, two clusters, no scaling."""
    t = X.traffic(spark, sf)
    model = A.fit_clusters(t, X.TRAFFIC_NUMERIC, k=2, scale=False)
    return V.cluster_profile(model.transform(t))


@register()
def cluster_centres(spark, sf):
    model = A.fit_clusters(X.traffic(spark, sf), X.TRAFFIC_NUMERIC, k=5, iterations=40, tol=1e-5)
    return A.centres_table(spark, model).withColumn("centre", F.array_join(F.col("centre").cast("array<string>"), ","))


@register()
def geo_cluster_months(spark, sf):
    """Trip positions in five standardised clusters, counted by month."""
    e = X.trips(spark, sf)
    from ..functions.calendar import with_calendar

    return A.cluster_months(with_calendar(e, "Date_Time"), ["Lat", "Lon"], "month", 5)


@register()
def k_sweep(spark, sf):
    return A.score_k(X.traffic(spark, sf), X.TRAFFIC_NUMERIC, X.TRAFFIC_STRINGS, range(60, 271, 30), silhouette=True)


@register()
def kmeans_anomalies(spark, sf):
    """Rows at least as far from their fitted centre as the 100th farthest."""
    placed = A.cluster_bounded(X.traffic(spark, sf), X.TRAFFIC_NUMERIC, X.TRAFFIC_STRINGS, k=180, iterations=40)
    return A.anomalies(stage(placed.drop("features"), "distances"), [*X.TRAFFIC_NUMERIC, *X.TRAFFIC_STRINGS, "label"])


def _digits(spark, sf):
    d = M.with_vector(X.digits(spark, sf), "pixels")
    return d.filter(~F.col("valid")), d.filter("valid")


def _names(n: int = 64) -> list[str]:
    return [f"pixel_{i:02d}" for i in range(n)]


@register()
def tree_grid(spark, sf):
    train, _ = _digits(spark, sf)
    base = M.decision_tree()
    maps = M.param_grid(base, {"impurity": ["gini", "entropy"], "maxDepth": [2, 6]})
    _, board = M.search_split(train.select("label", "features"), base, maps, MulticlassClassificationEvaluator(metricName="accuracy"))
    return board


@register()
def forest_fit(spark, sf):
    train, test = _digits(spark, sf)
    model = M.random_forest(impurity="entropy", maxDepth=8, maxBins=32, numTrees=10, seed=1).fit(train)
    return M.predictions(model, test, "id")


@register()
def feature_importance(spark, sf):
    train, _ = _digits(spark, sf)
    model = M.random_forest(numTrees=10, seed=1).fit(train)
    return M.importances(spark, model, _names(), 10)


@register()
def named_scores(spark, sf):
    train, _ = _digits(spark, sf)
    return M.importances(spark, M.decision_tree(maxDepth=5, seed=1).fit(train), _names(), 10)


@register()
def model_description(spark, sf):
    train, _ = _digits(spark, sf)
    return M.describe_model(spark, M.decision_tree(maxDepth=3, seed=1).fit(train))


@register()
def pair_zip(spark, sf):
    """Settings zipped with their scores."""
    train, _ = _digits(spark, sf)
    base = M.decision_tree()
    maps = M.param_grid(base, {"maxDepth": [2, 5]})
    _, board = M.search_split(train.select("label", "features"), base, maps, MulticlassClassificationEvaluator(metricName="accuracy"), ratio=0.8)
    return board


@register()
def vector_indexed(spark, sf):
    """Columns with few values treated as categories before a tree is fitted."""
    p = load(spark, sf, "part").withColumn("label", (F.col("p_retailprice") > 1000).cast("double"))
    indexed = P.frequency_index(p, "p_type", "type_index")
    v = VectorAssembler(inputCols=["type_index", "p_size", "p_retailprice"], outputCol="features").transform(indexed)
    model = VectorIndexer(inputCol="features", outputCol="indexed", maxCategories=40, handleInvalid="keep").fit(v)
    return model.transform(v).select("p_partkey", F.col("indexed").cast("string").alias("indexed"))


@register()
def indexed_tree(spark, sf):
    """Category indexing and tree as one fitted chain of stages."""
    train, test = _digits(spark, sf)
    model = M.indexed_tree(M.decision_tree(maxDepth=6, seed=1)).fit(train)
    return M.predictions(model, test, "id")


@register()
def softmax_pixels(spark, sf):
    train, test = _digits(spark, sf)
    return M.predictions(M.softmax(iterations=20).fit(train), test, "id")


@register()
def mlp_pixels(spark, sf):
    train, test = _digits(spark, sf)
    scaled = [d.withColumn("features", array_to_vector(F.transform("pixels", lambda v: v / 255.0))) for d in (train, test)]
    return M.predictions(M.feed_forward(64, [100, 50], 10, epochs=20).fit(scaled[0]), scaled[1], "id")


def _doc_frame(spark, sf):
    """Style features of the labelled documents with both targets, of the others without, and their number; staged once."""
    c = X.comments(spark, sf)
    style = style_features(c, "id", "comment_text")
    cols = [x for x in style.columns if x != "id"]
    v = VectorAssembler(inputCols=cols, outputCol="raw").transform(style).join(c.select("id", "split", "toxic", "quality"), "id")
    v = stage(v.withColumns({"toxic": F.col("toxic").cast("double"), "quality": F.col("quality").cast("double")}), "docs")
    scaled = StandardScaler(inputCol="raw", outputCol="features").fit(v.filter("split = 'train'")).transform(v).drop("raw")
    return scaled.filter("split = 'train'"), scaled.filter("split = 'test'"), len(cols)


@register()
def assembled_features(spark, sf):
    df, _, _ = _doc_frame(spark, sf)
    return df.select("id", F.col("features").cast("string").alias("features"), "toxic")


@register()
def cached_fit(spark, sf):
    df, test, _ = _doc_frame(spark, sf)
    with cached(df):
        model = M.elastic_logistic("toxic", iterations=20).fit(df)
    return M.predictions(model, test, "id")


@register()
def gbt_fit(spark, sf):
    df, test, _ = _doc_frame(spark, sf)
    return M.predictions(M.boosted_trees("quality", trees=10, depth=4, rate=0.1, columns="0.5").fit(df), test, "id")


@register()
def logit_enet(spark, sf):
    df, test, _ = _doc_frame(spark, sf)
    return M.predictions(M.elastic_logistic("quality").fit(df), test, "id")


def _comment_matrix(spark, sf, terms):
    """Style columns and the most frequent terms of all documents, with both targets; stored."""
    docs, rows, _ = vocabulary_frame(spark, sf)
    total = load(spark, sf, "documents").agg(F.count("*").alias("n")).scalar()
    vocab = T.vocabulary(rows, "id", total, T.word_list(spark, sorted(set(T.ENGLISH_STOP_WORDS))), max_terms=terms)
    matrix = T.feature_matrix(T.style_features(docs, "id", "comment_text"), T.term_vectors(docs, rows, "id", vocab), "id")
    return stage(matrix.join(docs.select("id", "split", "toxic", "quality"), "id"), "matrix")


@register()
def ridge_path_cv(spark, sf):
    """Mean area under the curve of 50 penalties over 10 folds, on style columns and 400 terms."""
    df = _comment_matrix(spark, sf, 400)
    return penalty_path.cv_ridge(df.filter("split = 'train'"), df, "quality", "id", tolerance=1e-4)[1]


@register()
def ridge_path_scores(spark, sf):
    """One probability per target for every document without labels, each at the best of 50 penalties over 10 folds."""
    df = _comment_matrix(spark, sf, 400)
    train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
    scored = [penalty_path.cv_ridge(train, test, t, "id", tolerance=1e-4)[0].withColumnRenamed("probability", t) for t in ("toxic", "quality")]
    return scored[0].join(scored[1], "id")


@register()
def gaussian_nb(spark, sf):
    df, test, _ = _doc_frame(spark, sf)
    return M.predictions(M.gaussian_bayes("quality").fit(df), test, "id")


@register()
def mlp_fit(spark, sf):
    df, test, n = _doc_frame(spark, sf)
    return M.predictions(M.feed_forward(n, [10, 10, 10, 10], 2, "quality", epochs=50).fit(df), test, "id")


@register()
def fold_grid(spark, sf):
    """Grid over stratified folds with a leaderboard by AUC."""
    df, _, _ = _doc_frame(spark, sf)
    base = M.random_forest("quality", numTrees=5, seed=1)
    maps = M.param_grid(base, {"maxDepth": [2, 4]})
    auc = BinaryClassificationEvaluator(labelCol="quality", metricName="areaUnderROC")
    _, board = M.search_folds(M.with_folds(df, "quality", "id", 3), base, maps, auc, "fold", 3)
    return board


@register()
def multi_target_scores(spark, sf):
    """One probability per target for every document without labels, as a submission table."""
    df, test, _ = _doc_frame(spark, sf)
    return M.score_targets(df, test, "id", ["toxic", "quality"], M.elastic_logistic())


@register()
def auto_select(spark, sf):
    df, _, n = _doc_frame(spark, sf)
    _, board = M.auto_select(df, "quality", "id", n, folds=2)
    return board
