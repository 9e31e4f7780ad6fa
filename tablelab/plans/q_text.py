"""Registered queries: text."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import textexpr as E
from ..operators import text as T
from ..operators.relational import keep_listed, weighted_tally
from ..session import stage
from . import fixtures as X
from .fixtures import load

QUERIES: dict = {}
ORACLES: dict = {}


def register(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def _rows(spark, sf):
    return T.token_rows(X.comments(spark, sf), "id", "comment_text")


def _stop(spark, sf, counts):
    return T.stop_words(counts, [T.word_list(spark, T.ENGLISH_STOP_WORDS)])


def _clean(spark, sf):
    rows = _rows(spark, sf)
    counts = stage(T.token_counts(rows), "counts")  # read three times below
    return T.clean_rows(rows, _stop(spark, sf, counts), counts)


_LISTED = ", ".join(f"('{w}')" for w in sorted(set(T.ENGLISH_STOP_WORDS)))
_TOKENS = f"""{X.COMMENTS_SQL},
pieces AS (SELECT id, regexp_split_to_array(
  regexp_replace(comment_text, '[^\\p{{L}}\\p{{M}}\\p{{Nl}}\\p{{Nd}}]', ' ', 'g'), '[^A-Za-z0-9_]+') AS ws FROM comments),
toks AS (SELECT id, lower(w) AS token, pos FROM (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS pos FROM pieces)
  WHERE length(w) > 2 AND NOT regexp_matches(w, '[0-9]')),
counts AS (SELECT token, count(*) AS n FROM toks GROUP BY 1)"""
_STOP = f"""stops AS (SELECT token FROM (SELECT token, rank() OVER (ORDER BY n DESC) AS r FROM counts) WHERE r <= 200
  UNION SELECT * FROM (VALUES {_LISTED}) v(token))"""
_CLEAN = f"""{_TOKENS}, {_STOP}, clean AS (SELECT id, pos, token FROM toks WHERE token NOT IN (SELECT token FROM stops)
  AND token NOT IN (SELECT token FROM counts WHERE n < 10))"""


@register(f"WITH {_TOKENS} SELECT id, pos, token FROM toks")
def tokens(spark, sf):
    return _rows(spark, sf).withColumn("pos", F.col("pos").cast("bigint"))


@register(f"WITH {_TOKENS}, {_STOP} SELECT token FROM stops")
def stop_words(spark, sf):
    return _stop(spark, sf, stage(T.token_counts(_rows(spark, sf)), "counts"))


@register(f"WITH {_TOKENS} SELECT token FROM counts WHERE n < 10")
def rare_words(spark, sf):
    return T.rare_words(T.token_counts(_rows(spark, sf)))


@register(f"WITH {_CLEAN} SELECT id, pos, token FROM clean")
def tokens_clean(spark, sf):
    return _clean(spark, sf).withColumn("pos", F.col("pos").cast("bigint"))


@register(f"WITH {_CLEAN} SELECT id, string_agg(token, ' ' ORDER BY pos) AS words FROM clean GROUP BY 1")
def tokens_regrouped(spark, sf):
    return T.regroup(_clean(spark, sf), "id").select("id", F.array_join("words", " ").alias("words"))


@register(f"WITH {_TOKENS} SELECT token, n * n AS n FROM counts")
def weighted_word_tally(spark, sf):
    return weighted_tally(_rows(spark, sf), "token")


@register(f"""WITH {_CLEAN} SELECT token, n FROM (SELECT token, count(*) AS n, rank() OVER (ORDER BY count(*) DESC) AS r
  FROM clean GROUP BY 1) WHERE r <= 10""")
def top_words(spark, sf):
    return T.top_words(_clean(spark, sf))


@register(f"""WITH {_CLEAN}, l AS (SELECT doc_id AS id, 'toxic' AS label FROM labels WHERE toxic = 1
  UNION ALL SELECT doc_id, 'quality' FROM labels WHERE quality = 1)
SELECT label, token, n FROM (SELECT label, token, count(*) AS n, rank() OVER (PARTITION BY label ORDER BY count(*) DESC) AS r
  FROM clean JOIN l USING (id) GROUP BY 1, 2) WHERE r <= 10""")
def top_words_per_label(spark, sf):
    labels = load(spark, sf, "labels").withColumnRenamed("doc_id", "id")
    return T.top_words_per_label(_clean(spark, sf), labels, "id", ["toxic", "quality"])


@register("""WITH s AS (SELECT CAST(sum(toxic) AS BIGINT) AS toxic, CAST(sum(quality) AS BIGINT) AS quality, count(*) AS total,
  count(*) FILTER (toxic = 0 AND quality = 0) AS clean FROM labels)
SELECT 'toxic' AS label, toxic AS n FROM s UNION ALL SELECT 'quality', quality FROM s UNION ALL SELECT 'total', total FROM s
UNION ALL SELECT 'clean', clean FROM s UNION ALL SELECT 'ok', total - toxic - quality FROM s""")
def label_frequency(spark, sf):
    return T.label_frequency(load(spark, sf, "labels"), ["toxic", "quality"])


def _count_sql(p: str) -> str:
    return f"len(regexp_extract_all(comment_text, '{p}'))"


_STYLE = f"""{X.COMMENTS_SQL}, c AS (SELECT id, length(comment_text) AS length, {_count_sql('[A-Z]')} AS use_cap,
  {_count_sql('[a-z]')} AS use_lower, {_count_sql('!')} AS use_exl, {_count_sql(' ')} AS use_space,
  {_count_sql('  ')} AS use_double_space, {_count_sql('[?]')} AS use_quest, {_count_sql('[[:punct:]]')} AS use_punt,
  {_count_sql('[0-9]')} AS use_digit, len(regexp_extract_all(comment_text, chr(10))) AS use_break,
  {_count_sql('[A-Za-z0-9_]+')} AS use_word, {_count_sql('[&@#$%*^]')} AS use_symbol,
  {_count_sql('[^A-Za-z0-9_]*' + chr(92) + 'b[A-Za-z0-9_]' + chr(92) + 'b[^A-Za-z0-9_]*')} AS use_char,
  {_count_sql(chr(92) + 'b[Ii]' + chr(92) + 'b')} AS use_i, {_count_sql('[:;=]-?[)DP]')} AS use_emotj FROM comments)"""


def _sql_ratio(a: str, b: str) -> str:
    return f"round(coalesce({a} / nullif({b}, 0), 0), 6)"


@register(f"""WITH {_STYLE} SELECT *, {_sql_ratio('use_cap', 'length')} AS cap_len, {_sql_ratio('use_lower', 'length')} AS low_len,
  {_sql_ratio('use_cap', 'use_lower')} AS cap_rate, {_sql_ratio('use_digit', 'length')} AS digit_len,
  {_sql_ratio('use_i', 'length')} AS i_len, {_sql_ratio('use_char', 'length')} AS char_len,
  {_sql_ratio('use_symbol', 'length')} AS symbol_len, {_sql_ratio('use_emotj', 'length')} AS cap_emo,
  {_sql_ratio('(use_cap / length)', '(use_lower / length)')} AS cap_odds FROM c""")
def style_features(spark, sf):
    df = T.style_features(X.comments(spark, sf), "id", "comment_text")
    ratios = list(E.style_ratios())
    whole = [c for c in df.columns if c not in ratios and c != "id"]
    return df.withColumns({**{c: F.round(c, 6) for c in ratios}, **{c: F.col(c).cast("bigint") for c in whole}})


def _normal_sql() -> str:
    """The rules without look-around, written for an engine whose \\b and \\w are ASCII."""
    expr = "lower(comment_text)"
    for pattern, replacement in E.cleaning_rules(repair=False):
        p = pattern.replace(E.WORD_START, r"\b").replace(E.WORD_END, r"\b").replace(r"[^\p{Graph}]", "[[:^graph:]]").replace(r"\p{Punct}", "[[:punct:]]")
        p, r = p.replace("'", "''"), replacement.replace("'", "''")
        expr = f"regexp_replace({expr}, '{p}', '{r}', 'g')"
    return expr


@register(f"WITH {X.COMMENTS_SQL} SELECT id, {_normal_sql()} AS text FROM comments")
def normalise_text(spark, sf):
    return X.comments(spark, sf).select("id", E.normalise(F.col("comment_text"), repair=False).alias("text"))


@register()
def regex_lookaround(spark, sf):
    """All rules, the look-around ones included, with caller-supplied word repairs."""
    pairs = [("t he", "the"), ("a nd", "and")]
    return X.comments(spark, sf).select("id", E.normalise(F.col("comment_text"), pairs, ascii=False).alias("text"))


@register(f"""WITH {X.COMMENTS_SQL} SELECT id, regexp_replace(comment_text, '[^\\p{{L}}\\p{{M}}\\p{{Nl}}\\p{{Nd}}]', ' ', 'g') AS text
  FROM comments""")
def alphanumeric_only(spark, sf):
    return X.comments(spark, sf).select("id", E.letters_and_digits(F.col("comment_text")).alias("text"))


_VOCAB = f"""{_TOKENS}, {_STOP}, tf AS (SELECT id, token, count(*) AS tf FROM toks
  WHERE token NOT IN (SELECT * FROM (VALUES {_LISTED}) v(token)) GROUP BY 1, 2),
vocab AS (SELECT token, CAST(sum(tf) AS BIGINT) AS term_count, count(*) AS doc_count FROM tf GROUP BY 1
  HAVING sum(tf) >= 4 AND count(*) / (SELECT count(*) FROM comments) <= 0.3 ORDER BY 2 DESC, 1 LIMIT 10000)"""


def _vocab(spark, sf, staged=True):
    docs, rows = X.comments(spark, sf), _rows(spark, sf)
    if staged:
        rows = stage(rows, "tokens")  # for queries that read the tokens more than once
    listed = T.word_list(spark, sorted(set(T.ENGLISH_STOP_WORDS)))
    total = load(spark, sf, "documents").agg(F.count("*").alias("n")).scalar()
    return docs, rows, T.vocabulary(rows, "id", total, listed, max_terms=10_000)


@register(f"WITH {_VOCAB} SELECT * FROM vocab")
def vocabulary_pruned(spark, sf):
    return _vocab(spark, sf, staged=False)[2]


@register(f"""WITH {_VOCAB}, w AS (SELECT id, token, round(tf / sqrt(sum(tf * tf) OVER (PARTITION BY id)), 6) AS weight
  FROM tf WHERE token IN (SELECT token FROM vocab)) SELECT c.id, token, weight FROM comments c LEFT JOIN w USING (id)""")
def dtm_l2(spark, sf):
    docs, rows, vocab = _vocab(spark, sf)
    return T.term_matrix(docs, rows, "id", vocab).withColumn("weight", F.round("weight", 6))


@register(f"""WITH {_VOCAB} SELECT lang, count(*) AS n FROM toks JOIN vocab USING (token) JOIN comments USING (id) GROUP BY 1""")
def term_vocab_join(spark, sf):
    docs, rows, vocab = _vocab(spark, sf)
    known = keep_listed(rows, "token", vocab.select("token"))
    return known.join(docs.select("id", "lang"), "id").groupBy("lang").agg(F.count("*").alias("n"))


@register()
def word_stems(spark, sf):
    return T.stem_words(_rows(spark, sf).select("token").distinct(), "token")


@register()
def matrix_bound(spark, sf):
    """Style features and term vector of each document in one vector."""
    docs, rows, vocab = _vocab(spark, sf)
    style = T.style_features(docs, "id", "comment_text")
    return T.feature_matrix(style, T.term_vectors(docs, rows, "id", vocab), "id").select(
        "id", F.col("features").cast("string").alias("features")
    )


def _model(spark, sf, epochs=2):
    rows = stage(_clean(spark, sf), "tokens")
    return T.fit_word2vec(T.regroup(rows, "id"), epochs=epochs), rows


@register()
def word2vec_fit(spark, sf):
    model, _ = _model(spark, sf)
    return model.getVectors().select("word", F.col("vector").cast("string").alias("vector"))


@register()
def word_neighbours(spark, sf):
    model, rows = _model(spark, sf)
    asked = [r["token"] for r in T.top_words(rows, 5).orderBy(F.col("n").desc(), "token").limit(5).collect()]
    return T.word_neighbours(model, asked, 5)


@register()
def doc_vectors(spark, sf):
    model, rows = _model(spark, sf)
    return T.document_vectors(model, rows, "id", 10).select("id", F.col("vector").cast("string").alias("vector"), "known")


@register(f"""WITH {X.COMMENTS_SQL} SELECT id, array_to_string(list_filter(list_transform(regexp_split_to_array(comment_text, '[^A-Za-z0-9_]+'),
  lambda w: lower(w)), lambda w: length(w) > 2 AND NOT regexp_matches(w, '[0-9]')), ' ') AS words FROM comments""")
def token_arrays(spark, sf):
    """Tokens of the uncleaned text as one array per document."""
    return X.comments(spark, sf).select("id", F.array_join(E.tokens(F.col("comment_text")), " ").alias("words"))
