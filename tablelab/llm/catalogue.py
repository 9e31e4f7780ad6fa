"""Queries of the pipeline operators over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablelab import session
from tablelab.llm import chosen_path, decontaminate, fingerprints, jaccard, language, licences, line_dedup, lm, mixing, prefix_trie, search, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(modulus: int) -> F.Column:
    """crc32 of the id as text; rows without an id count as held out."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_groups(_table(spark, sf_dir, "documents"), size=5, percent=80)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontaminate.build_index(_table(spark, sf_dir, "documents"))
    phrases = decontaminate.phrases_of(_table(spark, sf_dir, "benchmark"), size=10)
    found = decontaminate.summarise(index, decontaminate.search(index, phrases))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document: doc_id, licenses (comma-joined, sorted), n_lines, whole."""
    documents = _table(spark, sf_dir, "documents")
    found = licences.scan(documents, licences.known(spark)).groupBy("doc_id")
    found = found.agg(F.array_join(F.array_sort(F.collect_list("license")), ",").alias("licenses"), F.sum("n_lines").alias("n_lines"), F.bool_or("whole").alias("whole"))
    rows = documents.select("doc_id").join(found, "doc_id", "left")
    return rows.select("doc_id", F.coalesce("licenses", F.lit("")).alias("licenses"), F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"), F.coalesce("whole", F.lit(False)).alias("whole"))


LANGUAGE_TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}
TOPIC_TARGETS = {"prose": 0.7, "tables": 0.15, "markup": 0.05}
SOURCE_TARGETS = {"src0": 0.1}


def with_topic(documents: DataFrame) -> DataFrame:
    """A topic by the form of the text: tables, markup or prose."""
    marks = F.length("text") - F.length(F.translate("text", "|%#$&*", ""))
    topic = F.when(F.contains(F.col("text"), F.lit(" | ")), "tables").when(marks * 20 > F.length("text"), "markup").otherwise("prose")
    return documents.withColumn("topic", topic)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_topic(_table(spark, sf_dir, "documents")).select("doc_id", "source", "lang", "topic", mixing.tokens().alias("n_tokens"))
    targets = {"source": SOURCE_TARGETS, "lang": LANGUAGE_TARGETS, "topic": TOPIC_TARGETS}
    mixed = mixing.mix(session.stage(rows, "counted"), targets, budget=0.3, counted="n_tokens")
    return mixed.select("doc_id", "source", "lang", "topic", "n_tokens", "rate", "kept")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = session.fresh_path(spark, "warc")
    archives = warc.write(_table(spark, sf_dir, "pages"), folder)
    found = warc.read(archives, folder=folder, payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def toxicity_model(spark: SparkSession, documents: DataFrame, sf_dir: str) -> dict:
    labels = _table(spark, sf_dir, "labels").where(remainder(5) != 0)
    return toxicity.learn(documents, labels)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = toxicity_model(spark, documents, sf_dir)
    rows = documents.select("doc_id", F.coalesce(remainder(5) == 0, F.lit(True)).alias("held_out"), "text")
    scored = toxicity.score(rows, model, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that go: doc_id, line_no, group_doc."""
    return line_dedup.decide(_table(spark, sf_dir, "documents"), exact_words=1)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    names, table = language.learn(documents.where(remainder(5) != 0))
    rows = documents.select("doc_id", F.coalesce(remainder(5) == 0, F.lit(True)).alias("held_out"), "text")
    found = language.predict(rows, names, table, ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", F.array_join("langs", ",").alias("langs"))


def with_next(rows: DataFrame) -> DataFrame:
    """Columns of ``rows`` (doc_id, text) with next_id, next_text: the next row by descending doc_id, after the last the first.

    Rows are cut into slices at quantiles of doc_id, so each task orders one slice; the ends of the slices are
    joined by their ids.
    """
    parts = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    step = max(1, int(len(cuts) ** 0.5))
    grid = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<bigint>")
    coarse = F.array(*[F.lit(c).cast("long") for c in cuts[step - 1 :: step]]) if cuts else grid
    block = F.size(F.filter(coarse, lambda c: c < F.col("doc_id")))
    slice_no = block * step + F.size(F.filter(F.slice(grid, block * step + 1, F.lit(step)), lambda c: c < F.col("doc_id")))
    sliced = rows.where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), slice_no.alias("slice"))
    # the row after a slice's last is the first of the next slice that has rows: one row for each slice
    heads = sliced.groupBy("slice").agg(F.max("doc_id").alias("head"))
    order = Window.orderBy(F.col("slice").desc())
    heads = heads.select("slice", F.coalesce(F.lead("head").over(order), F.max("head").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    heads = F.broadcast(heads).join(rows.where("doc_id is not null").select(F.col("doc_id").alias("after"), F.coalesce("text", F.lit("")).alias("after_text")), "after")
    heads = session.stage(heads, "heads")
    down = Window.partitionBy("slice").orderBy(F.col("doc_id").desc())
    led = sliced.select("*", F.lead("doc_id").over(down).alias("next_id"), F.lead("text").over(down).alias("next_text"))
    out = led.join(F.broadcast(heads), "slice")  # as many rows as slices
    return out.select("doc_id", "text", F.coalesce("next_id", "after").alias("next_id"), F.when(F.col("next_id").isNull(), F.col("after_text")).otherwise(F.col("next_text")).alias("next_text"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    n = F.length("text")
    moved = F.floor(n / 3).cast("int")
    edited = F.concat(F.left("text", n - moved), F.left("next_text", moved))
    rows = with_next(documents).select("doc_id", "next_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    rows = rows.select("doc_id", "next_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))).alias("v"))
    rows = rows.select("doc_id", "next_id", "n_chars", "edited_sha256", "v.kind", "v.text")
    prints = session.stage(fingerprints.fingerprints(rows, ["doc_id", "next_id", "n_chars", "edited_sha256", "kind"]), "prints")
    own = prints.where("kind = 0").select("doc_id", "next_id", "n_chars", "edited_sha256", F.col("fingerprint").alias("own"))
    changed = prints.where("kind = 1").select("doc_id", F.col("fingerprint").alias("changed"))
    following = own.select(F.col("doc_id").alias("next_id"), F.col("own").alias("following"))
    # near documents of every document whose id is divisible by 20, among all documents
    copies = own.groupBy(F.col("own").alias("near")).agg(F.count("*").alias("copies"))
    asked = own.where("doc_id % 20 = 0").select(F.col("own").alias("fingerprint"))
    pairs = fingerprints.near_pairs(asked, own.select(F.col("own").alias("fingerprint")), radius=3)
    near = pairs.join(copies, "near").groupBy(F.col("query").alias("own")).agg((F.sum("copies") - 1).alias("n_near"))
    out = own.join(changed, "doc_id").join(following, "next_id").join(near, "own", "left")
    return out.select(
        "doc_id", "n_chars", "edited_sha256", fingerprints.hex_of(F.col("own")).alias("fingerprint"), fingerprints.hex_of(F.col("changed")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("own"), F.col("changed")).alias("near_edited"), fingerprints.likeness(F.col("own"), F.col("following")).alias("near_next"),
        F.when(F.col("doc_id") % 20 == 0, F.col("n_near")).alias("n_near"),
    )


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "documents").select("doc_id", "text", remainder(7).alias("fold"))
    found = lm.score(rows, "fold != 2")
    return found.select("doc_id", (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = session.stage(prefix_trie.turn_rows(_table(spark, sf_dir, "conversations")), "turns")
    return prefix_trie.build(prefix_trie.with_shared_heads(turns))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.join_groups(_table(spark, sf_dir, "documents"), size=5, percent=85)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=50)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard, op2_decontaminate, op3_licences, op4_mixing, op5_warc, op6_toxicity, op7_line_dedup, op8_language,
        op9_fingerprints, op10_language_model, op11_prefix_trie, op12_minhash_dedup, op13_ranked_search, pipeline,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id != b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= PERCENT * (min(a.n) + min(b.n) - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.b) AS component_id FROM s JOIN reach r ON s.doc_id = r.a GROUP BY s.doc_id, len(s.s)
"""
_OP1 = _JACCARD.replace("PERCENT", "80")
_OP12 = f"SELECT *, doc_id = component_id AS kept FROM ({_JACCARD.replace('PERCENT', '85')})"

_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_OP2 = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item_id, {_WORDS.format(_LOWER)} AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[k:k+9], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
x AS (SELECT doc_id, k, size, array_to_string(w[k:k+size-1], ' ') AS g
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, (SELECT DISTINCT size FROM p))),
h AS (SELECT x.doc_id, x.k, x.size, p.item_id FROM x JOIN p ON x.size = p.size AND x.g = p.g),
c AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS pos FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(t.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(t.items, '')) AS items_sha256, c.n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""


def _licence_sql() -> str:
    form = "' ' || regexp_replace(array_to_string(list_filter(string_split(lower({}), chr(10)), lambda x: NOT regexp_matches(x, '" + licences.COPYRIGHT_LINE + "')), chr(10)), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') || ' '"
    form = f"regexp_replace({form}, ' v ?([0-9])', ' version \\1', 'g')"
    for words, to in licences.SPELLINGS:
        form = f"replace({form}, ' {words} ', ' {to} ')"
    form = f"trim(regexp_replace({form}, ' +', ' ', 'g'))"
    notices = ", ".join(f"('{name}', '{text}')" for name, text in licences.NOTICES)
    return f"""
WITH k AS (SELECT license, {form.format('text')} AS form FROM (VALUES {notices}) AS v(license, text)),
p AS (SELECT doc_id, true AS whole, coalesce(text, '') AS part FROM documents
  UNION ALL SELECT doc_id, false, unnest(string_split(coalesce(text, ''), chr(10))) FROM documents),
f AS (SELECT doc_id, whole, {form.format('part')} AS form FROM p),
h AS (SELECT doc_id, license, sum((NOT whole)::INT) AS n, bool_or(whole) AS whole FROM f JOIN k ON f.form = k.form AND f.form != '' GROUP BY ALL),
g AS (SELECT doc_id, string_agg(license, ',' ORDER BY license) AS licenses, sum(n) AS n, bool_or(whole) AS whole FROM h GROUP BY doc_id)
SELECT d.doc_id, coalesce(g.licenses, '') AS licenses, coalesce(g.n, 0)::BIGINT AS n_lines, coalesce(g.whole, false) AS whole
FROM documents d LEFT JOIN g USING (doc_id)
"""


_OP5 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
x AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS h FROM p),
y AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS winner,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), '') AS payload_digest FROM x)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = winner THEN NULL ELSE winner END AS refers_to FROM y
"""

_OP11 = """
WITH o AS (SELECT conv_id, list({'r': coalesce(role, ''), 'x': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) AS s
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, s, (xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295) % 9)::INT AS h FROM o),
r AS (SELECT c.conv_id, list_concat(coalesce(b.s, [])[1:c.h], c.s[c.h + 1:]) AS s FROM h c LEFT JOIN o b ON b.conv_id = c.conv_id - c.conv_id % 5),
p AS (SELECT conv_id, len(s) AS size, d, s[1:d] AS k, CASE WHEN d = 0 THEN 0 ELSE octet_length(encode(s[d].x)) END AS bytes
  FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM r)),
n AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n, min(bytes) AS bytes,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends FROM p GROUP BY k, d),
c AS (SELECT k[1:d - 1] AS k, count(*) AS children FROM n WHERE d > 0 GROUP BY 1),
u AS (SELECT n.*, coalesce(c.children, 0) AS children FROM n LEFT JOIN c USING (k)),
t AS (SELECT k[1:a] AS k, count(*) FILTER (children = 0) AS leaves, sum((n - 1) * bytes) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM u) GROUP BY 1)
SELECT u.conv_id, u.d::BIGINT AS depth, q.conv_id AS parent_conv_id, u.n AS n_convs, u.children AS n_children, t.leaves AS n_leaves,
  t.saved::BIGINT AS saved_tokens, u.ends AS ends_sha256
FROM u JOIN t USING (k) LEFT JOIN n q ON u.d > 0 AND q.k = u.k[1:u.d - 1]
"""

_TERMS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

_OP13 = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
s AS (SELECT count(*) FILTER (len(w) > 0)::BIGINT AS n, sum(len(w))::BIGINT AS l FROM d),
i AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
p AS (SELECT doc_id, len(w)::BIGINT AS n, t, count(*)::BIGINT AS tf FROM (SELECT doc_id, w, unnest(w) AS t FROM d)
  WHERE t IN (SELECT t FROM i) GROUP BY doc_id, w, t),
f AS (SELECT t, floor(1000 * ln((2 * s.n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY t, s.n),
c AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * p.n * s.n) // s.l))) AS part FROM p JOIN f USING (t), s),
x AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM i JOIN c USING (t) GROUP BY item_id, doc_id HAVING sum(part) > 0),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM x)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""

ORACLES: dict[str, str] = {"op1_ngram_jaccard": _OP1, "op2_decontaminate": _OP2, "op3_licences": _licence_sql(), "op5_warc": _OP5, "op11_prefix_trie": _OP11, "op12_minhash_dedup": _OP12, "op13_ranked_search": _OP13}
