"""Text operators: word counts, stop and rare words, vocabularies, term matrices, word vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler, Word2Vec, Word2VecModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import textexpr as E
from ..session import small_side, stage
from .ordered import row_positions, top_with_ties
from .relational import count_by, long_from_wide

# Common English words; a longer list is a parameter of the operators below.
ENGLISH_STOP_WORDS = (
    "a about above after again all also am an and any are as at be because been before being below between both but by "
    "can could did do does down during each few for from further had has have having he her here hers him his how i if in "
    "into is it its just me more most my no nor not now of off on once only or other ought our out over own same she so some "
    "such than that the their them then there these they this those through to too under until up very was we were what "
    "when where which while who whom why will with would you your"
).split()

def word_list(spark, words: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(w,) for w in words], "token string")


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """Words split on single blanks with how often each occurs; empty pieces do not count."""
    words = lines.select(F.explode(F.split(column, " ")).alias("word")).filter("word <> ''")
    return count_by(words, "word")


def token_rows(df: DataFrame, key: str, text: str, ascii: bool = True, min_length: int = 3) -> DataFrame:
    """``key, pos, token``: lower-cased words of the cleaned text with their place in it.

    Short words and words with a digit are left out. Cleaning (neither letter nor digit → blank) and
    splitting at non-word characters are one split, so each text is scanned once; the filters run on
    rows inside generated code. ``[\\W_]`` is all but ASCII letters and digits, and several times as fast as the
    negated class.
    """
    gap = r"[\W_]+" if ascii else r"[^\p{IsAlphabetic}\p{Nd}]+"
    words = df.select(key, F.posexplode(F.split(text, gap)).alias("pos", "word"))
    kept = words.filter((F.char_length("word") >= min_length) & ~F.col("word").rlike("[0-9]"))
    return kept.select(key, "pos", F.lower("word").alias("token"))


def token_counts(rows: DataFrame) -> DataFrame:
    return count_by(rows, "token")


def stop_words(counts: DataFrame, lists: Sequence[DataFrame], top: int = 200) -> DataFrame:
    """The most frequent corpus words (ties kept) and the given lists, each word once."""
    out = top_with_ties(counts, "n", top).select("token")
    for extra in lists:
        out = out.union(extra.toDF("token"))
    return out.distinct()


def rare_words(counts: DataFrame, below: int = 10) -> DataFrame:
    return counts.filter(F.col("n") < below).select("token")


def clean_rows(rows: DataFrame, stop: DataFrame, counts: DataFrame, below: int = 10, broadcast_rows: int = 2_000_000) -> DataFrame:
    """Token rows that are neither stop words nor rare.

    Rare words make up most of a vocabulary, so the join runs against the much shorter list of
    words to keep, broadcast once measured as small: no token row moves. A longer list is shuffled with the rows;
    words that make up more than a thousandth of them are then dealt out over many tasks, or dropped before.
    """
    keep = stage(counts.filter(F.col("n") >= below).join(stop, "token", "left_anti").select("token", "n"), "kept")
    words = keep.select("token")
    near = small_side(words, max_rows=broadcast_rows)
    if near is not words:
        return rows.join(near, "token", "left_semi").select(*rows.columns)
    lanes = 64
    total = counts.agg(F.sum("n").alias("total"))
    frequent = counts.join(F.broadcast(total)).filter(F.col("n") * 1000 > F.col("total")).select("token")
    listed = keep.join(F.broadcast(frequent.withColumn("__hot", F.lit(True))), "token", "left")
    dealt = listed.select("token", F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(lanes - 1))).otherwise(F.array(F.lit(0)))).alias("__lane"))
    hot = frequent.join(keep.select("token", F.lit(True).alias("__kept")), "token", "left")
    marked = rows.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), "token", "left").filter("__hot is null or __kept")
    lane = F.when(F.col("__hot"), F.pmod(F.xxhash64(*rows.columns), F.lit(lanes))).otherwise(0).cast("int")
    return marked.withColumn("__lane", lane).join(dealt, ["token", "__lane"], "left_semi").select(*rows.columns)


def regroup(rows: DataFrame, key: str) -> DataFrame:
    """Token rows back to one ordered array per document."""
    pairs = F.sort_array(F.collect_list(F.struct("pos", "token")))
    return rows.groupBy(key).agg(F.transform(pairs, lambda p: p["token"]).alias("words"))


def top_words(rows: DataFrame, k: int = 10) -> DataFrame:
    return top_with_ties(stage(token_counts(rows), "counts"), "n", k)  # read twice


def top_words_per_label(rows: DataFrame, labels: DataFrame, key: str, targets: Sequence[str], k: int = 10) -> DataFrame:
    """Most frequent words of each label: one counting pass for all labels, then one row per label and word."""
    joined = rows.join(labels.select(key, *targets), key)
    counts = joined.groupBy("token").agg(*[F.count_if(F.col(t) == 1).alias(t) for t in targets])
    long = long_from_wide(counts, ["token"], targets, "label", "n").filter("n > 0")
    return top_with_ties(long, "n", k, ["label"])


def label_frequency(labels: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Rows per label; ``ok`` is the total minus all label counts, ``clean`` the rows without any label."""
    sums = [F.sum(t).cast("bigint").alias(t) for t in targets]
    none = F.lit(True)
    for t in targets:
        none = none & (F.col(t) == 0)
    wide = labels.agg(*sums, F.count("*").alias("total"), F.count_if(none).alias("clean"))
    rest = F.col("total")
    for t in targets:
        rest = rest - F.col(t)
    return long_from_wide(wide.withColumn("ok", rest), [], [*targets, "total", "clean", "ok"], "label", "n")


def style_features(df: DataFrame, key: str, text: str, ascii: bool = True) -> DataFrame:
    """24 style columns per document: the text is shortened step by step and counted, ratios follow."""
    steps, counts = E.style_steps(F.col(text), ascii)
    short = df.select(key, text)
    for columns in steps:
        short = short.withColumns(columns)
    return short.select(key, *[c.alias(n) for n, c in counts.items()]).withColumns(E.style_ratios())


def vocabulary(
    rows: DataFrame, key: str, documents: Column | int, stop: DataFrame | None = None,
    min_count: int = 4, max_share: float = 0.3, max_terms: int | None = None,
) -> DataFrame:
    """``token, term_count, doc_count`` after pruning; only the most frequent ``max_terms`` if given."""
    if stop is not None:
        rows = rows.join(stop, "token", "left_anti")
    per_doc = rows.groupBy(key, "token").agg(F.count("*").alias("tf"))
    terms = per_doc.groupBy("token").agg(F.sum("tf").alias("term_count"), F.count("*").alias("doc_count"))
    n = documents if isinstance(documents, Column) else F.lit(documents)
    kept = terms.filter((F.col("term_count") >= min_count) & (F.col("doc_count") / n <= max_share))
    ordered = kept.orderBy(F.col("term_count").desc(), "token")
    return ordered if max_terms is None else ordered.limit(max_terms)


def term_matrix(docs: DataFrame, rows: DataFrame, key: str, vocab: DataFrame) -> DataFrame:
    """Long document-term matrix ``key, token, weight`` with rows of length 1; documents without
    a term keep one row with NULLs."""
    tf = rows.join(vocab.select("token"), "token").groupBy(key, "token").agg(F.count("*").cast("double").alias("tf"))
    norms = tf.groupBy(key).agg(F.sqrt(F.sum(F.col("tf") * F.col("tf"))).alias("norm"))
    weighted = tf.join(norms, key).select(key, "token", (F.col("tf") / F.col("norm")).alias("weight"))
    return docs.select(key).join(weighted, key, "left")


def numbered_terms(vocab: DataFrame) -> DataFrame:
    """``token, index``: terms numbered from 0 in alphabetical order, in a table of their own.

    Numbering reads its input three times, so the terms are stored and the vocabulary is computed once.
    """
    return row_positions(vocab.select("token").distinct(), [], ["token"], "__pos", staged=True).select("token", (F.col("__pos") - 1).cast("int").alias("index"))


def sparse_rows(docs: DataFrame, weights: DataFrame, key: str, terms: DataFrame) -> DataFrame:
    """``key, indices, values``: the known terms of each document in the order of their numbers; documents without any stay."""
    cells = weights.where("weight is not null").join(terms, "token").select(key, F.struct("index", "weight").alias("cell"))
    rows = cells.groupBy(key).agg(F.sort_array(F.collect_list("cell")).alias("cells"))
    filled = docs.select(key).join(rows, key, "left").withColumn("cells", F.coalesce("cells", F.array().cast("array<struct<index:int,weight:double>>")))
    return filled.select(key, F.col("cells.index").alias("indices"), F.col("cells.weight").alias("values"))


def as_vectors(rows: DataFrame, key: str, size: int, out: str) -> DataFrame:
    """Sparse rows as vectors of ``size`` terms.

    The rows are written once in the storage form of a vector and read back as vectors, so no row passes through
    Python and no term through the driver.
    """
    stored = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), "indices", "values")
    schema = T.StructType([rows.schema[key], T.StructField(out, VectorUDT())])
    return stage(rows.select(key, stored.alias(out)), "vectors", schema)


def term_vectors(docs: DataFrame, rows: DataFrame, key: str, vocab: DataFrame) -> DataFrame:
    """Sparse vector form of the matrix in column ``dtm``, for a vocabulary of any size."""
    terms = stage(numbered_terms(vocab), "terms")
    weights = term_matrix(docs, rows, key, terms)
    return as_vectors(sparse_rows(docs, weights, key, terms), key, terms.count(), "dtm")


def feature_matrix(style: DataFrame, dtm: DataFrame, key: str) -> DataFrame:
    """Style columns and term vector side by side in one vector."""
    cols = [c for c in style.columns if c != key]
    joined = style.join(dtm, key)
    return VectorAssembler(inputCols=[*cols, "dtm"], outputCol="features").transform(joined).select(key, "features")


# --- word stems ------------------------------------------------------------------------------------

_V = "[aeiouy]"
_NOT_V = "[^aeiouy]"
# Fixed values of the published English suffix-stripping rules (suffix → replacement), longest first.
_STEP2 = [
    ("ational", "ate"), ("ization", "ize"), ("fulness", "ful"), ("ousness", "ous"), ("iveness", "ive"), ("tional", "tion"),
    ("biliti", "ble"), ("lessli", "less"), ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"),
    ("ousli", "ous"), ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"),
    ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"),
]
_STEP3 = [
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"), ("ical", "ic"),
    ("ness", ""), ("ful", ""),
]
_STEP4 = "ement ance ence able ible ment ant ent ism ate iti ous ive ize al er ic".split()
_SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
    "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe",
    "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
_FINISHED_AFTER_PLURAL = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]


def stem_words(words: DataFrame, column: str, out: str = "stem") -> DataFrame:
    """English word stems by suffix rules, as built-in expressions over a table of distinct words."""
    w = F.col("__w")

    def cut(n: int) -> Column:
        return F.substr(w, F.lit(1), F.char_length(w) - n)

    def starts_at(suffix: str) -> Column:
        return F.char_length(w) - len(suffix)

    def replace_first(rules, region: str, last: Column) -> Column:
        """The longest matching suffix decides; it is replaced only when it lies in the region."""
        expr = None
        for s, r in sorted(rules, key=lambda x: -len(x[0])):
            new = F.when(starts_at(s) >= F.col(region), F.concat(cut(len(s)), F.lit(r))).otherwise(w)
            expr = F.when(w.endswith(s), new) if expr is None else expr.when(w.endswith(s), new)
        return expr.otherwise(last)

    short_end = w.rlike(f"({_NOT_V}{_V}[^aeiouywxY]|^{_V}{_NOT_V})$")
    prefix = F.char_length(F.regexp_extract(w, "^(gener|commun|arsen)", 1))
    first = F.char_length(F.regexp_extract(w, f"^({_NOT_V}*{_V}+{_NOT_V})", 1))
    df = words.withColumn("__w", F.regexp_replace(F.lower(column), "^'", ""))
    df = df.withColumn("__w", F.regexp_replace(F.regexp_replace(w, "^y", "Y"), "(?<=[aeiouy])y", "Y"))
    df = df.withColumn("__r1", F.when(prefix > 0, prefix).when(first > 0, first).otherwise(F.char_length(w)))
    rest = F.substr(w, F.col("__r1") + 1)
    second = F.char_length(F.regexp_extract(rest, f"^({_NOT_V}*{_V}+{_NOT_V})", 1))
    df = df.withColumn("__r2", F.when(second > 0, F.col("__r1") + second).otherwise(F.char_length(w)))
    df = df.withColumn("__w", F.regexp_replace(w, "'(s'?)?$", ""))
    df = df.withColumn(
        "__w",
        F.when(w.endswith("sses"), cut(2))
        .when(w.rlike("ie[ds]$"), F.when(F.char_length(w) > 4, cut(2)).otherwise(cut(1)))
        .when(w.rlike("(us|ss)$"), w)
        .when(w.rlike(f"{_V}.+s$"), cut(1))
        .otherwise(w),
    )
    df = df.withColumn("__done", w.isin(_FINISHED_AFTER_PLURAL))
    ending = F.regexp_extract(w, "(eedly|ingly|edly|eed|ing|ed)$", 1)
    df = df.withColumn("__e", ending)
    base = F.substr(w, F.lit(1), F.char_length(w) - F.char_length("__e"))
    in_r1 = F.char_length(w) - F.char_length("__e") >= F.col("__r1")
    dropped = F.col("__e").isin("ed", "edly", "ing", "ingly") & base.rlike(_V)
    df = df.withColumn("__cut", dropped).withColumn(
        "__w", F.when(F.col("__e").isin("eed", "eedly"), F.when(in_r1, F.concat(base, F.lit("ee"))).otherwise(w)).when(dropped, base).otherwise(w)
    )
    df = df.withColumn(
        "__w",
        F.when(~F.col("__cut"), w)
        .when(w.rlike("(at|bl|iz)$"), F.concat(w, F.lit("e")))
        .when(w.rlike("(bb|dd|ff|gg|mm|nn|pp|rr|tt)$"), cut(1))
        .when(short_end & (F.char_length(w) <= F.col("__r1")), F.concat(w, F.lit("e")))
        .otherwise(w),
    )
    df = df.withColumn("__w", F.regexp_replace(w, f"(?<=.{_NOT_V})[yY]$", "i"))
    og = F.when(w.endswith("logi") & (starts_at("ogi") >= F.col("__r1")), cut(1))
    li = F.when(w.rlike("[cdeghkmnrt]li$") & (starts_at("li") >= F.col("__r1")), cut(2))
    df = df.withColumn("__w", replace_first(_STEP2, "__r1", F.coalesce(og, li, w)))
    ative = F.when(w.endswith("ative") & (starts_at("ative") >= F.col("__r2")), cut(5)).otherwise(w)
    df = df.withColumn("__w", replace_first(_STEP3, "__r1", ative))
    ion = F.when(w.rlike("[st]ion$") & (starts_at("ion") >= F.col("__r2")), cut(3)).otherwise(w)
    df = df.withColumn("__w", replace_first([(s, "") for s in _STEP4], "__r2", ion))
    before_e = F.substr(w, F.lit(1), F.char_length(w) - 1)
    short_before = before_e.rlike(f"({_NOT_V}{_V}[^aeiouywxY]|^{_V}{_NOT_V})$")
    drop_e = (starts_at("e") >= F.col("__r2")) | ((starts_at("e") >= F.col("__r1")) & ~short_before)
    df = df.withColumn(
        "__w2",
        F.when(w.endswith("e"), F.when(drop_e, cut(1)).otherwise(w))
        .when(w.endswith("ll") & (starts_at("l") >= F.col("__r2")), cut(1))
        .otherwise(w),
    )
    low = F.lower(F.regexp_replace(F.lower(column), "^'", ""))
    finished = F.when(F.col("__done"), F.regexp_replace(low, "s$", "")).otherwise(F.lower("__w2"))
    stemmed = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in _SPECIAL.items() for x in kv]), F.lower(column)), finished)
    return df.withColumn(out, F.when(F.char_length(column) <= 2, F.lower(column)).otherwise(stemmed)).select(*words.columns, out)


def stem_rows(rows: DataFrame) -> DataFrame:
    """Token rows with the stem: each distinct word is stemmed once, then joined back."""
    return rows.join(stem_words(rows.select("token").distinct(), "token"), "token").select(*rows.columns, "stem")


# --- word vectors ----------------------------------------------------------------------------------


def fit_word2vec(docs: DataFrame, column: str = "words", size: int = 10, min_count: int = 10, window: int = 5,
                 rate: float = 0.025, epochs: int = 15, seed: int = 1, partitions: int | None = None) -> Word2VecModel:
    """Skip-gram vectors; each document is a sequence of its own. Partitions train side by side and are
    averaged after each epoch; too many of them dilute the result, hence the modest default."""
    parts = partitions or min(docs.sparkSession.sparkContext.defaultParallelism, 32)
    w2v = Word2Vec(
        vectorSize=size, minCount=min_count, windowSize=window, stepSize=rate, maxIter=epochs, seed=seed,
        numPartitions=parts, inputCol=column, outputCol="vector",
    )
    return w2v.fit(docs)


def word_neighbours(model: Word2VecModel, words: Sequence[str], k: int = 5) -> DataFrame:
    """k most similar words (cosine) of each given word: ``word, neighbour, similarity``, in one pass over the vectors."""
    vectors = model.getVectors().select("word", vector_to_array("vector").alias("v"))
    size = model.getVectorSize()

    def dot(a, b):
        return sum((F.get(a, i) * F.get(b, i) for i in range(size)), F.lit(0.0))

    mine = vectors.filter(F.col("word").isin(list(words))).collect()
    asked = F.array(*[F.struct(F.lit(r["word"]).alias("asked"), F.array(*[F.lit(x) for x in r["v"]]).alias("q")) for r in mine])
    pairs = vectors.select("word", "v", F.inline(asked)).filter("word <> asked")
    cosine = F.try_divide(dot("v", "q"), F.sqrt(dot("v", "v") * dot("q", "q")))
    scored = pairs.select("asked", "word", F.coalesce(cosine, F.lit(0.0)).alias("similarity"))
    w = Window.partitionBy("asked").orderBy(F.col("similarity").desc(), "word")
    best = scored.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)
    return best.select(F.col("asked").alias("word"), "place", F.col("word").alias("neighbour"), "similarity")


def document_vectors(model: Word2VecModel, rows: DataFrame, key: str, size: int) -> DataFrame:
    """Mean vector of a document's known words (``key, vector, known``); unknown words do not dilute it."""
    vectors = model.getVectors().select(F.col("word").alias("token"), vector_to_array("vector").alias("v"))
    sums = [F.avg(F.get("v", i)).alias(f"d{i}") for i in range(size)]
    means = rows.join(vectors, "token").groupBy(key).agg(*sums, F.count("*").alias("known"))
    return means.select(key, array_to_vector(F.array(*[f"d{i}" for i in range(size)])).alias("vector"), "known")
