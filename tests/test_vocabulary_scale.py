"""Numbering the terms does not compute the vocabulary again."""

from tablelab.operators import text


def test_vocabulary_is_computed_once(spark):
    rows = spark.createDataFrame([(d, t) for d in range(6) for t in ("pear", "fig", "kiwi")[: d % 3 + 1]], "id int, token string")
    vocab = text.vocabulary(rows, "id", 6, min_count=1, max_share=1.0, max_terms=2)
    numbered = text.numbered_terms(vocab)
    assert "doc_count" not in numbered._jdf.queryExecution().analyzed().toString()  # three times before
    assert {r["token"]: r["index"] for r in numbered.collect()} == {"fig": 0, "pear": 1}
