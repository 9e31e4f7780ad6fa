"""Language of a text as a mixture: expectation maximisation over n-gram likelihoods, penalised choice of languages.

Each language has a smoothed distribution over hashed character runs, counted over all its learning texts. A
text's runs are a mixture of languages: languages are added one by one, the proportions re-estimated by
expectation maximisation each time, and an addition stays only while the likelihood, less a penalty for each
language, still rises. The language with the largest proportion is the prediction.

Defined cases: null texts and texts without a letter are ``und`` with score 0; rows without a language are
never learnt from; without learning rows every text is ``und``; ties go to the first language in sort order;
repeated rows are predicted one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab.llm import words

BUCKETS = 1 << 14
UNKNOWN = "und"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LOWER[[b for b in range(0x80) if not chr(b).isalpha()]] = 32
_LOWER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def runs_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed buckets of runs of one to three bytes of each text (anything but letters reads as one blank)."""
    data, offsets = words.bytes_of(texts)
    a = _LOWER[data].astype(np.uint32)
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    out, owner = [], []
    for size in (1, 2, 3):
        n = max(len(a) - size + 1, 0)
        code = np.full(n, size, dtype=np.uint32)
        for k in range(size):
            code = code * np.uint32(0x01000193) + a[k : k + n] + np.uint32(1)
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        code ^= code >> np.uint32(12)
        inside = (doc[:n] == doc[size - 1 : size - 1 + n]) & ((a[:n] != 32) | (size == 3))
        out.append((code[inside] % np.uint32(BUCKETS)).astype(np.int64))
        owner.append(doc[:n][inside])
    return np.concatenate(out), np.concatenate(owner)


def learn(documents: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities (a row of ``BUCKETS`` each) from all rows with text and lang."""
    rows = documents.where("lang is not null and text is not null").select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for block in words.blocks(batches, "text", 4 << 20):
            names, lang = np.unique(np.array(block.column(1).to_pylist(), dtype=object).astype(str), return_inverse=True)
            bucket, doc = runs_of(block.column(0))
            n = np.bincount(lang[doc] * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
            for name, row in zip(names, n):
                total[str(name)] = total.get(str(name), 0) + row
        for name, row in total.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(row[at], pa.int64())], names=["lang", "bucket", "n"])

    sums = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = sums.toPandas()  # at most BUCKETS rows for each language
    languages = sorted(table["lang"].unique())
    n = np.zeros((len(languages), BUCKETS))
    if len(table):
        n[np.searchsorted(np.array(languages, dtype=object), table["lang"].to_numpy()), table["bucket"].to_numpy()] = table["n"].to_numpy()
        everywhere = n.sum(0) + 1
        n += 50.0 * everywhere / everywhere.sum() + 0.01
        n /= n.sum(1, keepdims=True)
    return languages, np.log(n) if len(languages) else n


def mixture(counts: np.ndarray, likelihood: np.ndarray, penalty: float, rounds: int = 12) -> tuple[list[int], np.ndarray]:
    """Chosen languages and their proportions. ``likelihood`` has a row for each run and a column for each language."""
    total = counts.sum()
    alone = counts @ np.log(likelihood)
    chosen = [int(np.argmax(alone))]
    share, best = np.ones(1), alone.max()
    while len(chosen) < likelihood.shape[1]:
        mixed = likelihood[:, chosen] @ share
        gain = (counts / mixed) @ likelihood / total
        gain[chosen] = -np.inf
        new = int(np.argmax(gain))
        if gain[new] <= 1 + 1e-9:
            break
        part = likelihood[:, [*chosen, new]]
        pi = np.append(share * 0.8, 0.2)
        for _ in range(rounds):
            mixed = part @ pi
            pi = pi * ((counts / mixed) @ part) / total
        value = counts @ np.log(part @ pi)
        if value - penalty * np.log(total + 1) <= best:
            break
        chosen, share, best = [*chosen, new], pi, value
    return chosen, share


def predict(documents: DataFrame, languages: list[str], table: np.ndarray, keep: list[str], penalty: float = 2.0) -> DataFrame:
    """Columns ``keep`` with lang_pred, score (its proportion) and langs (all chosen, by proportion)."""
    chance = np.exp(table).T.copy() if len(languages) else table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.blocks(batches, "text", 4 << 20):
            at = block.schema.get_field_index("text")
            texts = block.column(at)
            bucket, doc = runs_of(texts)
            order = np.argsort(doc, kind="stable")
            bucket, ends = bucket[order], np.searchsorted(doc[order], np.arange(block.num_rows + 1))
            names, scores, sets = [], [], []
            for i, text in enumerate(texts):
                text = text.as_py()
                own = bucket[ends[i] : ends[i + 1]]
                if not languages or not len(own) or not any(map(str.isalpha, text or "")):
                    names.append(UNKNOWN), scores.append(0.0), sets.append([])
                    continue
                n = np.bincount(own, minlength=BUCKETS)
                at_bucket = np.flatnonzero(n)
                chosen, share = mixture(n[at_bucket].astype(float), chance[at_bucket], penalty)
                ranked = sorted(zip(-share, chosen))
                names.append(languages[ranked[0][1]]), scores.append(min(1.0, float(-ranked[0][0])))
                sets.append([languages[c] for _, c in ranked])
            rest = [block.column(i) for i in range(block.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.list_(pa.string()))], names=[*keep, "lang_pred", "score", "langs"])

    rows = documents.select(*keep, "text")
    empty = rows.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.array(F.lit("")).alias("langs"))
    return rows.mapInArrow(run, empty.schema)
