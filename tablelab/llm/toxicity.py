"""Toxicity by compression distance: two zstandard dictionaries, one per class, compared window by window.

Fit, on a bounded sample of labelled rows: the ordinary dictionary is trained on pieces of the ordinary texts. The
toxic one is trained on character runs that are much more frequent in toxic texts, and holds the ordinary one as
well, so that ordinary text is as short with both and chance matches cancel out. Both are plain content, without
tables of their own. Every window of a text (about a hundred
bytes, cut at blanks) is compressed with both dictionaries; the difference of the two lengths tells whether
the window has runs that only the toxic texts know. How often the differences pass several thresholds feeds a logistic calibration that is fitted on the
part of the sample the dictionaries have not seen; its intercept is set so that 0.5 is the score with the best
balance of precision and recall at the class shares of all labels.

Defined cases: null and empty texts have one empty window and get the calibrated score of no evidence; rows
with a null label or id are never learnt from; repeated rows are scored one by one; without labelled rows of
both classes every score is the share of toxic rows (0 if there are no labels).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab import session

GRAM = 6
#: Bytes of a window, of the ordinary dictionary and of the runs that the toxic one adds; bytes of a training piece.
WINDOW, ORDINARY, TOXIC, PIECE = 96, 16_384, 4_096, 200
#: Pieces taken from one text for training, evenly over the whole of it.
PIECES = 8
THRESHOLDS = (1, 2, 3, 4, 5, 6)


def _plain(text: str | None) -> bytes:
    return (text or "").lower().replace("\n", " ").encode("utf-8", "replace")


def _gram_codes(data: bytes) -> np.ndarray:
    a = np.frombuffer(data, np.uint8).astype(np.uint64)
    out = np.zeros(max(len(a) - GRAM + 1, 0), np.uint64)
    for k in range(GRAM):
        out |= a[k : k + len(out)] << np.uint64(8 * k)
    return out


def _document_shares(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    codes, n = np.unique(np.concatenate([np.unique(_gram_codes(t)) for t in texts]), return_counts=True)
    return codes, n


def _share_of(codes: np.ndarray, known: tuple[np.ndarray, np.ndarray], total: int) -> np.ndarray:
    if not len(known[0]):
        return np.zeros(len(codes))
    at = np.minimum(np.searchsorted(known[0], codes), len(known[0]) - 1)
    return np.where(known[0][at] == codes, known[1][at], 0) / total


def _marks(own, n_own: int, other, n_other: int, ratio: float = 10.0) -> np.ndarray:
    """Character runs found ``ratio`` times as often in texts of the class as in the other, and in too many for chance.

    The likelihood ratio of a run's counts must exceed what the best of that many runs reaches by chance.
    """
    codes, hits = own
    share = n_own / (n_own + n_other)
    others = _share_of(codes, other, 1)
    n = hits + others
    found = hits / n
    gain = hits * np.log(found / share) + others * np.log(np.maximum(1 - found, 1e-300) / (1 - share))
    often = hits / n_own >= ratio * (others + 0.5) / n_other
    return codes[often & (gain > np.log(len(codes) + 1))]


def _runs(text: bytes, marks: np.ndarray) -> list[bytes]:
    hit = np.isin(_gram_codes(text), marks)
    covered = np.zeros(len(text) + 2, np.int8)
    for k in range(GRAM):
        covered[1 + k : 1 + k + len(hit)] |= hit
    edge = np.flatnonzero(np.diff(covered))
    return [text[i:j] for i, j in zip(edge[::2], edge[1::2])]


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the bare samples where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(dict.fromkeys(samples))[:size] or b" " * 16


def _pieces(text: bytes) -> list[bytes]:
    starts = range(0, max(len(text) - PIECE // 2, 1), max(PIECE, -(-len(text) // PIECES)))
    return [text[at : at + PIECE] for at in starts]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(
        window_log=15, hash_log=16, chain_log=16, search_log=4, min_match=5, target_length=32,
        strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    content.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=settings)


def windows(data: bytes, size: int) -> list[bytes]:
    """The whole text in windows of at most ``size`` bytes, cut at blanks where there are any."""
    out, at, n = [], 0, len(data)
    while n - at > size:
        to = data.rfind(b" ", at + 1, at + size) + 1 or at + size
        out.append(data[at:to])
        at = to
    out.append(data[at:])
    return out


def differences(data: bytes, size: int, ordinary, toxic) -> np.ndarray:
    """Bytes that the toxic dictionary saves against the ordinary one, window by window."""
    a, b = ordinary.compress, toxic.compress
    return np.array([len(a(w)) - len(b(w)) for w in windows(data, size)], dtype=np.int32)


def _pair(books: list[bytes]) -> tuple:
    """The compressors of the ordinary and the toxic dictionary."""
    ordinary, toxic = books
    return _compressor(ordinary), _compressor(toxic + ordinary)


def _features(data: bytes, pair: tuple) -> np.ndarray:
    d = differences(data, WINDOW, *pair)
    n = len(d)
    over = [(d >= t).sum() for t in THRESHOLDS]
    return np.array([d.mean(), d.max(), *[k / n for k in over], *[np.log1p(k) for k in over], np.log1p(n)])


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps, both classes weighing the same."""
    x1 = np.column_stack([np.ones(len(x)), x])
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    beta, ridge = np.zeros(x1.shape[1]), penalty * np.eye(x1.shape[1])
    ridge[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x1 @ beta, -30, 30)))
        grad = x1.T @ (weight * (y - p)) - ridge @ beta
        step = np.linalg.solve((x1 * (weight * p * (1 - p))[:, None]).T @ x1 + ridge, grad)
        beta += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def _threshold(z: np.ndarray, y: np.ndarray, share: float) -> float:
    """The score with the best balance of precision and recall at the true class shares."""
    order = np.argsort(-z)
    hit = np.cumsum(y[order]) / max(y.sum(), 1) * share
    wrong = np.cumsum(1 - y[order]) / max((1 - y).sum(), 1) * (1 - share)
    best = 2 * hit / (hit + wrong + share)
    return float(np.clip(z[order][int(np.argmax(best))] - 1e-9, -3.0, 3.0))


def fit(sample: pd.DataFrame, toxic_share: float) -> dict:
    """Model of a bounded sample with columns text and toxic."""
    texts, y = [_plain(t) for t in sample["text"]], sample["toxic"].to_numpy().astype(int)
    model = {"prior": float(toxic_share)}
    if y.sum() < 2 or (1 - y).sum() < 2:
        return model
    turn = np.zeros(len(y), bool)  # every third text of a class is kept for the calibration
    for label in (0, 1):
        turn[np.flatnonzero(y == label)[2::3]] = True
    own = {c: [t for t, k, held in zip(texts, y, turn) if k == c and not held] for c in (0, 1)}
    shares = {c: _document_shares(own[c]) for c in own}
    marks = _marks(shares[1], len(own[1]), shares[0], len(own[0]))
    ordinary = _dictionary([p for t in own[0] for p in _pieces(t)], ORDINARY)
    books = [ordinary, _dictionary([r for t in own[1] for r in _runs(t, marks)], TOXIC)]
    pair = _pair(books)
    if not turn.any() or len(set(y[turn])) < 2:
        turn[:] = True
    x = np.array([_features(t, pair) for t, held in zip(texts, turn) if held])
    mean, spread = x.mean(0), x.std(0) + 1e-9
    beta = _logistic((x - mean) / spread, y[turn])
    share = min(max(toxic_share, 1e-6), 1 - 1e-6)
    beta[0] += np.log(share / (1 - share)) - _threshold(beta[0] + np.log(share / (1 - share)) + ((x - mean) / spread) @ beta[1:], y[turn], share)
    return model | {"books": [b.hex() for b in books], "mean": mean.tolist(), "spread": spread.tolist(), "beta": beta.tolist()}


def learn(documents: DataFrame, labels: DataFrame, rows_per_class: int = 4_000) -> dict:
    """Fit on at most ``rows_per_class`` rows of each class, those with the smallest hashes of id and text.

    ``labels`` has doc_id and toxic (0 or 1), ``documents`` doc_id and text. The class shares are counted over all
    labels. Ids are drawn from the labels first, so only the drawn texts leave the scan.
    """
    known = labels.where("doc_id is not null").where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n, toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    share = toxic / n if n else 0.0
    mark = F.xxhash64("doc_id", F.lit(17))
    drawn = [known.where(F.col("toxic") == c).orderBy(mark, "doc_id").limit(rows_per_class) for c in (0, 1)]
    drawn = session.stage(drawn[0].unionByName(drawn[1]), "drawn")
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")  # at most 2 * rows_per_class ids
    sample = [rows.where(F.col("toxic") == c).orderBy(mark, F.xxhash64("text"), "text").limit(rows_per_class).select("text", "toxic") for c in (0, 1)]

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"model": [json.dumps(fit(frame, share))]})

    both = sample[0].unionByName(sample[1]).withColumn("one", F.lit(1))
    got = both.groupBy("one").applyInPandas(one, "model string").first()
    return json.loads(got["model"]) if got else {"prior": share}


def score(documents: DataFrame, model: dict, keep: list[str], with_text: bool = False, name: str = "score") -> DataFrame:
    """Columns ``keep`` with the score (0 to 1; column ``name``) of every whole text, and the text itself on request."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair([bytes.fromhex(b) for b in model["books"]]) if "books" in model else None
        if pair:
            mean, spread, beta = (np.array(model[k]) for k in ("mean", "spread", "beta"))
        for batch in batches:
            at = batch.schema.get_field_index("text")
            if pair:
                x = [_features(_plain(t.as_py()), pair) for t in batch.column(at)]
                z = beta[0] + ((np.array(x).reshape(-1, len(mean)) - mean) / spread) @ beta[1:]
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            else:
                p = np.full(batch.num_rows, model["prior"])
            rest = [batch.column(i) for i in range(batch.num_columns) if i != at]
            more, names = ([batch.column(at)], ["text"]) if with_text else ([], [])
            yield pa.RecordBatch.from_arrays([*rest, *more, pa.array(p, pa.float64())], names=[*keep, *names, name])

    rows = documents.select(*keep, "text")
    return rows.mapInArrow(run, rows.select(*keep, *(["text"] if with_text else []), F.lit(0.0).alias(name)).schema)
