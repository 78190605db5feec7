"""Quality classifier: hashed word n-gram logistic regression, trained follow-the-regularised-leader.

Words are maximal runs of letters (ASCII letters and all bytes beyond ASCII), of digits (each read as 0) or of
other signs; white space separates. Words and pairs of neighbouring words are hashed to 2 ** BITS weights (all
pairs of a word with itself to one); a text's score is the logistic of the bias and the sum of its features' weights over the square root of their
number, a sparse dot product over the whole text. Weights are learnt in numpy with per-coordinate FTRL-proximal
steps from at most max_rows labelled rows, and at most max_features features in all (the rows with the least hashes of id and
text; rows equal in both count once). Very long texts are read in pieces, each from the last word of the piece before.

Nulls: a null text is empty; an empty text has the bias alone; null ids and labels are not learnt from; several
labels of one id are averaged. Without labels every score is 0.5. Repeated rows get the same score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C
from .langid import bounded, least_keys, remainder

BITS = 18
_CLASS = np.full(256, 3, np.uint8)
_CLASS[:33] = 0
_CLASS[48:58] = 2
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = 1
_READ = np.arange(256, dtype=np.uint8)
_READ[48:58] = 48
_PAIR = np.uint64(0xA0761D6478BD642F)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


def features(data: np.ndarray, off: np.ndarray, known: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(owners, buckets) of all features of the texts that lie end to end in data, by owner within words and pairs. The first
    `known` words are only there for their pairs."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, end = words(data, off)
    hashes = C.range_hash(C.prefix_hash(_READ[data]), start, end)
    owner = np.searchsorted(off, start, "right") - 1
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    pairs = C.mix(hashes[pair] * _PAIR + hashes[pair + 1])
    pairs[hashes[pair] == hashes[pair + 1]] = _PAIR  # any word twice in a row is one feature
    shift = np.uint64(64 - BITS)
    return np.append(owner[known:], owner[pair]), np.append(hashes[known:] >> shift, pairs >> shift).astype(np.int64)


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts that lie end to end."""
    kind = _CLASS[data]
    new = np.ones(len(data), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[off[:-1][off[:-1] < len(data)]] = True
    edges = np.append(np.flatnonzero(new), len(data))
    word = kind[edges[:-1]] > 0
    return edges[:-1][word], edges[1:][word]


def _pieces(block: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """A block's texts; one very long text in pieces that end where a word ends, each after the word before it (1, else 0)."""
    data, off = C.text_buffer(block.column("text"))
    if block.num_rows > 1 or len(data) <= 2 * C.BLOCK:
        yield data, off, 0
        return
    at, before = 0, 0  # from before on stands the last word of what came
    while at < len(data):
        end = min(len(data), at + C.BLOCK)
        while end < len(data) and _CLASS[data[end]] == _CLASS[data[end - 1]]:  # to the end of what it would cut
            more = np.flatnonzero(_CLASS[data[end : end + C.BLOCK]] != _CLASS[data[end - 1]])
            end += int(more[0]) if len(more) else len(data[end : end + C.BLOCK])
        piece = data[before:end]
        one = np.array([0, len(piece)], np.int64)
        yield piece, one, int(before < at)
        start = words(piece, one)[0]
        at, before = end, before + int(start[-1]) if len(start) else end


@C.lean
def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row that the task has not seen as its distinct buckets and their values."""
    seen: set[int] = set()
    for block in C.blocks(batches):
        keys = block.column("key").to_pylist()
        fresh = [i for i, k in enumerate(keys) if k not in seen and not seen.add(k)]  # as many as rows to learn from
        if not fresh:
            continue
        block = block.take(pa.array(fresh, pa.int32()))
        total = [np.zeros(0, np.int64)] * block.num_rows
        for data, off, known in _pieces(block):
            owner, bucket = features(data, off, known)
            order = np.argsort(owner, kind="stable")
            cuts = np.searchsorted(owner[order], np.arange(block.num_rows + 1))
            for i in range(block.num_rows):
                total[i] = np.append(total[i], bucket[order[cuts[i] : cuts[i + 1]]])
        found = [np.unique(x, return_counts=True) for x in total]
        yield pa.RecordBatch.from_arrays([block.column("key"), block.column("label"), pa.array([x[0].astype(np.int32) for x in found], pa.list_(pa.int32())), pa.array([(x[1] / max(1, x[1].sum()) ** 0.5).astype(np.float32) for x in found], pa.list_(pa.float32()))], names=["key", "label", "buckets", "values"])


def fit(df: DataFrame, labels: DataFrame, learn: Column, label_col: str, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 12000, max_features: int = 16_000_000, epochs: int = 3, alpha: float = 0.1, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05) -> Model:
    """labels (id_col, label_col: 0 or 1); learns from the ids where learn holds, at most max_rows rows of df with at most
    max_features features."""
    chosen = labels.where(learn & F.col(f"`{label_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.avg(F.col(f"`{label_col}`")).alias("label"))
    chosen = chosen.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(max_rows)
    texts = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").select(F.xxhash64(F.col("id").cast("string"), "text").alias("key"), "label", "text")  # max_rows ids and labels at most
    rows = rows.where(F.col("key") <= F.lit(least_keys(rows, max_rows)))  # an id may have many rows
    found = bounded(rows.mapInArrow(_examples, "key long, label double, buckets array<int>, values array<float>"), "buckets", max_features)
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    zb = nb = bias = 0.0
    y = found.column("label").to_pylist()
    rows = C.list_rows(found, "buckets", "values")
    order = sorted(range(len(y)), key=lambda i: (len(rows[i][0]), float(rows[i][0].sum()), y[i]))  # Spark's order of rows may change
    rng = np.random.default_rng(11)

    def weights_at(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        return np.where(np.abs(zi) > l1, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2), 0.0)

    for _ in range(epochs):
        for k in rng.permutation(order):
            i, x = rows[k]
            w = weights_at(i)
            bias = -zb / ((beta + nb**0.5) / alpha)
            p = 1 / (1 + np.exp(-np.clip(w @ x + bias, -35, 35)))
            g = (p - y[k]) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha * w
            n[i] += g * g
            gb = float(p - y[k])
            zb += gb - ((nb + gb * gb) ** 0.5 - nb**0.5) / alpha * bias
            nb += gb * gb
    return Model(weights_at(np.arange(1 << BITS)).astype(np.float32), float(-zb / ((beta + nb**0.5) / alpha)))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """(id, the columns of more, score) for each row of df."""
    source = df.select(F.col(f"`{id_col}`").alias("id"), *[v.alias(k) for k, v in more.items()], F.col(f"`{text_col}`").cast("string").alias("text"))
    kept = ["id", *more]

    @C.lean
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in C.blocks(batches):
            total, count = np.zeros(block.num_rows), np.zeros(block.num_rows)
            for data, off, known in _pieces(block):
                owner, bucket = features(data, off, known)
                total += np.bincount(owner, model.weights[bucket], block.num_rows)
                count += np.bincount(owner, minlength=block.num_rows)
            logit = model.bias + total / np.sqrt(np.maximum(count, 1))
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in kept), pa.array(1 / (1 + np.exp(-np.clip(logit, -35, 35))))], names=[*kept, "score"])

    return source.mapInArrow(compute, T.StructType([*(T.StructField(c, source.schema[c].dataType) for c in kept), T.StructField("score", T.DoubleType())]))


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels")
    model = fit(docs, labels, F.coalesce(remainder("doc_id", 5) != 0, F.lit(False)), "quality")
    out = score(docs, model, held_out=F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)))
    return out.select(F.col("id").alias("doc_id"), "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
