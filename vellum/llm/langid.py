"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text's subwords are the byte 2-, 3- and 4-grams of its lower-cased words, a space standing for each end of a
word; each is hashed to one of 2 ** BITS embeddings. The mean embedding goes through a linear softmax. Both are
trained together by stochastic gradient descent in numpy, on at most max_rows labelled rows, and at most max_features
subwords in all (the rows with the least hashes of id and text; rows equal in both count once). A fifth of these is set aside to
calibrate: a temperature that minimises the log loss, and the confidence under which a prediction is rejected: the
least one with the fewest mistakes on the set-aside rows, where a wrong prediction that is kept and a right one that is
rejected count alike. As all is linear up to the softmax, scoring adds up one row of
embeddings @ weights for each subword of the whole text.

Nulls: a text that is null or has no letter is `und`, with score 0, and rejected; a null id is neither held out
nor learnt from, and null languages are not learnt. Without a learnt language all rows are `und`. Repeated
rows get the same prediction; of languages with equal scores the first by name is predicted. Long texts are scored piece by piece.
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

BITS, SIZES, DIMENSIONS = 17, (2, 3, 4), 16
UNKNOWN = "und"
_KEPT = np.full(256, 32, np.uint8)
_KEPT[97:123] = np.arange(97, 123)
_KEPT[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    scores: np.ndarray  # (2 ** BITS, languages): embeddings @ weights / temperature
    bias: np.ndarray
    threshold: float


def subwords(data: np.ndarray, count: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, buckets) of the subwords that start in the first count bytes. data: lower-cased UTF-8, a space
    at both ends of each text, so that no subword reaches across texts."""
    data = _KEPT[data]
    count = len(data) if count is None else count
    letter = data != 32
    for size in SIZES:
        n = min(count, len(data) - size + 1)
        if n <= 0:
            continue
        inner = letter[1 : n + 1].copy() if size > 2 else letter[:n] | letter[1 : n + 1]
        for k in range(2, size - 1):
            inner &= letter[k : n + k]
        at = np.flatnonzero(inner)
        code = np.full(len(at), size, np.uint64)
        for k in range(size):
            code = (code << np.uint64(8)) | data[at + k]
        yield at, ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int32)


def _prepared(df: DataFrame, text_col: str, **more: Column) -> DataFrame:
    text = F.col(f"`{text_col}`").cast("string")
    return df.select(*[v.alias(k) for k, v in more.items()], F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("has_letter"), F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" ")).alias("text"))


@C.lean
def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text that the task has not seen as its distinct buckets and their shares."""
    seen: set[tuple[int, str]] = set()
    for block in C.blocks(batches):
        data, off = C.text_buffer(block.column("text"))
        rows = []
        for key, lang, lo, hi in zip(block.column("key").to_pylist(), block.column("lang").to_pylist(), off[:-1], off[1:], strict=True):
            if (key, lang) in seen:
                continue
            seen.add((key, lang))  # as many as rows to learn from
            total = np.zeros(1 << BITS, np.int64)
            for p in range(lo, hi, C.BLOCK):
                for _, b in subwords(data[p : min(hi, p + C.BLOCK + 3)], min(hi - p, C.BLOCK)):
                    total += np.bincount(b, minlength=1 << BITS)
            at = np.flatnonzero(total)
            rows.append((key, lang, at.astype(np.int32), (total[at] / max(1, total.sum())).astype(np.float32)))
        if rows:
            kinds = (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["key", "lang", "buckets", "shares"])


def least_keys(keys: DataFrame, most: int) -> int | None:
    """The greatest of the `most` least distinct values of key; null without rows. Equal keys are counted once before the shuffle."""
    return keys.select("key").distinct().orderBy("key").limit(most).agg(F.max("key")).first()[0]


def bounded(found: DataFrame, size: str, most: int) -> pa.Table:
    """The rows of found (key, ...), one of each key, in order of key, as far as the sizes of their lists add up to `most`."""
    held = C.cut(found.dropDuplicates(["key"]), "features")
    sizes = held.select("key", F.size(size).alias("n")).toArrow().sort_by("key")  # a row for each row to learn from
    upto = np.cumsum(sizes.column("n").to_numpy())
    n = int(np.searchsorted(upto, most, "right"))
    last = sizes.column("key")[n - 1].as_py() if n else None
    return held.where(F.col("key") <= F.lit(last).cast("bigint")).toArrow().sort_by("key")


def fit(df: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = 3000, max_features: int = 16_000_000, epochs: int = 5, rate: float = 0.5) -> Model:
    """Learns from the rows of df where learn holds, at most max_rows of them, with at most max_features subwords."""
    able = df.where(learn & F.col(f"`{lang_col}`").isNotNull()).withColumn("key", F.xxhash64(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`").cast("string"), F.col(f"`{lang_col}`").cast("string")))
    last = least_keys(able, max_rows)  # hashes alone are sorted, not texts
    rows = _prepared(able.where(F.col("key") <= F.lit(last)), text_col, lang=F.col(f"`{lang_col}`").cast("string"), key=F.col("key")).where("has_letter")
    found = bounded(rows.select("key", "lang", "text").mapInArrow(_features, "key long, lang string, buckets array<int>, shares array<float>"), "buckets", max_features)
    langs = found.column("lang").to_pylist()
    names = tuple(sorted(set(langs)))
    if not names:
        return Model((), np.zeros((1 << BITS, 0), np.float32), np.zeros(0), 0.0)
    y = np.array([names.index(x) for x in langs])
    flat = C.list_rows(found, "buckets", "shares")
    rng = np.random.default_rng(7)
    order_ = rng.permutation(len(y))
    aside, train = (order_[: len(y) // 5], order_[len(y) // 5 :]) if len(y) >= 20 else (order_, order_)
    emb = rng.normal(0, 0.1, (1 << BITS, DIMENSIONS)).astype(np.float32)
    weights = rng.normal(0, 0.1, (DIMENSIONS, len(names))).astype(np.float32)
    bias = np.zeros(len(names), np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(train):
            idx, share = flat[i]  # each bucket once, so plain indexing adds up
            hidden = share @ emb[idx]
            p = _softmax((hidden @ weights + bias)[None])[0]
            p[y[i]] -= 1
            back = weights @ p
            weights -= step * np.outer(hidden, p)
            bias -= step * 0.1 * p
            emb[idx] -= step * 20 * share[:, None] * back
    scores = (emb @ weights).astype(np.float64)
    logits = np.array([(scores[b] * s[:, None]).sum(axis=0) for b, s in (flat[i] for i in aside)]).reshape(len(aside), len(names)) + bias
    heats = np.geomspace(0.25, 8, 41)
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(aside)), y[aside]], 1e-12)).mean() for t in heats]
    heat = heats[int(np.argmin(loss))]
    p = _softmax(logits / heat)
    del found, flat, emb
    C.give_back()  # the driver's, too
    return Model(names, (scores / heat).astype(np.float32), bias / heat, rejection(p.max(axis=1), p.argmax(axis=1) == y[aside]))


def rejection(confidence: np.ndarray, right: np.ndarray) -> float:
    """The least confidence to keep: of all with the fewest right ones under it and wrong ones from it on, the least."""
    order = np.argsort(confidence, kind="stable")
    mistakes = np.append(0, np.cumsum(right[order])) + (~right).sum() - np.append(0, np.cumsum(~right[order]))
    cut = np.append(True, np.diff(confidence[order], append=np.inf) > 0)  # equal ones go together
    k = int(np.flatnonzero(cut)[np.argmin(mistakes[cut])])
    return float(np.nextafter(confidence[order][k - 1], 2)) if k else 0.0


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def logits(model: Model, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The logits of texts that lie end to end in data."""
    sums, counts = np.zeros((len(off) - 1, len(model.languages))), np.zeros(len(off) - 1, np.int64)
    step = len(data) if len(off) > 2 else C.BLOCK
    for p in range(0, len(data), max(1, step)):
        for at, buckets in subwords(data[p : p + step + 3], min(step, len(data) - p)):
            if not len(at):
                continue
            edge = np.searchsorted(at + p, off)
            some = np.flatnonzero(edge[1:] > edge[:-1])
            sums[some] += np.add.reduceat(model.scores[buckets], edge[some], axis=0)
            counts += np.diff(edge)
    return sums / np.maximum(counts, 1)[:, None] + model.bias


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """(id, the columns of more, lang_pred, score, rejected) for each row of df."""
    source = _prepared(df, text_col, id=F.col(f"`{id_col}`"), **more)
    kept = ["id", *more]

    @C.lean
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in C.blocks(batches):
            data, off = C.text_buffer(block.column("text"))
            has = block.column("has_letter").to_numpy(zero_copy_only=False)
            if model.languages:
                p = _softmax(logits(model, data, off))
                best, score = p.argmax(axis=1), p.max(axis=1)
            else:
                has, best, score = np.zeros(len(has), bool), np.zeros(len(has), int), np.zeros(len(has))
            names = np.array([*model.languages, UNKNOWN], object)
            score = np.where(has, score, 0.0)
            out = [names[np.where(has, best, len(model.languages))], score, ~has | (score < model.threshold)]
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in kept), pa.array(out[0], pa.string()), pa.array(out[1], pa.float64()), pa.array(out[2], pa.bool_())], names=[*kept, "lang_pred", "score", "rejected"])

    schema = T.StructType([*(T.StructField(c, source.schema[c].dataType) for c in kept), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return source.mapInArrow(predict, schema)


def keep_identified(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of df whose language is predicted and not rejected, by a model learnt from df itself."""
    model = fit(df, F.lit(True), id_col, text_col, lang_col)
    return identify(df, model, id_col, text_col, row=F.struct(*[F.col(f"`{c}`") for c in df.columns])).where("not rejected").select("row.*")


def remainder(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; null for a null id."""
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % parts


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = fit(docs, F.coalesce(remainder("doc_id", 4) != 2, F.lit(False)))
    return identify(docs, model, held_out=held).withColumnRenamed("id", "doc_id")
