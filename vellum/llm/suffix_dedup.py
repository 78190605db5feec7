"""Exact substring dedup by a distributed suffix array.

Every byte covered by a `width`-byte string that also starts anywhere else, in the same text or another,
is removed. All suffixes, cut at `width` bytes, would be width times the input, so they are sorted in
blocks first and one by one only where blocks do not settle them:

1. A window of width bytes is keyed by the least hash of the GRAM-byte strings in it. Neighbouring
   windows whose key is at one place form a unit of two tokens: the key, and the hash of all its bytes.
2. Units are sorted as suffixes of two tokens: splitters sampled from the units range-partition them by
   leading token (then the rest, so equal units can lie in several buckets), each bucket sorts by
   multikey quicksort and compares neighbours; buckets' first and last rows are compared with each other.
   A unit alone with its key holds no repeat. Equal units are repeats throughout.
3. Units that share only their key, and one of each set of equal units beside them, are taken apart into blocks of STEP windows, aligned to the place of
   the key, whose tokens are the hash of the bytes that all of its windows share and that of all its
   bytes; they are sorted and compared alike.
4. The windows of what is left are suffixes whose tokens are the hashes of their two halves.

Tokens are 64-bit hashes from two families with their own tables and bases, the first token from one, the second from the other; a
repeat is one when both agree, 128 bits in all. (Tokens of the text itself would take a row of 200 bytes for each suffix.) Buckets
are numbered by rows that are counted, but for units, which are so many bytes of text each; the sample for the splitters is
one in so many rows by their hashes, MOST_SAMPLED at most.

Nulls: a null text is empty; a null id is kept. Texts under `width` bytes lose nothing. Repeated rows
count as separate texts, so their copies remove each other. No rows in, no rows out. Columns of the
input beyond id and text are carried along in a struct, so their names can't clash. Very long texts are read in pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

GRAM, STEP = 32, 12
ROWS_PER_BUCKET, UNIT_BYTES = 2_000_000, 60
SAMPLED, MOST_SAMPLED = 400, 1_000_000
SMALL = 1 << 12
#: cnt holds the number of windows, plus PACK times the distance from the start of the unit.
PACK = 1 << 16
TOKENS = "t1 long, t2 long, k long, n int, start int, cnt int"
KEY = ("t1", "t2", "k", "start")


def _runs(h: np.ndarray, m: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of each run, inside one text, of windows whose key stands at one
    place: the leftmost, so a run also ends with the window that starts there. Two windows of a run differ."""
    n, sizes = len(m), np.diff(off)
    change = np.zeros(n + 1, np.int32)
    long = sizes >= width
    np.add.at(change, off[:-1][long], 1)
    np.add.at(change, off[1:][long] - width + 1, -1)
    valid = np.cumsum(change[:n]) > 0
    new = np.ones(n, bool)
    new[1:] = (m[1:] != m[:-1]) | (h[: n - 1] == m[:-1])
    new[off[:-1][off[:-1] < n]] = True
    start = np.flatnonzero(new & valid)
    last = valid.copy()
    last[:-1] &= new[1:] | ~valid[1:]
    return start, np.flatnonzero(last) - start + 1


@C.lean
def _units(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[dict[str, np.ndarray]]:
    """Step 1. Long texts go piece by piece."""
    for block in C.blocks(batches):
        whole, offsets = C.text_buffer(block.column("text"))
        keys = block.column("k").to_numpy(zero_copy_only=False)
        pieces = [(0, whole, offsets)] if block.num_rows > 1 else [(p, whole[p : p + C.BLOCK + width - 1], None) for p in range(0, max(1, len(whole) - width + 1), C.BLOCK)]
        for base, data, off in pieces:
            off = np.array([0, len(data)], np.int64) if off is None else off
            if len(data) < width:
                continue
            h = C.rolling_hash(C.prefix_hash(data), GRAM)
            m = C.sliding_min(h, width - GRAM + 1)
            start, count = _runs(h, m, off, width)
            if not len(start):
                continue
            prefix = C.prefix_hash(data, 1)
            doc = np.searchsorted(off, start, "right") - 1
            yield {
                "t1": C.signed(C.mix(m[start])), "t2": C.signed(C.range_hash(prefix, start, start + count + width - 1, 1)), "k": keys[doc],
                "n": (off[doc + 1] - off[doc] if block.num_rows > 1 else np.full(len(doc), len(whole))).astype(np.int32),
                "start": (start - off[doc] + base).astype(np.int32), "cnt": count.astype(np.int32),
            }


def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """The order of rows by their columns, as multikey quicksort finds it: rows are split into those under, at and above a
    pivot of the first column; those at it go on with the next column, the others with the same. Short stretches are sorted
    outright, and their ties go on together."""
    out = np.empty(len(columns[0]), np.int64)
    todo = [(np.arange(len(out)), 0, 0)]  # rows, column, their place in the order
    while todo:
        rows, depth, place = todo.pop()
        v = columns[depth][rows]
        if len(rows) > SMALL:
            some = np.sort(v[:: len(v) // 255])
            pivot = some[len(some) // 2]
            under, at = v < pivot, v == pivot
            a, b = rows[under], rows[at]
            c = rows[~(under | at)]
            todo += [(x, d, p) for x, d, p in ((a, depth, place), (c, depth, place + len(a) + len(b))) if len(x)]
            if depth + 1 < len(columns):
                todo.append((b, depth + 1, place + len(a)))
            else:
                out[place + len(a) : place + len(a) + len(b)] = b
            continue
        order = np.argsort(v, kind="stable")
        rows, v = rows[order], v[order]
        out[place : place + len(rows)] = rows
        if depth + 1 == len(columns) or len(rows) < 2:
            continue
        same = v[1:] == v[:-1]
        if not same.any():
            continue
        tied = np.append(False, same) | np.append(same, False)
        group = np.cumsum(np.append(True, ~same))[tied]
        at = np.flatnonzero(tied)
        out[place + at] = rows[at][np.lexsort([*(c[rows[at]] for c in reversed(columns[depth + 1 :])), group])]
    return out


def _bucket(rows: dict[str, np.ndarray], splitters: list[np.ndarray]) -> np.ndarray:
    """The bucket of each row: the number of splitters that are not above it."""
    n = len(splitters[0])
    at = np.searchsorted(splitters[0], rows["t1"], "left").astype(np.int64)
    live = np.flatnonzero(at < n)
    while len(live):
        above, equal = np.zeros(len(live), bool), np.ones(len(live), bool)
        for name, s in zip(KEY, splitters, strict=True):
            mine, theirs = rows[name][live], s[at[live]]
            above |= equal & (mine > theirs)
            equal &= mine == theirs
        live = live[above | equal]
        at[live] += 1
        live = live[at[live] < n]
    return at.astype(np.int32)


@C.lean
def _sorted_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorts a bucket and keeps the rows whose first token is not alone: state 1, or 2 if both tokens
    agree, 3 if it also stands for its equals in the next comparison. edge is 1 for the bucket's first row, 2 for its last, 3 for both; these are kept always."""
    found = [b for b in batches if b.num_rows]
    if not found:
        return
    whole = pa.Table.from_batches(found).combine_chunks()
    rows = {c: whole.column(c).to_numpy() for c in whole.column_names}
    order = multikey_order([rows[c] for c in KEY])
    rows = {c: v[order] for c, v in rows.items()}
    state = np.zeros(len(order), np.int8)
    same = rows["t1"][1:] == rows["t1"][:-1]
    both = same & (rows["t2"][1:] == rows["t2"][:-1])
    for level, equal in ((1, same), (2, both)):
        state[1:][equal] = level
        state[:-1][equal] = np.maximum(state[:-1][equal], level)
    # of equal rows beside others with their first token, one goes on for those to be compared with
    run = np.cumsum(np.append(True, ~same)) - 1
    mixed = np.bincount(run, weights=np.append(False, same & ~both)) > 0
    mixed[[0, -1]] = True  # as far as this bucket knows
    state[(state == 2) & mixed[run] & np.append(True, ~both)] = 3
    edge = np.zeros(len(order), np.int8)
    edge[0] += 1
    edge[-1] += 2
    keep = (state > 0) | (edge > 0)
    for at in range(0, int(keep.sum()), 100_000):
        i = np.flatnonzero(keep)[at : at + 100_000]
        yield C.batch_of({c: v[i] for c, v in rows.items()} | {"state": state[i], "edge": edge[i]})


def sort_and_compare(source: DataFrame, tokens, total: int, what: str) -> DataFrame:
    """Rows (k, n, start, cnt, base, state): state 1 if another row has the same first token, 2 or 3 if also the second. tokens turns batches of source into rows of TOKENS, total or so of them."""
    spark = source.sparkSession
    n = int(max(C.partitions(spark), total // ROWS_PER_BUCKET))
    one_in = max(1, total // min(MOST_SAMPLED, SAMPLED * n))

    @C.lean
    def sampled(batches):
        for rows in tokens(batches):
            chosen = C.mix(rows["k"].view(np.uint64) + rows["start"].astype(np.uint64)) % np.uint64(one_in) == 0
            yield C.batch_of({c: rows[c][chosen] for c in KEY})

    seen = source.mapInArrow(sampled, "t1 long, t2 long, k long, start int").toArrow()
    known = [seen.column(c).to_numpy() for c in KEY]
    order = multikey_order(known)
    cuts = order[[len(order) * i // n for i in range(1, n)]] if len(order) else order
    splitters = [np.ascontiguousarray(x[cuts]) for x in known]

    @C.lean
    def dealt(batches):
        for rows in tokens(batches):
            yield C.batch_of({"bucket": _bucket(rows, splitters)} | {c: rows[c] for c in ("t1", "t2", "k", "n", "start", "cnt")})

    out = C.cut(source.mapInArrow(dealt, f"bucket int, {TOKENS}").repartitionById(n, F.col("bucket")).mapInArrow(_sorted_bucket, f"bucket int, {TOKENS}, state byte, edge byte"), what)
    ends = out.where("edge > 0")  # two of each bucket; rows with equal tokens in two buckets are at their ends
    apart = lambda *tokens: F.min("bucket").over(Window.partitionBy(*tokens)) < F.max("bucket").over(Window.partitionBy(*tokens))
    ends = ends.withColumn("both", apart("t1", "t2")).withColumn("state", F.greatest("state", F.when(F.col("both"), 3).when(apart("t1"), 1).otherwise(0).cast("byte"))).drop("both")
    out_ = out.where("edge = 0").unionByName(ends).where("state > 0")
    return out_.select("k", "n", "start", (F.col("cnt") % PACK).alias("cnt"), (F.col("start") - F.floor(F.col("cnt") / PACK)).cast("int").alias("base"), F.col("state").cast("int").alias("state"))


@C.lean
def _contents(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The bytes of each unit that its text's row lists."""
    for batch in batches:
        rows: list[tuple] = []
        size = 0
        for k, n, text, units in zip(*(batch.column(c).to_pylist() for c in ("k", "n", "text", "units")), strict=True):
            data = text.encode()
            for u in units:
                rows.append((k, n, u["start"], u["cnt"], data[u["start"] : u["start"] + u["cnt"] + width - 1]))
                size += u["cnt"] + width
                if size > 8 * C.BLOCK:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _CONTENT, strict=True)], names=["k", "n", "start", "cnt", "text"])
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _CONTENT, strict=True)], names=["k", "n", "start", "cnt", "text"])


_CONTENT = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


@C.lean
def _steps(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[dict[str, np.ndarray]]:
    """Step 3."""
    for block in C.blocks(batches):
        data, off = _buffer(block.column("text"))
        k, n, start, count = (block.column(c).to_numpy() for c in ("k", "n", "start", "cnt"))
        prefix = C.prefix_hash(data)
        h = C.rolling_hash(prefix, GRAM)
        m = C.sliding_min(h, width - GRAM + 1)[off[:-1]]  # a unit's windows have one key
        unit = np.repeat(np.arange(len(k)), count)
        at = np.arange(len(unit)) - np.repeat(np.cumsum(count) - count, count) + off[unit]  # the windows' places
        owner = np.repeat(np.arange(len(k)), np.diff(off))[: len(h)]
        place = np.where(h == m[owner], np.arange(len(h)), len(data))
        place = np.minimum.accumulate(place[::-1])[::-1]  # the first place of the key from here on
        anchor = place[at]
        q = (anchor - at) // STEP
        new = np.ones(len(at), bool)
        new[1:] = (unit[1:] != unit[:-1]) | (anchor[1:] != anchor[:-1]) | (q[1:] != q[:-1])
        first = np.flatnonzero(new)
        cnt = np.diff(np.append(first, len(at)))
        lo, q, u = at[first], q[first], unit[first]
        shared = anchor[first] - q * STEP
        t1 = C.mix(C.range_hash(prefix, shared, shared + width - STEP + 1) + q.astype(np.uint64))
        prefix = C.prefix_hash(data, 1)
        yield {
            "t1": C.signed(t1), "t2": C.signed(C.range_hash(prefix, lo, lo + cnt + width - 1, 1)), "k": k[u], "n": n[u],
            "start": (lo - off[u] + start[u]).astype(np.int32), "cnt": (cnt + PACK * (lo - off[u])).astype(np.int32),
        }


@C.lean
def _windows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[dict[str, np.ndarray]]:
    """Step 4."""
    for block in C.blocks(batches):
        data, off = _buffer(block.column("text"))
        k, n, start, count = (block.column(c).to_numpy() for c in ("k", "n", "start", "cnt"))
        prefix = C.prefix_hash(data)
        u = np.repeat(np.arange(len(k)), count)
        at = np.arange(len(u)) - np.repeat(np.cumsum(count) - count, count)
        place, half = at + off[u], width // 2
        first = C.range_hash(prefix, place, place + half)
        prefix = C.prefix_hash(data, 1)
        yield {
            "t1": C.signed(first), "t2": C.signed(C.range_hash(prefix, place + half, place + width, 1)), "k": k[u], "n": n[u],
            "start": (start[u] + at).astype(np.int32), "cnt": np.ones(len(u), np.int32),
        }


def repeated_spans(docs: DataFrame, width: int = 200) -> DataFrame:
    """docs (k, n, text) -> (k, n, spans): for each text that holds repeats, start and length of byte runs
    that cover all of them and nothing else; runs may overlap."""
    size = docs.agg(F.sum("n")).first()[0] or 0
    units = sort_and_compare(docs, lambda b: _units(b, width), size // UNIT_BYTES, "units")
    open_ = units.where("state in (1, 3)")
    windows_in = lambda df: df.agg(F.sum("cnt")).first()[0] or 0
    wide = open_.groupBy("k", "n").agg(F.collect_list(F.struct("start", "cnt")).alias("units"))
    contents = C.cut(docs.join(wide, ["k", "n"]).select("k", "n", "text", "units").mapInArrow(lambda b: _contents(b, width), "k long, n int, start int, cnt int, text binary"), "contents")
    steps = sort_and_compare(contents, lambda b: _steps(b, width), 2 * windows_in(contents) // STEP, "steps")
    last = steps.where("state in (1, 3)")
    both = last.groupBy("k", "n", "base").agg(F.collect_list(F.struct("start", "cnt")).alias("steps"))
    left = contents.select("k", "n", F.col("start").alias("base"), "text").join(both, ["k", "n", "base"]).select("k", "n", "base", "text", F.explode("steps").alias("s"))
    left = left.select("k", "n", F.col("s.start").alias("start"), F.col("s.cnt").alias("cnt"), F.expr(f"substring(text, s.start - base + 1, s.cnt + {width} - 1)").alias("text"))
    left = C.cut(left, "left")
    C.discard(contents)
    windows = sort_and_compare(left, lambda b: _windows(b, width), windows_in(left), "windows")
    C.discard(left)
    found = units.where("state > 1").unionByName(steps.where("state > 1")).unionByName(windows.where("state > 1"))
    return found.groupBy("k", "n").agg(F.collect_list(F.struct("start", (F.col("cnt") + (width - 1)).alias("length"))).alias("spans"))


@C.lean
def _removed(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in C.blocks([batch], limit=16 * C.BLOCK):
            out: list[tuple] = []
            for text, spans in zip(rows.column("text").to_pylist(), rows.column("spans").to_pylist(), strict=True):
                data, removed, runs, end, kept = (text or "").encode(), 0, 0, 0, []
                for lo, hi in sorted((s["start"], s["start"] + s["length"]) for s in spans or ()):
                    if lo > end or not runs:
                        kept.append(data[end:lo])
                        runs += 1
                        end = lo
                    if hi > end:
                        removed += hi - end
                        end = hi
                kept.append(data[end:])
                rest = b"".join(kept)
                out.append((len(data), removed, runs, hashlib.sha256(rest).hexdigest(), (None if text is None else rest.decode(errors="ignore")) if with_text else None))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([rows.column("row"), *(pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True))], names=["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 200, carry: list[str] | None = None, with_text: bool = True) -> DataFrame:
    """One row per row of df: row (a struct of its columns in carry; all but the text by default), n_bytes,
    n_removed, n_spans (maximal removed runs), kept_sha256 and kept_text (what is left; bytes that end up
    outside a whole character are left out of it, though not of kept_sha256; null stays null)."""
    carry = [c for c in df.columns if c != text_col] if carry is None else carry
    text = F.col(f"`{text_col}`").cast("string")
    docs = df.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), text.alias("text"), F.xxhash64(F.col(f"`{id_col}`").cast("string"), text).alias("k"), F.coalesce(F.octet_length(text), F.lit(0)).alias("n"))
    spans = repeated_spans(docs.select("k", "n", "text").where(F.col("n") >= width), width)
    joined = docs.join(spans, ["k", "n"], "left").select("row", "text", "spans")
    row = T.StructField("row", joined.schema["row"].dataType)
    rest = [T.StructField(c, t) for c, t in (("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept_sha256", T.StringType()), ("kept_text", T.StringType()))]
    return joined.mapInArrow(lambda b: _removed(b, with_text), T.StructType([row, *rest]))


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(C.table(spark, sf_dir, "documents"), carry=["doc_id"], with_text=False)
    return out.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
