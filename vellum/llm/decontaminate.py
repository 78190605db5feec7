"""Benchmark decontamination by the q-gram lemma.

Texts and benchmark items are lower-cased, and each run of ASCII signs and white space becomes one space. An item of m bytes is
found in a text if some substring of the text is within k = floor(rate * m) edits of it (fewer for short items:
k is at most (m - Q) // Q, so that the bound below is positive). Such a match shares at least
m - Q + 1 - k * Q q-grams with the item, on diagonals that differ by at most k. So the text's q-grams are looked
up among the items' (a bit table first, then a sorted list), hits are counted by item and band of diagonals,
each band overlapping the next by half, and bands that reach the bound are verified by banded alignment,
which gives the least number of edits. Hits are counted in slices of HITS along the text, and a band is settled as soon as
the text has passed it, so common q-grams take time but no memory.

The items are collected in parts of at most PART_BYTES, each with its own pass over the texts, so that no task
holds more than one part. An item of under Q normalised bytes is found where its words stand as they are, whole words only.
Nulls: a null text is empty; a null item matches nothing, nor does one without letters and digits. Ids may be null or repeated; each row of either table is its own. No rows, no rows. Columns of the
input are carried in a struct, so names can't clash. Long texts go in pieces whose normal forms overlap by two items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

Q, RATE = 8, 0.1
PART_BYTES = 4 << 20
HITS = 1 << 20
#: Bytes of text that are searched at once.
STEP = C.BLOCK // 2
_READ = np.full(256, 32, np.uint8)
_READ[48:58] = np.arange(48, 58)
_READ[97:123] = np.arange(97, 123)
_READ[65:91] = np.arange(97, 123)
_READ[128:] = np.arange(128, 256)


def normal(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's normal form, one space at its start and end; offsets as in text_buffer."""
    read = _READ[data]
    space = read == 32
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    inner = off[1:-1][off[1:-1] < len(data)]
    keep[inner[space[inner]]] = False
    if len(keep) and space[0]:
        keep[0] = False
    kept = np.append(0, np.cumsum(keep))
    out_off = kept[off]
    out = np.full(int(out_off[-1]) + 2 * (len(off) - 1), 32, np.uint8)
    owner = np.searchsorted(off, np.flatnonzero(keep), "right") - 1
    out[np.arange(int(out_off[-1])) + 2 * owner + 1] = read[keep]
    return out, out_off + 2 * np.arange(len(off))


def long_text(data: np.ndarray, overlap: int, step: int = STEP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The normal form of one text in pieces, each after the last overlap bytes of the form before it."""
    held = np.zeros(0, np.uint8)
    for p in range(0, max(1, len(data)), step):
        raw = data[p : p + step]
        core = normal(raw, np.array([0, len(raw)], np.int64))[0][1:-1]
        starts = len(raw) and _READ[raw[0]] == 32 and len(held) and held[-1] != 32
        held = np.concatenate([held[-overlap:], np.full(int(bool(starts)), 32, np.uint8), core if not (len(held) and held[-1] == 32 and len(core) and core[0] == 32) else core[1:]])
        whole = np.concatenate([np.full(1, 32, np.uint8), held, np.full(1, 32, np.uint8)])
        yield whole, np.array([0, len(whole)], np.int64)


def _codes(data: np.ndarray) -> np.ndarray:
    """The Q = 8 bytes from each place on as one number."""
    a = data.astype(np.uint16)
    a = (a[:-1] << np.uint16(8)) | a[1:]
    b = a.astype(np.uint32)
    b = (b[:-2] << np.uint32(16)) | b[2:]
    c = b.astype(np.uint64)
    return (c[:-4] << np.uint64(32)) | c[4:]


class Items:
    """One part of the benchmark, ready to be looked up."""

    def __init__(self, texts: list[str | None], rate: float) -> None:
        data, off = C.text_buffer(pa.array([(t or "").lower() for t in texts], pa.string()))
        data, off = normal(data, off)
        self.texts = [data[a:b].tobytes().strip() for a, b in zip(off[:-1], off[1:], strict=True)]
        m = np.array([len(t) for t in self.texts], np.int64)
        self.size = m
        by_width: dict[int, dict[int, list[int]]] = {}
        for i, t in enumerate(self.texts):
            if 0 < len(t) < Q:
                h = C.rolling_hash(C.prefix_hash(np.frombuffer(b" " + t + b"  ", np.uint8)), len(t) + 2)
                by_width.setdefault(len(t) + 2, {}).setdefault(int(h[0]), []).append(i)
        self.short = {w: (np.array(sorted(found), np.uint64), [found[h] for h in sorted(found)]) for w, found in by_width.items()}
        self.edits = np.maximum(0, np.minimum((rate * m).astype(np.int64), (m - Q) // Q))
        self.bound = m - Q + 1 - self.edits * Q
        self.band = self.edits + 1
        self.longest = int((m + self.edits).max(initial=0))
        codes, owners, places = [], [], []
        for i, t in enumerate(self.texts):
            if len(t) >= Q:
                c = _codes(np.frombuffer(t, np.uint8))
                codes.append(c)
                owners.append(np.full(len(c), i))
                places.append(np.arange(len(c)))
        flat = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.owner = np.concatenate(owners)[order] if codes else flat.astype(np.int64)
        self.place = np.concatenate(places)[order] if codes else flat.astype(np.int64)
        self.codes, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.bits = max(12, int(64 * max(1, len(self.codes))).bit_length())
        self.table = np.zeros(1 << self.bits, bool)
        self.table[self._slot(self.codes)] = True

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def _bands(self, at: np.ndarray, found: np.ndarray, off: np.ndarray, wide: int, solved: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Keys (text, item, band) of the hits of some places, with their counts."""
        times = self.count[found]
        hit = np.repeat(np.arange(len(at)), times)
        entry = self.first[found][hit] + np.arange(len(hit)) - np.repeat(np.cumsum(times) - times, times)
        if solved is not None:
            left = ~solved[self.owner[entry]]
            hit, entry = hit[left], entry[left]
        item = self.owner[entry]
        text = (np.searchsorted(off, at, "right") - 1)[hit]
        band = (at[hit] - self.place[entry] + self.longest) // self.band[item]
        return np.unique((text * len(self.texts) + item) * np.int64(wide) + band, return_counts=True)

    def find(self, data: np.ndarray, off: np.ndarray) -> dict[tuple[int, int], int]:
        """(text, item) -> least edits, over texts in normal form that lie end to end."""
        out = self._short(data, off)
        if len(data) < Q or not len(self.codes):
            return out
        codes = _codes(data)
        at = np.flatnonzero(self.table[self._slot(codes)])
        if not len(at):
            return out
        found = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
        real = self.codes[found] == codes[at]
        at, found = at[real], found[real]
        upto = np.cumsum(self.count[found])
        wide = len(data) + 2 * self.longest + 2
        solved = np.zeros(len(self.texts), bool) if len(off) == 2 else None
        key, count, lo = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        while lo < len(at):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + HITS, "right")))
            more, times = self._bands(at[lo:hi], found[lo:hi], off, wide, solved)
            if len(key):
                more, which = np.unique(np.append(key, more), return_inverse=True)
                times = np.bincount(which, np.append(count, times)).astype(np.int64)
            key, count = more, times
            both = count + np.append(np.where(key[1:] == key[:-1] + 1, count[1:], 0), 0)[: len(key)]
            owner, band = key // wide, key % wide
            item = owner % len(self.texts)
            low = band * self.band[item] - self.longest  # diagonals low to low + 2 bands
            past = low + 2 * self.band[item] + self.size[item] < (at[hi] if hi < len(at) else wide * 2)
            for i in np.flatnonzero(past & (both >= self.bound[item])):
                t, x = int(owner[i]) // len(self.texts), int(item[i])
                if out.get((t, x)) != 0 and (edits := self._verified(data, codes, off, t, x, int(low[i]), out.get((t, x)))) is not None:
                    out[t, x] = edits
                    if solved is not None and not edits:
                        solved[x] = True
            key, count, lo = key[~past], count[~past], hi
        return out

    def _verified(self, data: np.ndarray, codes: np.ndarray, off: np.ndarray, t: int, x: int, low: int, known: int | None) -> int | None:
        """The least edits of item x in text t on the diagonals from low to low + 2 bands, if less than known."""
        k, w, m = int(self.edits[x]), int(self.band[x]), int(self.size[x])
        lo, hi = max(int(off[t]), low), min(int(off[t + 1]) - Q + 1, low + 2 * w + m)
        own = _codes(np.frombuffer(self.texts[x], np.uint8))
        order = np.argsort(own, kind="stable")
        some = codes[lo:hi]
        a, b = np.searchsorted(own[order], some, "left"), np.searchsorted(own[order], some, "right")
        hit = np.repeat(np.arange(len(some)), b - a)
        place = order[np.arange(len(hit)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + a[hit]]
        diagonal = hit + lo - place
        inside = (diagonal >= low) & (diagonal < low + 2 * w)
        if not _reaches(diagonal[inside], place[inside], k, int(self.bound[x])):
            return None
        lo, hi = max(int(off[t]), low - k), min(int(off[t + 1]), low + 2 * w + m + k)
        return least_edits(self.texts[x], data[lo:hi], low - lo, 2 * w, k, k + 1 if known is None else known)

    def _short(self, data: np.ndarray, off: np.ndarray) -> dict[tuple[int, int], int]:
        """Items of under Q bytes, where a space stands at either end."""
        out: dict[tuple[int, int], int] = {}
        if not self.short:
            return out
        prefix = C.prefix_hash(data)
        for width, (hashes, items) in self.short.items():
            h = C.rolling_hash(prefix, width)
            at = np.flatnonzero((data[: len(h)] == 32) & (data[width - 1 :][: len(h)] == 32))
            found = np.minimum(np.searchsorted(hashes, h[at]), len(hashes) - 1)
            same = hashes[found] == h[at]
            for t, i in zip((np.searchsorted(off, at[same], "right") - 1).tolist(), found[same].tolist(), strict=True):
                for x in items[i]:
                    out[t, x] = 0
        return out


def _reaches(diagonal: np.ndarray, place: np.ndarray, k: int, bound: int) -> bool:
    """Whether some k + 1 neighbouring diagonals have hits of at least bound different places of the item."""
    if len(np.unique(place)) < bound:
        return False
    order = np.argsort(diagonal, kind="stable")
    diagonal, place = diagonal[order], place[order]
    stop = np.searchsorted(diagonal, diagonal + k, "right")
    start = np.flatnonzero((stop - np.arange(len(stop)) >= bound) & np.append(True, diagonal[1:] != diagonal[:-1]))
    return any(len(np.unique(place[a : stop[a]])) >= bound for a in start)


def least_edits(item: bytes, window: np.ndarray, diagonal: int, width: int, most: int, under: int) -> int | None:
    """The least edits between item and any substring of window whose alignment starts between diagonal - most and
    diagonal + width + most, if it is under `under` and at most `most`: rows of the band, a row for each byte of item."""
    if item in window.tobytes():
        return 0 if under > 0 else None
    lowest, size = diagonal - most, width + 2 * most + 1
    far = most + 1
    places = np.arange(size) + lowest  # of the window, before the row's byte
    row = np.where((places >= 0) & (places <= len(window)), 0, far)
    padded = np.concatenate([np.zeros(max(0, -lowest) + 1, np.uint8), window, np.zeros(len(item) + size + 2, np.uint8)])
    shift = max(0, -lowest) + 1
    steps = np.arange(size)
    for j, byte in enumerate(item):
        start = lowest + j + shift
        other = padded[start : start + size] != byte
        inside = (places + j >= 0) & (places + j < len(window))
        new = np.where(inside, row + other, far)  # take a byte of both
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)  # skip the item's byte
        new = np.minimum.accumulate(new - steps) + steps  # skip bytes of the window
        row = np.where((places + j + 1 >= 0) & (places + j + 1 <= len(window)), np.minimum(new, far), far)
        if row.min() >= min(far, under):
            return None
    best = int(row.min())
    return best if best < under and best <= most else None


def matches(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "text", item_id: str = "item_id", carry: list[str] | None = None, rate: float = RATE) -> DataFrame:
    """(row, matches) for each row of df: row is a struct of its columns in carry (all by default), matches an
    array of (item_id, edits), by item and edits."""
    spark = df.sparkSession
    items = benchmark.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_col}`").cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + int(total // (PART_BYTES // 2))
    carry = df.columns if carry is None else carry
    row = F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")
    source = df.select(row, F.lower(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("text"))
    kind = T.ArrayType(T.StructType([T.StructField("item_id", items.schema["item_id"].dataType), T.StructField("edits", T.IntegerType())]))
    for part in range(parts):
        chosen = items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == part).toArrow()  # PART_BYTES or so
        held = spark.sparkContext.broadcast((chosen.column("text").to_pylist(), chosen.column("item_id").to_pylist()))
        arrow = pa.list_(pa.struct([("item_id", chosen.schema.field("item_id").type), ("edits", pa.int32())]))
        source = _pass(source, held, arrow, kind, rate)
    return source.select("row", "matches")


def _pass(source: DataFrame, held, arrow: pa.DataType, kind: T.ArrayType, rate: float) -> DataFrame:
    again = "matches" in source.columns

    @C.lean
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, ids = held.value
        items = Items(texts, rate)
        for block in C.blocks(batches, limit=STEP):
            data, off = C.text_buffer(block.column("text"))
            found: dict[tuple[int, int], int] = {}
            for part, ends in [normal(data, off)] if block.num_rows > 1 else long_text(data, 2 * items.longest + Q):
                for k, v in items.find(part, ends).items():
                    found[k] = min(v, found.get(k, v))
            out = block.column("matches").to_pylist() if again else [[] for _ in range(block.num_rows)]
            for (t, x), edits in found.items():
                out[t].append({"item_id": ids[x], "edits": edits})
            for x in out:
                x.sort(key=lambda m: (m["item_id"] is not None, m["item_id"], m["edits"]))
            yield pa.RecordBatch.from_arrays([block.column("row"), block.column("text"), pa.array(out, arrow)], names=["row", "text", "matches"])

    return source.mapInArrow(search, T.StructType([source.schema["row"], T.StructField("text", T.StringType()), T.StructField("matches", kind)]))


def clean(df: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of df that hold no item of the benchmark."""
    return matches(df, benchmark, **options).where(F.size("matches") == 0).select("row.*")


def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = matches(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select("row.doc_id", F.explode("matches").alias("m")).select("doc_id", "m.item_id", "m.edits")
