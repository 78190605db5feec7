"""SimHash near-dedup by tiled exact comparison.

A text's fingerprint has a bit for each bit of its shingles' 64-bit hashes: 1 where over half of them are 1.
Distinct fingerprints are ordered by population count and cut into tiles; every pair of tiles is compared
whole, with numpy's exclusive or and bit counts, but for pairs whose population counts differ beyond the
radius, which can't hold a link. A tile's links leave it as a spanning forest, never as all pairs; connected
components make the groups. Tiles number about the square root of the fingerprints over SPREAD, and the rows
of a tile are streamed past the tile that they are compared with, so a task holds one tile.

Nulls: a null text is empty; empty texts have fingerprint zero and are linked like others. Null ids take part,
but a component's id is its smallest id that isn't null. Repeated rows share a fingerprint. No rows, no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C
from .components import components, join_least

SPREAD = 16
LEAST_BITS, MOST_BITS = 256, 1 << 18
#: Near copies: forests of a block's likeliest pairs, blocks of a text that these are taken of, and rows of a block at most.
FORESTS, BLOCKS, ROWS = 2, 2, 20_000
#: Keys of a bucket, about. Shingles are counted in one of SHARE texts, or in COUNTED if these are more; FREQUENT of them hold a
#: frequent one, of which OFTEN are told at most.
KEYS, COUNTED, SHARE, FREQUENT, OFTEN = 1 << 20, 1 << 13, 16, 3, 1 << 20
SEED = 42
_BYTES = np.uint64(0x0101010101010101)
PART = 1 << 16


def _shingles(text: bytes, size: int) -> Iterator[np.ndarray]:
    """The hashes of a text's shingles, at most PART at a time: repeats included, the whole if it is shorter."""
    words = text.lower().split()  # of bytes: only A-Z change, and only ASCII white space separates
    if not words:
        return
    whole, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        yield np.array([hashed(whole, SEED)], np.uint64)
        return
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    for at in range(0, len(words) - size + 1, PART):
        pairs = zip(starts[at : at + PART].tolist(), ends[at + size - 1 : at + PART + size - 1].tolist(), strict=False)
        yield np.fromiter([hashed(whole[a:b], SEED) for a, b in pairs], np.uint64)


def _bit_counts(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each run of hashes from starts, how many have each of the 64 bits: 255 at a time, eight bits at once."""
    sizes = np.diff(np.append(starts, len(hashes)))
    parts = -(-sizes // 255)
    run = np.repeat(np.arange(len(starts)), parts)
    cuts = starts[run] + 255 * (np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts))
    first = np.cumsum(parts) - parts
    out = np.empty((len(starts), 8, 8), np.int64)
    for j in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(j)) & _BYTES, cuts)
        out[:, :, j] = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8), first, axis=0, dtype=np.int64)
    return out.reshape(len(starts), 64)


def fingerprints_of(texts: list[bytes], size: int, words: int = 1) -> np.ndarray:
    """(n, words) fingerprints; the bits beyond the first 64 come from a bijection of the hashes."""
    out = np.zeros((len(texts), words), np.uint64)
    counts = np.zeros((len(texts), words, 64), np.int64)
    totals = np.zeros(len(texts), np.int64)
    pending: list[np.ndarray] = []
    owners: list[int] = []

    def add() -> None:
        if pending:
            hashes, starts = np.concatenate(pending), np.cumsum([0, *map(len, pending[:-1])])
            for w in range(words):
                np.add.at(counts[:, w], owners, _bit_counts(hashes, starts))
                hashes = C.mix(hashes)
            np.add.at(totals, owners, [len(x) for x in pending])
        pending.clear()
        owners.clear()

    for i, text in enumerate(texts):
        for part in _shingles(text, size):
            pending.append(part)
            owners.append(i)
            if len(pending) > 256 or len(part) == PART:
                add()
    add()
    bits = (2 * counts > totals[:, None, None]).astype(np.uint8)
    out[:] = np.packbits(bits.reshape(len(texts), words, 64), axis=2, bitorder="little").view(np.uint64).reshape(len(texts), words)
    return out


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, words: int = 1) -> DataFrame:
    """(id, f0, f1, ...): the fingerprint of each row of df in 64-bit words."""
    source = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    names = [f"f{w}" for w in range(words)]

    @C.lean
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in C.blocks(batches, limit=4 * C.BLOCK):
            found = fingerprints_of([(x or "").encode() for x in block.column("text").to_pylist()], size, words)
            yield pa.RecordBatch.from_arrays([block.column("id"), *(pa.array(C.signed(found[:, w])) for w in range(words))], names=["id", *names])

    return source.mapInArrow(compute, T.StructType([T.StructField("id", source.schema["id"].dataType), *(T.StructField(c, T.LongType()) for c in names)]))


def _hex(names: list[str]):
    return F.lower(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in names]))


def _tiles(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int]]:
    """(least, greatest population count, part, parts): neighbouring counts share a tile up to size rows;
    a count with more rows is cut into parts."""
    out, group, held = [], [], 0
    for p in sorted(histogram):
        if group and held + histogram[p] > size:
            out.append((group[0], group[-1], 0, 1))
            group, held = [], 0
        if histogram[p] > size:
            parts = -(-histogram[p] // size)
            out += [(p, p, i, parts) for i in range(parts)]
        else:
            group.append(p)
            held += histogram[p]
    return [*out, (group[0], group[-1], 0, 1)] if group else out


def _sent(tiles: list[tuple[int, int, int, int]], radius: int) -> list[list[int]]:
    """For each tile, the tiles whose tasks need its rows: its own, and for each pair within the radius one of the two."""
    out: list[list[int]] = [[t] for t in range(len(tiles))]
    for a in range(len(tiles)):
        for b in range(a + 1, len(tiles)):
            if tiles[b][0] - tiles[a][1] <= radius:
                host, guest = (a, b) if (a + b) % 2 == 0 else (b, a)
                out[guest].append(host)
    return out


def _near(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into a, into b) of rows within the radius; of one tile with itself only b after a."""
    step = max(1, (1 << 18) // max(1, len(b)))
    for at in range(0, len(a), step):
        c = np.bitwise_count(a[at : at + step, 0, None] ^ b[None, :, 0])
        for w in range(1, a.shape[1]):
            c = c + np.bitwise_count(a[at : at + step, w, None] ^ b[None, :, w])
        near = c <= radius
        if near.any():
            i, j = np.nonzero(near)
            i += at
            if same:
                i, j = i[i < j], j[i < j]
            yield i, j


class _Union:
    """Groups of rows: union() gives the pairs that joined two."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def union(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        joined: list[int] = []
        for lo in range(0, len(i), 4096):
            while not np.array_equal(flat := self.up[self.up], self.up):
                self.up = flat
            apart = lo + np.flatnonzero(flat[i[lo : lo + 4096]] != flat[j[lo : lo + 4096]])
            up = self.up
            for k, a, b in zip(apart.tolist(), i[apart].tolist(), j[apart].tolist(), strict=True):
                while up[a] != a:
                    a = up[a]
                while up[b] != b:
                    b = up[b]
                if a != b:
                    up[max(a, b)] = min(a, b)
                    joined.append(k)
        return np.array(joined, np.int64)


@C.lean
def _linked(batches: Iterator[pa.RecordBatch], radius: int, words: int) -> Iterator[pa.RecordBatch]:
    """Rows of one tile's task, its own first, then the others': a forest over all that are linked through it. Links are
    joined as they are found; what is held is the tile, a batch of others, and the forest."""
    own: list[np.ndarray] = []
    mine, groups = None, None

    def edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return C.batch_of({f"a{w}": C.signed(a[:, w]) for w in range(words)} | {f"b{w}": C.signed(b[:, w]) for w in range(words)})

    def joined(i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows of the tile."""
        if len(k := groups.union(i, j)):
            yield edges(mine[i[k]], mine[j[k]])

    def settle() -> Iterator[pa.RecordBatch]:
        nonlocal mine, groups
        if mine is None:
            mine = np.concatenate(own)
            groups = _Union(len(mine))
            for i, j in _near(mine, mine, radius, True):
                yield from joined(i, j)

    for batch in batches:
        guest = batch.column("guest").to_numpy()
        rows = np.stack([batch.column(f"f{w}").to_numpy().view(np.uint64) for w in range(words)], axis=1)
        if (guest == 0).any():
            own.append(rows[guest == 0])
        if (others := rows[guest == 1]).size:
            yield from settle()
            for lo in range(0, len(others), 4096):
                part = others[lo : lo + 4096]
                hook = np.full(len(part), -1)  # the first row of the tile that each is linked to
                for i, j in _near(mine, part, radius, False):
                    fresh = np.flatnonzero(hook[j] < 0)
                    at, where = np.unique(j[fresh], return_index=True)
                    hook[at] = i[fresh[where]]
                    if len(at):
                        yield edges(mine[hook[at]], part[at])
                    yield from joined(i, hook[j])  # all rows that one guest links are linked
    if own:
        yield from settle()


def _dealt(prints: DataFrame, names: list[str], radius: int) -> DataFrame:
    """(task, guest, f0, ...): the rows that each tile's task needs, its own first."""
    count = sum((F.bit_count(c) for c in names[1:]), F.bit_count(names[0])).cast("int")
    distinct = prints.select(*names, count.alias("pop"))
    histogram = {r["pop"]: r["count"] for r in distinct.groupBy("pop").count().collect()}  # 64 * words + 1 rows at most
    tiles = _tiles(histogram, max(256, int(SPREAD * sum(histogram.values()) ** 0.5)))
    sent = _sent(tiles, radius)
    first = {p: k for k, (lo, hi, part, _) in enumerate(tiles) if part == 0 for p in range(lo, hi + 1)}
    n = max(1, len(tiles))

    @C.lean
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [batch.column(c).to_numpy() for c in names]
            pops = batch.column("pop").to_numpy()
            tile = np.array([first[p] for p in pops.tolist()], np.int64)
            parts = np.array([t[3] for t in tiles], np.int64)[tile]
            tile += (C.mix(rows[0].view(np.uint64)) % parts.astype(np.uint64)).astype(np.int64)
            for t in np.unique(tile):
                at = np.flatnonzero(tile == t)
                to = np.array(sent[t], np.int32)
                for lo in range(0, len(at), max(1, 200_000 // len(to))):
                    i = np.tile(at[lo : lo + max(1, 200_000 // len(to))], len(to))
                    task = np.repeat(to, len(i) // len(to))
                    yield C.batch_of({"task": task, "guest": (task != t).astype(np.int8)} | {c: r[i] for c, r in zip(names, rows, strict=True)})

    longs = ", ".join(f"{c} long" for c in names)
    return distinct.mapInArrow(deal, f"task int, guest byte, {longs}").repartitionById(n, F.col("task")).sortWithinPartitions("task", "guest")


def links(prints: DataFrame, radius: int, words: int = 1) -> DataFrame:
    """(a, b): hexadecimal fingerprints of distinct rows (f0, ...) of prints, a forest that connects just those
    that links within the radius connect."""
    names = [f"f{w}" for w in range(words)]
    dealt = _dealt(prints, names, radius)
    ends = [f"{s}{w}" for s in "ab" for w in range(words)]
    found = dealt.mapInArrow(lambda b: _linked(b, radius, words), ", ".join(f"{c} long" for c in ends))
    return found.select(_hex(ends[:words]).alias("a"), _hex(ends[words:]).alias("b"))


# --- near copies at a similarity: rare shingles that two texts must share say which fingerprints meet, fingerprints choose
# pairs of these, bitmaps of the shingles reject most that fall short


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """A set of shingles as 64-bit words: a bit for each value of its hash's low bits, LEAST_BITS at least and four to eight
    a shingle, up to MOST_BITS. A bit that one set has and another lacks is a shingle that the other lacks."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << int(4 * len(shingles)).bit_length()))
    out = np.zeros(bits, np.uint8)
    out[(C.mix(shingles) & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").view(np.uint64)


def frequent(texts: DataFrame, total: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, counts) of shingles that FREQUENT or more of the counted ones of total texts (t, text) hold. It only says which
    shingles are taken as keys last: any order gives the same pairs, and this one few keys that many texts share."""

    @C.lean
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in C.blocks(batches, limit=4 * C.BLOCK):
            sets = [np.unique(np.concatenate([np.zeros(0, np.uint64), *_shingles((x or "").encode(), size)])) for x in block.column("text").to_pylist()]
            yield C.batch_of({"h": C.signed(np.concatenate(sets))})

    some = texts.where(F.pmod("t", F.lit(max(1, min(SHARE, total // COUNTED)))) == 0).dropDuplicates(["t"])
    counts = some.mapInArrow(compute, "h long").groupBy("h").count().where(F.col("count") >= FREQUENT)
    counts = counts.orderBy(F.desc("count"), "h").limit(OFTEN).toArrow()
    hashes = counts.column("h").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], counts.column("count").to_numpy()[order]


def keys(shingles: np.ndarray, order: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The first of a set's shingles, in ascending order of the set, in that order of all shingles: so many that sets of the
    similarity have at least one in common, as either holds that share of the other."""
    often, count = order
    if len(often) and len(shingles):
        at = np.minimum(np.searchsorted(often, shingles), len(often) - 1)
        shingles = shingles[np.argsort(np.where(often[at] == shingles, count[at], 0), kind="stable")]
    return shingles[: len(shingles) - math.ceil(similarity * len(shingles) - 1e-9) + 1]


@C.lean
def _sketches(batches: Iterator[pa.RecordBatch], size: int, words: int, order, similarity: float) -> Iterator[pa.RecordBatch]:
    """(t, f0, ..., n, bits, keys) of each text that the task has not seen yet: fingerprint, shingles in its set, bitmap, keys."""
    seen: set[int] = set()
    for block in C.blocks(batches, limit=4 * C.BLOCK):
        fresh = []
        for i, t in enumerate(block.column("t").to_pylist()):
            if t not in seen:
                fresh.append(i)
                if len(seen) < 1_000_000:
                    seen.add(t)
        if not fresh:
            continue
        block = block.take(pa.array(fresh, pa.int32()))
        texts = [(x or "").encode() for x in block.column("text").to_pylist()]
        prints = fingerprints_of(texts, size, words)
        sets = [np.unique(np.concatenate([np.zeros(0, np.uint64), *_shingles(x, size)])) for x in texts]
        binary = {"bits": [bitmap(x).tobytes() for x in sets], "keys": [keys(x, order.value, similarity).tobytes() for x in sets]}
        yield C.batch_of({"t": block.column("t")} | {f"f{w}": C.signed(prints[:, w]) for w in range(words)} | {"n": np.array([len(x) for x in sets], np.int32)} | {k: pa.array(v, pa.binary()) for k, v in binary.items()})


@C.lean
def _dealt_keys(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """(t, n, keys) -> (bucket, body): the keys of a bucket, each with its text, the size of its set, and how many shingles of
    it come from that key on."""
    for batch in batches:
        lists = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("keys")]
        sizes = np.array([len(x) for x in lists], np.int64)
        if not sizes.sum():
            continue
        key, n = np.concatenate(lists), np.repeat(batch.column("n").to_numpy(), sizes)
        left = (n - np.arange(len(key)) + np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        t = np.repeat(batch.column("t").to_numpy(), sizes)
        bucket = (C.mix(key) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        cuts = np.append(np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)), len(order))
        parts = [order[lo:hi] for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        yield C.batch_of({"bucket": bucket[[x[0] for x in parts]], "body": pa.array([b"".join(c[x].tobytes() for c in (key, t, n, left)) for x in parts], pa.binary())})


def _possible(n: np.ndarray, left: np.ndarray, m: np.ndarray, right: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of n and m shingles that share a key, and none before it, can reach the similarity."""
    return np.minimum(left, right) >= similarity / (1 + similarity) * (n + m) - 1e-9


def _blocks(key: np.ndarray, t: np.ndarray, n: np.ndarray, left: np.ndarray, similarity: float) -> Iterator[tuple[int, np.ndarray]]:
    """(name, texts) of the keys that two texts or more share, without texts that no other can be alike by that key. The same texts
    have one name, whatever their key."""
    order = np.argsort(key, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(key[order]) != 0))
    sizes = np.diff(np.append(starts, len(order)))
    i, j = order[starts[sizes == 2]], order[starts[sizes == 2] + 1]
    good = _possible(n[i], left[i], n[j], left[j], similarity)
    i, j = i[good], j[good]
    names = C.mix(C.mix(t[i].view(np.uint64)) + C.mix(t[j].view(np.uint64)))
    _, once = np.unique(names, return_index=True)
    yield from zip(names[once].tolist(), np.stack([t[i[once]], t[j[once]]], axis=1), strict=True)
    seen: set[int] = set()
    for lo, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        at = order[lo : lo + size]
        if size <= 1024:
            good = _possible(n[at][:, None], left[at][:, None], n[at], left[at], similarity)
            np.fill_diagonal(good, False)
            at = at[good.any(axis=1)]
        name = int(C.mix(np.array([C.mix(t[at].view(np.uint64)).sum()], np.uint64))[0])
        if len(at) and name not in seen:
            seen.add(name)
            yield name, t[at]


@C.lean
def _met(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """(bucket, body), in order -> (block, m, task, guest, t): the texts of each block, m in all. A block of over ROWS texts is
    dealt to a task for each two parts of it."""

    def solve(bodies: list[bytes]) -> Iterator[pa.RecordBatch]:
        counts = [len(x) // 24 for x in bodies]
        fields = ((np.uint64, 0, 8), (np.int64, 8, 8), (np.int32, 16, 4), (np.int32, 20, 4))
        columns = [np.concatenate([np.frombuffer(x, d, c, at * c) for x, c in zip(bodies, counts, strict=True)]) for d, at, _ in fields]
        out: list[tuple[int, int, int, int, np.ndarray]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            sizes = [len(x[4]) for x in out]
            cols = {c: np.repeat(np.array([x[k] for x in out], d), sizes) for k, (c, d) in enumerate((("block", np.uint64), ("m", np.int64), ("task", np.uint64), ("guest", np.int8)))}
            return C.batch_of({c: C.signed(v) if v.dtype == np.uint64 else v for c, v in cols.items()} | {"t": np.concatenate([x[4] for x in out])})

        for name, t in _blocks(*columns, similarity):
            parts = -(-len(t) // ROWS)
            if parts == 1:
                out.append((name, len(t), name, 0, t))
                held += len(t)
            else:
                part = (C.mix(t.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
                for a in range(parts):
                    for b in range(a, parts):
                        task = int(C.mix(np.array([name], np.uint64) + np.uint64(1 + a * parts + b))[0])
                        out += [(name, len(t), task, k, t[part == x]) for k, x in ((0, a), (1, b))[: 1 if a == b else 2]]
                        held += sum(len(x[4]) for x in out[-2:])
            if held > 100_000:
                yield flush()
                out, held = [], 0
        if out:
            yield flush()

    now, held = None, []
    for batch in batches:
        for bucket, body in zip(batch.column("bucket").to_pylist(), batch.column("body").to_pylist(), strict=True):
            if bucket != now and held:
                yield from solve(held)
                held = []
            now = bucket
            held.append(body)
    if held:
        yield from solve(held)


def blocks(rows: DataFrame, similarity: float) -> DataFrame:
    """(block, m, task, guest, t) of rows (t, n, keys): every two texts of the similarity or more meet in a task. Rows are as many as
    the keys that several texts share, at most; it needs no comparison of all texts."""
    sizes = rows.agg(F.sum("n").alias("n"), F.count("*").alias("rows")).first()
    buckets = max(8, int((1 - similarity) * (sizes["n"] or 0) + sizes["rows"]) // KEYS)
    dealt = rows.select("t", "n", "keys").mapInArrow(lambda b: _dealt_keys(b, buckets), "bucket int, body binary")
    n = min(buckets, 20_000)
    dealt = dealt.repartitionById(n, F.col("bucket") % n).sortWithinPartitions("bucket")
    return dealt.mapInArrow(lambda b: _met(b, similarity), "block long, m long, task long, guest byte, t long").distinct()


class _Side:
    """Rows of one tile: fingerprints, sizes, and bitmaps by their length, each also folded to half of it."""

    def __init__(self, rows: pa.Table, words: int) -> None:
        self.t, self.c, self.n = (rows.column(x).to_numpy() for x in ("t", "c", "n"))
        self.prints = np.stack([rows.column(f"f{w}").to_numpy().view(np.uint64) for w in range(words)], axis=1)
        bits = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("bits")]
        self.size = np.array([len(x) for x in bits], np.int64)
        self.at = np.zeros((len(bits), 2), np.int64)
        self.maps: dict[int, np.ndarray] = {}
        for s in np.unique(self.size).tolist():
            rows_at = np.flatnonzero(self.size == s)
            whole = np.stack([bits[i] for i in rows_at])
            for k, m in ((0, whole), (1, whole[:, : s // 2] | whole[:, s // 2 :])):
                if m.shape[1]:
                    before = self.maps.get(m.shape[1], np.zeros((0, m.shape[1]), np.uint64))
                    self.at[rows_at, k] = len(before) + np.arange(len(rows_at))
                    self.maps[m.shape[1]] = np.concatenate([before, m])

    def bitmaps(self, i: np.ndarray, size: int) -> np.ndarray:
        return self.maps[size][self.at[i, (self.size[i] != size).astype(np.int64)]]


def _at_most(a: _Side, i: np.ndarray, b: _Side, j: np.ndarray, similarity: float) -> np.ndarray:
    """What the Jaccard similarity of each pair is at most, by sizes and bitmaps; zero where that is under the one asked for."""
    n, m = a.n[i].astype(np.int64), b.n[j].astype(np.int64)
    good = np.minimum(n, m) >= similarity * np.maximum(n, m)
    least = np.minimum(a.size[i], b.size[j])
    good &= np.maximum(a.size[i], b.size[j]) <= 2 * least
    out = np.zeros(len(i))
    for s in np.unique(least[good]).tolist():
        at = np.flatnonzero(good & (least == s))
        step = max(1, (1 << 21) // s)
        for k in (at[lo : lo + step] for lo in range(0, len(at), step)):
            x, y = a.bitmaps(i[k], s), b.bitmaps(j[k], s)
            only = [np.bitwise_count(p & ~q).sum(axis=1, dtype=np.int64) for p, q in ((x, y), (y, x))]
            both = np.minimum(n[k] - only[0], m[k] - only[1])
            out[k] = both / np.maximum(1, n[k] + m[k] - both)
    return np.where(out >= similarity - 1e-9, out, 0.0)


@C.lean
def _candidates(batches: Iterator[pa.RecordBatch], radius: int, words: int, similarity: float, forest: bool) -> Iterator[pa.RecordBatch]:
    """Tasks of a block's rows (guest 0) and those of the part that they meet (guest 1; none: the rows with each other), in order:
    (a, b) for pairs of texts within the radius that may reach the similarity and whose groups c differ. As a forest: only
    pairs that join what no earlier pair of the task joins, and of the others once more, FORESTS times, so that what is connected
    stays so when some of them fail."""
    held: list[pa.RecordBatch] = []
    now = None

    def chosen(a: _Side, b: _Side, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        shift = len(a.t) if b is not a else 0
        forests = [_Union(len(a.t) + (len(b.t) if b is not a else 0)) for _ in range(FORESTS)]
        for i, j in pairs:
            apart = a.c[i] != b.c[j]
            i, j = i[apart], j[apart]
            most = _at_most(a, i, b, j, similarity)
            keep = np.flatnonzero(most)
            if forest:  # the likeliest first, as few of these fail
                left, taken = keep[np.argsort(-most[keep], kind="stable")], []
                for groups in forests:
                    joined = groups.union(i[left], j[left] + shift)
                    taken.append(left[joined])
                    left = np.delete(left, joined)
                keep = np.concatenate(taken)
            if len(keep):
                x, y = a.t[i[keep]], b.t[j[keep]]
                yield C.batch_of({"a": np.minimum(x, y), "b": np.maximum(x, y)})

    def solve() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        guest = rows.column("guest").to_numpy() == 1
        a = _Side(rows.filter(pa.array(~guest)), words)
        b = _Side(rows.filter(pa.array(guest)), words) if guest.any() else a
        if len(a.t):
            yield from chosen(a, b, _near(a.prints, b.prints, radius, b is a))

    def solve_small(rows: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        side, starts = _Side(pa.Table.from_batches([rows]), words), np.cumsum(sizes) - sizes

        def near() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for size in np.unique(sizes).tolist():
                i, j = ((starts[sizes == size][:, None] + x).ravel() for x in np.triu_indices(size, 1))
                good = np.bitwise_count(side.prints[i] ^ side.prints[j]).sum(axis=1, dtype=np.int64) <= radius
                yield i[good], j[good]

        yield from chosen(side, side, near())

    for batch in batches:
        tasks = batch.column("task").to_numpy()
        if not len(tasks):
            continue
        starts = np.flatnonzero(np.append(True, tasks[1:] != tasks[:-1]))
        sizes = np.diff(np.append(starts, len(tasks)))
        small = (sizes <= 64) & (np.add.reduceat(batch.column("guest").to_numpy().astype(np.int64), starts) == 0)
        small[[0, -1]] = False  # these may go on in another batch
        if small.any():
            yield from solve_small(batch.filter(pa.array(np.repeat(small, sizes))), sizes[small])
        for lo, size in zip(starts[~small].tolist(), sizes[~small].tolist(), strict=True):
            if tasks[lo] != now and held:
                yield from solve()
                held = []
            now = tasks[lo]
            held.append(batch.slice(lo, size))
    if held:
        yield from solve()


def candidates(met: DataFrame, rows: DataFrame, words: int, radius: int, similarity: float, forest: bool) -> DataFrame:
    """Pairs (a, b) of rows (t, c, f0, ..., n, bits) that meet (task, guest, t), as in _candidates."""
    names = [f"f{w}" for w in range(words)]
    dealt = met.select("task", "guest", "t").join(rows.select("t", "c", *names, "n", "bits"), "t")
    n = max(C.partitions(met.sparkSession), met.count() // 100_000)
    dealt = dealt.select("task", "guest", "t", "c", *names, "n", "bits").repartition(n, "task").sortWithinPartitions("task")
    return dealt.mapInArrow(lambda b: _candidates(b, radius, words, similarity, forest), "a long, b long").distinct()


def alike(pairs: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts (t, text) have sets of shingles with a Jaccard similarity of at least that."""

    @C.lean
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in C.blocks(batches, limit=4 * C.BLOCK):
            sets = [np.unique(np.concatenate([np.zeros(0, np.uint64), *_shingles((x or "").encode(), size)])).tobytes() for x in block.column("text").to_pylist()]
            yield C.batch_of({"t": block.column("t"), "s": pa.array(sets, pa.binary())})

    @C.lean
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for k, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                if min(len(x), len(y)) >= similarity * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good[k] = both >= similarity * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(good)) for c in ("a", "b")], names=["a", "b"])

    need = pairs.select(F.col("a").alias("t")).union(pairs.select(F.col("b").alias("t"))).distinct()
    sets = C.cut(texts.join(need, "t", "left_semi").dropDuplicates(["t"]).mapInArrow(compute, "t long, s binary"), "sets")
    joined = pairs.join(sets.select(F.col("t").alias("a"), F.col("s").alias("x")), "a").join(sets.select(F.col("t").alias("b"), F.col("s").alias("y")), "b")
    out = C.cut(joined.select("a", "b", "x", "y").mapInArrow(compared, "a long, b long"), "alike")
    C.discard(sets)
    return out


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 3, words: int = 1) -> DataFrame:
    """(id, fingerprint, component_id) for each row of df: texts whose fingerprints of 64 * words bits, over
    shingles of size words, differ in at most radius bits are linked; component_id is the smallest id reached."""
    names = [f"f{w}" for w in range(words)]
    prints = C.cut(fingerprints(df, id_col, text_col, size, words), "prints")
    distinct = C.cut(prints.groupBy(*names).agg(F.min("id").alias("least"), F.count("*").alias("n")), "distinct")
    roots = components(links(distinct, radius, words))
    keyed = distinct.select(_hex(names).alias("fingerprint"), "least", "n")
    member = C.cut(keyed.drop("n").join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint"), "members")
    least = member.groupBy("root").agg(F.min("least").alias("m"), F.count("*").alias("n"))
    groups = join_least(member, least, "root", member.count()).select("fingerprint", F.col("m").alias("group"))
    every = keyed.join(groups, "fingerprint", "left").select("fingerprint", F.coalesce("group", "least").alias("m"), "n")
    return join_least(prints.select("id", _hex(names).alias("fingerprint")), every, "fingerprint", prints.count()).select("id", "fingerprint", F.col("m").alias("component_id"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, radius: int = 60, words: int = 4, similarity: float = 0.8) -> DataFrame:
    """The rows of df without near copies: of each group the row with the smallest id stays, and of repeated rows
    one. Texts are linked if their sets of 5-word shingles have a Jaccard similarity of at least 0.8, which is verified for
    every link; groups are components of links. Fingerprints only say which pairs are looked at. By default these have 256
    bits: at 0.8 texts differ in 39 bits on average (standard deviation 6), unrelated ones in 128. Fingerprints are compared
    where texts share one of their keys, as all texts of that similarity do. Of the pairs within the
    radius, those that sizes and bitmaps can't reject are verified in two rounds: first a forest of some of them, then, without
    a limit, every one whose groups still differ. Null ids count as the smallest, null texts as empty."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    digest = F.xxhash64(F.col(f"`{id_col}`").isNull(), F.col(f"`{text_col}`").cast("string"))
    key = {"k1": F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), "k2": digest}
    named = F.struct(F.col(f"`{id_col}`").alias("id"), *[v.alias(k) for k, v in key.items()])
    least = C.cut(df.select(F.xxhash64(text).alias("t"), named.alias("id")).groupBy("t").agg(F.min("id").alias("least")), "texts")
    texts = df.select(F.xxhash64(text).alias("t"), text.alias("text"))
    names = [f"f{w}" for w in range(words)]
    longs = ", ".join(f"{c} long" for c in names)
    order = df.sparkSession.sparkContext.broadcast(frequent(texts, least.count(), size))
    each = texts.mapInArrow(lambda b: _sketches(b, size, words, order, similarity), f"t long, {longs}, n int, bits binary, keys binary")
    rows = C.cut(each.dropDuplicates(["t"]), "sketches")
    met = C.cut(blocks(rows, similarity), "blocks")
    largest = F.dense_rank().over(Window.partitionBy("t").orderBy(F.desc("m"), "block"))
    some = C.cut(met.withColumn("k", largest).where(F.col("k") <= BLOCKS).select("task", "guest", "t"), "some")
    pairs = C.cut(candidates(some, rows.withColumn("c", F.col("t")), words, radius, similarity, True), "nearest")
    sure = alike(pairs, texts, size, similarity)
    roots = C.cut(components(sure), "roots")
    C.discard(some, pairs)
    group = met.join(roots, F.col("t") == F.col("node"), "left").select("task", "guest", "t", F.coalesce("root", "t").alias("c"))
    unsettled = group.groupBy("task").agg(F.min("c").alias("least"), F.max("c").alias("most")).where("least < most").select("task")
    some = C.cut(group.join(unsettled, "task"), "open")
    groups = some.select("t", "c").distinct()
    pairs = C.cut(candidates(some, rows.join(groups, "t"), words, radius, similarity, False), "crossing")
    more = alike(pairs, texts, size, similarity)
    C.discard(rows, met, some, pairs)
    merged = more.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left").join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
    merged = merged.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).distinct()  # links between groups, not texts
    final = components(merged).withColumnRenamed("node", "group").withColumnRenamed("root", "top")
    member = roots.select(F.col("node").alias("t"), F.col("root").alias("group"))
    member = least.join(member, "t", "left").withColumn("group", F.coalesce("group", "t")).join(final, "group", "left").select(F.coalesce("top", "group").alias("root"), "least")
    kept = member.groupBy("root").agg(F.min("least").alias("m")).select("m.k1", "m.k2")
    once = df.select(*[v.alias(k) for k, v in key.items()], F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")).groupBy("k1", "k2").agg(F.first("row").alias("row"))
    return once.join(kept, ["k1", "k2"], "left_semi").select("row.*")


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(C.table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
