"""Text operators against brute force."""

from __future__ import annotations

import hashlib
import pickle
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellum.llm import chaining, common, components, decontaminate, langid, pieces, quality, simhash, suffix_dedup

RNG = random.Random(5)
WORDS = ["".join(RNG.choice("abcdeéfghñ") for _ in range(RNG.randint(2, 9))) for _ in range(3000)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def removed(texts, width):
    """n_bytes, n_removed, n_spans and hash by counting every window."""
    data = [(x or "").encode() for x in texts]
    seen = Counter(d[i : i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - width + 1):
            if seen[d[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        runs = sum(1 for i, x in enumerate(gone) if x and (not i or not gone[i - 1]))
        out.append((len(d), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(d, gone, strict=True) if not g)).hexdigest()))
    return out


def suffix_cases():
    shared = [prose(60) for _ in range(4)]
    texts = [None, "", "short", "a" * 1000, "ab" * 700, "a" * 900 + "b"] + [prose(RNG.randint(5, 200)) for _ in range(20)]
    for _ in range(40):
        c, k = RNG.choice(shared), RNG.randint(0, 60)
        texts.append(prose(RNG.randint(0, 60)) + " " + c[k : RNG.randint(k, len(c))] + " " + RNG.choice(shared)[: RNG.randint(150, 260)])
    for _ in range(20):
        x = list(RNG.choice(texts[6:26]))
        x[RNG.randrange(len(x))] = "Q"
        texts.append("".join(x))
    return texts + texts[10:14]


def test_suffix_dedup(spark):
    texts = suffix_cases()
    df = spark.createDataFrame([(i if i % 7 else None, x) for i, x in enumerate(texts)], "doc_id long, text string").withColumn("spans", F.lit("x")).withColumn("k", F.lit(1)).withColumn("n_bytes", F.lit(2))
    rows = suffix_dedup.remove_repeats(df).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == sorted(removed(texts, 200))
    assert rows[0].row.k == 1 and rows[0].row.n_bytes == 2
    assert suffix_dedup.remove_repeats(df.limit(0)).collect() == []


def test_suffix_dedup_whole_table(spark, sf_dir):
    table = pq.read_table(f"{sf_dir}/documents.parquet").to_pydict()
    want = [(i, *x) for i, x in zip(table["doc_id"], removed(table["text"], 200), strict=True)]
    assert sorted(tuple(r) for r in suffix_dedup.op2_suffix_dedup(spark, sf_dir).collect()) == sorted(want)


def test_multikey_order():
    rng = np.random.default_rng(1)
    cols = [rng.integers(0, 4, 500) for _ in range(3)] + [np.arange(500)]
    assert (suffix_dedup.multikey_order(cols) == np.lexsort(cols[::-1])).all()
    for n, values in ((20_000, 3), (30_000, 10**12), (9000, 1), (0, 1)):
        cols = [rng.integers(0, values, n) for _ in range(3)] + [rng.permutation(n)]
        assert (suffix_dedup.multikey_order(cols) == np.lexsort(cols[::-1])).all()


def test_suffix_dedup_of_long_texts(spark):
    """Texts of over a block, which are read in pieces: repeats at the pieces' edges, in the text and in others."""
    rng = random.Random(12)
    long = "".join(rng.choice("abcdefgh ") for _ in range(common.BLOCK + 5000))
    spot = [long[i : i + 300] for i in (0, common.BLOCK - 150, common.BLOCK - 350, common.BLOCK + 20, len(long) - 300)]
    texts = [long, *("#" + x + "#" for x in spot), long[: common.BLOCK // 2] + "!" + long[common.BLOCK // 2 - 250 :]]
    want = removed_of_long(texts, 200)
    rows = suffix_dedup.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == sorted(want)


def removed_of_long(texts, width):
    """As removed(), with one 64-bit hash for each window."""
    data = [x.encode() for x in texts]
    seen = Counter(hash(d[i : i + width]) for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - width + 1):
            if seen[hash(d[i : i + width])] > 1:
                gone[i] += 1
                gone[i + width] -= 1
        mask = np.cumsum(gone)[: len(d)] > 0
        runs = int((mask & ~np.append(False, mask[:-1])).sum())
        out.append((len(d), int(mask.sum()), runs, hashlib.sha256(np.frombuffer(d, np.uint8)[~mask].tobytes()).hexdigest()))
    return out


def fingerprint(text, size, words=1):
    w = (text or "").encode().lower().split()
    parts = [b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [b" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x, 42) for x in parts]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def groups(ids, prints, radius):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(least.get(find(i), 1 << 60), x)
    return [least.get(find(i)) for i in range(len(ids))]


@pytest.mark.parametrize("radius", [3, 12])
def test_simhash(spark, sf_dir, radius):
    table = pq.read_table(f"{sf_dir}/documents.parquet").to_pydict()
    ids, texts = [*table["doc_id"], 1000, 1001, None, 1003, 1003], [*table["text"], None, "", "A b", "a\x1cb c\x0bd", "a\x1cb c\x0bd"]
    for i in range(40):
        x = texts[i % 9].split(" ")
        x[i % len(x)] = "zz"
        ids.append(2000 - i)
        texts.append(" ".join(x))
    prints = [fingerprint(x, 3) for x in texts]
    want = sorted(zip([-1 if i is None else i for i in ids], [f"{p:016x}" for p in prints], groups(ids, prints, radius), strict=True))
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").withColumn("f0", F.lit(1)).withColumn("fingerprint", F.lit(1))
    got = sorted((-1 if r.id is None else r.id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(df, radius=radius).collect())
    assert got == want


def test_simhash_stage(spark):
    base = [prose(120) for _ in range(30)]
    near = [b.replace(b.split(" ")[60], "changed", 1) for b in base[:10]]
    texts = base + near + base[:5] + [None, "", "x y", "x z"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("row", F.lit(1))
    kept = sorted(r.doc_id for r in simhash.keep_one(df.unionByName(df.limit(3))).collect())
    assert kept == [*range(30), 45, 47, 48]
    assert simhash.keep_one(df.limit(0)).collect() == []


def test_stage_keeps_what_is_not_alike(spark):
    """Pairs on either side of 0.8, a chain of them, and many texts that share most with one."""
    rng = random.Random(17)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]

    def other(words, jaccard):
        return words[: round((len(words) - 4) * 2 * jaccard / (1 + jaccard)) + 4] + fresh(len(words) - 4 - round((len(words) - 4) * 2 * jaccard / (1 + jaccard)))

    texts, gone = [], set()
    for jaccard in (0.65, 0.7, 0.75, 0.78, 0.82, 0.85):
        for _ in range(15):
            words = fresh(204)
            gone |= {len(texts) + 1} if jaccard > 0.8 else set()
            texts += [words, other(words, jaccard)]
    hub = fresh(204)
    texts += [hub, *(other(hub, 0.72) for _ in range(10))]
    chain = fresh(260)
    gone |= {len(texts) + 1, len(texts) + 2}
    texts += [chain[:220], chain[20:240], chain[40:260]]
    df = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id for r in simhash.keep_one(df).collect()} == set(range(len(texts))) - gone


def test_components_of_a_chain(spark):
    edges = [(f"{i:03d}", f"{i + 1:03d}") for i in range(60) if i % 20 != 19] + [("000", "000"), ("005", "004")]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {f"{i:03d}": f"{i // 20 * 20:03d}" for i in range(60)}


def test_components_of_a_hub(spark):
    edges = [(5, 10 + i) for i in range(3000)] + [(4999 - i, 4998 - i) for i in range(30)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got[10 + i] for i in range(3000)) == {5} and got[5] == 5 and got[4999] == 4969


def least_edits(item, text):
    row = [0] * (len(text) + 1)
    for j, b in enumerate(item):
        new = [j + 1]
        for i, c in enumerate(text):
            new.append(min(row[i] + (b != c), row[i + 1] + 1, new[i] + 1))
        row = new
    return min(row)


def test_decontaminate(spark, sf_dir):
    rng = random.Random(3)
    items = [*pq.read_table(f"{sf_dir}/benchmark.parquet").to_pydict()["text"][:6], None, "ab", "short one here"]
    filler = [x[:300] for x in pq.read_table(f"{sf_dir}/documents.parquet").to_pydict()["text"][:6]]
    texts = [*filler, None, "", " ... ", "short one here", "x Short, one here!"]
    for _ in range(20):
        x = list(rng.choice(items[:6]))
        for _ in range(rng.randint(0, int(len(x) * 0.16))):
            k, kind = rng.randrange(len(x)), rng.random()
            x[k : k + (kind >= 0.4)] = ["z"] if kind < 0.7 else []
        texts.append(f"{rng.choice(filler)} {''.join(x)} {rng.choice(filler)}")
    found = decontaminate.Items(items, decontaminate.RATE)
    data, off = decontaminate.normal(*common.text_buffer(pa.array([(x or "").lower() for x in texts])))
    want = {}
    for k in range(len(texts)):
        for i, item in enumerate(found.texts):
            if len(item) >= decontaminate.Q and (e := least_edits(item, data[off[k] : off[k + 1]].tobytes())) <= found.edits[i]:
                want[k, i] = e
    assert found.find(data, off) == want and len(want) > 8
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("matches", F.lit(1))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.row.doc_id, m.item_id): m.edits for r in decontaminate.matches(docs, bench).collect() for m in r.matches}
    assert got == want
    assert {r.doc_id for r in decontaminate.clean(docs, bench).collect()} == set(range(len(texts))) - {k for k, _ in want}
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(texts) and decontaminate.clean(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("step", [7, 50, 1000])
def test_long_texts_are_read_in_pieces(step):
    rng = random.Random(step)
    text = "".join(rng.choice(["ab", " ", "...", "é", "C", "\n\t ", "xyz"]) for _ in range(400))
    data = np.frombuffer(text.lower().encode(), np.uint8)
    whole = decontaminate.normal(data, np.array([0, len(data)]))[0].tobytes().strip()
    joined = b""
    for part, _ in decontaminate.long_text(data, 10**6, step):
        joined = part.tobytes().strip()
    assert joined == whole
    for part, _ in decontaminate.long_text(data, 20, step):
        assert part.tobytes().strip() in whole


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load(pieces.MODEL)


def every_path(v, s):
    out = []

    def go(at, score, ids):
        if at == len(s):
            out.append((score, ids))
            return
        single = False
        for end in range(at + 1, len(s) + 1):
            if (i := v.ids.get(s[at:end])) is not None:
                go(end, score + v.score[i], (*ids, i))
                single = single or end == at + 1
        if not single:
            go(at + 1, score + v.unknown, ids + tuple(v.bytes[b] for b in s[at].encode()))

    go(0, 0.0, ())
    return sorted(out, key=lambda x: -x[0])


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abthernion é\n日.1", max_size=9))
def test_nbest_is_exhaustive(s):
    v = _vocabulary()
    whole = every_path(v, pieces.MARK + s.replace(" ", pieces.MARK)) if s else [(0.0, ())]
    found = v.nbest(pieces.MARK + s.replace(" ", pieces.MARK), 5) if s else v.nbest("", 5)
    assert [x for x, _ in found] == [x for x, _ in whole[:5]] and all(x in whole for x in found)
    ids, scores = pieces.Encoder(v, 4).encode(s)
    assert scores == [x for x, _ in whole[:4]]
    assert pieces.decode(v, ids) == s


_held: list[pieces.Vocabulary] = []


def _vocabulary():
    if not _held:
        _held.append(pieces.Vocabulary.load(pieces.MODEL))
    return _held[0]


@pytest.mark.parametrize("text", ["", "a", " two  spaces ", "x\n\ny\t z", "mark ▁ here▁▁x", "▁", "日本 語 \x00 \U0001f600", "  ", "a ▁ b", "x" * 500])
def test_pieces_round_trip(vocabulary, text):
    assert pieces.decode(vocabulary, pieces.Encoder(vocabulary, 4).encode(text)[0]) == text


def test_pieces_frame(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, None), (3, ""), (None, "x")], "doc_id long, text string").withColumn("ids", F.lit(1))
    got = {r.row.doc_id: r for r in pieces.digests(pieces.encode(df)).collect()}
    assert got[2].n_pieces is None and got[3].n_pieces == 0 and got[3].scores == [0.0]
    assert got[1].decoded_sha256 == hashlib.sha256(b"hello world").hexdigest()
    assert pieces.encode(df.limit(0)).collect() == []


def test_language_id(spark):
    out = langid.op1_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert len(out) == 1000 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held) and all(0 <= r.score <= 1 for r in out)
    assert sum(r.rejected for r in out) <= 2
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs, F.lit(True))
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (None, "the and of")], "doc_id long, text string").withColumn("score", F.lit("x"))
    assert {r.id: (r.lang_pred, r.rejected) for r in langid.identify(odd, model).where("id is not null").collect()} == {k: ("und", True) for k in (1, 2, 3)}
    empty = langid.fit(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in langid.identify(odd, empty).collect()} == {"und"}
    assert langid.keep_identified(docs.limit(0)).collect() == []


def test_quality(spark):
    sf = "/root/testdata/sf0.1"
    out = quality.op10_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = [r.score for r in out if r.quality == 1], [r.score for r in out if r.quality == 0]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad)
    assert auc > 0.95 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    docs = spark.createDataFrame([(1, None), (None, "x"), (3, "")], "doc_id long, text string").withColumn("label", F.lit(1))
    none = quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"), F.lit(True), "quality")
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}


def test_passages(spark):
    rng = random.Random(2)
    shared = [[rng.choice(WORDS) for _ in range(60)] for _ in range(6)]
    rows, planted = [], {}
    for i in range(150):
        body = [rng.choice(WORDS) for _ in range(rng.randint(30, 200))]
        if i % 5 == 0:
            p = list(shared[i // 5 % 6])
            for _ in range(rng.randint(0, 3)):
                p[rng.randrange(60)] = "changed"
            at = rng.randint(0, len(body))
            body[at:at] = p
            planted.setdefault(i // 5 % 6, set()).add(i)
        rows.append((i, " ".join(body)))
    rows += [(300, rows[3][1]), (301, None), (302, ""), (303, "few words")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("t", F.lit(1)).withColumn("h", F.lit(1))
    out = chaining.repeated_passages(df, bucket_rows=1000).collect()
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for r in out:
        parent[find(r.doc_id)] = find(r.other_id)
    assert all(len({find(i) for i in v}) == 1 for v in planted.values())
    assert {r.doc_id for r in out} | {r.other_id for r in out} == set().union(*planted.values()) | {3, 300}
    assert chaining.repeated_passages(df.limit(0)).collect() == []


@pytest.mark.parametrize("gap", [26, 60, 150])
def test_two_passages_of_a_pair(spark, gap):
    """Two passages that two texts share in order, with own words between, are two rows."""
    rng = random.Random(gap)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    p, q = fresh(50), fresh(50)
    texts = [" ".join(fresh(30) + p + fresh(gap) + q + fresh(30)) for _ in range(2)]
    out = chaining.repeated_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((r["first"], r["last"], r.other_first, r.other_last, r.matched) for r in out) == [(30, 80) * 2 + (50,), (80 + gap, 130 + gap) * 2 + (50,)]


def test_changed_passages(spark):
    """Every seventh word of a passage of 50 changed: all pairs are found."""
    rng = random.Random(5)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    rows = []
    for i in range(60):
        p = fresh(50)
        q = [w if k % 7 != 3 else fresh(1)[0] for k, w in enumerate(p)]
        rows += [(2 * i, " ".join(fresh(20) + p + fresh(20))), (2 * i + 1, " ".join(fresh(20) + q + fresh(20)))]
    out = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {frozenset((r.doc_id, r.other_id)) for r in out} == {frozenset((2 * i, 2 * i + 1)) for i in range(60)}


def test_passage_of_frequent_lines(spark):
    """Three lines of which many texts hold two are a passage only of the two texts that hold all."""
    rng = random.Random(8)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    texts, want = [], set()
    for _ in range(5):
        one, two, three = fresh(15), fresh(15), fresh(15)
        want.add(frozenset((len(texts), len(texts) + 1)))
        for lines in [one + two + three] * 2 + [one + two] * 30 + [two + three] * 30:
            texts.append(" ".join(fresh(30) + lines + fresh(30)))
    out = chaining.repeated_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {frozenset((r.doc_id, r.other_id)) for r in out} == want


def test_common_grams_hide_no_passage(spark):
    """Two texts share 60 words; 60 short texts hold each of its 5-word grams."""
    rng = random.Random(4)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    passage = fresh(60)
    texts = [" ".join(fresh(20) + passage + fresh(20)) for _ in range(2)]
    texts += [" ".join(fresh(3) + passage[i : i + 5] + fresh(3)) for i in range(56) for _ in range(60)]
    out = chaining.repeated_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [(r["first"], r["last"], r.other_first, r.other_last, r.matched) for r in out] == [(20, 80, 20, 80, 60)]


def passages(texts, min_words=40, similarity=0.8):
    """Every two occurrences of every seed in two texts matched, in one dictionary; then chains and alignment as they are."""
    words = [chaining.words_of((x or "").encode()) for x in texts]
    places = {}
    for i, w in enumerate(words):
        for p in range(len(w) - 4):
            places.setdefault(tuple(w[p : p + 5].tolist()), []).append((i, p))
    found = [(a[0], b[0], a[1], b[1]) for at in places.values() for b in at for a in at if a[0] > b[0]]
    out = set()
    columns = [np.array(x) for x in zip(*found, strict=True)] + [np.full(len(found), 5), np.zeros(len(found), np.int64)]
    for t, u, pos, upos in chaining.pair_chains(*columns, min_words) if found else ():
        a, b = words[t].astype(np.uint32).tolist(), words[u].astype(np.uint32).tolist()
        out |= {(t, p[0], p[1], u, p[2], p[3], p[4]) for p in chaining.aligned(a, b, pos.tolist(), upos.tolist(), min_words, similarity)}
    return out


def either_way(rows):
    """Each passage with its smaller id first."""
    return {(t, a, b, u, c, d, n) if t < u else (u, c, d, t, a, b, n) for t, a, b, u, c, d, n in rows}


@pytest.mark.parametrize("common", [0, 200])
def test_passages_against_brute_force(spark, common):
    """Places and agreeing words of all passages; with groups of common lines, the pairs that are linked through them."""
    rng = random.Random(common)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    pool, lines = [fresh(rng.randint(30, 120)) for _ in range(30)], [fresh(8) for _ in range(5)]
    texts = [None, "", "a b c d", "x " * 300]
    for _ in range(120):
        body = []
        for _ in range(rng.randint(1, 3)):
            p = list(rng.choice(pool))
            p = p[rng.randint(0, 20) :] + fresh(rng.randint(0, 40))
            for _ in range(rng.randint(0, len(p) // 8)):
                p[rng.randrange(len(p))] = rng.choice(["changed", *fresh(1)])
            body += p + (rng.choice(lines) if common else [])
        texts.append(" ".join(body))
    texts += [" ".join(fresh(10) + rng.choice(lines) + fresh(10)) for _ in range(common)]
    want = either_way(passages(texts))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = either_way((r.doc_id, r["first"], r["last"], r.other_id, r.other_first, r.other_last, r.matched) for r in chaining.repeated_passages(rows, bucket_rows=300).collect())
    pairs = lambda x: {(r[0], r[3]) for r in x}
    if common:
        assert len(pairs(got) & pairs(want)) >= 0.95 * len(pairs(want)) and pairs(got) <= pairs(want)
    else:
        assert len(want) > 100 and len(got & want) >= 0.98 * len(want) and pairs(got) == pairs(want)


def test_long_words_and_pieces(monkeypatch):
    """Words as bytes.split cuts them, in a block, alone, and in pieces."""
    texts = [x.encode() for x in ("", " ", "One  two\tTHREE\x0bfour\x1cfive\n six seven", "é" * 50 + " A b", "last")] + [prose(400).encode()]
    data, off = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    words, at = chaining.hashed_words(data, off)
    one = lambda w: chaining.hashed_words(np.frombuffer(w, np.uint8), np.array([0, len(w)]))[0].tolist()
    want = [[h for w in x.lower().split() for h in one(w)] for x in texts]
    assert [words[a:b].tolist() for a, b in zip(at, at[1:])] == want
    monkeypatch.setattr(chaining, "PIECE", 30)
    assert [chaining.words_of(x).tolist() for x in texts] == want
    h, text, pos = chaining.seeds(words, at)
    assert list(zip(text.tolist(), pos.tolist())) == [(i, p) for i, x in enumerate(want) for p in range(len(x) - 4)] and len(set(h.tolist())) == len(h)


def test_runs_of_seeds():
    """Grams of any width on one diagonal are one run, if their seeds follow each other; links need half of min_words."""
    chained = lambda *rows: [(t, u, a.tolist(), b.tolist()) for t, u, a, b in chaining.pair_chains(*(np.array(x) for x in zip(*rows)), 40)]
    assert chained((2, 1, 0, 3, 10, 0), (2, 1, 6, 9, 5, 0), (3, 1, 0, 0, 5, 0)) == [(2, 1, [0, 6], [3, 9])]
    assert chained((2, 1, 0, 3, 40, 1)) == [(2, 1, [0, 35], [3, 38])] and chained((2, 1, 0, 3, 19, 1)) == []
    assert chained((2, 1, 0, 3, 12, 1), (2, 1, 14, 17, 10, 1)) == [(2, 1, [0, 5, 14, 19], [3, 8, 17, 22])]
    assert chained((2, 1, 0, 3, 5, 0), (2, 1, 14, 17, 5, 0)) == [(2, 1, [0, 14], [3, 17])]
    assert chained((2, 1, 0, 3, 9, 0)) == [] and chained((2, 1, 0, 3, 10, 0)) == [(2, 1, [0, 5], [3, 8])]
    shifted = [(2, 1, p, q, 5, 0) for p in range(0, 60) for q in range(0, 40)]
    assert [(a[0], b[0]) for _, _, a, b in chaining.pair_chains(*(np.array(x) for x in zip(*shifted)), 40)] == [(0, 0), (45, 0)]  # the rest lies in the first


def test_repeated_words_are_one_passage(spark):
    texts = [f"{prose(30)} {'no ' * n}{prose(30)}" for n in (100, 80, 60)]
    out = chaining.repeated_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {frozenset((r.doc_id, r.other_id)) for r in out} == {frozenset(x) for x in ((0, 1), (0, 2), (1, 2))} and len(out) <= 6 and min(r.matched for r in out) >= 40


@pytest.mark.parametrize("copies", [3, 40])
def test_passage_of_least_length(spark, copies):
    """A passage of just 40 words, rare or frequent, links all texts that hold it."""
    rng = random.Random(copies)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    passage = fresh(40)
    rows = [(i, " ".join(fresh(9) + passage + fresh(9))) for i in range(copies)] + [(100 + i, " ".join(fresh(20) + passage[:39] + fresh(20))) for i in range(copies)]
    out = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.matched for r in out} == {40} and {(r["first"], r["last"], r.other_first, r.other_last) for r in out} == {(9, 49, 9, 49)}
    linked = {0}
    for _ in range(copies):
        linked |= {x for r in out for x in (r.doc_id, r.other_id) if {r.doc_id, r.other_id} & linked}
    assert linked == set(range(copies))


def test_packed_blocks():
    t, pos, key = np.array([5, 5, 5, -3, 9]), np.array([0, 7, 300, 2, 70000]), np.array([1, 2**40 - 1, 3, 0, 9], np.uint64)
    assert [x.tolist() for x in chaining.unpack_places(chaining.pack_places(t, pos, key))] == [t.tolist(), pos.tolist(), key.tolist()]
    u, upos = np.array([1, 1, 2, -9, 4]), np.array([3, 1, 500, 0, 7])
    assert [x.tolist() for x in chaining.unpack_matches(chaining.pack_matches(t, u, pos, upos, 10, True))] == [x.tolist() for x in (t, u, pos, upos)] + [[10] * 5, [1] * 5]
    assert [x.tolist() for x in chaining.unpack(chaining.pack(np.zeros(0, np.uint64), np.array([0, 0])))] == [[], [0, 0]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=12), st.lists(st.integers(0, 5), max_size=12))
def test_agreeing(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row, before = [0], row
        for j, y in enumerate(b):
            row.append(max(before[j + 1], row[j], before[j] + (x == y)))
    assert chaining.agreeing(a, b) == row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=14, unique=True))
def test_best_chain(points):
    points = sorted(points)
    best = [0.0] * len(points)
    for i, (p, u) in enumerate(points):
        before = [best[j] - chaining.GAP * (p - q + u - v) for j, (q, v) in enumerate(points[:i]) if q < p and v < u]
        best[i] = chaining.K + max([0.0, *before])
    found = chaining.chains(np.array([p for p, _ in points]), np.array([u for _, u in points]))
    assert sorted(i for c in found for i in c) == list(range(len(points)))
    first = [points[i] for i in found[0]]
    score = len(first) * chaining.K - chaining.GAP * sum(q - p + v - u for (p, u), (q, v) in zip(first, first[1:], strict=False))
    assert score == pytest.approx(max(best))


def small_vocabulary():
    pieces_ = [("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("▁a", -2.0), ("ab", -2.0), ("b", -1.0), ("aaa", -3.0)]
    return pieces.Vocabulary([*pieces_, *[(None, 0.0)] * 256], list(range(len(pieces_), len(pieces_) + 256)))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abz", min_size=1, max_size=8))
def test_ties_go_to_the_longest_last_piece(s):
    """By enumeration: of the best paths, that with the longest last piece, then the longest before it; in both searches."""
    v = small_vocabulary()
    size = {i: len(p) for p, i in v.ids.items()}
    marked = pieces.MARK + s
    paths = every_path(v, marked)
    lengths = lambda ids: [size.get(i, 1) for i in reversed(ids)]
    want = max((x for x in paths if x[0] == paths[0][0]), key=lambda x: lengths(x[1]))
    assert v.nbest(marked, 3)[0] == want and [x for x, _ in v.nbest(marked, 3)] == [x for x, _ in paths[:3]]
    assert np.frombuffer(pieces.Encoder(v, 4).encode(s)[0], np.int32).tolist() == list(want[1])


def test_ties_cost_a_path_each():
    v = small_vocabulary()
    for n in (36, 400, 3000):
        found = v.nbest(pieces.MARK + "a" * n, 4)
        assert len({x for _, x in found}) == 4 and {x for x, _ in found} == {-float(n + 1)}


def test_both_searches_agree():
    """Random words of the real vocabulary, encoded many at once and alone."""
    v, rng = _vocabulary(), random.Random(3)
    words = ["".join(rng.choice("abdeghilnorstuyé") for _ in range(rng.randint(3, 40))) for _ in range(1500)]
    encoder = pieces.Encoder(v, 4)
    for w, (ids, scores) in zip(words, encoder.encode_all(words), strict=True):
        alone = v.nbest(pieces.MARK + w, 4)
        assert np.frombuffer(ids, np.int32).tolist() == list(alone[0][1]) and scores == [x for x, _ in alone]


def test_one_letter_is_counted_in_slices(monkeypatch):
    """A long text and an item of one letter: each of its q-grams meets every place of the other."""
    monkeypatch.setattr(decontaminate, "HITS", 1 << 20)
    items = decontaminate.Items(["a" * 100, "no such thing at all"], decontaminate.RATE)
    data, off = decontaminate.normal(*common.text_buffer(pa.array(["a" * (1 << 20) + "b" * 19])))
    assert items.find(data, off) == {(0, 0): 0}


@pytest.mark.parametrize("hits", [50, 1000, 1 << 21])
def test_slices_change_nothing(monkeypatch, sf_dir, hits):
    rng = random.Random(6)
    common_words = "of the people by the people for the people "
    items = [common_words + prose(6, rng) for _ in range(20)] + ["ab", "x, Y!", "", "..", None]
    texts = [common_words * rng.randint(1, 4) + rng.choice(items[:20]) + common_words for _ in range(10)] + ["ab", "cab abs", "x y", "X-y z ab", ""]
    data, off = decontaminate.normal(*common.text_buffer(pa.array([x.lower() for x in texts])))
    whole = decontaminate.Items(items, decontaminate.RATE).find(data, off)
    monkeypatch.setattr(decontaminate, "HITS", hits)
    assert decontaminate.Items(items, decontaminate.RATE).find(data, off) == whole
    assert {k for k in whole if k[1] >= 20} == {(10, 20), (12, 21), (13, 20), (13, 21)} and {t for t, x in whole if x < 20} == set(range(10))


def test_matches_across_pieces(spark):
    """An item that lies across the place where a long text is cut."""
    rng = random.Random(2)
    item = prose(30, rng)
    filler = ("".join(rng.choice("qwxyz ") for _ in range(997)) + "  ") * (1 + common.BLOCK // 999)
    for at in (common.BLOCK - 40, common.BLOCK - 3, common.BLOCK + 1):
        docs = spark.createDataFrame([(1, filler[:at] + " " + item + " " + filler[at:]), (2, filler)], "doc_id long, text string")
        found = decontaminate.matches(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
        assert {r.row.doc_id: [(m.item_id, m.edits) for m in r.matches] for r in found} == {1: [(7, 0)], 2: []}


def test_language_scores_by_a_plain_loop(spark):
    """A frozen model's sums, subword by subword."""
    rng = np.random.default_rng(5)
    model = langid.Model(("x", "y", "z"), rng.normal(0, 1, (1 << langid.BITS, 3)).astype(np.float32), rng.normal(0, 1, 3), 0.5)
    texts = ["Abc déf, g12h", "a", "Ünïcode  words\tand\nlines", prose(300)]
    for text in texts:
        raw = [" "] + list(text.lower()) + [" "]
        data = [b if 97 <= b <= 122 or b >= 128 else 32 for b in "".join(raw).encode()]
        total, n = np.zeros(3), 0
        for size in langid.SIZES:
            for i in range(len(data) - size + 1):
                gram = data[i : i + size]
                inner = gram[1:-1]
                if (32 in inner) if size > 2 else gram == [32, 32]:
                    continue
                code = size
                for b in gram:
                    code = (code << 8 | b) & 0xFFFFFFFFFFFFFFFF
                total += model.scores[(code * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> (64 - langid.BITS)]
                n += 1
        want = total / max(1, n) + model.bias
        buffer = common.text_buffer(pa.array([" " + text.lower() + " "]))
        assert langid.logits(model, *buffer)[0] == pytest.approx(want)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)] + [(0, texts[0])], "doc_id long, text string")
    rows = langid.identify(df, model).collect()
    assert len(rows) == 5 and len({(r.id, r.lang_pred, r.score) for r in rows}) == 4


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([0.1, 0.3, 0.5, 0.7, 0.9]), st.booleans()), min_size=1, max_size=12))
def test_rejection_makes_the_fewest_mistakes(rows):
    confidence, right = np.array([c for c, _ in rows]), np.array([r for _, r in rows])
    mistakes = lambda t: sum(r != (c >= t) for c, r in rows)
    found = langid.rejection(confidence, right)
    tried = [0.0, *(np.nextafter(c, 2) for c in sorted(set(confidence)))]
    assert mistakes(found) == min(map(mistakes, tried)) and found == min(t for t in tried if mistakes(t) == mistakes(found))


def test_fits_are_bounded(spark):
    """Rows of one id, repeated rows and long texts count towards the bounds."""
    rng = random.Random(1)
    rows = [(1, prose(30, rng), "x") for _ in range(300)] + [(2, "one text", "y")] * 300 + [(None, prose(20, rng), "z") for _ in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    keyed = df.withColumn("key", F.xxhash64("doc_id", "text"))
    last = langid.least_keys(keyed, 100)
    chosen = keyed.where(F.col("key") <= last)
    assert chosen.select("key").distinct().count() == 100
    held = langid.bounded(chosen.withColumn("buckets", F.sequence(F.lit(1), F.lit(10))).select("key", "buckets"), "buckets", 305)
    assert held.num_rows == 30 and held.column("key").to_pylist() == sorted(held.column("key").to_pylist())
    assert langid.fit(df, F.lit(True), max_rows=50, max_features=2000).languages


def plain_features(text):
    """Words and pairs one by one: (weights' places, times)."""
    kinds, out = {}, []
    for b in text:
        kind = 0 if b < 33 else 2 if 48 <= b <= 57 else 1 if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 3
        if out and kinds.get("last") == kind:
            out[-1] += bytes([b])
        else:
            out.append(bytes([b]))
        kinds["last"] = kind
    words = [w for w in out if w[0] >= 33]
    digit = [bytes(48 if 48 <= b <= 57 else b for b in w) for w in words]
    one = lambda w: int(common.range_hash(common.prefix_hash(np.frombuffer(w, np.uint8)), np.array([0]), np.array([len(w)]))[0])
    hashes = [one(w) for w in digit]
    both = [int(quality._PAIR) if a == b else int(common.mix(np.array([(a * int(quality._PAIR) + b) & 0xFFFFFFFFFFFFFFFF], np.uint64))[0]) for a, b in zip(hashes, hashes[1:])]
    return Counter(h >> (64 - quality.BITS) for h in hashes + both)


def test_quality_features_by_a_plain_loop(spark, monkeypatch):
    """Features of a text, whole or read in pieces, and its score from a frozen model."""
    rng = random.Random(7)
    texts = ["It's 12 or 345 — ok?! ok ok", "", "  \n", "é" * 40 + " x", "word" * 200, prose(200, rng), "a1b2 " * 60 + "!" * 90]
    monkeypatch.setattr(common, "BLOCK", 64)
    for text in texts:
        want = plain_features(text.encode())
        block = pa.RecordBatch.from_arrays([pa.array([text])], names=["text"])
        found = Counter()
        for data, off, known in quality._pieces(block):
            found.update(quality.features(data, off, known)[1].tolist())
        assert found == want
    weights = np.random.default_rng(1).normal(0, 1, 1 << quality.BITS).astype(np.float32)
    rows = quality.score(spark.createDataFrame(list(enumerate([*texts, texts[0]])), "doc_id long, text string"), quality.Model(weights, 0.25)).collect()
    for r in rows:
        f = plain_features([*texts, texts[0]][r.id].encode())
        total = sum(float(weights[k]) * n for k, n in f.items()) / max(1, sum(f.values())) ** 0.5
        assert r.score == pytest.approx(1 / (1 + np.exp(-(0.25 + total))), rel=1e-5)


def test_near_copies_against_brute_force(spark, sf_dir):
    """The rows that stay on a whole table, by the sets of shingles of every two texts."""
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    sets = []
    for text in table["text"]:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(b" ".join(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([b" ".join(w)] * bool(w)))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    places = {}
    for i, x in enumerate(sets):
        for g in x or [b""]:
            places.setdefault(g, []).append(i)
    for at in places.values():
        for i in at:
            for j in at[: at.index(i)] if len(at) < 200 else ():
                a, b = sets[i], sets[j]
                if find(i) != find(j) and (table["text"][i] == table["text"][j] or len(a & b) >= 0.8 * len(a | b) > 0):
                    parent[max(find(i), find(j))] = min(find(i), find(j))
    ids = table["doc_id"]
    groups: dict[int, list[int]] = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    want = {min(g) for g in groups.values()}
    kept = {r.doc_id for r in simhash.keep_one(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")).collect()}
    gone = len(ids) - len(want)
    assert gone > 20 and len(kept - want) <= 0.02 * gone and len(want - kept) <= 0.02 * gone


def test_bitmaps_reject_nothing_alike():
    rng = np.random.default_rng(3)
    for n in (10, 150, 1000, 5000):
        whole = rng.integers(0, 1 << 63, 2 * n).astype(np.uint64)
        sets = [np.unique(whole[rng.random(2 * n) < p]) for p in (0.5, 0.55, 0.9, 0.95, 1.0, 1.0)] + [whole[:n], whole[: n + n // 5], whole[n // 10 :]]
        side = simhash._Side(pa.table({"t": list(range(len(sets))), "c": [0] * len(sets), "n": pa.array([len(x) for x in sets], pa.int32()), "f0": [0] * len(sets), "bits": [simhash.bitmap(x).tobytes() for x in sets]}), 1)
        i, j = np.triu_indices(len(sets), 1)
        possible = simhash._at_most(side, i, side, j, 0.8) > 0
        true = np.array([len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b])) for a, b in zip(i, j)])
        assert possible[true >= 0.8].all() and not possible[true < 0.6].any()


def test_passages_where_every_fifth_word_is_changed(spark):
    rng = random.Random(11)
    new = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    changes = [set(range(4, 39, 5)), {8 + 4 * k for k in range(8)}, {3, 7, 11, 15, 24, 28, 32, 36}, *[set(rng.sample(range(1, 39), 8)) for _ in range(30)]]
    texts = []
    for changed in changes:
        words = new(40)
        other = [new(1)[0] if k in changed else w for k, w in enumerate(words)]
        texts += [" ".join(new(50) + words + new(50)), " ".join(new(60) + other + new(40))]
    out = chaining.repeated_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), k=4).collect()
    assert {tuple(sorted((r.doc_id, r.other_id))) for r in out} == {(2 * k, 2 * k + 1) for k in range(len(changes))}
    assert all(r["last"] - r["first"] >= 40 and r.matched >= 32 for r in out)


def test_pieces_are_encoded_and_digested_in_one_worker(spark):
    rows = spark.createDataFrame([(1, "to be  or not"), (2, None), (3, ""), (4, f"{pieces.MARK}a\u2028b"), (1, "to be  or not")], "doc_id long, text string")
    once = pieces.encoded_digests(rows, carry=["doc_id"])
    assert once._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    both = pieces.digests(pieces.encode(rows, carry=["doc_id"]))
    assert once.schema == both.schema and sorted(once.collect(), key=repr) == sorted(both.collect(), key=repr)


def test_near_copies_meet_by_keys(monkeypatch):
    """Every two sets of 0.8 or more meet in a task, whatever shingles are frequent and however large blocks are; sets of
    nothing in common never do, so that work doesn't grow with the square of the texts."""
    rng = np.random.default_rng(5)
    fresh = lambda n: rng.integers(0, 1 << 63, n).astype(np.uint64)
    line, sets = fresh(20), []
    for n in (1, 2, 5, 9, 60, 200, 300):
        whole = np.append(fresh(n), line[: n // 8])
        sets += [np.unique(np.append(whole[rng.random(len(whole)) < p], fresh(k))) for p in (1, 1, 0.97, 0.9, 0.85) for k in (0, n // 20, n // 8)]
    sets += [np.unique(np.append(fresh(200), line)) for _ in range(40)] + [np.unique(fresh(300)) for _ in range(200)] + [np.zeros(0, np.uint64)]
    for often in (fresh(0), np.sort(line), np.unique(np.concatenate(sets[::2]))):
        order = often, rng.integers(3, 9, len(often))
        rows = common.batch_of({"t": np.arange(len(sets)), "n": np.array([len(x) for x in sets], np.int32), "keys": pa.array([simhash.keys(x, order, 0.8).tobytes() for x in sets], pa.binary())})
        dealt = pa.Table.from_batches(simhash._dealt_keys(iter([rows.slice(0, 100), rows.slice(100)]), 5)).sort_by("bucket").to_batches()
        for limit in (20_000, 7):
            monkeypatch.setattr(simhash, "ROWS", limit)
            tasks: dict[int, tuple[set[int], set[int]]] = {}
            for r in pa.Table.from_batches(simhash._met(iter(dealt), 0.8)).to_pylist():
                tasks.setdefault(r["task"], (set(), set()))[r["guest"]].add(r["t"])
            met = {(min(a, b), max(a, b)) for own, guests in tasks.values() for a in own for b in guests or own if a != b}
            alike = {(a, b) for a in range(len(sets)) for b in range(a) if len(x := np.intersect1d(sets[a], sets[b])) >= 0.8 * (len(sets[a]) + len(sets[b]) - len(x)) > 0}
            assert len(alike) > 100 and {(b, a) for a, b in alike} <= met
            assert max(max(p) for p in met) < len(sets) - 201


def segmentations(v, ids):
    """Each list of ids as its score and the pieces' texts, bytes that spell a character as one."""
    score, run, raw = 0.0, 0, set(v.bytes)
    for i in ids:
        if i not in raw:
            score += v.score[i]
        elif not run:
            run = len(f"{v.spell[i][0]:08b}".split("0")[0]) or 1  # the bytes of the character
            score += v.unknown
        run = max(run - 1, 0) if i in raw else 0
    return score


@pytest.mark.parametrize("word", ["", "ab", "the bathing  other", "é\u65e5 z▁z", "▁", "aaaa aaaa", "x" * 70])
def test_nbest_are_segmentations(spark, word):
    """The n best of a text, not their scores alone: ids, each with its score, all different, each decoded to the text."""
    v = _vocabulary()
    found = pieces.Encoder(v, 4).nbest_all([word])[0]
    ids = [np.frombuffer(x, np.int32).tolist() for _, x in found]
    assert [segmentations(v, x) for x in ids] == [x for x, _ in found] and len({tuple(x) for x in ids}) == len(ids)
    assert all(pieces.decode(v, x) == word for _, x in found)
    if len(word) < 20 and pieces.MARK not in word:
        whole = every_path(v, pieces.MARK + word.replace(" ", pieces.MARK)) if word else [(0.0, ())]
        assert all((s, tuple(x)) in whole for (s, _), x in zip(found, ids, strict=True)) and [s for s, _ in found] == [s for s, _ in whole[:4]]


def test_nbest_reach_the_rows(spark):
    rows = spark.createDataFrame([(1, "to be  or not"), (2, None), (3, ""), (4, f"{pieces.MARK}a"), (1, "to be  or not")], "doc_id long, text string")
    encoded = pieces.encode(rows, carry=["doc_id"])
    v, sha = _vocabulary(), lambda x: hashlib.sha256(x).hexdigest()
    for r, d in zip(*(sorted(x.collect(), key=lambda r: r.row.doc_id) for x in (encoded, pieces.digests(encoded))), strict=True):
        text = {1: "to be  or not", 3: "", 4: f"{pieces.MARK}a"}.get(r.row.doc_id)
        if text is None:
            assert r.others is None and d.others is None
            continue
        found = pieces.Encoder(v, 4).nbest_all([text])[0]
        assert [np.array(x, np.int32).tobytes() for x in (r.ids, *r.others)] == [x for _, x in found] and len(r.scores) == len(found)
        assert [tuple(x) for x in d.others] == [(len(x) // 4, sha(x), sha(text.encode())) for _, x in found[1:]]


@pytest.fixture(scope="module")
def unigram_models(tmp_path_factory):
    """Small models whose scores are learnt, so that the library has n best segmentations itself: without rules, and with its usual ones."""
    import sentencepiece

    lines = [x for t in pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()["text"][:60] for x in t.split("\n")]
    out = []
    for rules in ({"normalization_rule_name": "identity", "remove_extra_whitespaces": False}, {}, {"add_dummy_prefix": False}):
        out.append(str(tmp_path_factory.mktemp("unigram") / "m"))
        sentencepiece.SentencePieceTrainer.train(
            sentence_iterator=iter(lines), model_prefix=out[-1], vocab_size=800, model_type="unigram", byte_fallback=True, minloglevel=2, num_threads=1, **rules
        )
    return [f"{x}.model" for x in out], lines


@pytest.mark.parametrize("k", [0, 1, 2])
def test_nbest_are_the_library_s(unigram_models, k):
    """The library's own n best, in order, but for those of equal scores; texts are normalised as it does."""
    import sentencepiece

    (path, lines), n = (unigram_models[0][k], unigram_models[1]), 0
    sp, v = sentencepiece.SentencePieceProcessor(model_file=path), pickle.loads(pickle.dumps(pieces.Vocabulary.load(path)))
    texts = ["", " ", " two  spaces ", "ﬁ Ａ", "a\tb", *(x[:150] for x in lines[:300:3])]
    for text, found in zip(texts, pieces.Encoder(v, 4).nbest_all(texts), strict=True):
        want = sp.nbest_encode_as_ids(text, 5) if text.strip() else [sp.encode(text)]
        got, scores = [np.frombuffer(x, np.int32).tolist() for _, x in found], [segmentations(v, x) for x in want]
        assert len({tuple(x) for x in got}) == len(got) and [x for x, _ in found] == pytest.approx(scores[: len(found)], abs=1e-3)
        assert [segmentations(v, x) for x in got] == pytest.approx([x for x, _ in found], abs=1e-3)
        if all(a - b > 1e-3 for a, b in zip(scores, scores[1:], strict=False)):
            assert got == want[:4]
            n += 1
        assert {pieces.decode(v, x) for _, x in found} == {sp.decode(want[0])}
    assert n > 40


def test_merges_are_the_library_s(spark):
    """Ids by merges, many stretches at once and alone, are those of the library for a BPE file; without merges there are none."""
    import sentencepiece

    sp, v = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL), _vocabulary()
    texts = ["", "  ", "é日 z", "x" * 300, "\x00 a", "日本語日本語 mixed1text 12,5%", "aaa bbb" * 30]
    texts += [x[:2000] for x in pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()["text"][:100]]
    got = [np.frombuffer(x, np.int32).tolist() for _, x in pieces.Encoder(v, 4).all(texts)]
    assert got == sp.encode(texts, num_threads=1) and got != [np.frombuffer(x[0][1], np.int32).tolist() for x, _ in pieces.Encoder(v, 4).all(texts)]
    assert [[i for s in v.stretches(x) for i in v.merged(s)] for x in texts] == got
    assert pieces.Encoder(small_vocabulary(), 4).all(["ab"])[0][1] is None
    rows = spark.createDataFrame([(1, "the bathing"), (2, None)], "doc_id long, text string")
    encoded = pieces.encode(rows, carry=["doc_id"])
    assert {r.row.doc_id: r.merged for r in encoded.collect()} == {1: sp.encode("the bathing"), 2: None}
    out = {r.row.doc_id: r.merged for r in pieces.digests(encoded).collect()}
    assert out[2] is None and tuple(out[1])[2] == hashlib.sha256(b"the bathing").hexdigest()
