"""Records: archives, vectors, conversations."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vellum.llm import chat, common, knn, queries, warc


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_matches_sql(spark, sf_dir, name):
    import glob
    import os

    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = queries.QUERIES[name](spark, sf_dir)
    cursor = con.execute(queries.ORACLE_SQL[name])
    at = {d[0]: k for k, d in enumerate(cursor.description)}
    assert sorted(at) == sorted(df.columns)
    theirs = sorted((tuple(r[at[c]] for c in df.columns) for r in cursor.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.collect()), key=repr) == theirs


def test_warc_round_trip(spark):
    rows = [(1, "http://a/é%20\r\nX: y", "<a>é"), (2, None, "<a>é"), (3, "u", None), (None, "n", "zz"), (5, "x", ""), (7, "t", "zz\r\n\r\nWARC/1.1\r\n"), (7, "t", "zz\r\n\r\nWARC/1.1\r\n")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha", F.lit(1))
    warc.register(spark)
    path = common.fresh_path(spark, "warc")
    warc.with_revisits(df, "page_id", "url", "html").write.format("warc").mode("append").save(path)
    back = spark.read.format("warc").load(path)
    got = sorted(((r.id, r.uri, r.record_type, r.refers_to, r.payload_bytes, bytes(r.payload)) for r in back.collect()), key=repr)
    whole = "zz\r\n\r\nWARC/1.1\r\n".encode()
    want = [(1, rows[0][1], "revisit", 2, 5, b""), (2, None, "response", None, 5, "<a>é".encode()), (3, "u", "revisit", 5, 0, b""), (None, "n", "response", None, 2, b"zz"), (5, "x", "response", None, 0, b""), (7, "t", "response", None, 16, whole), (7, "t", "response", None, 16, whole)]
    assert got == sorted(want, key=repr)
    assert all(r.digest == warc.digest(bytes(r.payload)) for r in back.where("record_type = 'response'").collect())
    some = spark.read.format("warc").option("columns", "id,record_type").load(path).where("record_type = 'revisit' and id > 1")
    assert [tuple(r) for r in some.collect()] == [(3, "revisit")]
    assert " Filter " not in some._jdf.queryExecution().executedPlan().toString()


def test_warc_skips_payloads(spark, tmp_path):
    """With no payload wanted, no record's payload is decoded into a row; filters are kept from Spark only if known."""
    data = b"".join(warc.record(k, "u", b"x" * 50, "D", None) for k in range(3))
    (tmp_path / "plain.warc").write_bytes(data)
    reader = warc.WarcReader(str(tmp_path), ["id", "payload_bytes"])
    from pyspark.sql.datasource import EqualTo, StringContains

    left = list(reader.pushFilters([EqualTo(("id",), 1), StringContains(("uri",), "u"), EqualTo(("payload",), b"x")]))
    assert len(left) == 2
    (part,) = reader.partitions()
    assert [b.to_pylist() for b in reader.read(part)] == [[{"id": 1, "payload_bytes": 50}]]


FOREIGN = (
    b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:9b0a>\r\nWARC-Target-URI: http://a/%E9%zz%20\xff\r\nContent-Type: application/http;\r\n msgtype=response\r\n"
    b"Content-Length: 25\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody!!\r\n\r\n"
    b"WARC/1.0\r\nwarc-type: metadata\r\nWARC-Record-ID: <urn:uuid:77>\r\nWARC-Refers-To: <urn:uuid:9b0a>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
)


@pytest.mark.parametrize("pack", [bytes, lambda x: __import__("gzip").compress(x), lambda x: b"".join(__import__("gzip").compress(p) for p in (x[:300], x[300:]))])
def test_warc_reads_archives_of_others(spark, tmp_path, pack):
    (tmp_path / "in/deep").mkdir(parents=True)
    data = pack(FOREIGN)
    name = "x.warc" if data == FOREIGN else "x.warc.gz"
    (tmp_path / "in/deep" / name).write_bytes(data)
    (tmp_path / "in" / f"copy{name}").write_bytes(data)
    warc.register(spark)
    rows = spark.read.format("warc").load(str(tmp_path / "in")).orderBy("record_id").collect()
    assert len(rows) == 4 and [r.id for r in rows] == [None] * 4
    assert (rows[3].record_id, rows[3].uri, rows[3].content_type, bytes(rows[3].payload)) == ("<urn:uuid:9b0a>", "http://a/%E9%zz%20�", "application/http; msgtype=response", b"HTTP/1.1 200 OK\r\n\r\nbody!!")
    assert (rows[0].record_type, rows[0].refers_to_id, rows[0].payload_bytes) == ("metadata", "<urn:uuid:9b0a>", 3)
    one = spark.read.format("warc").load(str(tmp_path / "in" / f"copy{name}")).where("record_type = 'metadata'")
    assert one.count() == 1
    for cut in (len(data) // 3, len(data) - 6):
        (tmp_path / "in" / f"copy{name}").write_bytes(data[:cut])
        with pytest.raises(Exception, match="ends inside"):
            spark.read.format("warc").load(str(tmp_path / "in")).collect()


def test_warc_appends_and_overwrites(spark):
    warc.register(spark)
    path = common.fresh_path(spark, "warc")
    ids = lambda: sorted(r.id for r in spark.read.format("warc").load(path).collect())
    rows = lambda *n: warc.with_revisits(spark.createDataFrame([(i, "u", f"text {i}") for i in n], "page_id long, url string, html string").repartition(2), "page_id", "url", "html")
    rows(1, 2, 3).write.format("warc").mode("append").save(path)
    rows(4, 5).write.format("warc").mode("append").save(path)
    assert ids() == [1, 2, 3, 4, 5]
    rows(9).write.format("warc").mode("overwrite").save(path)
    assert ids() == [9]


def test_warc_passes_over_members(tmp_path):
    """What a member holds beyond its headers is not inflated unless it is wanted: damage there goes unseen."""
    data = [warc.member(warc.record(k, "u", random.Random(k).randbytes(9000), "D", None)) for k in range(3)]
    broken = bytearray(data[1])
    broken[5000:5400] = bytes(400)
    (tmp_path / "x.warc.gz").write_bytes(data[0] + bytes(broken) + data[2])

    def read(*columns):
        reader = warc.WarcReader(str(tmp_path), list(columns))
        return [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]

    assert [r["id"] for r in read("id", "payload_bytes")] == [0, 1, 2]
    with pytest.raises(ValueError, match="x.warc.gz"):
        read("id", "payload")


def test_warc_small_payloads(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    got = {r.id: r.refers_to for r in warc.with_revisits(df, "page_id", "url", "html", least_bytes=3).collect()}
    assert got == {1: None, 2: None, 3: 4, 4: None}


def test_empty_warc(spark):
    warc.register(spark)
    path = common.fresh_path(spark, "warc")
    df = spark.createDataFrame([], "page_id long, url string, html string")
    warc.with_revisits(df, "page_id", "url", "html").write.format("warc").mode("append").save(path)
    assert spark.read.format("warc").load(path).count() == 0


def brute(rows, k):
    clean = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in clean:
        if q % 50 == 0:
            scores = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in clean if i != q))[:k]  # noqa: B905
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_knn(spark, spread):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1, (6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(0, spread, 8)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # one common vector
    rows += [(600, None), (650, [1.0, None] + [0.0] * 6), (700, [float("nan")] * 8), (750, [float("inf")] * 8), (None, [1.0] * 8), (800, [0.0] * 8), (850, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("task", F.lit("x"))
    got = sorted(tuple(r) for r in knn.nearest(df, F.col("vec_id") % 50 == 0).collect())
    assert got == brute(rows, 5)
    few = df.where("vec_id in (0, 1, 2)")
    assert len(knn.nearest(few, F.col("vec_id") % 50 == 0).collect()) == 2
    assert knn.nearest(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


@pytest.mark.parametrize("copies", [10, 100])
def test_knn_repeated_query(spark, copies):
    """Rows with the query's id, however many, leave no neighbour out."""
    rng = np.random.default_rng(4)
    rows = [(i, (np.eye(24)[i % 4] * 4 + rng.normal(0, 0.05, 24)).tolist()) for i in range(1, 80) if i % 50]
    rows += [(50 * q, (np.eye(24)[4 + q] * 9).tolist()) for q in range(20) for _ in range(copies)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in knn.nearest(df, F.col("vec_id") % 50 == 0).collect())
    assert got == sorted(set(brute(rows, 5)))


def test_knn_repeated_rows(spark):
    """One id on 300 rows, and one vector under 5000 ids: nothing is lost, blocks stay bounded."""
    rng = np.random.default_rng(9)
    rows = [(7, rng.normal(0, 1, 6).tolist()) for _ in range(300)] + [(i, rng.normal(0, 1, 6).tolist()) for i in range(40, 160)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in knn.nearest(df, F.col("vec_id") % 50 == 0).collect()) == brute(rows, 5)
    only = spark.createDataFrame([(7, [1.0, 2.0])] * 300 + [(50, [2.0, 1.0])], "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in knn.nearest(only, F.col("vec_id") % 50 == 0).collect()) == [(50, n, 7, 4 * 256 * 256) for n in range(1, 6)]
    common = [(1000 + i, [1.0, 0.5]) for i in range(5000)] + [(i, [float(i % 3), 1.0]) for i in range(0, 300, 10)]
    small = spark.createDataFrame(common, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in knn.nearest(small, (F.col("vec_id") % 50 == 0) & (F.col("vec_id") < 1000)).collect()) == [r for r in brute(common, 5) if r[0] < 1000]


def test_knn_prunes():
    """Rows near one center aren't sent to the queries of a far one."""
    space = knn._Space(np.array([[100, 0], [-100, 0]]), 100.0**2 * 2)
    cells = knn._Cells(np.array([50, 50]), [np.zeros(6), np.zeros(6)], np.array([1.0, 1.0]), 5, 1)
    groups = knn._Groups(2)
    d = space.distances(np.array([[100, 0], [-100, 0]]), True)
    groups.add(d, cells.bound(d, space))
    rows = space.distances(np.array([[100, 0], [-100, 0], [99, 1]]), False)
    assert groups.needs(rows).tolist() == [[True, False], [False, True], [True, False]]


def test_chat_grammar():
    rng = random.Random(1)
    parts = ["<", "|", "\\", "\n", "im_end", "|>", chat.END, chat.START, "p", "n", "a"]
    for _ in range(5000):
        role, text = ("".join(rng.choice(parts) for _ in range(rng.randint(0, 7))) for _ in range(2))
        shown = chat.render(role, text)
        assert [x[:2] for x in chat.parse(shown + shown)] == [(role, text)] * 2
    with pytest.raises(chat.Conflict):
        list(chat.parse("<|im_start|>user\na<|im_start|>b<|im_end|>\n"))


def test_chat_frames(spark):
    rows = [(1, 1, "assistant", "b<|im_end|>"), (1, 0, "user", "a"), (2, None, None, None), (2, 0, "assistant", "x"), (2, 0, "assistant", "x"), (None, 5, "user", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(1)).withColumn("loss", F.lit(1))
    formatted = chat.format_conversations(df)
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[1].n_turns, got[1].turns_sha256, got[1].loss_sha256, got[1].loss_chars) == (2, sha("user\na\nassistant\nb<|im_end|>\n"), sha("b<|im_end|>"), 11)
    assert (got[2].n_turns, got[2].turns_sha256, got[2].loss_chars) == (3, sha("\n\nassistant\nx\nassistant\nx\n"), 2) and got[None].loss_sha256 == sha("")
    parts = {r.conv_id: r for r in formatted.collect()}
    assert got[1].formatted_chars == len(parts[1].text) and [chat.unescape_text(parts[1].text[s.start : s.end]) for s in parts[1].loss] == ["b<|im_end|>"]
    assert chat.read_back(chat.format_conversations(df.limit(0))).collect() == []


def test_list_rows():
    table = pa.table({"a": pa.chunked_array([[[1, 2], []], [[3]]])})
    assert [x[0].tolist() for x in common.list_rows(table, "a")] == [[1, 2], [], [3]]


def test_conversations_of_several_parts(spark, monkeypatch):
    """A conversation that fills many parts comes back as one, in order; one of many turns on one number keeps them all."""
    monkeypatch.setattr(chat, "PART", 200)
    rows = [(c, t, "assistant" if t % 2 else "user", f"turn {t} <|im_end|> " * 5) for c in (1, 2) for t in range(60)] + [(3, 0, "user", f"{k:04d}") for k in range(300)]
    formatted = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert formatted.where("conv_id = 1").count() > 20
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in chat.read_back(formatted).collect():
        mine = [x for x in rows if x[0] == r.conv_id]
        assert (r.n_turns, r.turns_sha256) == (len(mine), sha("".join(f"{x[2]}\n{x[3]}\n" for x in mine)))
        assert r.loss_sha256 == sha("".join(x[3] for x in mine if x[2] == "assistant"))
