"""WARC round trips and the exact kNN join against plain Python."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import knn, warc

BIG = "<html>" + "é€ long page " * 120 + "</html>"
FAKE = warc.MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def page_rows():
    rows = [(i, f"http://x.example/{i}", f"<p>page {i}</p>" * (i * 7)) for i in range(40)]
    rows += [(100, "u", BIG), (101, "u", BIG), (102, None, BIG), (103, "u", "s"), (104, "u", "s"), (105, "u", None), (106, "u", ""),
             (107, "bad\r\nWARC-Type: revisit", "x" * 999), (108, "u", "x" * 999), (109, "u", "y" * 1000), (110, "u", "y" * 1000), (110, "u", "y" * 1000),
             # payloads that hold the magic: a whole record, a broken one, the bare magic at both ends
             (120, "u", "before " + FAKE + " after"), (121, "u", FAKE), (122, "u", warc.MAGIC), (123, "u", warc.MAGIC + "x" + warc.MAGIC * 3),
             (124, "u", "a" * 3000 + FAKE * 5 + "b" * 3000), (125, "u", "WARC/1.1\r"), (126, "u", "\r\n\r\n"), (127, "u", "a" * 3000 + FAKE * 5 + "b" * 3000)]
    return rows


def expected(rows):
    by_payload = {}
    for i, _, h in rows:
        p = (h or "").encode()
        by_payload[p] = max(by_payload.get(p, -1), i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        again = len(p) >= 1000 and by_payload[p] != i
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", by_payload[p] if again else None))
    return Counter(out)


def read_back(spark, path):
    out = warc.resolved(warc.read_archives(spark, path))
    assert out.where(~F.col("digest_ok")).count() == 0
    return Counter(tuple(r) for r in out.select(warc.page_number("record_id"), "payload_bytes", "payload_digest", "record_type", warc.page_number("refers_to")).collect())


@pytest.fixture(scope="module")
def pages(spark):
    data = [(*r, "c", "c", "c") for r in page_rows()]
    return spark.createDataFrame(data, "page_id long, url string, html string, digest string, value string, payload string")


@pytest.mark.parametrize("bucket,split", [(1 << 22, None), (700, None), (700, 1500)])
def test_round_trip_rejects_magic_in_payloads(spark, pages, tmp_path, monkeypatch, bucket, split):
    monkeypatch.setattr(warc, "BUCKET", bucket)
    path = str(tmp_path / "archives")
    warc.write_archives(pages.coalesce(2), path)
    if split:  # candidates of one file come from many tasks
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert read_back(spark, path) == expected(page_rows())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_null_page_id_and_empty_table(spark, tmp_path):
    data = [(None, "u", BIG), (None, "u", BIG), (7, "u", BIG)]
    path = str(tmp_path / "a")
    warc.write_archives(spark.createDataFrame(data, "page_id long, url string, html string"), path)
    got = read_back(spark, path)
    assert sorted((k[0], k[3], k[4], n) for k, n in got.items() if k[0]) == [(7, "response", None, 1)]
    assert sum(n for k, n in got.items() if k[0] is None and k[3:] == ("revisit", 7)) == 2
    path = str(tmp_path / "b")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_archives(spark, path).count() == 0


def test_chain_stops_at_a_broken_link(spark, tmp_path):
    good = warc.MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:{}>\r\nContent-Length: 4\r\n\r\n\r\n\r\n" + warc.GAP
    folder = tmp_path / "c"
    folder.mkdir()
    (folder / "one.warc").write_bytes((good.format(1) + good.format(2) + "damage" + good.format(3)).encode())
    (folder / "two.warc").write_bytes(("not a record " + good.format(4)).encode())
    assert sorted(r.record_id for r in warc.read_archives(spark, str(folder)).collect()) == ["<urn:page:1>", "<urn:page:2>"]


def test_contract_leads_out_of_the_bucket():
    assert warc.contract([0, 10, 20, 25], [10, 20, 130, None], 100) == [130, 130, 130, -1]


def brute(vectors, is_query, k):
    out = []
    for q, a in vectors.items():
        if is_query(q):
            scored = sorted((-int(np.dot(a, b)), i) for i, b in vectors.items() if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("cell_rows,block", [(40_000, 50_000), (20, 3)])
def test_top_k(spark, monkeypatch, cell_rows, block):
    monkeypatch.setattr(knn, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(knn, "QUERY_BLOCK", block)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 12))
    data = [(i, (centres[i % 6] + 0.3 * rng.normal(size=12)).tolist()) for i in range(400)]
    data += [(i, data[0][1]) for i in range(400, 460)]  # ties: one vector many times
    data += [(500, None), (510, [1.0, None]), (520, [float("nan")] * 12), (530, [float("inf")] + [0.0] * 11), (None, [1.0] * 12), (540, []), (550, [0.5, -0.5]), (560, [0.0] * 12)]
    df = spark.createDataFrame([(*r, "x", "x") for r in data], "vec_id long, embedding array<double>, cell_group string, score string")
    vectors = {}
    for i, v in data:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            vectors[i] = np.array([int(np.floor(1024 * x)) for x in v] + [0] * (12 - len(v)))
    got = knn.top_k(knn.integer_vectors(df), F.col("vec_id") % 10 == 0)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == brute(vectors, lambda q: q % 10 == 0, 10)


def test_top_k_of_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert knn.top_k(knn.integer_vectors(spark.createDataFrame([], schema)), F.lit(True)).count() == 0
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.25, 0.5])], schema)
    assert sorted(tuple(r) for r in knn.top_k(knn.integer_vectors(df), F.col("vec_id") == 0).collect()) == [(0, 1, 1, 512 * 1024)]
