"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib

import pytest

from corpus_fixtures import docs, no_docs, rows  # noqa: F401
from fleetlens.llm import resampling

TARGET = [(1, "The weather, the WEATHER of the house; wish1 123 Straße"), (2, None), (3, ""), (4, "qui avec ça où")]


def runs(text, order):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    return len(w), [" ".join(w[i:i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)]


def want(texts, targets, order, buckets=10_000):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    raw, aim = [0] * buckets, [0] * buckets
    for count, some in ((raw, [t for _, t in texts]), (aim, targets)):
        for t in some:
            for f in runs(t, order)[1]:
                count[bucket(f)] += 1
    s_all, t_all = sum(raw), sum(aim)
    gain = [math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets)))) for s, t in zip(raw, aim)]
    out, able = [], []
    for i, t in texts:
        n, found = runs(t, order)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        row = [i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
        out.append(row)
        if n >= 20:
            able.append(row)
    able.sort(key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[2], r[1]))
    for place, row in enumerate(able[:10 * len(able) // 100]):
        row[4] = place + 1
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("order, joined, block, per_range", [(1, 4_000_000, 100_000, 1_000_000), (3, 500, 7, 10)])
def test_resampling(spark, docs, rows, monkeypatch, order, joined, block, per_range):
    monkeypatch.setattr(resampling, "JOINED_BYTES", joined)
    monkeypatch.setattr(resampling, "BLOCK", block)
    monkeypatch.setattr(resampling, "ROWS_PER_RANGE", per_range)
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    got = resampling.resample(docs, target, order=order).collect()
    assert sorted(map(tuple, got), key=str) == want([(i, t) for i, t, _, _ in rows], [t for _, t in TARGET], order)


def test_empty_tables(spark, docs, no_docs):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resample(no_docs, empty).count() == 0
    got = resampling.resample(docs, empty)
    assert got.count() == docs.count() and got.where("rank is not null").count() > 0


def test_sentinels_in_texts_part_words(spark):
    a = [(1, "a\x00b c"), (2, "d")]
    got = {r.doc_id: r.n_features for r in resampling.weigh(spark.createDataFrame(a, "doc_id long, text string"), [0] * 100, order=2).collect()}
    assert got == {1: 5, 2: 1}


def test_draw_prefers_texts_like_the_target(spark):
    data = [(i, " ".join(["kernel matrix vector tensor" if i % 10 == 0 else "garden river mountain valley"] * 6)) for i in range(400)]
    target = spark.createDataFrame([(0, "tensor kernel vector matrix " * 20)], "item_id long, text string")
    got = resampling.resample(spark.createDataFrame(data, "doc_id long, text string"), target).where("rank is not null").collect()
    assert {r.doc_id for r in got} == set(range(0, 400, 10)) and sorted(r["rank"] for r in got) == list(range(1, 41))
