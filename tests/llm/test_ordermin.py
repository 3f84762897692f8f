"""Order MinHash fingerprints against plain Python."""

import hashlib
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from corpus_fixtures import docs, no_docs, rows  # noqa: F401
from fleetlens.llm import ordermin

MASK = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hash_of(*values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v if isinstance(v, bytes) else (v & MASK).to_bytes(8, "little"), seed=seed)
    return signed(seed)


def signature(text):
    """The same selection, written down step by step for one text."""
    tokens = re.findall(r"[^\x20\x09-\x0D]{1,16}[\x20\x09-\x0D]?|[\x20\x09-\x0D]", text or "")
    kmers = [hash_of(*(t.encode() for t in tokens[i:i + 2])) >> 31 for i in range(len(tokens))]
    if not kmers:
        return [0xFFFF] * 64
    seen, numbered = Counter(), []
    for place, k in enumerate(kmers):
        numbered.append((hash_of(k, seen[k]) >> 31, place))
        seen[k] += 1
    out = []
    for g in range(2):
        order = sorted((hash_of(k, g) >> 31, place) for k, place in numbered)
        for j in range(32):
            start = (-(1 << 63) + j * (1 << 59)) >> 31
            at = next((i for i, (h, _) in enumerate(order) if h >= start), 0)
            chosen = sorted((order[(at + e) % len(order)] for e in range(2)), key=lambda x: x[1])
            out.append(hash_of(*(h & (1 << 33) - 1 for h, _ in chosen)) & 0xFFFF)
    return out


def test_signatures_equal_the_plain_ones(docs, rows):
    got = ordermin.fingerprints(docs).select("text", "signature", "fingerprint").collect()
    assert len(got) == len(rows)
    want = {t: signature(t) for _, t, _, _ in rows}
    for r in got:
        assert list(r.signature) == want[r.text] and r.fingerprint == "".join(f"{v:04x}" for v in r.signature)


@pytest.mark.parametrize("per_range", [9, 500])
def test_successors(docs, rows, monkeypatch, per_range):
    monkeypatch.setattr(ordermin, "ROWS_PER_RANGE", per_range)
    got = ordermin.with_successors(docs).collect()
    order = sorted(((i is not None, i or 0, hash_of((t or "").encode())), i, t or "") for i, t, _, _ in rows)
    want = Counter()
    for at, (_, i, t) in enumerate(order):
        after = order[(at + 1) % len(order)][2]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        want[(i, len(t), hashlib.sha256(edited.encode()).hexdigest(), *map(tuple, map(signature, (t, edited, after))))] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, tuple(r.signature), tuple(r.edited_signature), tuple(r.next_signature)) for r in got) == want


def test_empty_and_single_row_tables(spark, no_docs):
    assert ordermin.with_successors(no_docs).count() == 0
    one = spark.createDataFrame([(5, "one two three four")], "doc_id long, text string")
    r = ordermin.with_successors(one).select("*", ordermin.likeness("signature", "next_signature").alias("near")).first()
    assert r.near == 1.0 and r.edited_sha256 == hashlib.sha256(b"one two tone two t").hexdigest()


def test_likeness_follows_edits_and_order(spark):
    words = [f"w{i * 7919 % 1000}" for i in range(600)]
    moved = words[300:] + words[:300]
    few = [w if i % 40 else f"x{i}" for i, w in enumerate(words)]
    back = words[::-1]
    data = [(n, " ".join(w)) for n, w in (("same", words), ("few", few), ("moved", moved), ("back", back), ("other", [f"y{i}" for i in range(600)]))]
    sig = {r.name: r.signature for r in ordermin.with_signatures(spark.createDataFrame(data, "name string, text string"), {"text": "signature"}).collect()}
    near = {n: sum(a == b for a, b in zip(sig["same"], s)) / 64 for n, s in sig.items()}
    assert near["same"] == 1 and near["few"] > 0.7 and 0.3 < near["moved"] < 0.7 and near["back"] < 0.1 and near["other"] < 0.05


def test_no_python_workers_in_the_plan(docs):
    plan = ordermin.with_successors(docs)._jdf.queryExecution().executedPlan().toString()
    signed = ordermin.with_signatures(docs.select(F.col("text")), {"text": "signature"})._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan + signed for x in ("Python", "Pandas", "Arrow"))
