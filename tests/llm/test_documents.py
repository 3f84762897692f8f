"""Operators over documents against plain Python on a small corpus."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_fixtures import docs, no_docs, rows  # noqa: F401
from fleetlens.llm import components, jaccard, language, lm, packing, pieces, quality_model, quality_rules, substrings


def split(text):
    return (text or "").encode().split()


# op3 -----------------------------------------------------------------------------------------------------

def rule_counts(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    inside = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 20 or 100 * len(inside) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed


def test_quality_rules(docs, rows, no_docs):
    got = quality_rules.judge(docs).collect()
    want = sorted((i is None, i or 0, *rule_counts(t)) for i, t, _, _ in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert all(not r.kept for r in got if r.base_failed) and sum(r.kept for r in got) > 100
    assert quality_rules.judge(no_docs).count() == 0


def test_host_of_failures_is_rejected(spark):
    good = " ".join(f"w{i}" for i in range(40))
    data = [(i, good if i % 50 == 0 or i >= 200 else "too short", "bad" if i < 200 else f"h{i % 7}") for i in range(400)]
    got = quality_rules.judge(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()
    assert {r.host for r in got if r.host_rejected} == {"bad"}
    assert all(r.kept == (r.host != "bad") for r in got)


def test_hosts_are_rejected_that_fail_more_often_than_not(spark):
    """Hosts at 5, 40, 60 and 80 % failures, large and small: only the large ones beyond half go, with their passing documents."""
    good = " ".join(f"w{i}" for i in range(40))
    data, rates = [], {**{f"h{i}": (300, 5) for i in range(8)}, "at40": (1000, 40), "at60": (1000, 60), "at80": (1000, 80), "few": (5, 80)}
    for name, (n, percent) in rates.items():
        data += [(len(data) + i, "too short" if i * 100 < percent * n else good, name) for i in range(n)]
    got = quality_rules.judge(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()
    assert {r.host for r in got if r.host_rejected} == {"at60", "at80"}
    assert sum(r.kept != (not r.base_failed) for r in got) == 400 + 200
    assert all(r.kept == (not r.base_failed) for r in got if r.host not in ("at60", "at80"))


# op4 -----------------------------------------------------------------------------------------------------

def check_packing(got, capacity):
    used = defaultdict(list)
    for r in got:
        used[r.sequence_id].append((r.offset, r.length))
    for spots in used.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= capacity
    return len(used)


@pytest.mark.parametrize("rows_per_range", [250_000, 40])
def test_packing(docs, rows, no_docs, monkeypatch, rows_per_range):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "ROWS_PER_RANGE", rows_per_range)
    got = packing.packed_pieces(docs).collect()
    tool = Tokenizer.from_file(packing.default_tokenizer())
    want, total = Counter(), 0
    for i, t, _, _ in rows:
        ids = tool.encode(t or "", add_special_tokens=False).ids + [1]
        total += len(ids)
        for p in range(0, len(ids), 4096):
            own = ids[p:p + 4096]
            want[(i, p // 4096, p, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert check_packing(got, 4096) <= -(-total // 4096) + 2
    if rows_per_range == 40:
        assert packing.packed_pieces(no_docs).count() == 0


def test_packing_of_many_tiny_texts(spark):
    data = [(i, " ".join(["cat"] * (1 + i % 40))) for i in range(3000)]
    got = packing.packed_pieces(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert len(got) == 3000
    assert check_packing(got, 4096) <= -(-sum(r.length for r in got) // 4096) + 2


@pytest.mark.parametrize("rows_per_range", [250_000, 4000])
def test_packing_of_short_documents_uses_the_gaps(spark, monkeypatch, rows_per_range):
    monkeypatch.setattr(packing, "ROWS_PER_RANGE", rows_per_range)
    sizes = np.clip(np.random.default_rng(1).lognormal(6.0, 0.7, 10000).astype(int) + 1, 1, 4096).tolist()
    units = packing.keep(spark.createDataFrame(list(enumerate(sizes)), "uid long, size long"), "short-units")
    spots = packing.pack(units).join(units, "uid").select(F.col("seq").alias("sequence_id"), F.col("at").alias("offset"), F.col("size").alias("length")).collect()
    assert sorted(r.length for r in spots) == sorted(sizes)
    assert check_packing(spots, 4096) <= 1.005 * sum(sizes) / 4096


def test_gaps_take_several_small_units():
    u, g, left_u, left_g = packing.sweep(np.array([0, 0, 0, 0, 1, 1]), np.array([2, 3, 3, 9, 10, 12]), 4)
    assert list(zip(u, g)) == [(3, 4), (2, 5), (1, 5), (0, 5)] and not len(left_u) and not len(left_g)
    assert packing.across([(0, 5, 0), (1, 0, 4)], lambda gap_part, unit_part: 2) == [(1, 0, 0, 0, 5)]
    assert packing.across([(0, 1, 0), (1, 3, 0), (2, 0, 3)], lambda gap_part, unit_part: 2) == [(2, 0, 1, 0, 3), (2, 2, 0, 0, 1)]


def test_sweep_matches_nearest_and_across_by_rank():
    kinds, sizes = np.array([0, 0, 1, 1, 1, 0, 1, 0]), np.array([1, 2, 2, 3, 4, 5, 6, 9])
    u, g, left_u, left_g = packing.sweep(kinds, sizes)
    assert list(zip(u, g)) == [(1, 2), (0, 3), (5, 6)] and list(left_u) == [7] and list(left_g) == [4]
    assert packing.across([(0, 3, 0), (1, 1, 2), (2, 0, 4)]) == [(1, 0, 0, 0, 2), (2, 0, 1, 0, 1), (2, 1, 0, 2, 1)]


# op5 -----------------------------------------------------------------------------------------------------

def test_substring_dedup(docs, rows, no_docs):
    first = {}
    ids = lambda i: -1 if i is None else i
    for i, t, _, _ in rows:
        w = split(t)
        for s in range(len(w) - 49):
            k = tuple(w[s:s + 50])
            first[k] = min(first.get(k, 10 ** 9), ids(i))
    want = []
    for i, t, _, _ in rows:
        w = split(t)
        gone = {p for s in range(len(w) - 49) if first[tuple(w[s:s + 50])] < ids(i) for p in range(s, s + 50)}
        want.append((ids(i), len(w), len(gone), hashlib.sha256(b" ".join(x for p, x in enumerate(w) if p not in gone)).hexdigest()))
    got = [(ids(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substrings.removal_digest(docs).collect()]
    assert sorted(got) == sorted(want)
    assert sum(w[2] > 0 for w in want) > 15
    assert substrings.removal_digest(no_docs).count() == 0


def test_hot_passage_is_dealt_to_salted_shards(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_ROWS", 20)
    hot = " ".join(f"hot{i}" for i in range(70))
    data = [(i, " ".join(f"a{i}x{j}" for j in range(i % 30)) + " " + hot + " " + " ".join(f"b{i % 4}x{j}" for j in range(20))) for i in range(120)]
    got = {r.doc_id: r for r in substrings.removal_digest(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got[0].n_removed == 0
    for i in range(1, 120):  # the tail b0..b3 is shared as well, once an earlier document has it
        assert got[i].n_removed == (90 if i >= 4 else 70), i


def test_suffix_automaton_statistics():
    a = substrings.SuffixAutomaton()
    a.add(list("abcab"))
    a.add(list("xbca"))
    assert a.statistics(list("zabcxbcaq")) == [0, 1, 2, 3, 1, 2, 3, 4, 0]


def test_documents_without_passages(docs, rows):
    kept = substrings.without_redundant(docs)
    assert kept.columns == docs.columns
    by_id = {r.doc_id: r.text for r in kept.select("doc_id", "text").collect()}
    assert by_id[1] == rows[1][1] and by_id[200] is None
    assert 33 not in by_id and 0 not in by_id  # copies lose every word; the null id counts as smallest


# op8 -----------------------------------------------------------------------------------------------------

def shingle_set(text):
    w = split(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def brute_classes(items):
    sets = [shingle_set(t) for _, t in items]
    links = [[j for j in range(len(items)) if j != i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(len(items))]
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, near in enumerate(links):
        for j in near:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    least = defaultdict(lambda: 10 ** 9)
    for i, (d, _) in enumerate(items):
        least[find(i)] = min(least[find(i)], d)
    return sorted((d, least[find(i)], len(links[i])) for i, (d, _) in enumerate(items))


@pytest.mark.parametrize("small", [False, True])
def test_jaccard_classes(docs, rows, no_docs, monkeypatch, small):
    if small:  # salted buckets and several blocks
        monkeypatch.setattr(jaccard, "BUCKET_ROWS", 3)
        monkeypatch.setattr(jaccard, "BLOCK", 3)
    got = jaccard.similar_classes(docs).collect()
    least = lambda i: -1 if i is None else i
    want = brute_classes([(least(i), t) for i, t, _, _ in rows])
    assert sorted((least(r.doc_id), least(r.class_id), r.n_links) for r in got) == want
    assert max(w[2] for w in want) > 5
    if small:
        assert jaccard.similar_classes(no_docs).count() == 0


def test_one_of_each_class_stays(docs, rows):
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    want = Counter(d for d, c, _ in brute_classes([(-1 if i is None else i, t) for i, t, _, _ in rows]) if d == c)
    got = Counter(-1 if r.doc_id is None else r.doc_id for r in kept.select("doc_id").collect())
    assert set(got) == set(want) and max(got.values()) == 1


def test_bayesian_bounds():
    least = jaccard.least_matches(0.8)
    assert list(least) == sorted(least) and least[0] < 16 * 0.8 and least[-1] > 128 * 0.5
    same = np.zeros(128, np.uint16)
    other = np.ones(128, np.uint16)
    assert jaccard.survivors(same, np.array([same, other]), 0.8)[0].tolist() == [0]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}


# op7 -----------------------------------------------------------------------------------------------------

def test_lm_scores(docs, rows, no_docs, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 30)  # most words go through the join
    held = language.remainder("doc_id", 7) == 2
    model, words = lm.train_model(docs.where(~held))
    got = lm.score(docs, model, words).collect()
    counts = Counter()
    for i, t, _, _ in rows:
        if not language.held_out(i, 7, 2):
            counts.update((t or "").encode().lower().split() + [b"\n"])
    n, v = sum(counts.values()), len(counts)
    want = sorted((-1 if i is None else i, len(w), sum(counts[x] > 0 for x in w), round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6))
                  for i, t, _, _ in rows for w in [(t or "").encode().lower().split() + [b"\n"]])
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert all(r.train_tokens == n and r.score < 0 for r in got)
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    # transitions and emissions are distributions
    assert np.allclose((10 ** model["log_step"]).sum(axis=1), 1)
    assert lm.score(no_docs, model, words).count() == 0
    empty_model, no_words = lm.train_model(no_docs)
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in lm.score(docs, empty_model, no_words).collect())


def test_exchange_finds_alternating_classes():
    rng = np.random.default_rng(1)
    counts = np.zeros((41, 41))
    for _ in range(20000):  # a word of 1..20 is always followed by one of 21..40 and the reverse
        counts[rng.integers(1, 21), rng.integers(21, 41)] += 1
        counts[rng.integers(21, 41), rng.integers(1, 21)] += 1
    own = lm.exchange(counts, classes=3, sweeps=20)
    assert len(set(own[1:21])) == 1 and len(set(own[21:])) == 1 and own[1] != own[21]


# op9 -----------------------------------------------------------------------------------------------------

def test_language_id(docs, rows, no_docs):
    model = language.train(docs, language.remainder("doc_id", 4) != 2)
    got = language.predict(docs, model).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    held = [(i, lang) for i, _, lang, _ in rows if i is not None and i < 150 and language.held_out(i)]
    assert len(held) > 20 and sum(by_id[i].lang_pred == lang for i, lang in held) / len(held) > 0.97
    assert {by_id[i].lang_pred for i in (200, 201, 202, 204)} == {"und"}
    assert all(0 <= r.score <= 1 for r in got) and by_id[205].lang_pred == "de"
    kept = language.keep_identified(docs, model)
    assert kept.columns == docs.columns and {200, 201, 202, 204}.isdisjoint({r.doc_id for r in kept.select("doc_id").collect()})
    assert language.predict(no_docs, model).count() == 0
    nothing = language.train(no_docs)
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}


def test_features_of_blocks(monkeypatch):
    text = ("Über den Wäldern 12 liegt " * 50).encode()
    whole = language.features(text)
    monkeypatch.setattr(language, "BLOCK", 37)
    assert np.allclose(language.features(text), whole)


# op6 -----------------------------------------------------------------------------------------------------

def test_quality_model(docs, rows, no_docs):
    weights, prior, belief = quality_model.train(docs)
    got = {r.doc_id: r for r in quality_model.classify(docs, weights, prior, belief).collect()}
    junk = {i for i in range(150) if i % 17 == 2 and i % 29 != 4} | {91}  # 91 copies 87
    assert all(not got[i].kept for i in junk)
    assert all(got[i].kept for i in range(150) if i not in junk)
    assert not got[200].kept and not got[201].kept and got[203].kept
    kept = quality_model.keep_good(docs, weights, prior)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in quality_model.classify(docs, weights, prior, belief).collect())
    w, p, b = quality_model.train(no_docs)
    assert b == {} and quality_model.classify(no_docs, w, p, b).count() == 0


def test_em_recovers_labeller_accuracies():
    rng = np.random.default_rng(3)
    accuracy, patterns, truth = [0.95, 0.9, 0.85, 0.7, 0.65], Counter(), defaultdict(list)
    for _ in range(20000):
        good = rng.random() < 0.7
        votes = "".join("-" if rng.random() < 0.2 else str(int(good == (rng.random() < a))) for a in accuracy)
        patterns[votes] += 1
        truth[votes].append(good)
    belief = quality_model.posteriors(patterns)
    right = sum(sum(g == (belief[v] >= 0.5) for g in t) for v, t in truth.items())
    assert right / 20000 > 0.93


# op2 -----------------------------------------------------------------------------------------------------

def best_score(model, s):
    """Highest sum of scores over all segmentations, by plain dynamic programming."""
    best = [0.0] + [-math.inf] * len(s)
    for j in range(1, len(s) + 1):
        for i in range(max(0, j - model.longest), j):
            node = model.trie
            for c in s[i:j]:
                node = node.get(c, {})
            if "" in node:
                best[j] = max(best[j], best[i] + node[""][1])
            elif j == i + 1:
                best[j] = max(best[j], best[i] + model.unknown)
    return best[-1]


def test_viterbi_is_optimal_and_round_trips(rows):
    import sentencepiece

    model = pieces.load(pieces.default_model())
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    texts = [t for _, t, _, _ in rows[::9] if t] + ["  two  spaces ", "new\nline\ttab", "€uro 😀 中文 ñ", "x" * 300]
    for t in texts:
        t = t[:400]
        ids = np.frombuffer(model.encode(t, {}), "<u4").tolist()
        assert model.decode(np.array(ids)).decode() == t
        # the score of what was found: byte pieces stand for a character without a piece
        total, n = 0.0, 0
        for i in ids:
            if sp.is_byte(i):
                n += (model.decoded[i][0] & 0xC0) != 0x80
            else:
                total += sp.get_score(i)
        assert total + n * model.unknown == best_score(model, pieces.SPACE + t.replace(" ", pieces.SPACE))


def test_streaming_commits_early(rows):
    model = pieces.load(pieces.default_model())
    ids, most = model.viterbi("abcdefgh" * 5000)
    assert most < 200 and model.decode(np.array(ids)).decode() == "abcdefgh" * 5000


def test_round_trip_query_columns(docs, rows, no_docs):
    got = pieces.round_trip(docs).collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    assert {r.n_ids for r in got if r.doc_id in (200, 201)} == {0}
    encoded = pieces.encode(docs)
    back = {r.doc_id: r.text for r in pieces.decode(encoded).collect()}
    assert all(back[i] == (t or "") for i, t, _, _ in rows)
    crc = {r.doc_id: zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in encoded.collect()}
    assert all(crc[r.doc_id] == r.ids_crc32 for r in got)
    assert pieces.round_trip(no_docs).count() == 0
