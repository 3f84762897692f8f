"""The class-based language model against a plain-Python one, and the choice of frequent words."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_fixtures import docs, no_docs, rows  # noqa: F401
from fleetlens.llm import language, lm

C = lm.CLASSES


def plain_model(texts, held, units, head, sweeps):
    """Scores of all texts; learns from those that aren't held out. Dictionaries and loops only (but for the core's exchange)."""
    coded = [[lm.number(w) for w in (t or "").encode().lower().split()] for t in texts]
    train = [c for c, h in zip(coded, held) if not h]
    count = Counter(w for c in train for w in c)
    order = sorted(count, key=lambda w: (-count[w], w))
    core = {w: i + 1 for i, w in enumerate(order[:units])}

    def bigrams(value, width):
        out = [[0.0] * width for _ in range(width)]
        for c in train:
            values = [0, *(value(w) for w in c), 0]
            for a, b in zip(values, values[1:]):
                out[a][b] += 1
        return out

    width = units + 1 + lm.SUFFIXES
    unit = lambda w: core.get(w, units + 1 + w % lm.SUFFIXES)
    own = lm.exchange(np.array(bigrams(unit, width))).tolist()
    ending = lambda w: own[units + 1 + w % lm.SUFFIXES]
    classes = {w: own[u] for w, u in core.items()}
    context = lambda w, known: known.get(w, ending(w))
    known = dict(classes)
    follow = bigrams(lambda w: own[unit(w)], C)
    for _ in range(sweeps):
        before, after = defaultdict(Counter), defaultdict(Counter)
        for c in train:
            values = [0, *(context(w, known) for w in c), 0]
            for i, w in enumerate(c):
                before[w][values[i]] += 1
                after[w][values[i + 2]] += 1
        row = [math.log(sum(follow[g]) + 0.5 * C) for g in range(C)]
        col = [math.log(sum(follow[x][g] for x in range(C)) + 0.5 * C) for g in range(C)]
        classes = {w: own[u] for w, u in core.items()}
        for w, n in count.items():
            if w not in core and n >= 2:
                gain = [round(sum(k * (math.log(follow[g][x] + 0.5) - row[g]) for x, k in after[w].items())
                              + sum(k * (math.log(follow[x][g] + 0.5) - col[g]) for x, k in before[w].items()), 9) for g in range(1, C)]
                classes[w] = 1 + gain.index(max(gain))
        known = {w: classes.get(w, ending(w)) for w in order[:head]}
        follow = bigrams(lambda w: context(w, known), C)
    final = lambda w: classes.get(w, ending(w))
    tokens, kinds = [0.0] * C, [0.0] * C
    for w, n in count.items():
        tokens[final(w)] += n
        kinds[final(w)] += 1
    tokens[0], kinds[0] = len(train), min(len(train), 1)
    share = [(t + 1) / (sum(tokens) + C) for t in tokens]
    step = [[(follow[a][b] + lm.PRIOR * share[b]) / (sum(follow[a]) + lm.PRIOR) for b in range(C)] for a in range(C)]
    out = []
    for c in coded:
        at, total = 0, 0.0
        for w in [*c, None]:
            k, n = (0, len(train)) if w is None else (final(w), count[w])
            total += math.log10(step[at][k]) + math.log10((n + 1) / (tokens[k] + kinds[k] + 1))
            at = k
        out.append(total)
    return out


@pytest.mark.parametrize("units, head, sweeps", [(20, 40, 2), (64, 64, 1), (20, 100_000, 2)])
def test_scores_equal_the_plain_model(docs, rows, monkeypatch, units, head, sweeps):
    for name, value in (("UNITS", units), ("HEAD", head), ("REST_SWEEPS", sweeps), ("BLOCK", 500), ("WORDS_PER_PART", 100)):
        monkeypatch.setattr(lm, name, value)
    held = language.remainder("doc_id", 7) == 2
    coded = lm.encode(docs, ~held)
    model, words, codes = lm.train_on(coded)
    got = sorted(((r.doc_id is not None, r.doc_id or 0), round(r.score, 6)) for r in lm.score_codes(codes, model, words).collect())
    flags = [language.held_out(i, 7, 2) for i, _, _, _ in rows]
    want = plain_model([t for _, t, _, _ in rows], flags, units, head, sweeps)
    want = sorted(((i is not None, i or 0), round(s, 6)) for (i, _, _, _), s in zip(rows, want))
    assert [k for k, _ in got] == [k for k, _ in want] and np.allclose([s for _, s in got], [s for _, s in want], atol=2e-6)


def test_more_words_get_their_own_class_as_the_corpus_grows(spark, docs):
    own = lambda m: m[1].where("n >= 2").count()
    few = lm.train_model(docs.where("doc_id < 40"))
    many = lm.train_model(docs.union(docs.withColumn("text", F.regexp_replace("text", "([a-z])", "$1x"))))
    assert own(many) > 2 * own(few)


@pytest.mark.parametrize("counts", [[5] * 5000, [1] * 3000 + [7] * 40, list(range(1, 3000)), [10 ** 6] + [3] * 2000, [2] * 10, []])
def test_frequent_words_are_exact_whatever_the_counts(spark, counts):
    rng = np.random.default_rng(4)
    ids = rng.integers(-(2 ** 63), 2 ** 63 - 1, len(counts))
    table = spark.createDataFrame([(int(i), int(c)) for i, c in zip(ids, counts)], "id long, n long")
    got = lm.frequent(table, 50)
    want = sorted(zip(ids.tolist(), counts), key=lambda x: (-x[1], x[0]))[:50]
    assert list(zip(got["id"].tolist(), got["n"].tolist())) == want
