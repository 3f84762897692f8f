"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from fleetlens.llm import conversations as conv

LONG = 600


def plain_damage(rows):
    """(conv_id, turn, role, text) after damage."""
    out = []
    for c, t, role, text in rows:
        s = lambda x: " " if x is None else str(x)
        f = zlib.crc32(f"{s(c)}:{s(t)}".encode()) % 20
        role, text = s(role), s(text)
        text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
        out += [(c, t, "user" if f == 4 else role, text)] * (0 if f == 0 else 2 if f == 3 else 1)
    return out


def plain_repair(rows):
    """All columns of one conversation's rows (after damage): every edit sequence is weighed by (cost, audit)."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3][:32].encode(), hashlib.sha256(r[3].encode()).digest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        core = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None)
        seen.add((role, text))
    follow = {("", "u"): "u", ("", "s"): "s", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    whose = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def offer(to, state, value):
        if state not in to or value[:2] < to[state][:2]:
            to[state] = value

    def insert(states):
        for _ in range(4):
            for q, (cost, audit, lines) in list(states.items()):
                offer(states, whose[q], (cost + 2, audit + "I", lines + (f"{'user' if whose[q] == 'u' else 'assistant'}:",)))
        return states

    for (_, _, role, text), fault in zip(rows, faults):
        after = {}
        for q, (cost, audit, lines) in insert(best).items():
            offer(after, q, (cost + 3, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                cut = fault == "truncated"
                if (q, role[:1]) in follow:
                    offer(after, role[:1], (cost + cut, audit + "K", lines + (f"{role}:{text}",)))
                offer(after, whose[q], (cost + 2 + cut, audit + "R", lines + (f"{'user' if whose[q] == 'u' else 'assistant'}:{text}",)))
        best = after
    cost, audit, lines = min(v for q, v in insert(best).items() if q in ("", "a"))
    turns = {r[1] for r in rows if r[1] is not None}
    count = Counter(faults)
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def awkward():
    rng = random.Random(3)
    texts = ["Fine.", "Fine.", "Good!", "cut off", "", " \n\t", None, "What? ", "é.  ", "x" * 5000 + ".", "a\x0b.\r\n"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "support"]
    rows = []
    for c in [None, *range(60)]:
        n = rng.randint(1, 14)
        for i in range(n):
            role = ("user", "assistant")[i % 2] if rng.random() < 0.6 else rng.choice(roles)
            turn = i if rng.random() < 0.8 else rng.choice([None, i + 3, 0, 7])
            text = f"turn {i} of {c}." if rng.random() < 0.6 else rng.choice(texts)
            rows += [(c, turn, role, text)] * (2 if rng.random() < 0.05 else 1)
    # one long conversation: clean stretches, blank stretches (vectors never converge there), noise
    for i in range(LONG):
        kind = i // 100 % 4
        rows.append((1000, i, ("user", "assistant")[i % 2] if kind < 2 else rng.choice(roles),
                     "" if kind == 1 else f"line {i}" + ("." if rng.random() < 0.7 else "")))
    rows += [(1001, i, "user", "") for i in range(300)]  # only blank rows
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("per_range", [20, 4000])
def test_repair_equals_the_plain_search(spark, monkeypatch, per_range):
    monkeypatch.setattr(conv, "ROWS_PER_RANGE", per_range)
    rows = awkward()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, rid string, part long").repartition(5)
    want = {}
    for c in {r[0] for r in rows}:
        want[c] = plain_repair([r for r in plain_damage(rows) if r[0] == c])
    got = conv.repair(conv.damaged(df)).collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id], r.conv_id


def test_conversation_whose_rows_all_drop_out(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    got = conv.repair(conv.damaged(spark.createDataFrame([(gone, 1, "user", "Hi.")], "conv_id long, turn long, role string, text string"))).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conv.repair(conv.damaged(empty)).count() == 0


def test_stitched_vectors_equal_those_of_one_sweep():
    rng = random.Random(9)
    search = conv.Search()
    for _ in range(300):
        codes = "".join(rng.choice(rng.choice(["suaoSUAOx", "x", "ua", "xo"])) for _ in range(rng.randint(1, 60)))
        cuts = sorted(rng.sample(range(len(codes) + 1), min(4, len(codes))))
        pieces = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])]
        whole = search.vectors(codes, conv.END)
        need, at = conv.END, len(codes)
        for piece in reversed(pieces):
            before, matrix = search.converge(piece)
            fixed = search.rerun(piece, search.vectors(piece, conv.END), need)
            assert fixed[:-1] == whole[at - len(piece):at][:len(fixed) - 1]
            need = before if matrix is None else conv.through([list(m) for m in matrix], need)
            at -= len(piece)
            assert need == fixed[-1] == (whole[at - 1] if at else whole[-1])
