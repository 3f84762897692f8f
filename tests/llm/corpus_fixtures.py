"""Fixtures of the training-data operators: a small corpus with every awkward case."""

import random

import pytest

#: Extra columns whose names operators use inside.
CLASH = ["node", "sid", "did", "sign", "h", "n", "key", "rank", "size", "host", "kept", "score", "uid", "seq", "free", "value", "digest"]


def words(rng, n, vocabulary):
    return [rng.choice(vocabulary) for _ in range(n)]


def corpus():
    """(doc_id, text, lang, source): copies, near copies, shared passages, nulls, empties, long and tied texts."""
    rng = random.Random(5)
    vocab = {
        "en": ["the", "of", "thing", "with", "weather", "shall", "house", "king", "wood", "wish", "think", "hawk"] + [f"wh{a}th{b}" for a in "aeiou" for b in "aeiou"],
        "de": ["der", "und", "schön", "über", "nicht", "zeit", "kraft", "straße", "ich"] + [f"sch{a}z{b}ung" for a in "aeiou" for b in "äöüe"],
        "fr": ["le", "est", "être", "eau", "où", "ça", "qui", "avec"] + [f"{a}eaux{b}ment" for a in "éèaou" for b in "éèai"],
        "es": ["el", "que", "niño", "los", "año", "mira", "para"] + [f"{a}ción{b}o" for a in "aeiou" for b in "sñl"],
    }
    rows, langs = [], list(vocab)
    passage = " ".join(words(rng, 60, vocab["en"]))
    near = words(rng, 120, vocab["en"])
    for i in range(150):
        lang = langs[i % 4]
        text = " ".join(words(rng, rng.randint(30, 200), vocab[lang])).capitalize() + ".\n" + " ".join(words(rng, rng.randint(5, 60), vocab[lang])) + "."
        if i % 11 == 3:
            text = passage + "\n" + text if i % 2 else text + " " + passage
        if i % 13 == 5:
            lang, other = "en", list(near)
            for _ in range(i % 3):
                other[rng.randrange(len(other))] = f"new{i}"
            text = " ".join(other)
        if i % 17 == 2:
            text = "".join(f"{w}{rng.choice(['***', '$$$', '&&&', '###'])} " for w in text.split())
        if i % 29 == 4:
            text = rows[i - 4][1]  # an exact copy
        rows.append((i, text, lang, "hot" if i % 3 else f"src{i % 5}"))
    rows += [(200, None, "en", "src1"), (201, "", "en", None), (202, " \n\t ", None, "src1"), (203, "x", "en", "src2"), (204, "1234 56 !! ??", None, "src2"),
             (205, " ".join(words(rng, 9000, vocab["de"])), "de", "src3"), (206, "a b c", "en", "src2"), (207, "a b c", "en", "src2"), (207, "a b c", "en", "src2"),
             (None, "null id " + rows[0][1], "en", "src1"), (208, "W" * 5000, "en", "src1"), (209, " ".join(["again"] * 70), "en", "src1"), (210, " ".join(["again"] * 300), "en", "src1")]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    """The corpus as a written table with clashing extra columns."""
    path = str(tmp_path_factory.mktemp("corpus") / "documents.parquet")
    names = ["doc_id", "text", "lang", "source", "n_chars", *CLASH]
    data = [(i, t, lang, s, len(t or ""), *(["x"] * len(CLASH))) for i, t, lang, s in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)
    assert len(data[0]) == len(names)
    spark.createDataFrame(data, schema).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("doc_id < 0")
