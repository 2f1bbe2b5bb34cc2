"""Naive Bayes and TF-IDF against a plain-Python implementation of the same formulas."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratum.operators import text_models as TM

TRAIN = [
    (1, "the cat sat on the mat", 1),
    (2, "the dog ate the bone", 0),
    (3, "a cat and a dog", 1),
    (4, "bones and mats", 0),
    (5, "Café crème, café noir", 1),
]
TEST = [(10, "the cat ate a café"), (11, "zebra unknown words"), (12, ""), (13, "dog dog dog")]


def _tok(t):
    return re.findall(r"\b\w+\b", t.lower())


def _nb_python(train, test):
    classes = sorted({y for _, _, y in train})
    counts = {c: Counter() for c in classes}
    vocab = set()
    for _, t, y in train:
        for w in _tok(t):
            counts[y][w] += 1
            vocab.add(w)
    n = len(train)
    prior = {c: (sum(1 for *_, y in train if y == c) + 1) / (n + len(classes)) for c in classes}
    out = {}
    for d, t in test:
        s = {}
        for c in classes:
            tot = sum(counts[c].values()) + len(vocab)
            s[c] = math.log(prior[c]) + sum(math.log((counts[c][w] + 1) / tot) for w in _tok(t))
        out[d] = s
    return out


def test_nb_matches_python(spark):
    train = spark.createDataFrame(TRAIN, "doc_id long, text string, label int")
    test = spark.createDataFrame(TEST, "doc_id long, text string")
    model = TM.nb_fit(train, "text", "label")
    got = {r["doc_id"]: r for r in TM.nb_score(model, test, "doc_id", "text").collect()}
    want = _nb_python(TRAIN, TEST)
    for d, s in want.items():
        assert got[d]["score0"] == pytest.approx(s[0], abs=1e-9)
        assert got[d]["score1"] == pytest.approx(s[1], abs=1e-9)
        assert got[d]["prediction"] == (1 if s[1] > s[0] else 0)
        assert got[d]["probability"] == pytest.approx(1 / (1 + math.exp(s[0] - s[1])), abs=1e-9)


def test_nb_scores_without_a_broadcast(spark):
    train = spark.createDataFrame(TRAIN, "doc_id long, text string, label int")
    test = spark.createDataFrame(TEST, "doc_id long, text string")
    model = TM.nb_fit(train, "text", "label")
    a = sorted(tuple(r) for r in TM.nb_score(model, test, "doc_id", "text").collect())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = sorted(tuple(r) for r in TM.nb_score(model, test, "doc_id", "text", partitions=3).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert a == b


def _terms(t):
    toks = re.findall(r"\b\w\w+\b", t.lower())
    return toks + [f"{a} {b}" for a, b in zip(toks, toks[1:])]


def test_tfidf_matches_python(spark):
    docs = [(i, t) for i, t, _ in TRAIN]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    k = 6
    cf, dfreq = Counter(), Counter()
    for _, t in docs:
        ts = _terms(t)
        cf.update(ts)
        dfreq.update(set(ts))
    vocab = sorted(cf, key=lambda w: (-cf[w], w))[:k]
    want = {}
    for d, t in docs:
        tf = Counter(w for w in _terms(t) if w in vocab)
        w = {x: c * (math.log((1 + len(docs)) / (1 + dfreq[x])) + 1) for x, c in tf.items()}
        norm = math.sqrt(sum(v * v for v in w.values()))
        want.update({(d, x): v / norm for x, v in w.items()})
    got = {(r["doc_id"], r["token"]): r["weight"] for r in TM.tfidf(df, "doc_id", "text", max_features=k).collect()}
    assert got.keys() == want.keys()
    for key, v in want.items():
        assert got[key] == pytest.approx(v, abs=1e-12)


def test_doc_frequency_and_dedup(spark):
    df = spark.createDataFrame([(1, "aa bb aa"), (2, "AA  bb aa "), (3, "cc")], "doc_id long, text string")
    f = {r["token"]: (r["df"], r["cf"]) for r in TM.doc_frequency(df, "doc_id", "text").collect()}
    assert f["aa"] == (2, 4) and f["aa bb"] == (2, 2) and f["bb aa"] == (2, 2)
    kept = sorted(r["doc_id"] for r in TM.dedup_text(df, "doc_id", "text").collect())
    assert kept == [1, 3]


def test_top_terms_equal_sort_limit(spark):
    rows = [(f"t{i:05d}", (i * 37) % 11, (i * 13) % 7 + 1) for i in range(3000)]  # many ties in cf
    dfreq = spark.createDataFrame([(t, d, c) for t, d, c in rows], "token string, df long, cf long")
    want = [tuple(r) for r in dfreq.orderBy(F.col("cf").desc(), F.col("token")).limit(1234).collect()]
    got = sorted((tuple(r) for r in TM.top_terms(dfreq, 1234).collect()), key=lambda r: (-r[2], r[0]))
    assert got == want


def test_terms_are_counted_once_an_occurrence(spark):
    from collections import Counter

    from stratum.functions.text import WORD, WORD2, tokenize
    from stratum.operators.text_models import term_frequencies

    rows = [["b", "a", "b"], [], None, ["a", None, None], ["a b", "a"]]
    out = term_frequencies(spark.createDataFrame([(r,) for r in rows], "t array<string>"), "t")
    cf, df = Counter(t for r in rows for t in r or []), Counter(t for r in rows for t in set(r or []))
    assert {r["token"]: (r["df"], r["cf"]) for r in out.collect()} == {t: (df[t], cf[t]) for t in cf}
    assert "array_distinct" not in out._jdf.queryExecution().toString()  # each occurrence and, again, each term

    text = spark.createDataFrame([("Ab c dé\U0001d4d0 x_1\n",), ("",), (None,), ("..a",), ("日 日本 a-bb",)], "t string")
    got = text.select(tokenize(text["t"], WORD).alias("w"), tokenize(text["t"], WORD2).alias("w2"))
    assert [tuple(r) for r in got.collect()] == [
        (["ab", "c", "dé\U0001d4d0", "x_1"], ["ab", "dé\U0001d4d0", "x_1"]), ([], []), ([], []), (["a"], []), (["日", "日本", "a", "bb"], ["日本", "bb"]),
    ]
    assert "regexp_extract_all" not in got._jdf.queryExecution().toString()
