"""State that grows with arriving batches: Naive Bayes counts, digests, categories; shrinkage, drift, references, CSV lines."""

import html
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions.text import html_unescape
from stratum.operators import fitstate as S
from stratum.operators import nb_state as N
from stratum.operators import text_models as TM
from stratum.operators.recommend import recommend_shrunk
from stratum.session import scratch_path
from stratum.sources import sinks as K
from stratum.sources.digest_index import DigestIndex

# ------------------------------------------------------------- Naive Bayes state


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, label int")


def _random_docs(n, seed=1):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(25)]
    return [(i, " ".join(rnd.choices(words, k=rnd.randrange(0, 8))), rnd.choice([0, 1, 1, None])) for i in range(n)]


def _same(model, docs):
    fresh = TM.nb_fit(docs.where("label IN (0, 1)"), "text", "label")
    assert sorted(map(tuple, model.terms.collect())) == sorted(map(tuple, fresh.terms.collect()))
    flat = lambda m: [x for r in sorted(map(tuple, m.classes.collect())) for x in r]
    assert flat(model) == pytest.approx(flat(fresh))
    assert model.vocab_size == fresh.vocab_size


def test_updates_equal_a_refit_on_what_is_in_force(spark):
    rows, path = _random_docs(60), scratch_path(spark, "nb")
    df = _docs(spark, rows)
    N.update(spark, path, "a", add=df.where("doc_id < 40"))
    _same(N.model(spark, path), df.where("doc_id < 40"))
    N.update(spark, path, "b", add=df.where("doc_id >= 40"), forget=df.where("doc_id < 10"))
    _same(N.model(spark, path), df.where("doc_id >= 10"))
    N.update(spark, path, "c", forget=df.where("doc_id >= 10 AND doc_id < 59"))
    _same(N.model(spark, path), df.where("doc_id = 59 OR doc_id < 0"))
    _same(N.model(spark, path, 1), df.where("doc_id < 40"))


def test_a_batch_counts_once_and_a_killed_update_not_at_all(spark):
    path, df = scratch_path(spark, "nb"), _docs(spark, _random_docs(30, seed=2))
    assert N.update(spark, path, "a", add=df) == 1 and N.update(spark, path, "a", add=df) == 1
    df.select("text").withColumn("c0", F.lit(1).cast("long")).withColumn("c1", F.lit(1).cast("long")).write.parquet(f"{path}/v2/terms")  # killed before its batches were written
    _same(N.model(spark, path), df)
    assert N.update(spark, path, "b", add=df.limit(0)) == 2
    _same(N.model(spark, path), df)
    with pytest.raises(ValueError):
        N.update(spark, path, "c", forget=_docs(spark, [(1, "never seen", 1)]))
    _same(N.model(spark, path), df)
    with pytest.raises(ValueError):
        N.model(spark, scratch_path(spark, "none"))


# ------------------------------------------------------------------ digest index


def test_arriving_batches_leave_what_one_run_leaves(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([f"Text {k}  here" for k in range(25)] + [None, "", " "])) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, t string")
    for order in ((0, 1, 2, 3), (3, 1, 0, 2)):
        index = DigestIndex(spark, scratch_path(spark, "di"), T.LongType())
        stands: dict = {}
        for b in order:
            for r in index.add(f"b{b}", df.where(F.col("id") % 4 == b), "id", "t").collect():
                if r["kept"]:
                    stands.pop(r["replaced"], None)
                    stands[r["key"]] = True
        index.add("b1", df.where(F.col("id") % 4 == 1), "id", "t")  # run again
        want = {}
        for i, t in rows:
            want.setdefault(None if t is None else " ".join(t.lower().split()), i)
        assert {r["key"] for r in index.survivors().collect()} == set(want.values()) == set(stands)
    assert DigestIndex(spark, scratch_path(spark, "di"), T.LongType()).survivors().collect() == []


# ------------------------------------------------------------ many categories


def test_dictionary_has_dense_sorted_indices(spark):
    df = spark.createDataFrame([("b", 10), ("a", 9), ("b", None), (None, 9), ("é", 10)], "x string, y int")
    found = {(r["feature"], r["value"]): (r["index"], r["size"]) for r in S.fit_dictionary(df, ["x", "y"]).collect()}
    assert found == {("x", "a"): (0, 3), ("x", "b"): (1, 3), ("x", "é"): (2, 3), ("y", "10"): (0, 2), ("y", "9"): (1, 2)}


def test_a_hundred_thousand_categories_encode_and_train(spark):
    from pyspark.ml.classification import LogisticRegression

    n = 100_000
    df = spark.range(2 * n).select("id", F.concat(F.lit("c"), (F.col("id") % n).cast("string")).alias("c"), (F.col("id") % 3).cast("string").alias("d"), (F.col("id") % n < n // 2).cast("double").alias("y"))
    known = S.fit_dictionary(df, ["c", "d"])
    hot = S.one_hot_sparse(df.unionByName(spark.createDataFrame([(-1, "new", None, 0.0)], df.schema)), ["c", "d"], known)
    by = {r["id"]: r["features"] for r in hot.where("id < 2").collect()}
    assert by[-1].size == n + 3 and len(by[-1].indices) == 0
    assert list(by[0].indices) == [0, n] and by[1].numNonzeros() == 2 and hot.columns == ["id", "c", "d", "y", "features"]
    model = LogisticRegression(labelCol="y", maxIter=2).fit(hot)
    assert model.numFeatures == n + 3


# ---------------------------------------------------- shrinkage, drift, text


def test_one_glowing_review_ranks_below_many_good_ones(spark):
    rnd = random.Random(4)
    rows = [("g", "one", 10)] + [("g", "good", r) for r in [9, 9, 8, 10, 9] * 20]
    rows += [("g", f"d{i}", max(1, min(10, round(rnd.gauss(5 + i % 3 / 2, 2))))) for i in range(20) for _ in range(10)]
    rows += [("h", "x", 5), ("h", "y", None)]
    got = {(r["g"], r["item"]): r for r in recommend_shrunk(spark.createDataFrame(rows, "g string, item string, r int"), "g", "item", "r", k=50).collect()}
    assert got["g", "good"]["rank"] == 1 and got["g", "one"]["rank"] > 1 and got["g", "one"]["mean_rating"] == 10
    assert got["h", "x"]["score"] == 5 and ("h", "y") not in got
    by = defaultdict(list)
    for g, d, r in rows:
        if g == "g":
            by[d].append(r)
    every = [x for v in by.values() for x in v]
    mu, k, total = sum(every) / len(every), len(by), len(every)
    means = {d: sum(v) / len(v) for d, v in by.items()}
    within = sum((x - means[d]) ** 2 for d, v in by.items() for x in v) / (total - k)
    between = max(0, sum(len(v) * (means[d] - mu) ** 2 for d, v in by.items()) - (k - 1) * within) / (total - sum(len(v) ** 2 for v in by.values()) / total)
    for d, v in by.items():
        assert got["g", d]["score"] == pytest.approx((len(v) * between * means[d] + within * mu) / (len(v) * between + within))


def test_drift_distances_equal_brute_force(spark):
    rnd, inf = random.Random(5), float("inf")
    rows = [(rnd.choice(["a", "b", "c"]), rnd.choice([None, inf, -inf, float("nan"), *(rnd.randint(0, 9) / 2 for _ in range(12))]), None, 1.0) for _ in range(400)]
    got = {r["feature"]: r for r in S.drift_distances(spark.createDataFrame(rows, "s string, x double, y double, z double"), ["x", "y", "z"], "s", "a", "b", cells=4).collect()}
    side = {s: sorted(x for t, x, *_ in rows if t == s and x is not None and math.isfinite(x)) for s in "ab"}
    share = lambda s, v: sum(x <= v for x in side[s]) / len(side[s])
    values = sorted(set(side["a"] + side["b"]))
    apart = [abs(share("a", v) - share("b", v)) for v in values]
    cell = lambda v: min(3, sum(x < v for x in side["a"]) * 4 // len(side["a"]))
    part = {s: Counter(map(cell, side[s])) for s in "ab"}
    psi = 0.0
    for c in range(4):
        p, q = (max(part[s][c] / len(side[s]), 1e-4) for s in "ab")
        psi += (q - p) * math.log(q / p)
    r = got["x"]
    assert r["ks"] == pytest.approx(max(apart)) and r["psi"] == pytest.approx(psi)
    assert r["wasserstein"] == pytest.approx(sum(d * (b - a) for d, a, b in zip(apart, values, values[1:])))
    assert (r["n_base"], r["inf_base"], r["null_base"]) == (len(side["a"]), sum(t == "a" and x is not None and math.isinf(x) for t, x, *_ in rows), sum(t == "a" and (x is None or math.isnan(x)) for t, x, *_ in rows))
    assert got["y"]["ks"] is None and got["y"]["n_base"] == 0 and got["z"]["ks"] == 0 and got["z"]["psi"] == 0


def test_references_are_decoded_once(spark):
    cases = {
        "&#38;lt;": "&lt;", "&#38;#39; &#39;": "&#39; '", "&amp;amp;": "&amp;", "a&lt;b&gt;&quot;&apos;": "a<b>\"'", "&eacute;&Eacute;&hearts;&euro;": "éÉ♥€",
        "&#x41;&#X42;&#67;": "ABC", "&nosuch; &#0; &#xD800; &#1114112;": "&nosuch; &#0; &#xD800; &#1114112;", "&amp": "&amp", "&;&#;&#x;": "&;&#;&#x;", "": "", "&lt;": "<", "x&nbsp;y": "x y", "&#x1F600;": "😀",
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "t string")
    got = {r["t"]: r["u"] for r in df.select("t", html_unescape(F.col("t")).alias("u")).collect()}
    assert got == {**cases, None: None}
    for k in ("a&lt;b&gt;&quot;&apos;", "&#38;lt;", "&eacute;&Eacute;&hearts;&euro;", "&amp;amp;"):
        assert html.unescape(k) == got[k]


def test_one_line_files_are_split_and_refuse_line_breaks(spark):
    df = spark.range(50_000).select("id", (F.col("id") / 7).alias("x"))
    path = K.write_csv(df.coalesce(1), scratch_path(spark, "csv"))
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        back = K.read_csv(spark, path, df.schema)
        assert back.rdd.getNumPartitions() > 3 and back.count() == 50_000 and back.agg(F.sum("id")).first()[0] == sum(range(50_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    text = spark.createDataFrame([("a, \"b\"", 1), (None, 2), ("", 3)], "t string, n int")
    path = K.write_csv(text, scratch_path(spark, "csv"), one_line=True)
    assert sorted(map(tuple, K.read_csv(spark, path, text.schema, one_line=True).collect()), key=lambda r: r[1]) == [("a, \"b\"", 1), (None, 2), ("", 3)]
    with pytest.raises(Exception, match="line break"):
        K.write_csv(spark.createDataFrame([("a\nb",)], "t string"), scratch_path(spark, "csv"), one_line=True)
