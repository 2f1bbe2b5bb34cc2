"""Trained models (rows-only in the oracle run) and streaming/batch equality."""

import random

import pytest
from pyspark.sql import functions as F

from stratum.operators import evaluate as E
from stratum.operators import models as M


@pytest.fixture(scope="module")
def separable(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(400):
        y = i % 2
        rows.append((i, rnd.gauss(2.0 * y, 1.0), rnd.gauss(-1.0 * y, 1.0), y))
    return spark.createDataFrame(rows, "k long, a double, b double, y int")


def test_logistic_learns_and_score_linear_reproduces(spark, separable):
    model = M.fit([M.assembler(["a", "b"]), M.logistic("y", None, reg=1e-3, max_iter=100, tol=1e-8)], separable)
    scored = M.score(model, separable, keep=["k", "y"])
    assert E.roc_auc(scored, "y", "probability").first()["roc_auc"] > 0.8
    coefs, b = M.coefficient_table(model, ["a", "b"], spark)
    lin = M.score_linear(separable, {r["feature"]: r["coefficient"] for r in coefs.collect()}, b, keep=["k"])
    pairs = scored.join(lin.withColumnRenamed("probability", "p2"), "k").select("probability", "p2").collect()
    assert max(abs(r[0] - r[1]) for r in pairs) < 1e-9


def test_forest_and_boosting_run(spark, separable):
    for est in (M.forest("y", None, trees=10, depth=4), M.boosted("y", None, max_iter=5)):
        model = M.fit([M.assembler(["a", "b"]), est], separable)
        out = M.score(model, separable, keep=["y"])
        assert E.roc_auc(out, "y", "probability").first()["roc_auc"] > 0.8
        imp = M.rank_features(M.importance_table(model, ["a", "b"], spark), 2).collect()
        assert [r["rank"] for r in imp] == [1, 2] and imp[0]["ratio"] == 1.0


def test_stream_score_equals_batch(spark):
    from tests.conftest import SF_SMALL
    from stratum.plans.catalog import QUERIES

    stream = sorted(tuple(r) for r in QUERIES["stream_score"](spark, SF_SMALL).collect())
    batch = sorted(tuple(r) for r in QUERIES["score_linear"](spark, SF_SMALL).collect())
    assert stream == batch
    ev = QUERIES["stream_eval"](spark, SF_SMALL).first()
    cm = QUERIES["confusion_matrix"](spark, SF_SMALL).first()
    assert tuple(ev) == tuple(cm)


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    out = entry(spark)
    rows = out.collect()
    assert len(rows) == 1 and set(out.columns) >= {"accuracy", "tn", "fp", "fn", "tp"}
    assert rows[0]["tn"] + rows[0]["fp"] + rows[0]["fn"] + rows[0]["tp"] > 0


def test_stream_eval_many_micro_batches(spark, tmp_path):
    from stratum.sources.fixtures import scored_from
    from stratum.streaming import score as ST
    from tests.conftest import SF_SMALL

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = tmp_path / "in"
    for i in range(3):  # three files arrive: three micro-batches
        ev.where(F.col("event_id") % 3 == i).write.parquet(str(src / f"part{i}"))
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", "true").parquet(str(src))
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    ST.run_to_end(ST.stream_eval(scored_from(stream), out, ckpt))
    ev.where(F.col("event_id") % 5 == 0).write.parquet(str(src / "part3"))  # arrives later; the query restarts
    ST.run_to_end(ST.stream_eval(scored_from(stream), out, ckpt))
    assert ST.running_counts(spark, out).count() <= 4
    ev = ev.unionByName(ev.where(F.col("event_id") % 5 == 0))
    got = ST.confusion_from_counts(ST.running_counts(spark, out)).first()
    want = E.confusion_matrix(scored_from(ev)).first()
    assert tuple(got) == tuple(want)


def test_score_falls_back_without_probability(spark, separable):
    from pyspark.ml.classification import LinearSVC

    model = M.fit([M.assembler(["a", "b"]), LinearSVC(featuresCol=M.FEATURES, labelCol="y", maxIter=20)], separable)
    out = M.score(model, separable, keep=["y"])
    probs = [r["probability"] for r in out.collect()]
    assert all(0.0 <= p <= 1.0 for p in probs)
    assert E.roc_auc(out, "y", "probability").first()["roc_auc"] > 0.8


def test_loan_train_job_then_score_job(spark, tmp_path):
    from stratum.plans import loan
    from tests.conftest import SF_SMALL

    out = str(tmp_path / "loan")
    meta = loan.train_and_save(spark, SF_SMALL, out)
    assert meta["live_offset"] == meta["train_rows"] + meta["eval_rows"]
    scored = {r["loan_id"]: (r["prediction"], round(r["probability"], 9)) for r in loan.score_saved(spark, SF_SMALL, out).collect()}
    direct = {r["loan_id"]: (r["prediction"], round(r["probability"], 9)) for r in loan.loan_score_live(spark, SF_SMALL).collect()}
    assert scored == direct and len(scored) == meta["row_count"] - meta["live_offset"]
    capped = loan.score_saved(spark, SF_SMALL, str(tmp_path / "loan"), max_rows=7)
    assert capped.count() == 7


def test_fault_train_job_then_score_job(spark, tmp_path):
    from pyspark.sql import functions as F

    from stratum.plans import fault
    from tests.conftest import SF_SMALL

    out = str(tmp_path / "fault")
    m = fault.train_and_save(spark, SF_SMALL, out, kind="logistic").first()
    assert m["tp"] + m["fn"] + m["tn"] + m["fp"] > 0
    data = fault.fault_data(spark, SF_SMALL)
    offset = data.frame.where(F.col("split") != "live").count()
    scored = {r["event_id"]: (r["predicted_fault"], round(r["probability"], 9))
              for r in fault.score_saved(spark, SF_SMALL, out, offset).collect()}
    direct = sorted((r["predicted_fault"], r["probability"]) for r in fault.fault_score_live(spark, SF_SMALL, "logistic").collect())
    saved = sorted((p, q) for p, q in scored.values())
    assert len(saved) == len(direct) == data.frame.where(F.col("split") == "live").count()
    assert all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-6 for a, b in zip(saved, direct))


def test_fraud_json_records_score_like_rows(spark):
    from pyspark.sql import functions as F

    from stratum.plans import fraud
    from tests.conftest import SF_SMALL

    df = fraud.fraud_frame(spark, SF_SMALL)
    model, feats, prepared, prep = fraud.fit_fraud_model(df, with_prep=True)
    test = df.where(F.col("split") == "test")
    direct = {r["txn_id"]: r["probability"] for r in M.score(model, prep(test), keep=["txn_id"], threshold=0.5).collect()}
    fields = ["type", *fraud.NUMERIC]
    records = test.select("txn_id", F.to_json(F.struct(*fields)).alias("body"))
    junk = spark.createDataFrame([(-1, "[1, 2]")], "txn_id long, body string")
    out = {r["txn_id"]: r for r in fraud.score_json_records(records.unionByName(junk), "body", model, prep, keep=("txn_id",)).collect()}
    assert out[-1]["prediction"] is None
    assert all(abs(out[k]["probability"] - p) < 1e-12 for k, p in direct.items())
    partial = spark.createDataFrame([(7, '{"amount": 12.5}')], "txn_id long, body string")
    row = fraud.score_json_records(partial, "body", model, prep, keep=("txn_id",)).first()
    assert row["prediction"] in (0, 1) and 0.0 <= row["probability"] <= 1.0


def test_metadata_with_null_metric_round_trips(spark, tmp_path):
    from stratum.sources import sinks as K

    path = str(tmp_path / "meta")
    K.write_metadata(spark, path, {"table_name": "t", "live_offset": 12, "seed": 42}, {"accuracy": 1, "roc_auc": None})
    assert K.read_live_offset(spark, path) == 12
    row = spark.read.json(path).first()
    assert row["metric_accuracy"] == 1.0 and "metric_roc_auc" not in row.asDict() or row["metric_roc_auc"] is None


def test_running_counts_before_any_epoch(spark, tmp_path):
    from stratum.streaming import score as ST

    cm = ST.confusion_from_counts(ST.running_counts(spark, str(tmp_path / "nothing"))).first()
    assert tuple(cm) == (0, 0, 0, 0)


def test_training_rows_of_one_file_are_spread(spark, monkeypatch):
    from stratum.operators import models as M

    class Seen:
        def __init__(self, stages):
            pass

        def fit(self, train):
            return train.rdd.getNumPartitions(), sorted(r["id"] for r in train.collect())

    one = spark.range(1000).coalesce(1)
    monkeypatch.setattr(M, "Pipeline", Seen)
    assert M.fit([], one)[0] == 1
    monkeypatch.setattr(M, "TASK_ROWS", 50, raising=False)
    assert M.fit([], one) == (20, list(range(1000)))


def test_reviews_of_one_file_are_spread(spark, monkeypatch):
    from stratum.operators import models as M
    from stratum.plans.drug import review_frame

    sf = "/root/testdata/sf0.001"
    rows = lambda: sorted((r["uniqueID"], r["sentiment"], r["split"], tuple(r["terms"])) for r in review_frame(spark, sf).collect())
    whole = rows()
    monkeypatch.setattr(M, "TASK_CHARS", 2000, raising=False)
    assert review_frame(spark, sf).rdd.getNumPartitions() > 8 and rows() == whole


def test_a_stratified_split_leaves_rows_where_they_are(spark):
    from stratum.operators.split import split_stratified

    df = spark.range(2000).repartition(7).withColumn("y", F.when(F.col("id") % 50 != 7, (F.col("id") % 2).cast("int")))
    out = split_stratified(df, "id", "y", 0.2, 42)
    assert out.rdd.getNumPartitions() == 7 and "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    n = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert n == {(0, "test"): 200, (0, "train"): 800, (1, "test"): 192, (1, "train"): 768, (None, None): 40}


def test_a_forests_rows_are_spread_before_a_task_is_full(spark, monkeypatch):
    from stratum.operators import models as M

    class Seen:
        def __init__(self, stages):
            pass

        def fit(self, train):
            return train.rdd.getNumPartitions(), sorted(r["id"] for r in train.collect())

    one = spark.range(1000).coalesce(1)
    monkeypatch.setattr(M, "Pipeline", Seen)
    assert M.fit([M.forest("y")], one)[0] == 1
    monkeypatch.setattr(M, "FOREST_ROWS", 500, raising=False)
    assert M.fit([M.forest("y")], one) == (2, list(range(1000))) and M.fit([M.logistic("y")], one)[0] == 1
    monkeypatch.setattr(M, "BOOSTED_ROWS", 50, raising=False)
    assert M.fit([M.boosted("y")], one) == (20, list(range(1000)))


def test_terms_of_texts_are_not_cached(spark, monkeypatch):
    from stratum.operators import models as M
    from stratum.plans import drug

    rows = [(i, i % 2, ["good", "fine", f"w{i % 7}"] if i % 2 else ["bad", "poor", f"w{i % 7}"], "train") for i in range(60)]
    train = spark.createDataFrame(rows, f"{drug.KEY} long, {drug.TARGET} int, terms array<string>, split string")
    held = []
    monkeypatch.setattr(type(train), "persist", lambda self, *_: held.append(self.columns) or self)
    model = drug.fit_text_model(train)
    assert not any("terms" in c for c in held)  # a batch of the cache is 10,000 rows of any length
    assert all(r["prediction"] == r[drug.TARGET] for r in M.score(model, train, keep=[drug.TARGET]).collect())


def test_metrics_read_written_scores(spark, monkeypatch):
    from stratum.plans import fault

    df = spark.range(100).select(F.col("id").alias(fault.KEY), (F.col("id") % 2).cast("int").alias(fault.TARGET), F.lit("eval").alias("split"))
    score = lambda model, frame, keep: frame.select(*keep, (F.col(fault.TARGET) * 0.5 + F.col(fault.KEY) / 1000).alias("probability"))
    seen, evaluate = [], fault.E.evaluate_scores
    monkeypatch.setattr(fault, "fault_data", lambda *_: fault.FaultData(df, ["x"]))
    monkeypatch.setattr(fault, "fit_fault_model", lambda *_: None)
    monkeypatch.setattr(fault.M, "score", score)
    monkeypatch.setattr(fault.E, "evaluate_scores", lambda ev, *a: seen.append(ev._jdf.queryExecution().executedPlan().toString()) or evaluate(ev, *a))
    got = fault.fault_eval(spark, "").first()
    assert got["tp"] == 50 and got["tn"] == 50 and got["roc_auc"] == 1.0
    assert "FileScan parquet" in seen[0] and "Range" not in seen[0]  # no stage of the metrics holds the model
