"""Rank index: positions answered from one file, appends, killed appends, against plain sorting."""

import random

import pytest
from pyspark.sql import functions as F

from stratum.operators.split import page, scan_range, split_range
from stratum.session import scratch_path
from stratum.sources import rank_index


def _table(spark, keys):
    return spark.createDataFrame([(k, f"v{k}") for k in keys], "k long, v string").repartition(4)


def _keys(df):
    return [r["k"] for r in df.orderBy("k").collect()]


@pytest.fixture(scope="module")
def index(spark):
    keys = random.Random(1).sample(range(100_000), 3000)
    return sorted(keys), rank_index.build(_table(spark, keys), "k", scratch_path(spark, "ri"), rows_per_file=250)


def test_positions_equal_a_plain_sort(index):
    keys, ri = index
    assert ri.count() == 3000
    for at, n in ((0, 1), (0, None), (249, 3), (250, 250), (1234, 777), (2999, 5), (3000, 5), (10, 0)):
        assert _keys(ri.scan_range(at, n)) == keys[at : None if n is None else at + n]
    assert [r["k"] for r in ri.row_at(1500).collect()] == [keys[1500]] and ri.row_at(-1).collect() == [] and ri.row_at(3000).collect() == []
    rows, total = ri.page(7, 100)
    assert total == 3000 and [r["k"] for r in rows.collect()] == keys[600:700]
    assert ri.page(0, 10)[0].collect() == ri.page(1, 10)[0].collect() and ri.page(1, 0)[0].count() == 3000


def test_results_equal_select_ranks(spark, index):
    keys, ri = index
    df = _table(spark, keys)
    assert _keys(ri.scan_range(700, 900)) == _keys(scan_range(df, "k", 700, 900))
    assert ri.page(3, 50)[0].collect() == page(df, "k", 3, 50)[0].collect()
    split = lambda d: {r["k"]: r["split"] for r in d.collect()}
    assert split(ri.split_range(1000, 300)) == split(split_range(df, "k", 1000, 300))


def test_a_page_reads_one_file(spark, index):
    _, ri = index
    first = ri.files.where("before = 0").first()["n"]
    rows, _ = ri.page(2, 50)
    files = rows.inputFiles()
    assert len(files) == 1
    size = lambda p: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)).getLength()
    assert size(files[0]) * 8 < size(f"{ri.path}/rows")
    assert len(ri.row_at(5).inputFiles()) == 1 and len(ri.scan_range(first - 5, 10).inputFiles()) == 2


def test_appends_extend_and_merge(spark):
    path = scratch_path(spark, "ri")
    ri = rank_index.build(_table(spark, range(0, 2000, 2)), "k", path, rows_per_file=100)
    before = {r["file"] for r in ri.files.collect()}
    ri = ri.append(_table(spark, range(2000, 2500)), rows_per_file=100)  # above all keys: old files stay
    assert before <= {r["file"] for r in ri.files.collect()} and _keys(ri.scan_range()) == [*range(0, 2000, 2), *range(2000, 2500)]
    ri = ri.append(_table(spark, range(301, 501, 2)), rows_per_file=100)  # amid: only the files that it meets change
    kept = {r["file"] for r in ri.files.collect()}
    want = sorted([*range(0, 2000, 2), *range(2000, 2500), *range(301, 501, 2)])
    assert _keys(ri.scan_range()) == want and len(before - kept) <= 3
    for at in (0, 149, 150, 200, 260, 1099, 1599):
        assert ri.row_at(at).first()["k"] == want[at]
    assert _keys(rank_index.RankIndex(spark, path, "k", ri.schema).scan_range(100, 300)) == want[100:400]
    assert ri.append(_table(spark, []).where("k < 0")).version == ri.version


def test_a_killed_append_leaves_the_version_before(spark):
    path = scratch_path(spark, "ri")
    ri = rank_index.build(_table(spark, range(300)), "k", path, rows_per_file=100)
    more = _table(spark, range(250, 350)).withColumn("v", F.lit("new"))
    rank_index._write_rows(more, "k", path, ri.version + 1, 100)  # killed before its index was written
    again = rank_index.RankIndex(spark, path, "k", ri.schema)
    assert again.version == ri.version and again.count() == 300
    assert _keys(again.append(_table(spark, range(300, 320))).scan_range()) == list(range(320))


def test_null_equal_and_text_keys_and_an_empty_table(spark):
    df = spark.createDataFrame([(None, 1), ("b", 2), ("b", 3), ("é", 4), ("a", 5)], "k string, n int")
    ri = rank_index.build(df, "k", scratch_path(spark, "ri"), rows_per_file=2)
    assert ri.count() == 4 and ri.row_at(0).first()["n"] == 5 and ri.row_at(3).first()["n"] == 4 and sorted(r["n"] for r in ri.scan_range(1, 2).collect()) == [2, 3]
    empty = rank_index.build(df.limit(0), "k", scratch_path(spark, "ri"))
    assert empty.count() == 0 and empty.scan_range(0, 5).collect() == [] and empty.page(1, 5)[0].collect() == []
    assert empty.append(df).count() == 4
    with pytest.raises(ValueError):
        rank_index.build(df, "k", ri.path)


def test_a_task_writes_many_files(spark):
    seen = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("many-files", "")
    ri = rank_index.build(_table(spark, range(1500)), "k", scratch_path(spark, "ri"), rows_per_file=10)
    spark.sparkContext.setJobGroup("", "")
    infos = [seen.getStageInfo(s) for j in seen.getJobIdsForGroup("many-files") for s in seen.getJobInfo(j).stageIds]
    assert ri.files.count() == 150 and ri.files.where(F.col("n") > 10).isEmpty() and max(i.numTasks for i in infos if i) < 100
    assert _keys(ri.scan_range(1234, 77)) == list(range(1234, 1311))


def test_equal_keys_over_several_files(spark):
    df = spark.createDataFrame([(k, i) for i, k in enumerate([1, 2, *[5] * 25, 7, 8])], "k long, i int").repartition(3)
    ri = rank_index.build(df, "k", scratch_path(spark, "ri"), rows_per_file=4)
    want = [1, 2, *[5] * 25, 7, 8]
    for at, n in ((0, None), (0, 3), (3, 10), (25, 3), (26, 2)):
        assert _keys(ri.scan_range(at, n)) == want[at : None if n is None else at + n]
    assert len({r["i"] for at in range(29) for r in ri.row_at(at).collect()}) == 29
    ri = ri.append(spark.createDataFrame([(5, 90), (6, 91)], "k long, i int"), rows_per_file=4)
    assert _keys(ri.scan_range()) == sorted([*want, 5, 6]) and _keys(ri.scan_range(27, 3)) == [5, 6, 7]


def test_many_files_are_read_as_their_folders(spark, monkeypatch):
    monkeypatch.setattr(rank_index, "NAMED_FILES", 4, raising=False)
    seen = spark.sparkContext.statusTracker()
    ri = rank_index.build(_table(spark, range(0, 2000, 2)), "k", scratch_path(spark, "ri"), rows_per_file=10)
    ri = ri.append(_table(spark, range(301, 401, 2)), rows_per_file=10)  # ten files of the first generation are superseded, and stay in its folder
    want = sorted([*range(0, 2000, 2), *range(301, 401, 2)])
    spark.sparkContext.setJobGroup("folders", "")
    ri = ri.append(_table(spark, range(101, 1801, 100)), rows_per_file=10)
    got = _keys(ri.scan_range(15, 1020))
    spark.sparkContext.setJobGroup("", "")
    infos = [seen.getStageInfo(s) for j in seen.getJobIdsForGroup("folders") for s in seen.getJobInfo(j).stageIds]
    want = sorted([*want, *range(101, 1801, 100)])
    assert len({r["file"][:3] for r in ri.files.collect()}) == 2 and max(i.numTasks for i in infos if i) < 20
    assert got == want[15:1035] and _keys(ri.scan_range()) == want and _keys(ri.scan_range(1000)) == want[1000:]
