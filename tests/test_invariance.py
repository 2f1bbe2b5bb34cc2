"""Results do not depend on the number of shuffle partitions."""

import pytest

from tests.compare import _rows
from tests.conftest import SF_SMALL

from __spark_entry__ import queries

Q = queries()


@pytest.mark.parametrize("name", ["nb_score", "tfidf", "roc_auc", "profile_numeric", "split_stratified", "dedup_text"])
def test_same_result_for_1_and_8_partitions(spark, name):
    def run(parts: int):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            df = Q[name](spark, SF_SMALL)
            return _rows(df.columns, [tuple(r) for r in df.collect()])
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)

    assert run(1) == run(8)


def test_scratch_tables_can_be_released(spark):
    import os

    from stratum.session import cut_lineage, release_scratch

    df = cut_lineage(spark.range(10), "released")
    folder = os.path.dirname(df.inputFiles()[0].removeprefix("file:").replace("//", "/"))
    assert os.path.isdir(folder)
    assert release_scratch(spark) >= 1
    assert not os.path.exists(folder)
