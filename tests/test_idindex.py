"""The index of landed ids: exact answers, touched buckets only, repeatable."""

import pytest

from matchmart.operators.idindex import IdIndex
from test_plans import plan_of


def ids(spark, numbers):
    return spark.createDataFrame([(f"M_{i}",) for i in numbers], "match_id string")


def names(df):
    return sorted(r["match_id"] for r in df.collect())


@pytest.fixture()
def index(tmp_path):
    return IdIndex(str(tmp_path / "ids"), buckets=16, blocks=2)


def test_answers_are_exact(spark, index):
    asked = ids(spark, [1, 2, 2, 5000])
    assert names(index.landed(asked)) == []
    index.add(ids(spark, range(0, 3000)), "a")
    index.add(ids(spark, range(3000, 4000)).union(spark.createDataFrame([(None,), ("",)], "match_id string")), "b")
    assert names(index.landed(asked)) == ["M_1", "M_2"]
    every = ids(spark, range(0, 9000, 7))
    assert names(index.landed(every)) == sorted(f"M_{i}" for i in range(0, 4000, 7))
    assert index.landed(every.limit(0)).count() == 0
    assert index.landed(spark.createDataFrame([(None,), ("",)], "match_id string")).count() == 0


def test_adding_a_batch_again_changes_nothing(spark, index):
    for _ in range(2):
        index.add(ids(spark, range(100)), "a")
    stored = spark.read.parquet(f"{index.root}/ids")
    assert stored.count() == 100
    assert names(index.landed(ids(spark, [5, 500]))) == ["M_5"]


def test_filters_let_few_absent_ids_through(spark, index):
    index.add(ids(spark, range(20_000)), "a")  # 16 x 2 blocks: 625 ids each
    absent = ids(spark, range(100_000, 110_000))
    assert index.maybe_landed(absent).count() < 100
    assert index.landed(absent).count() == 0


def test_an_overfull_filter_is_still_exact(spark, tmp_path):
    index = IdIndex(str(tmp_path / "full"), buckets=1, blocks=1)
    index.add(ids(spark, range(60_000)), "a")
    assert index.maybe_landed(ids(spark, range(90_000, 91_000))).count() > 900
    assert index.landed(ids(spark, range(59_000, 91_000, 500))).count() == 2


def test_only_touched_buckets_are_opened(spark, index):
    index.add(ids(spark, range(5000)), "a")
    asked = ids(spark, [7])
    bucket = index.maybe_landed(asked).first()["bucket"]
    plan = plan_of(index.maybe_landed(asked))
    assert "PartitionFilters" in plan and "bucket#" in plan
    # Every other bucket may be unreadable.
    spoilt = 0
    import glob

    for f in glob.glob(f"{index.root}/*/bucket=*/batch=a/*.parquet"):
        if f"bucket={bucket}/" not in f:
            open(f, "wb").write(b"spoilt")
            spoilt += 1
    assert spoilt > 10
    assert names(index.landed(asked)) == ["M_7"]
