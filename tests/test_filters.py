import pytest
from pyspark.sql import functions as F

from cairn.functions import filters
from cairn.sources import datasets


@pytest.fixture(scope="module")
def xy(spark):
    return spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, None)], "x int, y int, s string")


def rows(df):
    return sorted((r.x, r.y) for r in df.collect())


def test_or_of_ands(xy):
    assert rows(filters.select_where(xy, filters=[[("x", "=", 1), ("y", "==", 2)], [("x", "=", "2")]])) == [(1, 2), (2, 1)]
    assert rows(filters.select_where(xy, filters=[("x", "=", 1), ("y", "=", 2)])) == [(1, 2)]


def test_sets_and_text(xy):
    assert rows(filters.select_where(xy, filters=[("x", "in", {"1"})], schema=xy.schema)) == [(1, 1), (1, 2)]
    assert rows(filters.select_where(xy, filters=[("x", "in", set())])) == []
    assert rows(filters.select_where(xy, filters=[("x", "not in", [2])])) == [(1, 1), (1, 2)]
    assert rows(filters.select_where(xy, filters=[("s", "like", "a%")])) == [(1, 1)]


@pytest.mark.parametrize(
    "bad", [[("x", "=", 1), [("y", "=", 1)]], [("x", "=")], [("x", "drop table", 1)], [("nope", "=", 1)], [("nope", "in", [1])]]
)
def test_refused(xy, bad):
    with pytest.raises(ValueError):
        filters.select_where(xy, filters=bad, schema=xy.schema)


def test_guards(xy):
    with pytest.raises(ValueError):
        filters.select_where(xy, need_filters=True)
    with pytest.raises(ValueError):
        filters.select_where(xy, columns=["nope"], schema=xy.schema)
    with pytest.raises(ValueError):
        filters.select_where(xy, columns=["x"], filters=[("s", "=", "a")], denied=["s"])
    with pytest.raises(ValueError):
        datasets.query_protein_similarity(xy, search_db="other", filters=[("metric", "=", "m")])


def test_large_sets_are_joined(xy):
    assert rows(filters.members(xy, "x", range(2, 5000))) == [(2, 1)]
    assert rows(filters.members(xy, "x", range(2, 5000), negate=True)) == [(1, 1), (1, 2)]


def test_pushdown(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 7 as k", "'x' as wide").write.parquet(f"{tmp_path}/t")
    df = filters.select_where(spark.read.parquet(f"{tmp_path}/t"), columns=["id"], filters=[("k", ">", 3)])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(k,3)" in plan and "wide" not in plan.split("ReadSchema")[-1]


def test_protein_similarity_and_default_splits(spark):
    scores = spark.createDataFrame([("a", "b", "pocket_fident", 70, "holo"), ("a", "c", "pocket_fident", 80, "apo")], "query_system string, target_system string, metric string, similarity byte, search_db string")
    given = [("search_db", "=", "apo"), ("similarity", ">", "50")]
    found = datasets.query_protein_similarity(scores, search_db="apo", columns=["target_system"], filters=given)
    assert [r.target_system for r in found.collect()] == ["c"] and len(given) == 2
    index = spark.createDataFrame([("s1", "1abc"), ("s2", "2abc"), ("s3", "3abc")], "system_id string, entry_pdb_id string")
    splits = spark.createDataFrame([("s1", "train"), ("s2", "test")], "system_id string, split string")
    assert [r.system_id for r in datasets.query_index(index, splits).collect()] == ["s1"]
    every = {r.system_id: r.split for r in datasets.query_index(index, splits, wanted=["*"]).collect()}
    assert every == {"s1": "train", "s2": "test", "s3": "unassigned"}


def test_partition_folders_and_clusters(spark, tmp_path):
    from cairn.sources.sinks import write_clusters

    rows_ = [("s1", "c0", "m", "components", False, 50), ("s2", "c1", "m", "components", True, 70)]
    labels = spark.createDataFrame(rows_, "system_id string, label string, metric string, cluster string, directed boolean, threshold int")
    assert write_clusters(labels, f"{tmp_path}/c") and not write_clusters(labels, f"{tmp_path}/c", skip_existing=True)
    back = datasets.scan(spark, f"{tmp_path}/c")
    found = datasets.query_clusters(back, columns=["system_id"], filters=[("directed", "=", True), ("threshold", "=", 70)])
    assert [r.system_id for r in found.collect()] == ["s2"]
    assert "PartitionFilters: [isnotnull(threshold" in back.where(F.col("threshold") == 70)._jdf.queryExecution().executedPlan().toString()


def test_shards():
    assert datasets.shards(system_ids=["1abc__1"], codes=["zz"]) == ["ab"] and datasets.shards(entry_ids=["1abc", "2abd"]) == ["ab"]
    with pytest.raises(ValueError):
        datasets.shards(system_ids=["1a"])
