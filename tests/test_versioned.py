"""The versioned history: loads that take effect in one step, or not at all."""

import os

import pytest
from pyspark.sql import functions as F

from rosterflow.sinks import history
from rosterflow.sinks.versioned import ConcurrentLoad, History


def _rows(df, *columns):
    return sorted([tuple(r) for r in df.select(*(columns or df.columns)).collect()], key=repr)


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")}


@pytest.fixture
def books(spark, tmp_path):
    table = History(spark, str(tmp_path / "h"), "k")
    table.replace(spark.createDataFrame([("a b.xlsx", 1), ("a b.xlsx", 2), ("007", 3), (None, 4), (" ", 5)], "k string, v int"))
    return table


def test_a_load_replaces_its_keys_and_tells_what_it_did(spark, books):
    told = books.replace(spark.createDataFrame([("007", 8), ("007", 9), ("new", 1)], "k string, v int"))
    assert _rows(told) == [("007", 2, 1, "reemplazo"), ("new", 1, 0, "inserción nueva")]
    assert _rows(books.read(), "k", "v") == [("007", 8), ("007", 9), ("a b.xlsx", 1), ("a b.xlsx", 2), ("new", 1)]
    assert books.versions() == [1, 2] and books.read().columns == ["k", "v"]


def test_a_load_killed_before_its_commit_changes_nothing(spark, books, monkeypatch):
    before = _rows(books.read())

    def killed(*_):
        raise KeyboardInterrupt

    more = spark.createDataFrame([("007", 8), ("z", 9)], "k string, v int")
    for step in ("_commit", "_publish"):
        with monkeypatch.context() as patch:
            patch.setattr(History, step, killed)
            with pytest.raises(KeyboardInterrupt):
                books.replace(more, ["007", "a b.xlsx"])
        assert _rows(books.read()) == before and books.versions() == [1]
    assert len(_files(books.path)) > 2
    assert books.vacuum(orphan_hours=0) == 2 and _rows(books.read()) == before
    books.replace(more)
    assert _rows(books.read(), "k", "v") == [("007", 8), ("a b.xlsx", 1), ("a b.xlsx", 2), ("z", 9)]


def test_two_loads_at_once(spark, books, monkeypatch):
    more = spark.createDataFrame([("007", 8)], "k string, v int")
    publish = History._publish

    def slower(self, after, *rest):
        monkeypatch.setattr(History, "_publish", publish)
        books.replace(spark.createDataFrame([("first", 1)], "k string, v int"))
        return publish(self, after, *rest)

    monkeypatch.setattr(History, "_publish", slower)
    with pytest.raises(ConcurrentLoad):
        books.replace(more)
    assert _rows(books.read(), "k", "v") == [("007", 3), ("a b.xlsx", 1), ("a b.xlsx", 2), ("first", 1)]


def test_readers_keep_their_version_until_it_is_deleted(spark, books):
    pinned = books.read()
    books.replace(spark.createDataFrame([("007", 8)], "k string, v int"))
    assert _rows(pinned, "k", "v") == [("007", 3), ("a b.xlsx", 1), ("a b.xlsx", 2)] == _rows(books.read(1), "k", "v")
    assert books.rollback(1) == 3 and _rows(books.read()) == _rows(pinned)
    books.replace(spark.createDataFrame([("007", 10)], "k string, v int"))
    # Two folders of the key, and the one of a load that is empty then.
    assert books.vacuum() == 3 and books.versions() == [4]
    assert _rows(books.read(), "k", "v") == [("007", 10), ("a b.xlsx", 1), ("a b.xlsx", 2)]
    assert books.vacuum() == 0


@pytest.mark.parametrize("kind, listed", [("string", [202503, 202504]), ("bigint", ["202503", "202504"]), ("int", [202503, "202504", None, "x"])])
def test_listed_keys_of_another_type(spark, tmp_path, kind, listed):
    rows = spark.createDataFrame([("202503", 1), ("202504", 2), ("202505", 3)], "k string, v int").withColumn("k", F.col("k").cast(kind))
    sent = rows.where("k <> 202505").withColumn("v", F.col("v") * 10)
    table = History(spark, str(tmp_path / "v"), "k")
    for rows_, values in ((rows, None), (sent.where("k = 202503"), listed)):
        table.replace(rows_, values)
        history.replace_partition(rows_, str(tmp_path / "p"), "k", values)
    want = [("202503", 10), ("202505", 3)]
    assert _rows(table.read(), "k", "v") == want
    assert _rows(history.read_history(spark, str(tmp_path / "p")), "k", "v") == want


def test_unlisted_keys_are_added_and_a_table_may_feed_itself(spark, books):
    more = books.read().where("k <> '007'").withColumn("v", F.col("v") + 10)
    books.replace(more, ["007"])
    assert _rows(books.read(), "k", "v") == [("a b.xlsx", 1), ("a b.xlsx", 11), ("a b.xlsx", 12), ("a b.xlsx", 2)]
    assert _rows(books.append(books.read())) == [("a b.xlsx", 4, 4, "reemplazo")]
    books.replace(books.read().limit(0), ["a b.xlsx"])
    assert books.read().count() == 0 and books.read().columns == ["k", "v"]


def test_an_upsert_writes_only_what_it_touches(spark, tmp_path):
    table = History(spark, str(tmp_path / "u"), "p")
    rows = [(1, "a", "x", "p1"), (2, "b", "y", "p2"), (None, "n", "z", "p2"), (4, "d", "w", "p3")]
    table.replace(spark.createDataFrame(rows, "k int, v string, w string, p string"))
    before = _files(table.path)
    table.upsert(spark.createDataFrame([(2, "B"), (9, "C"), (None, "N")], "k int, v string"), ["k"])
    assert _rows(table.read()) == sorted(
        [(1, "a", "x", "p1"), (2, "B", "y", "p2"), (None, "n", "z", "p2"), (4, "d", "w", "p3"), (9, "C", None, None), (None, "N", None, None)], key=repr
    )
    new = _files(table.path) - before
    assert before <= _files(table.path) and {f.split("/p=")[1].split("/")[0] for f in new} == {"p2", "__HIVE_DEFAULT_PARTITION__"}
    table.upsert(spark.createDataFrame([(4, "p1"), (9, "p4")], "k int, p string"), ["k"])
    assert _rows(table.read(), "k", "p") == sorted([(1, "p1"), (2, "p2"), (None, "p2"), (4, "p1"), (9, "p4"), (None, None)], key=repr)
    assert table.vacuum() > 0 and table.read().count() == 6
    with pytest.raises(ValueError):
        table.upsert(spark.createDataFrame([(4, "q"), (4, "r")], "k int, v string"), ["k"])


def test_new_columns_and_changed_types(spark, books):
    books.replace(spark.createDataFrame([("n", 1, "extra")], "k string, v int, w string"))
    assert _rows(books.read().where("v = 1")) == [("a b.xlsx", 1, None), ("n", 1, "extra")]
    with pytest.raises(TypeError):
        books.replace(spark.createDataFrame([("n", "1")], "k string, v string"))


def test_folders_are_pruned_by_the_manifest(spark, books):
    plan = books.read()._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_null_keys_of_an_upsert_do_not_meet_in_one_task(spark):
    target = spark.range(4000).select(F.lit(None).cast("int").alias("k"), F.col("id").cast("string").alias("v"))
    merged = history.upsert(target, target.limit(10), ["k"])
    assert merged.count() == 4010
    parts = merged.select(F.spark_partition_id().alias("p")).groupBy("p").count()
    assert parts.agg(F.max("count")).first()[0] < 4010
