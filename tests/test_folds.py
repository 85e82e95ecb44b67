"""Ordered folds: last wins, first that is there, nulls, ties and empty tables."""

from terrane.operators import folds

ROWS = [(1, "a", "x", 1), (1, "a", "y", 3), (1, "a", "z", 2), (1, "b", None, 5), (1, "b", "old", 4), (1, None, "lost", 9), (2, None, None, None), (3, "t", "m", 1), (3, "t", "n", 1), (4, "n", "late", None), (4, "n", "soon", 0)]
SCHEMA = "id long, key string, value string, at int"


def test_last_of_a_key_wins_and_back(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    maps = folds.fold_tags(rows, ["id"], "key", "value", ["at"])
    assert {r.id: r.tags for r in maps.collect()} == {1: {"a": "y", "b": None}, 2: {}, 3: {"t": "n"}, 4: {"n": "soon"}}
    back = {tuple(r) for r in folds.unfold_tags(maps, ["id"]).collect()}
    assert back == {(1, "a", "y"), (1, "b", None), (3, "t", "n"), (4, "n", "soon")}
    assert folds.fold_tags(rows.limit(0), ["id"], "key", "value", ["at"]).count() == 0


def test_first_that_is_there(spark):
    found = folds.first_values(spark.createDataFrame(ROWS, SCHEMA), ["id"], ["value", "key"], ["at"])
    assert {tuple(r) for r in found.collect()} == {(1, "x", "a"), (2, None, None), (3, "m", "t"), (4, "late", "n")}


def test_a_hot_entity_sends_a_row_a_key_and_task(spark):
    rows = spark.range(50_000).selectExpr("1L AS id", "concat('k', id % 5) AS key", "cast(id AS string) AS value", "id AS at")
    maps = folds.fold_tags(rows, ["id"], "key", "value", ["at"])
    assert maps.first().tags == {f"k{i}": str(49_995 + i) for i in range(5)}
    plan = maps._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
