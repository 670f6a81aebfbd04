from conftest import rows

from lakestar.operators.upsert import (
    first_write_wins, from_state, last_write_wins, merge_states, rows_to_insert, to_state, upsert,
)

USERS = "id int, name string, level string"
INCOMING = "id int, name string, level string, ts int"


def users(spark):
    return spark.createDataFrame([(1, "Ann", "free"), (2, "Bo", "paid")], USERS)


def batch(spark):
    # Out of file order; user 1 changes twice, ends with NULL; user 3 is new; one row has no key.
    data = [
        (1, "Anna", None, 30), (3, "Cy", "paid", 12), (1, "Ane", "paid", 20), (3, "Cyd", "free", 11),
        (None, "Nobody", "free", 5),
    ]
    return spark.createDataFrame(data, INCOMING).repartition(3)


def test_update_named_column_keeps_the_rest(spark):
    got = upsert(users(spark), batch(spark), ["id"], ["ts"], ["level"])
    assert rows(got) == [(1, "Ann", None), (2, "Bo", "paid"), (3, "Cyd", "paid")]
    assert got.columns == ["id", "name", "level"]


def test_insert_or_ignore(spark):
    got = upsert(users(spark), batch(spark), ["id"], ["ts"], [])
    assert rows(got) == [(1, "Ann", "free"), (2, "Bo", "paid"), (3, "Cyd", "free")]
    assert rows(rows_to_insert(users(spark), batch(spark), ["id"], ["ts"])) == [(3, "Cyd", "free")]


def test_overwrite_by_key(spark):
    got = upsert(users(spark), batch(spark), ["id"], ["ts"], None)
    assert rows(got) == [(1, "Anna", None), (2, "Bo", "paid"), (3, "Cy", "paid")]


def test_applying_a_batch_twice_changes_nothing(spark):
    for update in (["level"], [], None):
        once = upsert(users(spark), batch(spark), ["id"], ["ts"], update)
        assert rows(upsert(once, batch(spark), ["id"], ["ts"], update)) == rows(once)


def test_states_merge_in_any_order(spark):
    parts = [batch(spark).filter(f"ts % 3 = {i}") for i in range(3)]
    states = [to_state(p, ["id"], ["ts"], ["name"], ["level"]) for p in parts]
    for order in ([0, 1, 2], [2, 0, 1], [1, 1, 0, 2, 0]):
        merged = merge_states([states[i] for i in order], ["id"])
        assert rows(from_state(merged, ["id"], ["id", "name", "level"])) == [(1, "Ane", None), (3, "Cyd", "paid")]


def test_ties_are_decided_by_values(spark):
    df = spark.createDataFrame([(1, "b", 5), (1, "a", 5), (1, None, 5)], "k int, v string, ts int")
    assert rows(first_write_wins(df, ["k"], ["ts"])) == [(1, None, 5)]
    assert rows(last_write_wins(df, ["k"], ["ts"])) == [(1, "b", 5)]
