import itertools
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import checks, compare, mutate, shape
from tallyloom.operators.mutate import Scope

STATE = "K string, SEASON string, QTY int, NOTE string, CXL int"
FEED = "K string, SEASON string, QTY int"


@pytest.fixture()
def state(spark):
    return spark.createDataFrame(
        [
            ("a", "SP-20", 1, "n1", 0),
            ("b", "SP-20", 2, "n2", 0),
            ("c", "FA-19", 3, "n3", 0),
            ("d", "SP-20", 4, "n4", 1),
            ("e", None, 5, "n5", 0),
        ],
        STATE,
    )


@pytest.fixture()
def feed(spark):
    return spark.createDataFrame([("a", "FA-20", 10), ("d", "SP-20", 40), ("z", "SP-20", 99)], FEED)


VALUES = {"SEASON": "SEASON", "QTY": "QTY"}


def test_upsert_keeps_unnamed_columns(rows, state, feed):
    out = rows(mutate.upsert(state, feed, ["K"], VALUES))
    assert ("a", "FA-20", 10, "n1", 0) in out
    assert ("z", "SP-20", 99, None, 0) in out
    assert ("b", "SP-20", 2, "n2", 0) in out
    assert ("d", "SP-20", 40, "n4", 1) in out


def test_soft_delete_scoped_by_old_season(rows, state, feed):
    out = rows(mutate.upsert_soft_delete(state, feed, ["K"], VALUES, zero=["QTY"], scope=Scope("SEASON", feed, "SEASON")))
    assert out == [
        ("a", "FA-20", 10, "n1", 0),
        ("b", "SP-20", 0, "n2", 1),
        ("c", "FA-19", 3, "n3", 0),
        ("d", "SP-20", 40, "n4", 0),
        ("e", None, 5, "n5", 0),
        ("z", "SP-20", 99, None, 0),
    ]


def test_scope_joined_by_broadcast_and_by_shuffle_gives_the_same(spark, rows, state, feed):
    scope = Scope("SEASON", feed, "SEASON")
    few = rows(mutate.upsert_soft_delete(state, feed, ["K"], VALUES, scope=scope))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(mutate.upsert_soft_delete(state, feed, ["K"], VALUES, scope=scope)) == few
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_scope_stays_lazy(spark, state, feed):
    broken = feed.withColumn("SEASON", F.raise_error(F.lit("boom")).cast("string"))
    mutate.upsert_soft_delete(state, feed, ["K"], VALUES, scope=Scope("SEASON", broken, "SEASON"))


def test_unscoped_soft_delete(rows, state, feed):
    out = {r[0]: r[4] for r in rows(mutate.upsert_soft_delete(state, feed, ["K"], VALUES))}
    assert out == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1, "z": 0}


def test_upsert_is_idempotent(rows, state, feed):
    scope = Scope("SEASON", feed, "SEASON")
    once = mutate.upsert_soft_delete(state, feed, ["K"], VALUES, zero=["QTY"], scope=scope)
    assert rows(mutate.upsert_soft_delete(once, feed, ["K"], VALUES, zero=["QTY"], scope=scope)) == rows(once)


def three_statements(state, feed, seasons):
    """The upsert as UPDATE, INSERT and UPDATE over plain dictionaries."""
    table = {r[0]: list(r) for r in state}
    given = {r[0]: r for r in feed}
    for k, row in table.items():
        if k in given:
            row[1], row[2], row[4] = given[k][1], given[k][2], 0
    old = {r[0]: r[1] for r in state}
    for k, r in given.items():
        table.setdefault(k, [k, r[1], r[2], None, 0])
    for k, row in table.items():
        if k not in given and old.get(k) in seasons:
            row[2], row[4] = 0, 1
    return sorted(map(tuple, table.values()))


@pytest.mark.parametrize("seed", range(3))
def test_upsert_equals_three_statements(spark, rows, seed):
    rnd = random.Random(seed)
    seasons = ["SP-19", "FA-19", "SP-20"]
    state = [(f"k{i}", rnd.choice(seasons), rnd.randint(1, 9), "n", rnd.randint(0, 1)) for i in range(40) if rnd.random() < 0.7]
    feed = [(f"k{i}", rnd.choice(seasons[:2]), rnd.randint(1, 9)) for i in range(40) if rnd.random() < 0.5]
    df, src = spark.createDataFrame(state, STATE), spark.createDataFrame(feed, FEED)
    out = mutate.upsert_soft_delete(df, src, ["K"], VALUES, zero=["QTY"], scope=Scope("SEASON", src, "SEASON"))
    assert rows(out) == three_statements(state, feed, {r[1] for r in feed})


def test_repeated_and_null_keys_stop_the_load(spark, rows, state):
    twice = spark.createDataFrame([("a", "SP-20", 1), ("a", "SP-20", 2)], FEED)
    with pytest.raises(Exception, match="repeated key in source: K"):
        rows(mutate.upsert(state, twice, ["K"], VALUES))
    blank = spark.createDataFrame([(None, "SP-20", 1)], FEED)
    with pytest.raises(Exception, match="null key in source: K"):
        rows(mutate.upsert(state, blank, ["K"], VALUES))
    assert rows(mutate.update_from(state, blank, ["K"], {"QTY": "QTY"})) == rows(state)
    with pytest.raises(Exception, match="repeated key in source: K"):
        rows(mutate.update_from(state, twice, ["K"], {"QTY": "QTY"}))
    first = mutate.upsert(state, twice, ["K"], VALUES, on_duplicate="first", order=["QTY"])
    assert ("a", "SP-20", 1, "n1", 0) in rows(first)


def test_key_check_ignores_rows_removed_before(spark, rows):
    df = spark.createDataFrame([(None, 0), ("a", 1)], "K string, X int").filter("X > 0")
    known = spark.createDataFrame([("a",), ("b",)], "K string")
    assert rows(mutate.require_keys(df.join(known, "K", "left_semi"), ["K"])) == [("a", 1)]


def test_updates(spark, rows, state, feed):
    out = rows(mutate.update_from(state, feed, ["K"], {"QTY": "QTY"}), "K", "QTY")
    assert out == [("a", 10), ("b", 2), ("c", 3), ("d", 40), ("e", 5)]
    zeroed = mutate.update_where(state, F.col("SEASON") == "SP-20", {"QTY": F.lit(0)})
    assert rows(zeroed, "K", "QTY") == [("a", 0), ("b", 0), ("c", 3), ("d", 0), ("e", 5)]
    fixed = mutate.apply_corrections(state, [({"K": "a"}, {"SEASON": "FA-19"}), ({"SEASON": "FA-19"}, {"CXL": 7})])
    assert rows(fixed, "K", "CXL") == [("a", 7), ("b", 0), ("c", 7), ("d", 1), ("e", 0)]


def test_carry_forward_across_slices(spark, rows):
    cells = [("f", i // 7, i, "v%d" % i if i % 11 == 3 else None) for i in range(100)]
    cells += [("g", 0, 0, None), ("g", 5, 60, "x"), ("g", 9, 90, None)]
    df = spark.createDataFrame(cells, "file string, block int, row int, v string")
    out = rows(shape.carry_forward(df, ["v"], ["file"], ["block", "row"], "block"), "file", "row", "v")
    expected, last = [], {}
    for file, _, row, v in cells:
        last[file] = v or last.get(file)
        expected.append((file, row, last[file]))
    assert out == sorted(expected, key=lambda r: tuple(str(v) for v in r))


def test_last_or_match_is_that_of_a_plain_scan(spark, rows):
    rng = random.Random(5)
    cells = [(g, i // 6, i, rng.choice([None, "a", "b", "c"]), rng.random() < 0.2) for g in ("f", "g") for i in range(80)]
    cells.append(("h", 0, 0, "a", None))
    df = spark.createDataFrame(cells, "file string, block int, row int, k string, hit boolean")
    want = []
    for file in ("f", "g", "h"):
        own, found = [c for c in cells if c[0] == file], "nothing"
        for c, following in zip(own, [*own[1:], None]):
            if c[4]:
                found = c[3]
                want.append((file, c[2]))
            elif (following is None or following[3] != c[3]) and c[3] != found:
                want.append((file, c[2]))
    got = shape.last_or_match(df, ["k"], F.col("hit"), ["file"], ["block", "row"], "block")
    assert got.columns == df.columns and sorted((r.file, r.row) for r in got.collect()) == sorted(want)
    assert shape.last_or_match(df.limit(0), ["k"], F.col("hit"), ["file"], ["block", "row"], "block").count() == 0


def test_stacked_exceptions_are_those_of_single_checks(spark, rows):
    df = spark.createDataFrame([("x", 1, 5), ("y", None, 7), ("z", 9, None)], "k string, a int, b int")
    rules = [checks.Rule("small", F.col("a") < 5, ["k"], "too small", "b", "a"), checks.Rule("unknown", F.col("b").isNull(), ["k", "a"], "no b")]
    got = checks.stacked_exceptions(df, rules, ["a"])
    assert rows(got) == [(1, "small", "x", "5", "1", "too small"), (9, "unknown", "z|9", None, None, "no b")]
    single = [checks.exception_rows(df.filter(r.bad), r.check_id, r.key, r.reason, r.expected, r.actual) for r in rules]
    assert rows(got.drop("a")) == rows(checks.all_exceptions(single))
    assert checks.stacked_exceptions(df.limit(0), rules).count() == 0


def test_drop_last_and_first_by(spark, rows):
    df = spark.createDataFrame([("f", 0, 1), ("f", 1, 0), ("g", 0, 5)], "file string, block int, row int")
    assert rows(shape.drop_last(df, ["file"], ["block", "row"])) == [("f", 0, 1)]
    assert shape.drop_last(df, ["file"], ["block", "row"], 2).count() == 0
    assert shape.drop_last(df, ["file"], ["block", "row"], 0).count() == 3
    assert rows(shape.first_by(df, ["file"], ["block", "row"])) == [("f", 0, 1), ("g", 0, 5)]
    blanks = spark.createDataFrame([(None, 1), (None, 2), ("g", None), ("g", 1)], "file string, row int")
    assert rows(shape.drop_last(blanks, ["file"], ["row"])) == [(None, 1), ("g", None)]


def test_a_group_of_any_size_is_spread(spark):
    """No join on the group alone feeds the slices of a group."""
    df = spark.createDataFrame([("f", 0, 1, "x")], "file string, block int, row int, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        kept = shape.drop_last(df, ["file"], ["block", "row"])
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("row" in line for line in joins)


def test_hold_back(spark, rows):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, n int")
    new = spark.createDataFrame([("a", 2), ("b", 2), ("c", 2), (None, 2)], "k string, n int")
    held = spark.createDataFrame([("b",), ("c",), ("b",), (None,)], "k string")
    assert rows(checks.hold_back(old, new, held, ["k"])) == [(None, 2), ("a", 2), ("b", 1)]


def test_unpivot_pairs(spark, rows):
    df = spark.createDataFrame(
        [("1", "2/S", "X", "2", None), ("3", "1/M", "Y", "4", "9/L")],
        "SCALE string, DESC string, OTHER string, `SCALE 2` string, `DESC 2` string",
    )
    assert rows(shape.unpivot_pairs(df)) == [("1", "2/S"), ("3", "1/M"), ("4", "9/L")]
    with pytest.raises(ValueError):
        shape.unpivot_pairs(df.drop("DESC 2"))


def test_null_comparisons(spark):
    values = [1, 2, None]
    df = spark.createDataFrame(list(itertools.product(values, values)), "a int, b int")
    got = {(r[0], r[1]): r[2] for r in df.select("a", "b", compare.ne_or_null("a", "b")).collect()}
    assert got == {(a, b): a is None or b is None or a != b for a, b in got}


@pytest.mark.parametrize("diff,flagged", [("0.009", 0), ("0.01", 1), ("0.011", 1), ("-0.01", 1)])
def test_tolerance(spark, diff, flagged):
    df = spark.createDataFrame([(100.10 + float(diff), 100.10)], "a double, b double")
    assert df.filter(compare.beyond_tolerance("a", "b")).count() == flagged


def test_review_gate(spark):
    df = spark.createDataFrame([("x",), ("y",)], "k string")
    found = checks.all_exceptions(
        [checks.exception_rows(df, "one", ["k"], "r"), checks.exception_rows(df.filter("k = 'x'"), "two", ["k"], "r")]
    )
    assert checks.review_gate(found, "proceed") == {"one": 2, "two": 1}
    with pytest.raises(checks.CheckFailed) as error:
        checks.review_gate(found, accepted=["one"])
    assert error.value.counts == {"two": 1}
    assert checks.review_gate(checks.no_exceptions(df)) == {}
    with pytest.raises(ValueError):
        checks.review_gate(found, "maybe")


def test_control_totals(spark, rows):
    sent = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5), (None, 9)], "k string, n int")
    stored = spark.createDataFrame([("a", 3), ("b", 4)], "k string, n int")
    assert rows(checks.control_totals(sent, stored, ["k"], "n")) == [("b", 5, 4)]
