import gzip

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.shape import carry_forward
from tallyloom.schemas import ASSOCIATION
from tallyloom.sources import delimited, forms
from tallyloom.sources.warehouse import PublishConflict, Split, Warehouse


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


POSITIONS = {0: ("A", "string"), 2: ("N", "long"), 3: ("B", "nullable string")}


def test_read_positional(spark, rows, tmp_path):
    write(tmp_path / "x.csv", "h,h,h,h,h", "01,u, 5,x,y", ",u,,,", '"a,b",u,7,z')
    df = delimited.read_positional(spark, str(tmp_path / "x.csv"), POSITIONS)
    assert rows(df, "A", "N", "B") == [("", None, None), ("01", 5, "x"), ("a,b", 7, "z")]


def test_preamble_counts_physical_lines(spark, rows, tmp_path):
    for name in ("x.csv", "y.csv"):
        write(tmp_path / name, "title", "", "h,h,h,h", f"{name},u,5,q", "", "b,u,6,q", "total,,11,")
    df = delimited.read_positional(spark, str(tmp_path), POSITIONS, skip=3, with_position=True)
    assert rows(df, "A", "N") == [("b", 6), ("b", 6), ("total", 11), ("total", 11), ("x.csv", 5), ("y.csv", 5)]
    assert rows(delimited.trim_footer(df), "A") == [("b",), ("b",), ("x.csv",), ("y.csv",)]


def test_compressed_feed_is_carried_in_slices(spark, tmp_path):
    lines = [f"{i // 700 if i % 700 == 5 else ''},u,{i},q" for i in range(20000)]
    with gzip.open(tmp_path / "one.csv.gz", "wt") as out:
        out.write("\n".join(["title", "h,h,h,h", *lines]) + "\n")
    df = delimited.read_positional(spark, str(tmp_path), {0: ("A", "nullable string"), 2: ("N", "long")}, skip=2, with_position=True)
    assert df.select("_block").distinct().count() == 1
    sliced = delimited.feed_slice(1000)
    assert df.select(sliced).distinct().count() >= 20
    # as for a feed beyond one task: joins by shuffle, partitions as they are
    large = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in large.items():
        spark.conf.set(name, value)
    try:
        filled = carry_forward(df, ["A"], ["_file"], ["_block", "_row"], sliced)
        used = filled.filter("A IS NOT NULL AND N >= 0").groupBy(F.spark_partition_id()).count().count()
    finally:
        for name in large:
            spark.conf.unset(name)
    assert used > 1
    got = {r.N: r.A for r in filled.collect()}
    assert got == {i: str((i - 5) // 700) if i >= 5 else None for i in range(20000)}


def test_preamble_across_blocks(spark, tmp_path):
    write(tmp_path / "big.csv", "t1", "t2", *[f"{i},u,{i},q" for i in range(20000)], "total,,0,")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = delimited.read_positional(spark, str(tmp_path), POSITIONS, skip=2, with_position=True)
        assert df.rdd.getNumPartitions() > 4
        trimmed = delimited.trim_footer(df)
        got = trimmed.agg(F.count("*"), F.sum("N"), F.min(F.col("N")), F.max(F.col("N"))).collect()[0]
        assert tuple(got) == (20000, sum(range(20000)), 0, 19999)
        ordered = [r["N"] for r in trimmed.orderBy("_block", "_row").select("N").collect()]
        assert ordered == list(range(20000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_bad_number_stops(spark, tmp_path):
    write(tmp_path / "x.csv", "h", "a,u,five,q")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        delimited.read_positional(spark, str(tmp_path / "x.csv"), POSITIONS).collect()


def test_feed_family_and_missing_feed(spark, rows, tmp_path):
    write(tmp_path / "sp-20 ASSOC.csv", "h", "q,G1,x,12,5,123-A")
    write(tmp_path / "FA-20 ASSOC+x.csv", "h", "q,G2,x,12,5,124-A")
    write(tmp_path / "OO.csv", "h", "q,G3,x,12,5,123-A")
    df = delimited.read_feed_family(spark, str(tmp_path), "*ASSOC*", ASSOCIATION)
    assert rows(df, "GREEN_BAR", "FILE") == [("G1", "sp-20 ASSOC.csv"), ("G2", "FA-20 ASSOC+x.csv")]
    seasons = df.select("GREEN_BAR", delimited.season_first(F.col("FILE")).alias("s"))
    assert rows(seasons) == [("G1", "SP-20"), ("G2", "FA-20")]
    last = spark.createDataFrame([("SOURCE_HFC_ASSOC_SP-20.csv",)], "n string").select(delimited.season_last(F.col("n")))
    assert last.collect()[0][0] == "SP-20"
    with pytest.raises(delimited.MissingFeed):
        delimited.read_feed_family(spark, str(tmp_path), "*ALL*", ASSOCIATION)
    with pytest.raises(delimited.MissingFeed):
        delimited.require_feed(spark, str(tmp_path / "OO.csv"), str(tmp_path / "INV.csv"))


def test_sheets(spark, rows, tmp_path):
    write(tmp_path / "sheet=SP-20 ALL" / "p.csv", "h,h,h,h", "a,u,1,q")
    write(tmp_path / "sheet=FA-20 ALL" / "p.csv", "h,h,h,h", "b,u,2,q")
    write(tmp_path / "sheet=OO" / "p.csv", "h,h,h,h", "c,u,3,q", "total,,3,")
    family = delimited.read_sheet_family(spark, str(tmp_path), "ALL", POSITIONS)
    assert rows(family, "A", "SHEET") == [("a", "SP-20 ALL"), ("b", "FA-20 ALL")]
    assert rows(delimited.read_sheet(spark, str(tmp_path), "OO", POSITIONS, footer=1), "A") == [("c",)]


def test_headered_and_cancelled(spark, rows, tmp_path):
    write(tmp_path / "m.csv", "MAKER,HFC,ECOM", "X,12,1", ",13,")
    df = delimited.read_headered(spark, str(tmp_path / "m.csv"), {"HFC": "string", "MAKER": "nullable string", "ECOM": "int"})
    assert rows(df) == [("12", "X", 1), ("13", None, None)]
    names = spark.createDataFrame([("a.xls",), ("a CANCEL.xls",), ("a cancel.xls",), ("b.xlsx",)], "n string")
    assert rows(delimited.not_cancelled(names, F.col("n"))) == [("a.xls",)]


def test_body_end(spark, rows):
    cells = [("f", 22, 0, "a"), ("f", 23, 0, "b"), ("f", 24, 0, " "), ("f", 25, 0, "c"), ("g", 22, 0, "a"), ("h", 5, 1, "x"), ("h", 30, 1, "x")]
    df = spark.createDataFrame(cells, "file string, row int, col int, value string")
    assert rows(forms.body_end(df)) == [("f", 24, True), ("g", 23, False), ("h", 22, True)]
    assert rows(forms.body_lines(df), "file", "row", "style") == [("f", 22, "a"), ("f", 23, "b")]


def test_publish_is_atomic_and_versioned(spark, rows, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    assert store.version() == 0 and not store.exists("T")
    t = spark.createDataFrame([("a", "SP-20"), ("b", "FA-20"), ("c", None)], "K string, SEASON string")
    store.publish({"T": t, "U": t.limit(1)}, {"T": Split("SEASON")})
    assert rows(store.read("T")) == rows(t)
    bad = t.withColumn("K", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        store.publish({"U": t, "T": bad}, {"T": Split("SEASON")})
    assert store.version() == 1 and store.read("U").count() == 1
    # a table may be read and replaced in one load; only the named part is rewritten
    part = store.read("T", ["SP-20"]).withColumn("K", F.lit("z"))
    store.publish({"T": part}, {"T": Split("SEASON", ["SP-20"])})
    assert rows(store.read("T")) == [("b", "FA-20"), ("c", None), ("z", "SP-20")]
    assert rows(store.read("T", ["FA-20", None])) == [("b", "FA-20"), ("c", None)]
    gone = store.read("T", ["FA-20"]).filter("K = 'x'")
    store.publish({"T": gone}, {"T": Split("SEASON", ["FA-20"])})
    assert rows(store.read("T")) == [("c", None), ("z", "SP-20")]
    with pytest.raises(ValueError, match="not named for replacement"):
        store.publish({"T": t}, {"T": Split("SEASON", ["SP-20"])})


def test_part_names_of_every_kind_read_back(spark, rows, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    names = ["A<1", "a b+c", "50%", "x=y", "SP-20"]
    t = spark.createDataFrame([(n, n) for n in names], "K string, SEASON string")
    store.publish({"T": t}, {"T": Split("SEASON")})
    assert rows(store.read("T")) == rows(t)
    assert rows(store.read("T", ["A<1", "50%"])) == [("50%", "50%"), ("A<1", "A<1")]


def test_second_writer_is_told(spark, tmp_path, monkeypatch):
    one, two = Warehouse(spark, str(tmp_path)), Warehouse(spark, str(tmp_path))
    t = spark.createDataFrame([("a",)], "K string")
    monkeypatch.setattr(two, "_latest", lambda: (0, {}))
    one.publish({"T": t})
    with pytest.raises(PublishConflict):
        two.publish({"T": t})
    # two records in one commit: nobody guesses which one counts
    t.selectExpr("'{}' AS value").write.mode("append").text(str(tmp_path / "_commits" / "c=1"))
    with pytest.raises(PublishConflict, match="2 records"):
        one.read("T")


def test_latest_commit_by_number(spark, rows, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    for i in range(11):
        store.publish({"T": spark.createDataFrame([(i,)], "n int")})
    assert store.version() == 11 and rows(store.read("T")) == [(10,)]


def test_family_of_folders(spark, rows, tmp_path):
    rows_out = spark.createDataFrame([("1", "A_SP-20.csv"), ("2", "A_FA-20.csv")], "k string, feed string")
    rows_out.write.partitionBy("feed").option("header", True).csv(str(tmp_path / "x"))
    back = delimited.read_feed_family(spark, str(tmp_path / "x") + "/", "feed=A*", {0: ("K", "long")})
    assert rows(back.select("K", delimited.season_last(F.col("FILE")))) == [(1, "SP-20"), (2, "FA-20")]
