from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.operators import quality as Q
from panelkit.sources import csv, tables


def schema(**fields):
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


@pytest.mark.parametrize("raw, clean", [
    ("Rate per 100,000", "rate_per_100000"), ("Lower 95% CI", "lower_95pct_ci"), ("Province/Territory", "province_territory"),
    ("Age group (type)", "age_group_type"), ("Risk-adjusted rate: lower", "risk_adjusted_rate:_lower"), ("A b ", "a_b")])
def test_clean_column_name(raw, clean):
    assert csv.clean_column_name(raw) == clean


def test_title_header_and_latin1(spark, tmp_path, rows):
    path = tmp_path / "t.csv"
    path.write_bytes('"Table 1, rates"\nGeo name,Rate per 100,000 (%)\nQu\xe9bec,"1"\n"Nfld, Lab",2\nCanada,\n'.replace(
        "Rate per 100,000 (%)", '"Rate per 100,000 (%)"').encode("latin-1"))
    df = csv.read_csv_table(spark, str(path), schema(geo_name=T.StringType(), rate_per_100000_pct=T.DoubleType()), 1, "ISO-8859-1")
    assert rows(df) == [("Canada", None), ("Nfld, Lab", 2.0), ("Québec", 1.0)]
    text = csv.read_csv_table(spark, str(path), skip_rows=1, encoding="ISO-8859-1")
    assert text.columns == ["geo_name", "rate_per_100000_pct"] and dict(text.dtypes) == dict.fromkeys(text.columns, "string")


def test_na_stays_text_and_numbers_that_fail_become_null(spark, tmp_path, rows):
    path = tmp_path / "n.csv"
    path.write_text("Name,Value,Other\nN/A,5,x\nB,abc,y\nC,NaN,z\n")
    got = rows(csv.read_csv_table(spark, str(path), schema(name=T.StringType(), value=T.DoubleType())))
    assert got == [("B", None), ("C", None), ("N/A", 5.0)]
    assert rows(csv.read_csv_table(spark, str(path), schema(name=T.StringType()), null_tokens=("", "N/A"))) == [(None,), ("B",), ("C",)]


def test_missing_column_and_missing_file(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="no column c"):
        csv.read_csv_table(spark, str(path), schema(c=T.StringType()))
    gone = csv.read_csv_table(spark, str(tmp_path / "none.csv"), schema(a=T.LongType()))
    assert gone.count() == 0 and gone.columns == ["a"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        csv.read_csv_table(spark, str(tmp_path / "none.csv"))


def test_total_rows(spark, rows):
    df = spark.createDataFrame([("Both sexes", "All ages", 1), ("Males", "All ages", 2), (" Total - gender", "0 to 4", 3)], "Sex string, `Age group` string, n int")
    assert rows(csv.filter_total_rows(df), "n") == [(1,)]
    assert csv.filter_total_rows(df.select("n")).count() == 3


def test_write_counts_and_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.write_table(spark.range(10), path) == 10
    assert tables.write_table(spark.range(4), path) == 4
    assert tables.read_table(spark, path).count() == 4


def test_export_is_sorted_with_display_headers(spark, tmp_path):
    path = tmp_path / "e"
    tables.export_csv(spark.range(100).select((F.col("id") * 37 % 100).alias("n")), str(path), {"n": "Number (n)"}, ["n"])
    lines = [x for part in sorted(path.glob("part-*.csv")) for x in part.read_text().splitlines()]
    assert lines[0] == "Number (n)" and [int(x) for x in lines if x != "Number (n)"] == list(range(100))


def test_checks(spark):
    df = spark.createDataFrame([("a", 1.0, True), ("b", None, False), ("a", 200.0, True)], "k string, v double, f boolean")
    checks = [
        Q.NotNull("t", "v"), Q.NotNull("t", "k"), Q.Accepted("t", "k", ("a",)), Q.Accepted("t", "v", (1.0, 200.0)),
        Q.InRange("t", "v", 0, 100), Q.InRange("t", "v", 0, 100, "k = 'b'"), Q.Unique("t", ("k",)), Q.Unique("t", ("v",)),
        Q.Present("t", "k = 'z'"), Q.Present("t"), Q.ExactlyOne("t", "f"), Q.ExactlyOne("t", "not f"),
    ]
    got = sorted((r["check"], r["failures"]) for r in Q.run_checks({"t": df}, checks).collect())
    assert got == sorted([
        ("not_null:t.v", 1), ("not_null:t.k", 0), ("accepted:t.k", 1), ("accepted:t.v", 0), ("range:t.v", 1), ("range:t.v", 0),
        ("unique:t.k", 1), ("unique:t.v", 0), ("present:t", 1), ("present:t", 0), ("exactly_one:t", 1), ("exactly_one:t", 0)])
    assert Q.failing_rows({"t": df}, checks[4]).collect()[0]["v"] == 200.0
    assert Q.failing_rows({"t": df}, checks[6]).collect()[0]["n"] == 2
    for check in (Q.NotNull("typo", "v"), Q.Unique("typo", ("v",)), Q.Present("typo")):
        with pytest.raises(KeyError, match="typo"):
            Q.run_checks({"t": df}, [checks[0], check])


def table_of(spark, folder, **options):
    return sorted((tuple(r) for r in csv.read_csv_table(spark, str(folder), **options).collect()), key=str)


def test_titles_and_headers_go_by_place(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Table 2019\nk,v\nTable 2019,\nk,v\nx,1\n")
    (tmp_path / "b.csv").write_text("Table 2020\nK,V\nx,1\nTable 2019,2\n")
    assert table_of(spark, tmp_path, skip_rows=1) == sorted([("Table 2019", None), ("k", "v"), ("x", "1"), ("x", "1"), ("Table 2019", "2")], key=str)


def test_blank_title_line_counts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\nk,v\n\nx,1\n")
    assert table_of(spark, tmp_path, skip_rows=1) == [("x", "1")]


def test_files_with_other_columns_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\nx,1\n")
    (tmp_path / "b.csv").write_text("v,k\n2,y\n")
    with pytest.raises(ValueError, match="different headers"):
        csv.read_csv_table(spark, str(tmp_path))
    (tmp_path / "b.csv").write_text("")
    assert table_of(spark, tmp_path) == [("x", "1")]
    (tmp_path / "b.csv").write_text("title\n")
    with pytest.raises(ValueError, match="different headers|without header"):
        csv.read_csv_table(spark, str(tmp_path))


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n"two\nlines",1\n"say ""hi"", you",2\n5" pipe,3\n')
    with pytest.raises(Exception, match="multi_line"):
        csv.read_csv_table(spark, str(tmp_path)).collect()
    assert ("two\nlines", "1") in table_of(spark, tmp_path, multi_line=True)
    assert len(table_of(spark, tmp_path, multi_line=True)) == 3


def test_many_splits_of_one_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("title\nk,v\n" + "".join(f"r{i},{i}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = csv.read_csv_table(spark, str(tmp_path / "a.csv"), skip_rows=1)
        assert got.rdd.getNumPartitions() > 5
        assert sorted(int(r.v) for r in got.collect()) == list(range(5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_latin_1_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Größe\nName,é%\nÄ,1\n".encode("latin-1"))
    got = csv.read_csv_table(spark, str(tmp_path), skip_rows=1, encoding="ISO-8859-1")
    assert got.columns == ["name", "épct"] and got.first()[0] == "Ä"


@pytest.mark.parametrize("multi_line", [False, True])
def test_very_many_columns(spark, tmp_path, multi_line):
    (tmp_path / "a.csv").write_text(",".join(f"c{i}" for i in range(1200)) + "\n" + ",".join(str(i) for i in range(1200)) + "\n")
    got = csv.read_csv_table(spark, str(tmp_path), multi_line=multi_line)
    assert got.columns == [f"c{i}" for i in range(1200)] and list(got.first()) == [str(i) for i in range(1200)]


@pytest.mark.parametrize("multi_line", [False, True])
def test_one_scan(spark, tmp_path, multi_line):
    for name in "abc":
        (tmp_path / f"{name}.csv").write_text(f"title {name}\nk,v\n" + "".join(f"{name}{i},{i}\n" for i in range(50)))
    got = csv.read_csv_table(spark, str(tmp_path), skip_rows=1, multi_line=multi_line)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and "Exchange" not in plan
    assert got.count() == 150


def test_titles_are_counted_in_every_file_of_a_task(spark, tmp_path):
    """Small files share a task and batches; compressed ones and names with spaces are read alike."""
    import gzip

    for i in range(40):
        (tmp_path / f"f {i}.csv").write_text("same\nk,v\n" + "same\nk,v\nx,1\n" * (i % 3))
    with gzip.open(tmp_path / "z.csv.gz", "wt") as f:
        f.write("same\r\nk,v\r\nx,1\r\n")
    got = table_of(spark, tmp_path, skip_rows=1)
    n = sum(i % 3 for i in range(40))
    assert got == sorted([("x", "1")] * (n + 1) + [("k", "v")] * n + [("same", None)] * n, key=str)


def test_long_titles(spark, tmp_path):
    (tmp_path / "a.csv").write_text("t" * 200_000 + "\nk,v\nx,1\n")
    assert table_of(spark, tmp_path, skip_rows=1) == [("x", "1")]
    assert table_of(spark, tmp_path, skip_rows=1, multi_line=True) == [("x", "1")]


def failing(spark, n):
    """A frame whose last row can not be computed."""
    return spark.range(n).select(F.when(F.col("id") < n - 1, F.col("id")).otherwise(F.raise_error(F.lit("no such row"))).alias("id"))


def test_a_failing_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(10), path)
    with pytest.raises(Exception, match="no such row"):
        tables.write_table(failing(spark, 5), path)
    assert tables.read_table(spark, path).count() == 10
    assert [x.name for x in tmp_path.iterdir()] == ["t"]
    # A table may be replaced by what is read from it.
    assert tables.write_table(tables.read_table(spark, path).where("id < 3"), path) == 3
    assert tables.read_table(spark, path).count() == 3


def test_metrics_of_a_write(spark, tmp_path):
    found = tables.write_measured(spark.range(10), str(tmp_path / "t"), {"odd": F.count_if(F.col("id") % 2 == 1), "most": F.max("id")})
    assert found == {"rows": 10, "odd": 5, "most": 9}


def test_published_versions(spark, tmp_path):
    path, now = str(tmp_path / "mart"), [0.0]
    first = tables.publish(spark.range(1), path)
    reader = tables.Published(spark, path, max_age=300, clock=lambda: now[0])
    old = reader.read()
    second = tables.publish(spark.range(2), path)
    assert reader.read() is old and old.count() == 1 and reader.version == first
    now[0] = 299.9
    assert reader.read().count() == 1
    now[0] = 300.0
    assert reader.read().count() == 2 and reader.version == second == tables.current_version(spark, path)
    # Looked again, nothing new: the same frame for another 300 seconds.
    now[0] = 700.0
    same = reader.read()
    assert reader.read() is same
    with pytest.raises(Exception, match="no such row"):
        tables.publish(failing(spark, 5), path)
    assert tables.current_version(spark, path) == second and tables.Published(spark, path).read().count() == 2
    tables.publish(spark.range(3), path)
    kept = sorted(x.name for x in (tmp_path / "mart").iterdir() if x.name.startswith("version-") and any(x.glob("*.parquet")))
    assert first not in kept and second in kept and tables.Published(spark, path).read().count() == 3


def test_keys_are_counted_in_one_pass(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, None, 2), (None, "a", 2), (None, "a", 2), (2, "b", None)], "x int, y string, z int")
    checks = [Q.Unique("t", c) for c in (("x",), ("y", "x"), ("x", "y"), ("z",), ("x", "y", "z"), ("x",))]
    found = Q.unique_counts(df, checks)
    assert [r["failures"] for r in found.collect()] == [Q.failing_rows({"t": df}, c).count() for c in checks]
    assert found._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    left = spark.range(1000).selectExpr("id % 97 as k", "id as v")
    right = spark.range(97).selectExpr("id as key", "id * 2 as w")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = tables.write_bucketed(left, "bucketed_a", f"{tmp_path}/a", ["k"], 4)
        tables.write_bucketed(right, "bucketed_b", f"{tmp_path}/b", ["key"], 4)
        b = tables.read_bucketed(spark, "bucketed_again", f"{tmp_path}/b", right.schema, ["key"], 4)
        both = a.groupBy("k").agg(F.sum("v").alias("v")).join(b, F.col("k") == F.col("key"))
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert both.count() == 97 and both.agg(F.sum("v")).first()[0] == sum(range(1000))
        assert len(list((tmp_path / "a").glob("part-*.parquet"))) == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("bucketed_a", "bucketed_b", "bucketed_again"):
            spark.sql(f"drop table if exists {name}")
