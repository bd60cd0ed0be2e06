import pytest
from pyspark.sql import Row

from statloom.sources import readers
from statloom.sources.sinks import save_results


def test_csv_pads_short_rows_and_skips_long_ones(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("a,b,c\n1,x,2.5\n2,y\n3,z,1.0,9\n")
    df = readers.read_table(spark, str(path))
    assert df.dtypes[0] == ("a", "int")
    assert sorted(df.collect()) == sorted([Row(a=1, b="x", c=2.5), Row(a=2, b="y", c=None)], key=lambda r: r[0])
    assert df.count() == 2


def test_csv_falls_back_to_latin1(spark, tmp_path):
    path = tmp_path / "l.csv"
    path.write_bytes("name,n\nJosé,1\n".encode("latin-1"))
    assert readers.read_table(spark, str(path)).first()["name"] == "José"


def test_other_formats(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("a\tb\n1\tx\n")
    (tmp_path / "r.json").write_text('[{"a": 1, "b": "x"}, {"a": 2, "b": null}]')
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n{"a": 2}\n')
    assert readers.read_table(spark, str(tmp_path / "t.tsv")).first() == Row(a=1, b="x")
    assert readers.read_table(spark, str(tmp_path / "r.json")).count() == 2
    assert readers.read_table(spark, str(tmp_path / "l.jsonl")).count() == 2
    spark.range(3).write.parquet(str(tmp_path / "p.parquet"))
    spark.range(3).write.orc(str(tmp_path / "o.orc"))
    assert readers.read_table(spark, str(tmp_path / "p.parquet"), limit=2).count() == 2
    assert readers.read_table(spark, str(tmp_path / "o.orc")).count() == 3
    with pytest.raises(ValueError):
        readers.read_table(spark, "x.xlsx")


def test_index_column_can_be_dropped(spark, tmp_path):
    (tmp_path / "i.csv").write_text("idx,a\n0,5\n1,6\n")
    assert readers.read_table(spark, str(tmp_path / "i.csv"), drop_index=True).columns == ["a"]


def test_sanitize(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, None, None)], "` a ` int, b string, c string")
    out = readers.sanitize(df)
    assert out.columns == ["a", "c"] and out.count() == 1
    assert readers.unique_names(["x", " x", "y\n1", "x"]) == ["x", "x_2", "y 1", "x_3"]


def test_preview_is_ordered(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "a int")
    assert [r[0] for r in readers.preview(df, 2).collect()] == [1, 2]


def test_results_are_stored_per_dataset(spark, tmp_path):
    for name in ("d1", "d2"):
        save_results({"t": spark.range(2)}, str(tmp_path / "out"), name)
    back = spark.read.parquet(str(tmp_path / "out" / "t"))
    assert back.count() == 4 and back.filter("dataset_id = 'd1'").count() == 2


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('id,say,end\n1,"say ""hi"", you",ok\n2,"line1\nline2",ok\n3,plain,ok,extra\n4,"a, b"\n')
    rows, rejected = readers.read_with_rejected(spark, str(path))
    assert sorted(map(tuple, rows.collect())) == [(1, 'say "hi", you', "ok"), (2, "line1\nline2", "ok"), (4, "a, b", None)]
    assert [(r.id, r._extra) for r in rejected.collect()] == [(3, "extra")]
    single = tmp_path / "s.csv"
    single.write_text("a;b\n'x;y';1\n")
    assert readers.read_delimited(spark, str(single), sep=";", quote="'").first() == Row(a="x;y", b=1)


def test_csv_headers_are_numbered(spark, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text("a,a,b\n1,2,3\n")
    assert readers.read_table(spark, str(path)).columns == ["a", "a_2", "b"]
    assert readers.unique_names(["a", "a", "a_2"]) == ["a", "a_3", "a_2"]
    assert readers.unique_names(["a", "a_2", "a", "a"]) == ["a", "a_2", "a_3", "a_4"]
