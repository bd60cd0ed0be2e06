"""Quoted line breaks over split boundaries: every split size gives the same rows as a plain parser."""

import csv
import io
import random

import pytest

from statloom.sources import readers


def made(rng, n):
    rows = []
    for i in range(n):
        text = "".join(rng.choice(["a", "é", ",", '"', "\n", "\n\n", " ", "x\r\ny", '""']) for _ in range(rng.randint(0, 12)))
        rows.append((str(i), text, rng.choice(["", "plain", "l\nm\nn"]), str(rng.randint(-5, 10**11))))
    return rows


def written(rows, quoting=csv.QUOTE_MINIMAL, ending="\n"):
    out = io.StringIO()
    csv.writer(out, quoting=quoting, lineterminator=ending).writerows([("i", "t", "u", "n"), *rows])
    return out.getvalue()


@pytest.fixture
def tiny_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "97b", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_records_over_splits(spark, tmp_path, tiny_splits, ending):
    rng = random.Random(len(ending))
    files = [made(rng, 60), made(rng, 1), [("9", "a\n" * 200 + '"', "", "7")], made(rng, 25)]
    for k, rows in enumerate(files):
        (tmp_path / f"f{k}.csv").write_bytes(written(rows, ending=ending).encode())
    back = readers.read_delimited(spark, str(tmp_path))
    assert back.rdd.getNumPartitions() > 10
    got = sorted((r.i, r.t or "", r.u or "", r.n) for r in back.collect())
    # a line break at the end of a field stays; the CSV parser joins none
    want = sorted((int(i), t, u, int(n)) for rows in files for i, t, u, n in rows)
    assert got == want
    assert dict(back.dtypes) == {"i": "int", "t": "string", "u": "string", "n": "bigint"}


def test_long_rows_and_headers(spark, tmp_path, tiny_splits):
    (tmp_path / "a.csv").write_text('a,"b\nb",a\n1,"x\ny",2.5\n3\n\n4,"p\nq",1,9,8\n')
    rows, rejected = readers.read_with_rejected(spark, str(tmp_path / "a.csv"))
    assert rows.columns == ["a", "b b", "a_2"]
    assert sorted(map(tuple, rows.collect())) == [(1, "x\ny", 2.5), (3, None, None)]
    assert [tuple(r) for r in rejected.collect()] == [(4, "p\nq", 1.0, "9")]


def test_uneven_quotes_are_read_file_by_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,5" pipe\n2,y\n')
    got = readers.read_delimited(spark, str(tmp_path / "a.csv")).collect()
    assert [(r.a, r.b) for r in got] == [(1, '5" pipe'), (2, "y")]


def test_latin1_with_line_breaks(spark, tmp_path, tiny_splits):
    (tmp_path / "a.csv").write_bytes(('n,t\n' + "".join(f'{i},"é\nü{i}"\n' for i in range(50))).encode("latin-1"))
    got = readers.read_delimited(spark, str(tmp_path / "a.csv")).collect()
    assert sorted((r.n, r.t) for r in got) == [(i, f"é\nü{i}") for i in range(50)]


def test_given_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"x\n1"\n2,"2020-01-01"\n')
    got = readers.read_delimited(spark, str(tmp_path / "a.csv"), schema="a double, b string").collect()
    assert sorted((r.a, r.b) for r in got) == [(1.0, "x\n1"), (2.0, "2020-01-01")]
