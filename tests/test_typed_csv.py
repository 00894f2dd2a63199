"""CSV columns by header name, per file, with a table of rejected lines."""

import datetime as dt
import os

from ashgrid.sources import files as SF


def put(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_shuffled_headers_and_bad_lines(spark, tmp_path):
    path = str(tmp_path / "csv")
    put(path, "a.csv", "st,d,precip\n1,2024-01-01,0.5\n2,2024-01-02,\n3,2024-01-03,wet\n4,2024-01-04\n5,2024-01-05,1.0,9\n")
    put(path, "b.csv", 'precip, d ,extra,st\n2.5,2024-02-01,"x, y",6\n\n7,not a day,"q",7\nprecip, d ,extra,st\n,,,\n')
    put(path, "c.csv", "\ufeffd,st\n2024-03-01,8\n")
    put(path, "empty.csv", "")
    put(path, "only_header.csv", "st,d,precip\n")
    rows, rejects = SF.typed_csv(spark, path, "st bigint, d date, precip double, missing int")
    got = sorted(map(tuple, rows.collect()), key=lambda r: (r[0] is None, r[0]))
    day = lambda m, d: dt.date(2024, m, d)
    assert got == [(1, day(1, 1), 0.5, None), (2, day(1, 2), None, None), (6, day(2, 1), 2.5, None), (8, day(3, 1), None, None),
                   (None, None, None, None)]
    bad = sorted((os.path.basename(r["source_file"]), r["line"], r["reason"]) for r in rejects.collect())
    assert bad == [("a.csv", "3,2024-01-03,wet", "bad value in precip"), ("a.csv", "4,2024-01-04", "wrong number of fields"),
                   ("a.csv", "5,2024-01-05,1.0,9", "wrong number of fields"), ("b.csv", '7,not a day,"q",7', "bad value in d")]


def test_large_files_are_split(spark, tmp_path):
    path = str(tmp_path / "csv")
    put(path, "a.csv", "b,a\n" + "".join(f"{i},{i * 2}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        rows, rejects = SF.typed_csv(spark, path, "a bigint, b bigint")
        assert rows.selectExpr("count(*) n", "sum(a) a", "sum(b) b").head()[:] == (20_000, 399_980_000, 199_990_000)
        assert rejects.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_no_files_with_lines(spark, tmp_path):
    path = str(tmp_path / "csv")
    put(path, "a.csv", "")
    rows, rejects = SF.typed_csv(spark, path, "a bigint")
    assert rows.count() == 0 and rejects.count() == 0 and rows.columns == ["a"]


def test_projection_is_typed(spark, tmp_path):
    path = str(tmp_path / "csv")
    put(path, "a.csv", "x,st,ndvi\n1,2,0.25\n3,4,none\n")
    got = SF.projected_csv(spark, path, ["st", "ndvi", "st", "gone"], {"st": "bigint", "ndvi": "double"})
    assert got.dtypes == [("st", "bigint"), ("ndvi", "double")]
    assert sorted(map(tuple, got.collect())) == [(2, 0.25), (4, None)]
    assert SF.projected_csv(spark, path, ["x"]).dtypes == [("x", "string")]
