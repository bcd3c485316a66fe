"""CSV files with bad lines: typed rows beside rejected lines."""

from pyspark.sql import types as T

from barline.sources.files import read_csv_lenient

SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("_line", T.LongType()),
                       T.StructField("ts", T.TimestampNTZType())])


def test_bad_lines_are_kept_beside_the_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'name,_line,ts\nx,1,2024-01-02 03:04:05\ny,one,2024-01-02 03:04:05\n\nz,2\n"q,r",,\nw,3,soon\nv,4,2024-01-02 03:04:05,more\n')
    rows, rejected = read_csv_lenient(spark, str(tmp_path), SCHEMA, "yyyy-MM-dd HH:mm:ss")
    assert [(r[0], r[1], str(r[2])) for r in rows.orderBy("name").collect()] == [("q,r", None, "None"), ("x", 1, "2024-01-02 03:04:05")]
    got = rejected.collect()
    assert sorted(r["line"] for r in got) == ["v,4,2024-01-02 03:04:05,more", "w,3,soon", "y,one,2024-01-02 03:04:05", "z,2"]
    assert all(r["file"].endswith("a.csv") for r in got)
    # a narrow selection judges a line by all its fields
    assert rows.select("name").count() == 2 and rejected.count() == 4


def test_missing_and_empty_files(spark, tmp_path):
    rows, rejected = read_csv_lenient(spark, str(tmp_path / "none"), SCHEMA)
    assert rows.count() == rejected.count() == 0 and rows.columns == SCHEMA.names
    (tmp_path / "b.csv").write_text("name,_line,ts\n")
    rows, rejected = read_csv_lenient(spark, str(tmp_path / "b.csv"), SCHEMA)
    assert rows.count() == rejected.count() == 0
