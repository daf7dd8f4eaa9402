"""One-pass CSV types against the reader's own inference."""

from seqlab.sources.profile import profile_csv, scan_csv_profiled

COLUMNS = {
    "i": ["1", "-7", "+3", ""], "l": ["1", "9999999999", "2", "3"], "big": ["123456789012345678901", "1", "-2", "3"],
    "d": ["1.5", "2", "", "-1e3"], "nan": ["NaN", "1.0", "Inf", "-Inf"], "b": ["true", "FALSE", "", "True"],
    "day": ["2024-01-31", "2024-02-29", "", "1999-12-31"], "t": ["2024-01-31 10:00:00", "2024-01-31T10:00:01", "", "1999-12-31 00:00:00"],
    "mixed": ["1", "x", "2024-01-01", "true"], "none": ["", "", "", ""], "word": ["a", "b", "1d", "5f"], "num_bool": ["1", "true", "2", "3"],
    "day_time": ["2024-01-31", "2024-01-31 10:00:00", "", "2024-01-01"], "zeros": ["007", "1", "2", "3"],
}


def written(tmp_path):
    for part in range(2):
        rows = list(zip(*COLUMNS.values()))[2 * part:2 * part + 2]
        (tmp_path / f"p{part}.csv").write_text("\n".join([",".join(COLUMNS), *[",".join(r) for r in rows]]) + "\n")
    return str(tmp_path)


def test_types_equal_the_readers_inference(spark, tmp_path):
    path = written(tmp_path)
    want = dict(spark.read.option("header", True).option("inferSchema", True).csv(path).dtypes)
    got = {r.column: r for r in profile_csv(spark, path).collect()}
    assert {c: r.type for c, r in got.items()} == want
    for name, cells in COLUMNS.items():
        full = sum(c != "" for c in cells)
        assert (got[name].cells, got[name].empty) == (full, len(cells) - full)
        assert got[name].place == list(COLUMNS).index(name) and got[name].bad == 0


def test_rows_are_read_with_the_types(spark, tmp_path):
    path = written(tmp_path)
    rows, profile = scan_csv_profiled(spark, path)
    want = spark.read.option("header", True).option("inferSchema", True).csv(path)
    assert rows.dtypes == want.dtypes
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, want.collect()))


def test_bad_cells_and_an_empty_file(spark, tmp_path):
    path = written(tmp_path)
    got = {r.column: r.bad for r in profile_csv(spark, path, {"mixed": "int", "word": "double", "i": "int"}).collect()}
    assert got["mixed"] == 3 and got["i"] == 0 and sum(got.values()) == got["mixed"] + got["word"]
    one = tmp_path / "only"
    one.mkdir()
    (one / "h.csv").write_text("a,b\n")
    assert [(r.column, r.type, r.cells) for r in profile_csv(spark, str(one)).collect()] == [("a", "string", 0), ("b", "string", 0)]
