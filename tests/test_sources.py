import hashlib

import pytest

from concordat.model import DatasetSpec
from concordat.sources import (
    audit_files,
    collect_file_metadata,
    file_hashes,
    layout_findings,
    read_table,
    read_table_from_spec,
    read_two_row_header,
    text_layouts,
    validate_file_exists,
    validate_file_input,
    write_table,
)
from concordat.sources.audit import store_locator, store_settings
from concordat.sources.readers import column_index


def write(path, lines, sep=","):
    path.write_text("\n".join(sep.join(map(str, line)) for line in lines) + "\n", encoding="utf-8")
    return str(path)


def test_csv_and_tsv_come_as_text_with_missing_cells_null(spark, tmp_path, rows):
    lines = [("id", "v"), ("01", "NA"), ("02", ""), ("03", "x")]
    for name, sep in (("t.csv", ","), ("t.tsv", "\t")):
        df = read_table(spark, write(tmp_path / name, lines, sep))
        assert df.dtypes == [("id", "string"), ("v", "string")]
        assert rows(df) == [("01", None), ("02", None), ("03", "x")]
    kept = read_table(spark, str(tmp_path / "t.csv"), na_texts=())
    assert rows(kept, "v") == [(None,), ("NA",), ("x",)]


def test_quotes_and_quoted_line_breaks(spark, tmp_path, rows):
    (tmp_path / "q.csv").write_text('a,b\n"x, ""y""",1\n"p\nq",2\n', encoding="utf-8")
    df = read_table(spark, str(tmp_path / "q.csv"), multi_line=True)
    assert rows(df) == [("p\nq", "2"), ('x, "y"', "1")]


def test_given_columns_are_selected_by_name(spark, tmp_path, rows):
    path = write(tmp_path / "t.csv", [("v", "id"), (2, 1)])
    assert rows(read_table(spark, path, columns=["id", "v"])) == [("1", "2")]
    assert rows(read_table(spark, path, columns=["v", "w"])) == [("2", None)]


def test_a_folder_is_read_by_name(spark, tmp_path, rows, plan_of):
    folder = tmp_path / "plain"
    folder.mkdir()
    write(folder / "a{1}.csv", [("id", "v"), (1, "x")])
    write(folder / "b [2].csv", [("v", "id"), ("y", 2)])
    write(folder / "c.csv", [("id", "more", "v"), (3, "m", "NA")])
    write(folder / "d.csv", [("id", "v"), (4, "z")])
    write(folder / "e.csv", [("id",), (5,)])
    (folder / "empty.csv").write_text("")
    df = read_table(spark, str(folder), "csv")
    assert rows(df, "id", "v", "more") == [("1", "x", None), ("2", "y", None), ("3", None, "m"), ("4", "z", None), ("5", None, None)]
    assert plan_of(df).count("FileScan csv") == 4
    layouts = text_layouts(spark, str(folder))
    assert rows(layouts.where("file like '%c.csv'"), "position", "name") == [(0, "id"), (1, "more"), (2, "v")]
    found = rows(layout_findings(spark, str(folder), ",", "demo", ["id", "v", "w"]), "check_name", "column_name", "row_count")
    assert found == [("column_absent_in_files", "more", 4), ("column_absent_in_files", "v", 1), ("column_absent_in_files", "w", 5), ("column_unknown_in_files", "more", 1)]
    spec = DatasetSpec("demo", str(folder), "csv")
    assert rows(validate_file_input(spark, spec).issues, "column_name") == [("more",), ("v",)]
    alike = tmp_path / "alike"
    spark.range(20).selectExpr("id", "id * 2 as v").repartition(3).write.option("header", True).csv(str(alike))
    df = read_table(spark, str(alike), "csv")
    assert plan_of(df).count("FileScan csv") == 1 and df.count() == 20


def test_headers_over_several_lines(spark, tmp_path, rows):
    folder = tmp_path / "quoted"
    folder.mkdir()
    (folder / "a.csv").write_text('"first\nname",b\n"p\nq",2\n', encoding="utf-8")
    (folder / "b.csv").write_text('\nb,"first\nname"\n3,x\n', encoding="utf-8")
    df = read_table(spark, str(folder), "csv", multi_line=True)
    assert rows(df, "`first\nname`", "b") == [("p\nq", "2"), ("x", "3")]


def test_round_trips_and_type_choice(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "A"), (2, "B")], "patient_id long, visit string")
    parquet = write_table(df, str(tmp_path / "deep" / "t.parquet"))
    assert rows(read_table(spark, parquet)) == [(1, "A"), (2, "B")]
    assert read_table(spark, parquet).dtypes == df.dtypes
    csv = write_table(df, str(tmp_path / "t.csv"))
    assert rows(read_table(spark, csv)) == [("1", "A"), ("2", "B")]
    df.write.parquet(str(tmp_path / "t.data"))
    assert read_table(spark, str(tmp_path / "t.data"), "PARQUET").count() == 2
    with pytest.raises(ValueError, match="Unsupported file type: data"):
        read_table(spark, str(tmp_path / "t.data"))
    with pytest.raises(ValueError, match="Unsupported output type"):
        write_table(df, str(tmp_path / "t.data2"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_table(df, parquet)


@pytest.mark.parametrize("letters, index", [("A", 0), ("n", 13), ("Z", 25), ("AA", 26), ("AZ", 51), (" C ", 2)])
def test_column_letters(letters, index):
    assert column_index(letters) == index


@pytest.mark.parametrize("letters", ["", "A1", "-", "é"])
def test_bad_column_letters(letters):
    with pytest.raises(ValueError, match="Invalid"):
        column_index(letters)


def export(rows_of_data, visit="Visit\tno"):
    """An export of six columns, the first four named in row 4, the others in row 1."""
    return [
        ["x", "x", "x", "x", "Pulse", "Pulse"],
        ["made", "by", "hand", "", "", ""],
        ["unit"] * 6,
        ["Key", visit, "Site", "Arm", "beats", "beats"],
        *[[f"k{n}", n, "s", "t", n + 1, n + 2] for n in rows_of_data],
    ]


LAYOUT = {"demographics_column_end": "D", "demographics_header_row": 4, "clinical_header_row": 1}


def test_two_row_headers(spark, tmp_path, rows, plan_of):
    df = read_two_row_header(spark, write(tmp_path / "e.csv", export([1, 2])), **LAYOUT)
    assert df.columns == ["Key", "Visit no", "Site", "Arm", "Pulse", "Pulse_2"]
    assert rows(df, "Key", "`Pulse_2`") == [("k1", "3"), ("k2", "4")]
    assert plan_of(df).count("FileScan") == 1 and "Window" not in plan_of(df) and "Exchange" not in plan_of(df).replace("BroadcastExchange", "")
    assert read_table(spark, write(tmp_path / "wide.csv", [["c"] * 3, [*"pqr"], [*"abc"], [1, 2, 3]]), "two_row_header").columns == ["a", "b", "c"]


def test_two_row_headers_differ_by_file(spark, tmp_path, rows, plan_of):
    folder = tmp_path / "mixed"
    folder.mkdir()
    for name, header, data in (("a", ["A", "B", "VAR"], [1, 2, 3]), ("b", ["B", "A", "VAR2"], [2, 1, 4]), ("c", ["A", "B", "VAR"], ["A", "B", "VAR"])):
        write(folder / f"{name}.csv", [header, data, header])
    layout = {"demographics_column_end": "B", "demographics_header_row": 1, "clinical_header_row": 1}
    for multi_line in (False, True):
        df = read_two_row_header(spark, str(folder), multi_line=multi_line, **layout)
        assert rows(df, "A", "B", "VAR", "VAR2") == sorted(
            [("1", "2", "3", None), ("1", "2", None, "4"), ("A", "B", "VAR", None), ("A", "B", "VAR", None), ("A", "B", "VAR", None), ("A", "B", None, "VAR2")],
            key=lambda r: tuple((v is not None, str(v)) for v in r),
        )
        assert plan_of(df).count("FileScan") == 2 and "Window" not in plan_of(df)


def test_two_row_headers_of_many_files(spark, tmp_path):
    folder = tmp_path / "exports"
    folder.mkdir()
    for part in range(5):
        write(folder / f"e{part}.csv", export(range(part * 10, part * 10 + 10)))
    df = read_two_row_header(spark, str(folder), **LAYOUT)
    assert sorted(int(r[0][1:]) for r in df.select("Key").collect()) == list(range(50))


def test_two_row_headers_of_a_file_in_many_blocks(spark, tmp_path):
    path = write(tmp_path / "big.csv", export(range(6000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.csv(path).rdd.getNumPartitions() > 3
        df = read_two_row_header(spark, path, **LAYOUT)
        assert sorted(int(r[0][1:]) for r in df.select("Key").collect()) == list(range(6000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_same_row_headers_with_skip(spark, tmp_path, rows):
    lines = [["top", ""], ["Weight", "Height"], ["kg", "cm"], ["-", "-"], [70, 180], [80, 190]]
    spec = DatasetSpec(
        "sizes", write(tmp_path / "sizes.csv", lines), "csv", header_strategy="two_row_header", demographics_column_end="A",
        demographics_header_row=2, clinical_header_row=2, skip_rows_after_header=2,
    )
    df = read_table_from_spec(spark, spec)
    assert df.columns == ["Weight", "Height"]
    assert rows(df) == [("70", "180"), ("80", "190")]


def test_empty_headers_are_named(spark, tmp_path):
    lines = export([1])
    lines[3][2] = ""
    with pytest.raises(ValueError, match="empty demographic headers in row 4 for columns: 3"):
        read_two_row_header(spark, write(tmp_path / "a.csv", lines), **LAYOUT)
    with pytest.raises(ValueError, match="empty variable headers in row 1 for columns: 6"):
        read_two_row_header(spark, write(tmp_path / "b.csv", [[*export([])[0][:5], " "], *export([1])[1:]]), **LAYOUT)
    with pytest.raises(ValueError, match="at least 4 rows; got 3"):
        read_two_row_header(spark, write(tmp_path / "c.csv", export([1])[:3]), **LAYOUT)


def test_file_audit_and_hashes(spark, tmp_path, rows):
    contents = {"a.csv": b"id,value\n1,a\n", "b c%20.TXT": b"x" * 5000, "noext": b""}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    expected = sorted((n, len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items())
    assert rows(collect_file_metadata(spark, str(tmp_path)), "name", "size_bytes", "sha256") == expected
    assert rows(audit_files(spark, str(tmp_path)), "name", "suffix") == [("a.csv", ".csv"), ("b c%20.TXT", ".txt"), ("noext", "")]
    # over many chunks of a file the digests are the same
    streamed = {r.path.rsplit("/", 1)[1]: r.sha256 for r in file_hashes(spark, str(tmp_path), chunk_bytes=7).collect()}
    assert streamed == {name: digest for name, _, digest in expected}


def test_files_are_hashed_from_paths_alone(spark, tmp_path):
    """At every size the same way: no content in the plan, and one task a file, however few bytes their names have."""
    for n in range(5):
        (tmp_path / f"{n}.bin").write_bytes(bytes([n]) * 3_000_000 * (n == 4) + b"end")
    hashes = file_hashes(spark, str(tmp_path))
    plan = hashes._jdf.queryExecution().optimizedPlan().toString()
    assert "content#" not in plan.split("Relation")[0] and "MapInPandas" in plan
    got = {r.path.rsplit("/", 1)[1]: r.sha256 for r in hashes.collect()}
    assert got == {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in tmp_path.iterdir()}


def test_stores_are_opened_with_the_sessions_settings(spark):
    conf = spark._jsc.hadoopConfiguration()
    given = {
        "fs.s3a.endpoint": "http://store.local:9000", "fs.s3a.access.key": "general", "fs.s3a.secret.key": "hidden",
        "fs.s3a.bucket.own.access.key": "special", "fs.s3a.bucket.own.endpoint": "https://other.local/",
        "fs.azure.account.key.acc.dfs.core.windows.net": "k",
    }
    before = {name: conf.get(name) for name in given}
    for name, value in given.items():
        conf.set(name, value)
    try:
        locate = store_locator(store_settings(spark))
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)
    kind, options, place = locate("s3a://data/a b/c%20.csv")
    assert (kind, place) == ("s3", "data/a b/c%20.csv") and options["access_key"] == "general"
    assert (options["endpoint_override"], options["scheme"]) == ("store.local:9000", "http")
    _, options, _ = locate("s3n://own/x")
    assert (options["access_key"], options["secret_key"], options["endpoint_override"]) == ("special", "hidden", "other.local")
    assert "scheme" not in options
    assert locate("abfss://box@acc.dfs.core.windows.net/in/x") == ("azure", {"account_name": "acc", "account_key": "k"}, "box/in/x")
    assert locate("file:/tmp/a b") == ("file", {}, "file:/tmp/a b")


def test_input_validation(spark, tmp_path, rows):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    found, issues = validate_file_exists(spark, str(tmp_path / "x.csv"), "demo")
    assert found and rows(issues, "severity") == [("INFO",)]
    result = validate_file_input(spark, DatasetSpec("demo", str(tmp_path / "x.csv")))
    assert result.succeeded() and result.metrics.first().size_bytes == 8 and result.issues.isEmpty()
    absent = validate_file_input(spark, DatasetSpec("demo", str(tmp_path / "y.csv")))
    assert not absent.succeeded() and rows(absent.issues, "check_name") == [("file_exists",)]
    (tmp_path / "folder").mkdir()
    empty, issues = validate_file_exists(spark, str(tmp_path / "folder"), "demo")
    assert not empty and rows(issues, "check_name") == [("is_file",)]
