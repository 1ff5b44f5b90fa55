from __future__ import annotations

import pytest

from tallyloom.sources import files, report, sinks, sql


def test_csv_blank_header_and_missing_texts(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"",Name,N,Flag,"say ""hi"""\n0,NA,1,True,x\n1,Bo,null,False,"a,b"\n2,"q ""r""",3,,n/a\n')
    df = files.load_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["Unnamed: 0", "Name", "N", "Flag", 'say "hi"']
    assert [t for _, t in df.dtypes] == ["bigint", "string", "bigint", "boolean", "string"]
    assert [tuple(r) for r in df.orderBy("`Unnamed: 0`").collect()] == [
        (0, None, 1, True, "x"), (1, "Bo", None, False, "a,b"), (2, 'q "r"', 3, None, None)]


@pytest.mark.parametrize("load", [files.load_csv, files.load_parquet, files.load_json, files.load_orc, files.load_feather])
def test_missing_file(spark, tmp_path, load):
    with pytest.raises(FileNotFoundError):
        load(spark, str(tmp_path / "absent"))


def test_feather_is_read_in_batches_by_several_tasks(spark, tmp_path):
    import pyarrow as pa

    table = pa.table({"k": list(range(100)), "x": [float("nan")] + [1.0] * 99})
    with pa.OSFile(str(tmp_path / "a.feather"), "wb") as sink, pa.ipc.new_file(sink, table.schema) as writer:
        writer.write_table(table, max_chunksize=10)
    df = files.load_feather(spark, str(tmp_path), batches_per_task=2)
    assert df.rdd.getNumPartitions() == 5
    assert df.count() == 100 and df.filter("x IS NULL").count() == 1
    assert files.load_feather(spark, str(tmp_path / "a.feather"), columns=["k"]).columns == ["k"]


def test_feather_files_need_one_schema(spark, tmp_path):
    import pyarrow as pa

    for name, table in (("a", pa.table({"k": [1]})), ("b", pa.table({"k": ["x"]}))):
        with pa.OSFile(str(tmp_path / f"{name}.feather"), "wb") as sink, pa.ipc.new_file(sink, table.schema) as writer:
            writer.write_table(table)
    with pytest.raises(ValueError, match="another schema"):
        files.load_feather(spark, str(tmp_path))


def test_json_forms(spark, tmp_path):
    (tmp_path / "r.json").write_text('[{"a": 1, "b": "x"}, {"a": 2, "b": null}]')
    (tmp_path / "l.json").write_text('{"a": 1, "b": "x"}\n{"a": 2, "b": null}\n')
    (tmp_path / "c.json").write_text('{"a": {"0": 1, "1": 2}, "b": {"0": "x", "1": null}}')
    wanted = {(1, "x"), (2, None)}
    for name, orient in (("r", "records"), ("l", "lines"), ("c", "columns")):
        df = files.load_json(spark, str(tmp_path / f"{name}.json"), orient).select("a", "b")
        assert {tuple(r) for r in df.collect()} == wanted, orient
    with pytest.raises(ValueError):
        files.load_json(spark, str(tmp_path / "r.json"), "split")


def test_query_from_a_file(spark, tmp_path):
    (tmp_path / "q.sql").write_text("SELECT id * 2 AS twice FROM {t}")
    out = sql.run_sql(spark, str(tmp_path / "q.sql"), {"t": spark.range(3)})
    assert sorted(r["twice"] for r in out.collect()) == [0, 2, 4]


def test_database_read_is_partitioned(spark, monkeypatch):
    """No database is started here: what the reader is asked for is checked instead."""
    from pyspark.sql import DataFrameReader

    seen = {}

    def jdbc(self, url, source, **options):
        seen.update(options, url=url, source=source)
        return spark.range(1)

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    sql.load_database(spark, "jdbc:x", "SELECT * FROM t;", "id", 0, 100, 8, {"user": "u"})
    assert seen["source"] == "(SELECT * FROM t) AS source"
    assert (seen["column"], seen["lowerBound"], seen["upperBound"], seen["numPartitions"]) == ("id", 0, 100, 8)


def test_load_report_of_an_empty_table(spark):
    row = report.load_report(spark.createDataFrame([], "a int, b string")).first()
    assert (row["rows"], row["missing_cells"], row["duplicate_rows"], row["bytes"], row["is_empty"]) == (0, 0, 0, 0, True)


def test_load_report_counts_duplicates_once_each(spark):
    row = report.load_report(spark.createDataFrame([(1, None), (1, None), (1, None), (2, "ab")], "a long, b string")).first()
    assert (row["rows"], row["duplicate_rows"], row["missing_cells"], row["bytes"]) == (4, 2, 3, 34)


def test_markdown(spark, tmp_path):
    path = str(tmp_path / "summary")
    sinks.write_markdown(spark.createDataFrame([("m", "0.1 (0.2)")], "model string, f1 string"), path)
    assert [r["value"] for r in spark.read.text(path).collect()] == ["| model | f1 |", "|---|---|", "| m | 0.1 (0.2) |"]
