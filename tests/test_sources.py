import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from vecloom.sources import files as files_source
from vecloom.sources.census import _describe, census, pick_column
from vecloom.sources.corpus import read_corpus

LONG = "lorem ipsum dolor sit amet " * 5


def put(path, **columns):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table(columns), path)


@pytest.fixture
def folder(tmp_path):
    root = str(tmp_path / "corpus")
    put(f"{root}/b.parquet", text=[LONG + "b0", None, ""], url=["http://b/0", "", None])
    put(f"{root}/nested/deep/a file.parquet", content=[LONG + "c0"], source_url=[None], text=pa.array([None], pa.string()))
    put(f"{root}/c.parquet", content=[f"  {LONG}c1 "], source_url=["http://c/1"], extra=[1])
    put(f"{root}/dict.parquet", text=pa.array([LONG + "d"]).dictionary_encode())
    put(f"{root}/none.parquet", html=["x"], url=["http://n"])
    put(f"{root}/numbers.parquet", text=[0, 7])
    with open(f"{root}/broken.parquet", "wb") as out:
        out.write(b"PAR1 not a parquet file")
    with open(f"{root}/notes.txt", "w") as out:
        out.write("ignored")
    return root


def test_discovery_and_patterns(spark, folder):
    names = {r.path.rsplit("/", 1)[-1] for r in files_source.list_files(spark, folder).collect()}
    assert names == {"a file.parquet", "b.parquet", "c.parquet", "dict.parquet", "none.parquet", "numbers.parquet", "broken.parquet"}
    assert files_source.list_files(spark, folder, ["nested/*"]).count() == 1
    assert files_source.list_files(spark, folder, ["b.parquet", "c*"]).count() == 2


def test_pick_column_takes_the_first_candidate():
    assert pick_column(["content", "text"], ["text", "content"]) == "text"
    assert pick_column(["body"], ["text", "content"]) is None


def test_census_and_corpus(spark, folder):
    facts = census(files_source.list_files(spark, folder)).collect()
    by_name = {r.path.rsplit("/", 1)[-1]: r for r in facts}
    assert by_name["broken.parquet"].status == "unreadable"
    assert by_name["none.parquet"].status == "no_text_column" and by_name["none.parquet"].url_col == "url"
    assert by_name["a file.parquet"].text_col == "text"  # by schema, though its values are null
    assert (by_name["c.parquet"].text_col, by_name["c.parquet"].url_col) == ("content", "source_url")
    assert by_name["numbers.parquet"].text_type == "bigint" and by_name["dict.parquet"].text_type == "string"
    assert by_name["b.parquet"].n_rows == 3

    rows = read_corpus(spark, [r for r in facts if r.status == "ok"]).collect()
    found = {(r.file_uri.rsplit("/", 1)[-1], r.row_index): (r.text, r.url) for r in rows}
    assert found[("b.parquet", 0)] == ((LONG + "b0"), "http://b/0")
    assert found[("b.parquet", 1)] == (None, "http://fw2.local/b.parquet-1")
    assert found[("b.parquet", 2)] == ("", "http://fw2.local/b.parquet-2")
    assert found[("c.parquet", 0)] == (LONG + "c1", "http://c/1")
    assert [v[0] for k, v in found.items() if "file.parquet" in k[0]] == [None]
    assert found[("numbers.parquet", 1)][0] == "7"
    assert {r.file_uri for r in rows} == {r.file_uri for r in facts if r.status == "ok"}


def test_broken_footers_are_told_from_lost_files(tmp_path):
    whole = tmp_path / "whole.parquet"
    pq.write_table(pa.table({"text": ["a"] * 100}), whole)
    data = whole.read_bytes()
    broken = {"empty": b"", "short": b"PAR1", "tail": data[:-6], "length": data[:-8] + b"\xff\xff\xff\x7fPAR1",
              "thrift": data[:-60] + b"\x99" * 52 + data[-8:]}
    for name, content in broken.items():
        file = tmp_path / f"{name}.parquet"
        file.write_bytes(content)
        assert _describe(str(file)) == {"status": "unreadable"}, name
    assert _describe(f"file://{whole}")["n_rows"] == 100
    with pytest.raises(FileNotFoundError):
        _describe(str(tmp_path / "gone.parquet"))


def test_scan_reads_only_the_chosen_columns(spark, folder):
    facts = [r for r in census(files_source.list_files(spark, folder)).collect() if r.path.endswith("c.parquet")]
    plan = read_corpus(spark, facts)._jdf.queryExecution().executedPlan().toString()
    assert "extra" not in plan and "content" in plan


def test_unprocessed_and_text_ledger(spark, folder, tmp_path):
    listed = files_source.list_files(spark, folder)
    uris = sorted(r.file_uri for r in listed.collect())
    ledger = tmp_path / "processed.txt"
    ledger.write_text("\n".join([uris[0], "", "   ", uris[1] + "  "]) + "\n")
    done = files_source.read_ledger_text(spark, str(ledger))
    assert sorted(r.path for r in done.collect()) == uris[:2]
    left = files_source.unprocessed(listed, done)
    assert sorted(r.file_uri for r in left.collect()) == uris[2:]
    failed = done.withColumn("status", F.lit("failed"))
    assert files_source.unprocessed(listed, failed).count() == len(uris)


def test_metadata_lines_append_and_keep_nulls(spark, tmp_path):
    path = str(tmp_path / "lines")
    rows = spark.createDataFrame([(1, None, "2024-01-02 03:04:05")], "id bigint, url string, created_at string").coalesce(1)
    files_source.write_metadata_lines(rows, path)
    files_source.write_metadata_lines(rows.withColumn("id", F.lit(2).cast("bigint")), path)
    assert all('"url":null' in r.value for r in spark.read.text(path).collect())
    assert sorted(r.id for r in files_source.read_metadata_lines(spark, path).collect()) == [1, 2]
