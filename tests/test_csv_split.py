"""Split-safe CSV equals the plain reader whatever the splits; inferred types equal those of pandas."""

import io

import pandas as pd
import pytest

from valuemill.sources import read_csv, read_csv_inferred, read_csv_split, write_csv
from valuemill.sources import csv_split

TEXTS = ["plain", 'quote " inside', "two\nlines", 'a "quoted\nbreak", with comma', "\n\n", "", None, "x" * 700 + "\n" + "y" * 700, '"', '""\n""', " blanks ", "tab\t",
         "win\r\nbreak", "ends\n", "\nbegins", "ünï\ncode 漢字", "a,b,c", "'", "\\", '\\"', "lines\n" * 120]


@pytest.fixture
def split_bytes(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}

    def set_to(n):
        for k in keys:
            spark.conf.set(k, str(n))
    yield set_to
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [97, 700, 1 << 27])
def test_equals_the_plain_reader(spark, tmp_path, split_bytes, size):
    df = spark.createDataFrame([(i, t, f"{i}") for i, t in enumerate(TEXTS * 3)], "id int, text string, tail string")
    path = str(tmp_path / "csv")
    write_csv(df.coalesce(1), path)
    split_bytes(size)
    got = read_csv_split(spark, path, df.schema)
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect())) == sorted(map(str, read_csv(spark, path, df.schema).collect()))
    tasks = csv_split._lines(spark, path).rdd.getNumPartitions()
    assert tasks == 1 if size > 1 << 20 else tasks > 5


def test_several_files_headers_and_bad_records(spark, tmp_path, split_bytes):
    split_bytes(16)
    for i, rest in enumerate(['1,"x\ny"\r\n2,z\r\n', "3,w", ""]):
        (tmp_path / f"f{i}.csv").write_bytes(b"id,text\r\n" + rest.encode())
    assert sorted(tuple(r) for r in read_csv_split(spark, str(tmp_path), "id int, text string").collect()) == [(1, "x\ny"), (2, "z"), (3, "w")]
    with pytest.raises(ValueError, match="header"):
        read_csv_split(spark, str(tmp_path), "text string, id int")
    (tmp_path / "bad.csv").write_text('id,text\nno number,x\n4,"never closed\nand on')
    kept = {r.broken for r in read_csv_split(spark, str(tmp_path), "id int, text string", corrupt_col="broken").collect()}
    assert "no number,x" in kept
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv_split(spark, str(tmp_path), "id int, text string").collect()
    (tmp_path / "other.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="differ"):
        read_csv_split(spark, str(tmp_path), "id int, text string")


COLUMNS = {
    "whole": ["1", "-2", "+3", " 4"], "gapped": ["1", "", "3", "NA"], "number": ["1", "2.5", "1e-3", ".5"], "gaps": ["", "nan", "NULL", "None"],
    "mixed": ["1", "x", "2", "3"], "truth": ["True", "false", "TRUE", "False"], "truth_gap": ["True", "", "False", "True"], "truth_one": ["True", "1", "0", "False"],
    "endless": ["inf", "-inf", "1", "Infinity"], "long": ["9223372036854775807", "-9223372036854775808", "0", "1"], "unit": ["12 kmpl", "9 kmpl", "", "1"],
    "beyond": ["99999999999999999999999", "1", "2", "3"], "dotted": ["1.", "2", "3", "4"], "dates": ["2024-01-01", "2024-01-02", "", "x"],
}


def test_types_equal_those_of_pandas(spark, tmp_path):
    text = pd.DataFrame(COLUMNS).to_csv(index=False)
    (tmp_path / "t.csv").write_text(text)
    plain = pd.read_csv(io.StringIO(text))
    names = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string", "str": "string"}
    got = read_csv_inferred(spark, str(tmp_path / "t.csv"))
    assert dict(got.dtypes) == {c: names[str(t)] for c, t in plain.dtypes.items()}
    for own, want in zip(got.collect(), plain.itertuples(index=False), strict=True):
        for a, b in zip(own, want, strict=True):
            # pandas keeps truth values beside gaps as objects
            assert (a is None and pd.isna(b)) or str(a) == str(b)


def test_no_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n")
    got = read_csv_inferred(spark, str(tmp_path / "t.csv"))
    assert got.collect() == [] and dict(got.dtypes) == {"a": "string", "b": "string"}


def test_documents_are_written_by_more_than_one_task(spark, tmp_path, monkeypatch):
    from valuemill.plans import registry
    text = 'a "quoted" line\nand, another\n'
    spark.createDataFrame([(i, text * (i % 3)) for i in range(60)], "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(registry, "scratch_path", lambda *_: str(tmp_path / "csv"))
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # a task a file
    try:
        got = registry.q_csv_split_documents(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert sorted((r.doc_id, r.text) for r in got) == [(i, text * (i % 3)) for i in range(60)]
    assert len(list((tmp_path / "csv").glob("*.csv"))) > 1


def test_lines_of_one_record_each_stay_one_batch():
    import pyarrow as pa
    lines = ["a,b", *[f"{i},x" for i in range(5000)], '9,"y', 'z"']
    batch = pa.RecordBatch.from_arrays([pa.array([7] * len(lines)), pa.array([0] * len(lines)), pa.array(lines)], ["file", "start", "value"])
    known = csv_split.starts([b for out in csv_split.block_quotes(iter([batch])) for b in out.to_pylist()])
    found = list(csv_split._records(known)(iter([batch])))
    assert len(found) == 1 and found[0].column(3).to_pylist() == [*lines[1:5001], '9,"y\nz"']
