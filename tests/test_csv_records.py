"""Records with line breaks in quoted fields, at any split of the file, against the csv module."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tillroll.sources import csv_records as CR
from tillroll.sources.retail_csv import csv_problems, read_transactions_csv, scan_text


def written(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


def random_rows(seed, n=60):
    rng = random.Random(seed)
    parts = ["a", "b c", '"', '""', ",", "\n", "\r\n", "\n\n", "é", "x" * 20]
    return [[str(i), "".join(rng.choices(parts, k=rng.randrange(6))), "".join(rng.choices(parts, k=rng.randrange(3)))] for i in range(n)]


def records(spark, path, encoding="UTF-8", **kw):
    return CR.read_records(spark, path, encoding, **kw).collect()


@pytest.mark.parametrize("split", [7, 40, 1_000_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_at_any_split(spark, tmp_path, split, end):
    rows = [["id", "text", "more"], *random_rows(split), ["900", "long\n" * 60, ""], ["901", "z", "last"]]
    (tmp_path / "f.csv").write_text(written(rows, end), newline="")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        for few in (CR.BROADCAST_SPLITS, 0):
            got = records(spark, str(tmp_path), broadcast_splits=few)
            assert all(r["closed"] for r in got) and sum(r["first"] for r in got) == 1
            parsed = [next(csv.reader(io.StringIO(r["value"], newline=""))) for r in got]
            assert sorted(parsed) == sorted(rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_state_of_a_line():
    for line, outside, within in [(b"", False, True), (b"a,b", False, True), (b'"a', True, False), (b'a"b,c', False, False), (b'"a""', True, False),
                                  (b'x,"a,b",c', False, False), (b'"",""', False, True), (b'a""', False, True), (b'",x,"', False, True)]:
        assert (CR.ends_within(line, False), CR.ends_within(line, True)) == (outside, within), line


def test_unclosed_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h\n\n"x\ny"\n"open\n\nrest')
    (tmp_path / "b.csv").write_text("")
    got = sorted((r["value"], r["first"], r["closed"]) for r in records(spark, str(tmp_path)))
    assert got == [('"open\n\nrest', False, False), ('"x\ny"', False, True), ("h", True, True)]


HEADER = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]


def test_transactions_with_line_breaks(spark, tmp_path):
    rows = [["1", "s", 'a "mug",\r\nred', "2", "12/1/2010 8:26", "2.5", "17850.0", "Norway"], ["2", "t", "plain é", "1", "1/2/2011 9:00", "1", "", "UK"]]
    (tmp_path / "f.csv").write_bytes(written([HEADER, *rows]).encode("latin-1"))
    assert CR.has_broken_fields(spark, str(tmp_path))
    got = {r["Invoice"]: r for r in read_transactions_csv(spark, str(tmp_path)).collect()}
    assert got["1"]["Description"] == 'a "mug",\r\nred' and got["1"]["Quantity"] == 2 and got["1"]["Country"] == "Norway"
    assert got["2"]["Description"] == "plain é" and got["2"]["Customer ID"] is None
    (tmp_path / "g.csv").write_text(written([HEADER]) + "3,u,x,1\n4,v,\"never closed,1,1/2/2011 9:00,1,,UK\n5,w,y\n")
    text = scan_text(spark, str(tmp_path))
    assert csv_problems(text, "M/d/yyyy H:mm").first()["corrupt_lines"] == 2 and text.count() == 4


def test_files_without_breaks_keep_the_plain_scan(spark, tmp_path):
    (tmp_path / "f.csv").write_text(written([HEADER, ["1", "s", 'a "b", c', "2", "12/1/2010 8:26", "2.5", "", "UK"]], "\r\n"), newline="")
    assert not CR.has_broken_fields(spark, str(tmp_path))
    assert read_transactions_csv(spark, str(tmp_path)).first()["Description"] == 'a "b", c'


@pytest.mark.parametrize("breaks", [False, True])
def test_a_file_is_parsed_once(spark, tmp_path, breaks):
    from tillroll.sources.retail_csv import read_transactions_csv
    path = tmp_path / "t.csv"
    text = '"one, ""two""\r\nthree"' if breaks else "one"
    path.write_bytes(("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
                      + "".join(f"{i},s{i},{text},{i},{i % 12 + 1}/{i % 28 + 1}/2010 8:05,1.5,17850.0,UK\n" for i in range(1, 60))).encode())
    df = read_transactions_csv(spark, str(path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in plan.lower() and "MapInArrow" not in plan and "FileScan csv" not in plan
    rows = df.orderBy("Quantity").collect()
    assert len(rows) == 59 and rows[0]["InvoiceDate"].month == 2
    assert {r["Description"] for r in rows} == {'one, "two"\r\nthree' if breaks else "one"}


def test_formats_are_tried_on_their_separators_alone(spark):
    from tillroll.functions.columns import TIMESTAMP_FORMATS, _format_signs, parse_timestamp, timestamp_format
    texts = ["2010-12-01 08:26:00", "2010-12-01 08:26", "2010-12-01T08:26:00", "2010-12-01t08:26:00", "12/1/2010 8:26", "12/1/2010 8:26:01",
             "31/12/2010 8:26", "2010-12-01", "12/31/2010", " 2010-12-01", "2010-12-01 ", "+2010-12-01", "-5/1/2010", "x", "", "1/2", None]
    for text in texts:
        df = spark.createDataFrame([(text,)], "d string")
        fits = df.select(*[(F.col("d").isNull() | parse_timestamp("d", f).isNotNull()).alias(str(i)) for i, f in enumerate(TIMESTAMP_FORMATS)]).first()
        plain = [f for i, f in enumerate(TIMESTAMP_FORMATS) if fits[i]]
        if plain:
            assert timestamp_format(df, "d") == plain[0]
        else:
            with pytest.raises(ValueError, match="no timestamp format"):
                timestamp_format(df, "d")
    assert _format_signs("yyyy-MM-dd HH:mm") == " :" and _format_signs("d MMM yyyy") is None
    month = spark.createDataFrame([("1 Dec 2010",)], "d string")
    assert timestamp_format(month, "d", ["yyyy-MM-dd", "d MMM yyyy"]) == "d MMM yyyy"
