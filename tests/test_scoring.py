"""Request validation (the reference API's cases), scoring, streaming, tracking."""

import json
import os
import uuid

import pytest

from tillroll.streaming import scoring as SC
from tillroll.streaming import validation as VA

CASES = [
    ('{"Recency":12,"Frequency":3,"Monetary":455.5}', None),
    ('{"Recency":8,"Frequency":2}', "Missing required field: 'Monetary'."),
    ('{"Recency":-4,"Frequency":2,"Monetary":31}', "Field 'Recency' must be non-negative."),
    ('{"Recency":"twelve","Frequency":2,"Monetary":31}', "Field 'Recency' must be numeric, got str."),
    ("", "Request body must be a JSON object."),
    ("[1, 2]", "Request body must be a JSON object."),
    ("not json", "Request body must be a JSON object."),
    ('{"Recency":true,"Frequency":5,"Monetary":100}', "Field 'Recency' must be numeric, got bool."),
    ('{"Recency":null,"Frequency":5,"Monetary":100}', "Field 'Recency' must be numeric, got NoneType."),
    ('{"Recency":1,"Frequency":[1],"Monetary":100}', "Field 'Frequency' must be numeric, got list."),
    ('{}', "Missing required field: 'Recency'."),
]


def test_validate_rfm_messages(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "id int, value string")
    got = {r["id"]: r["error"] for r in VA.validate_rfm(df).collect()}
    assert [got[i] for i in range(len(CASES))] == [e for _, e in CASES]


def test_validate_classifier_int_fields(spark):
    base = {"Recency": 1, "Frequency": 2.5, "Monetary": 3, "AvgBasketValue": 1.0, "AvgBasketSize": 2,
            "Volatility": 0, "FavoriteDay_Encoded": 3, "Country_Encoded": 4}
    bad_float = dict(base, FavoriteDay_Encoded=3.0)
    neg = dict(base, Recency=-5)
    text = [json.dumps(base), json.dumps(bad_float).replace("3.0", "3.0"), json.dumps(neg)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "id int, value string")
    got = {r["id"]: r["error"] for r in VA.validate_classifier(df).collect()}
    assert got[0] is None and got[2] is None
    assert got[1] == "Field 'FavoriteDay_Encoded' must be numeric, got float."


def _scorer():
    return SC.RfmScorer([10.0, 1.0, 5.0], [5.0, 0.5, 2.0], [(0, [-1.0, 1.0, 1.0]), (1, [1.0, -1.0, -1.0]),
                                                             (7, [5.0, 5.0, 5.0])], log_inputs=False)


def test_score_rfm_segments_and_default(spark):
    reqs = ['{"Recency":5,"Frequency":1.5,"Monetary":7}', '{"Recency":15,"Frequency":0.5,"Monetary":3}',
            '{"Recency":40,"Frequency":4,"Monetary":16}', '{"Recency":-1,"Frequency":1,"Monetary":1}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(reqs)], "id int, value string")
    out = {r["id"]: r for r in SC.score_rfm_requests(df, _scorer()).collect()}
    assert (out[0]["cluster"], out[0]["segment"]) == (0, "Champions")
    assert (out[1]["cluster"], out[1]["segment"]) == (1, "Potential Loyalists")
    assert (out[2]["cluster"], out[2]["segment"]) == (7, "Cluster_7")
    assert out[3]["valid"] is False and json.loads(out[3]["response"])["error"].endswith("non-negative.")
    assert json.loads(out[0]["response"])["probabilities"] is None


def test_stream_equals_batch(spark, tmp_path):
    base = str(tmp_path / uuid.uuid4().hex)
    os.makedirs(f"{base}/in")
    reqs = ['{"Recency":5,"Frequency":1.5,"Monetary":7}', '{"Recency":15,"Frequency":0.5,"Monetary":3}', "[]"]
    with open(f"{base}/in/part-0.txt", "w") as fh:
        fh.write("\n".join(reqs) + "\n")
    q = SC.start_rfm_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ck", _scorer())
    q.awaitTermination()
    out = sorted((r["value"], r["cluster"]) for r in spark.read.parquet(f"{base}/out").collect())
    batch = spark.createDataFrame([(t,) for t in reqs], "value string")
    ref = sorted((r["value"], r["cluster"]) for r in SC.score_rfm_requests(batch, _scorer()).collect())
    assert out == ref


def test_tracking_latest_run(spark, tmp_path):
    import datetime as dt
    from tillroll.sources import tracking as TR
    path = str(tmp_path / "runs")
    m = spark.createDataFrame([(0.5, 3.0)], "silhouette double, inertia double")
    TR.log_run(spark, path, "cluster", "clustering", {"model_path": "/old"}, m, start_time=dt.datetime(2024, 1, 1))
    TR.log_run(spark, path, "cluster", "clustering", {"model_path": "/new"}, {"silhouette": 0.7},
               start_time=dt.datetime(2024, 2, 1))
    assert TR.latest_param(spark, path, "cluster", "model_path") == "/new"
    assert TR.latest_param(spark, path, "missing", "model_path", "/fallback") == "/fallback"
    last = {r["key"]: r["value_num"] for r in TR.latest_run(spark, path, "cluster").where("kind = 'metric'").collect()}
    assert last == {"silhouette": 0.7}


def test_rfm_bundle_round_trip(spark, tmp_path):
    from tillroll.sources import tracking as TR
    params = spark.createDataFrame([("Recency", 10.0, 5.0), ("Frequency", 1.0, 0.5), ("Monetary", 5.0, 2.0)],
                                   "feature string, mean double, scale double")
    path = str(tmp_path / "bundle")
    TR.save_rfm_bundle(spark, path, params, [(0, [0.0, 0.0, 0.0]), (1, [1.0, 1.0, 1.0])], {0: "Lost", 1: "Champions"})
    scorer = TR.load_rfm_bundle(spark, path)
    assert scorer.means == [10.0, 1.0, 5.0] and scorer.segments == {0: "Lost", 1: "Champions"}


HEADERS = {"old": "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country",
           "new": "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country"}


def write_csv(tmp_path, header, *lines, encoding="latin-1"):
    p = tmp_path / "retail.csv"
    p.write_text("\n".join([header, *lines]) + "\n", encoding=encoding)
    return str(p)


@pytest.mark.parametrize("spelling", list(HEADERS))
def test_csv_scan_aliases_and_nulls(spark, tmp_path, spelling):
    from tillroll.sources.retail_csv import MissingInputError, read_transactions_csv
    path = write_csv(tmp_path, HEADERS[spelling], "536365,85123A,CAFÉ SIGN,6,12/1/2010 8:26,2.55,17850.0,France",
                     "536366,22633,NA,6.0,12/1/2010 8:28,1.85,,United Kingdom")
    rows = read_transactions_csv(spark, path).orderBy("Invoice").collect()
    assert rows[0].asDict().keys() == {n for n in HEADERS["new"].split(",")}
    assert rows[0]["Customer ID"] == 17850.0 and rows[1]["Description"] is None and rows[1]["Customer ID"] is None
    assert rows[0]["Description"] == "CAFÉ SIGN" and rows[1]["Quantity"] == 6
    assert rows[0]["InvoiceDate"].month == 12 and rows[0]["InvoiceDate"].hour == 8
    with pytest.raises(MissingInputError):
        read_transactions_csv(spark, str(tmp_path / "absent.csv"))


def test_csv_columns_go_by_name(spark, tmp_path):
    from tillroll.sources.retail_csv import read_transactions_csv
    path = write_csv(tmp_path, "Invoice,Description,StockCode,Price,Quantity,InvoiceDate,Country,Customer ID",
                     "1,MUG,85123A,2.5,6,2010-12-01 08:26:00,France,17")
    row, = read_transactions_csv(spark, path).collect()
    assert (row["StockCode"], row["Description"], row["Price"], row["Quantity"]) == ("85123A", "MUG", 2.5, 6)
    short = write_csv(tmp_path, "Invoice,StockCode", "1,2")
    with pytest.raises(ValueError, match="Country"):
        read_transactions_csv(spark, short)


def test_csv_bad_values_are_counted(spark, tmp_path):
    from tillroll.sources.retail_csv import csv_problems, read_transactions_csv, scan_text
    path = write_csv(tmp_path, HEADERS["new"], "1,A,X,abc,12/1/2010 8:26,2.5,x17,France", "2,A,X,1,12/2/2010 8:26,9,18,France",
                     "3,A,X,1,12/3/2010 8:26")
    row = csv_problems(scan_text(spark, path), "M/d/yyyy H:mm").first()
    assert (row["lines"], row["corrupt_lines"], row["bad_Quantity"], row["bad_Customer_ID"], row["bad_Price"]) == (3, 1, 1, 1, 0)
    with pytest.raises(ValueError, match="bad_Quantity"):
        read_transactions_csv(spark, path)
    got = read_transactions_csv(spark, path, allow_bad=True).orderBy("Invoice").collect()
    assert [r["Quantity"] for r in got] == [None, 1, 1]


def test_csv_one_date_format_for_the_column(spark, tmp_path):
    from tillroll.sources.retail_csv import read_transactions_csv
    line = "{0},A,X,1,{1},2.5,17,France".format
    day_first = write_csv(tmp_path, HEADERS["new"], line(1, "12/1/2010 8:26"), line(2, "13/1/2010 8:26"))
    assert {r["InvoiceDate"].month for r in read_transactions_csv(spark, day_first).collect()} == {1}
    mixed = write_csv(tmp_path, HEADERS["new"], line(1, "1/13/2010 8:26"), line(2, "13/1/2010 8:26"))
    with pytest.raises(ValueError, match="no timestamp format"):
        read_transactions_csv(spark, mixed)


def test_every_request_gets_a_row_and_one_scan(spark, tmp_path):
    texts = [t for t, _ in CASES]
    path = str(tmp_path / "req")
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, value string").write.parquet(path)
    out = SC.score_rfm_requests(spark.read.parquet(path), _scorer())
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    rows = {r["id"]: r for r in out.collect()}
    for i, (_, error) in enumerate(CASES):
        assert rows[i]["error"] == error and rows[i]["valid"] is (error is None)
        assert json.loads(rows[i]["response"]).get("error") == error


def test_latest_run_is_one_run_and_errors_are_not_absence(spark, tmp_path):
    import datetime as dt
    from tillroll.sources import tracking as TR
    path = str(tmp_path / "runs")
    assert TR.latest_param(spark, path, "c", "p", "fallback") == "fallback"
    ids = [TR.log_run(spark, path, "c", "c", {"p": str(i)}, start_time=dt.datetime(2024, 1, 1)) for i in range(3)]
    assert {r["run_id"] for r in TR.latest_run(spark, path, "c").collect()} == {min(ids)}
    with pytest.raises(FileNotFoundError):
        TR.load_latest_model(spark, path, "c")
    TR.log_run(spark, path, "c", "c", {"model_path": str(tmp_path / "no-model")})
    with pytest.raises(Exception, match="no-model"):
        TR.load_latest_model(spark, path, "c")
