"""The request stream: a run that is killed and started again equals one pass."""

import json

import pytest
from pyspark.sql import functions as F

from tillroll.streaming import request_stream as RS


def score(lines):
    """A stand-in model: numbers are accepted, and doubled."""
    number = F.expr("try_cast(value AS double)")
    error = F.when(number.isNull(), F.concat(F.lit("not a number: "), F.coalesce("value", F.lit("null"))))
    response = F.when(error.isNull(), F.to_json(F.struct((number * 2).alias("twice")))).otherwise(F.to_json(F.struct(error.alias("error"))))
    return lines.select("*", error.isNull().alias("valid"), error.alias("error"), (number * 2).alias("twice"), response.alias("response"))


def write_files(base, n=6):
    (base / "in").mkdir(parents=True)
    for i in range(n):
        (base / "in" / f"f{i}.txt").write_text("\n".join([str(10 * i), f"bad{i}", "", str(10 * i + 1), str(10 * i)]) + "\n")


def start(spark, base):
    return RS.start_request_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ck", score, files_a_batch=2)


def result(spark, base):
    accepted, rejected, responses, commits = (RS.read_committed(spark, f"{base}/out", t) for t in RS.TABLES)
    return (sorted(r["twice"] for r in accepted.collect()), sorted((r["value"], r["error"]) for r in rejected.collect()),
            sorted(r["value"] for r in responses.collect()), sorted((r["batch"], r["requests"], r["accepted"]) for r in commits.collect()))


def expected(n=6):
    good = sorted(2.0 * x for i in range(n) for x in (10 * i, 10 * i + 1, 10 * i))
    bad = sorted((x, f"not a number: {x}") for i in range(n) for x in (f"bad{i}", ""))
    answers = sorted([json.dumps({"twice": x}, separators=(",", ":")) for x in good] + [json.dumps({"error": e}, separators=(",", ":")) for _, e in bad])
    return good, bad, answers, [(b, 10, 6) for b in range(n // 2)]


def test_one_pass(spark, tmp_path):
    write_files(tmp_path)
    start(spark, tmp_path).awaitTermination()
    assert result(spark, tmp_path) == expected()


@pytest.mark.parametrize("step", ["commit", "responses"])
def test_killed_and_restarted_equals_one_pass(spark, tmp_path, monkeypatch, step):
    write_files(tmp_path)
    real_commit, real_write = RS._write_commit, RS.write_batch

    def dies_before_the_commit(rows, out, batch):
        if batch == 1:
            raise RuntimeError("killed")
        real_commit(rows, out, batch)

    def dies_midway(lines, batch, out, score):
        if batch == 1:  # half of the batch's rows stand where its output goes, as of a task that was lost
            score(lines).where("valid").limit(2).write.mode("overwrite").parquet(f"{out}/accepted/batch=1")
            raise RuntimeError("killed")
        real_write(lines, batch, out, score)

    with monkeypatch.context() as m:
        if step == "commit":
            m.setattr(RS, "_write_commit", dies_before_the_commit)
        else:
            m.setattr(RS, "write_batch", dies_midway)
        with pytest.raises(Exception, match="killed"):
            start(spark, tmp_path).awaitTermination()
    assert {r["batch"] for r in RS.read_committed(spark, f"{tmp_path}/out", "accepted").select("batch").collect()} == {0}
    start(spark, tmp_path).awaitTermination()
    assert result(spark, tmp_path) == expected()
    start(spark, tmp_path).awaitTermination()  # nothing new: nothing changes
    assert result(spark, tmp_path) == expected()


def test_files_that_come_later_and_an_unknown_table(spark, tmp_path):
    write_files(tmp_path, 2)
    start(spark, tmp_path).awaitTermination()
    (tmp_path / "in" / "late.txt").write_text("7\n")
    start(spark, tmp_path).awaitTermination()
    assert 14.0 in result(spark, tmp_path)[0] and len(result(spark, tmp_path)[3]) == 2
    with pytest.raises(ValueError, match="none of"):
        RS.read_committed(spark, str(tmp_path), "all")
