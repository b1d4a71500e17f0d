"""Replies that do not fit, rounds of asking, the log that outlives a stopped job, and updates by key."""

import json
import os
import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from loanclean.operators import escalation, merging
from loanclean.operators.escalation import Asking, ask_in_rounds, read_log
from loanclean.plans import jobs
from loanclean.sources import keyed_table
from loanclean.values import ESCALATED_COLUMNS, LOAN_COLUMNS

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import tests
RECORD = "customer_id string, row_pos long, application_date string, issue_date string, advisor_notes string"


def answer(records):
    return json.dumps({"records": records})


def records(spark, n):
    return spark.createDataFrame([(f"C{i}", i, "2019-01-01", None, f"note {i}") for i in range(n)], RECORD)


def calls(folder):
    """What a resolver was asked, over all worker processes."""
    return [json.loads(p.read_text()) for p in Path(folder).iterdir()]


def noting(folder, resolver):
    def run(request):
        name = f"{os.getpid()}-{len(os.listdir(folder))}-{os.urandom(4).hex()}"
        Path(folder, name).write_text(request)
        return resolver(request)

    return run


def loans(spark):
    rows = [dict.fromkeys(LOAN_COLUMNS) | {"customer_id": f"LC{i}", "application_date": "x", "issue_date": "y", "advisor_notes": "n"} for i in range(3)]
    schema = ", ".join(f"{c} string" for c in LOAN_COLUMNS) + ", row_pos long"
    return spark.createDataFrame([tuple(r[c] for c in LOAN_COLUMNS) + (i,) for i, r in enumerate(rows)], schema)


def repeating(request):
    """Right in number, but the first record comes twice and the second not at all."""
    found = json.loads(request)
    return answer([{**found[0], "advisor_notes": "first"}, {**found[0], "advisor_notes": "again"}, *found[2:]])


def test_a_repeated_id_in_a_reply_adds_no_rows(spark):
    raw = loans(spark)
    final = jobs.clean_loans(raw, resolver=repeating).final
    assert sorted(r.customer_id for r in final.collect()) == ["LC0", "LC1", "LC2"]
    assert {r.customer_id: r.advisor_notes for r in final.collect()}["LC0"] == "first"


def test_a_second_pass_keeps_one_row_per_key(spark):
    raw = loans(spark)
    layer2 = raw.select("customer_id", *ESCALATED_COLUMNS)
    out = jobs.second_pass(layer2, raw, repeating).collect()
    assert sorted(r.customer_id for r in out) == ["LC0", "LC1", "LC2"]
    assert {r.customer_id: r.advisor_notes for r in out} == {"LC0": "first", "LC1": "n", "LC2": "n"}


def test_a_reply_with_other_ids_is_asked_again(spark, tmp_path):
    def stubborn(request):  # mixes its records up while there are several
        found = json.loads(request)
        return answer(found if len(found) == 1 else [found[-1], found[-1], *found[1:-1]])

    got = escalation.escalate(records(spark, 10), noting(tmp_path, stubborn), "row_pos", size=4, asking=Asking(rounds=3))
    assert sorted(r.customer_id for r in got.collect()) == sorted(f"C{i}" for i in range(10))
    assert sorted(len(c) for c in calls(tmp_path)) == [1] * 10 + [2] * 5 + [4, 4]
    once = escalation.escalate(records(spark, 10), stubborn, "row_pos", size=4)
    assert 0 < once.count() < 10 and once.select("customer_id").distinct().count() == once.count()


def test_unasked_ids_are_left_out(spark):
    request = json.dumps([{"customer_id": "A"}, {"customer_id": "B"}])
    reply = answer([{"customer_id": "A", "advisor_notes": "1"}, {"customer_id": "X", "advisor_notes": "2"}])
    rows = spark.createDataFrame([(0, 2, request, reply)], "batch_id long, n long, request string, reply string")
    assert [(r.customer_id, r.advisor_notes) for r in escalation.asked_records(rows).collect()] == [("A", "1")]


def test_rounds_go_over_failed_batches_only(spark, tmp_path):
    def down_twice(request):
        marks = tmp_path / "marks"
        marks.mkdir(exist_ok=True)
        ids = [r["customer_id"] for r in json.loads(request)]
        if "C5" in ids and len(list(marks.iterdir())) < 2:
            (marks / os.urandom(4).hex()).write_text("")
            raise RuntimeError("down")
        return answer(json.loads(request))

    log = str(tmp_path / "log")
    asked = tmp_path / "asked"
    asked.mkdir()
    out = escalation.escalate(records(spark, 20), noting(asked, down_twice), "row_pos", size=5, asking=Asking(log, rounds=3, attempts=1))
    assert sorted(r.customer_id for r in out.collect()) == sorted(f"C{i}" for i in range(20))
    attempts = read_log(spark, f"{log}/records").groupBy("round", "status").count().collect()
    assert {(r["round"], r["status"]): r["count"] for r in attempts} == {(0, "ok"): 3, (0, "failed"): 1, (1, "ok"): 1, (1, "failed"): 1, (2, "ok"): 2}
    assert sorted(len(c) for c in calls(asked)) == [1, 2, 2, 3, 5, 5, 5, 5]


def test_a_stopped_job_goes_on_where_it_stopped(spark, tmp_path):
    asked, log, stop = tmp_path / "asked", str(tmp_path / "log"), tmp_path / "stop"
    asked.mkdir()
    stop.write_text("")

    def run(request):
        if stop.exists() and any(r["customer_id"] == "C50" for r in json.loads(request)):
            raise SystemExit("the machine is switched off")
        Path(asked, os.urandom(6).hex()).write_text(request)
        return answer(json.loads(request))

    asking = Asking(log, concurrency=1, slice=1)
    with pytest.raises(Exception):
        escalation.escalate(records(spark, 100), run, "row_pos", size=5, asking=asking)
    half = len(calls(asked))
    assert 0 < half < 20 and read_log(spark, f"{log}/records").count() == half
    stop.unlink()
    out = escalation.escalate(records(spark, 100), run, "row_pos", size=5, asking=asking)
    assert out.count() == 100 and len(calls(asked)) == 20  # every batch once
    again = escalation.escalate(records(spark, 100).repartition(3), run, "row_pos", size=5, asking=asking)
    assert again.count() == 100 and len(calls(asked)) == 20


def test_slices_grow_with_the_round_unless_given(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(escalation, "SLICE", 2)
    monkeypatch.setattr(escalation, "MOST_SLICES", 3)

    def slices(name, n, **asking):
        log = str(tmp_path / name)
        out = escalation.escalate(records(spark, n), lambda r: answer(json.loads(r)), "row_pos", size=1, asking=Asking(log, concurrency=2, **asking))
        assert sorted(r.customer_id for r in out.collect()) == sorted(f"C{i}" for i in range(n))
        return [r["count"] for r in read_log(spark, f"{log}/records").groupBy("part").count().collect()]

    many, few, given = slices("many", 30), slices("few", 4), slices("given", 12, slice=2)
    assert len(many) <= 3 and max(many) <= 20
    assert len(few) <= 2
    assert len(given) >= 6 and max(given) <= 2


def test_halves_cover_their_batch(spark):
    items = [{"customer_id": f"c{i}", "t": 'a "quoted", [x]'} for i in range(5)]
    batches = spark.createDataFrame([(3, 5, json.dumps(items)), (4, 1, json.dumps(items[:1]))], "batch_id long, n long, request string")
    got = {r.batch_id: (r.n, json.loads(r.request)) for r in escalation.halves(batches).collect()}
    assert got == {6: (3, items[:3]), 7: (2, items[3:]), 8: (1, items[:1])}


def test_verdicts_are_kept_apart_from_records(spark, tmp_path):
    payload = spark.createDataFrame([("a", "b")], "id_a string, id_b string").selectExpr(
        "id_a", "id_b", "named_struct('customer_id', id_a) as record_a", "named_struct('customer_id', id_b) as record_b"
    )

    def judge(request):
        return json.dumps({"verdicts": [{"record_a_id": p["record_a"]["customer_id"], "record_b_id": p["record_b"]["customer_id"], "is_duplicate": True} for p in json.loads(request)]})

    out = escalation.judge_pairs(payload, judge, asking=Asking(str(tmp_path / "log")))
    assert [tuple(r) for r in out.collect()] == [("a", "b", True)]
    assert read_log(spark, str(tmp_path / "log" / "verdicts")).count() == 1 and read_log(spark, str(tmp_path / "log" / "records")).isEmpty()


def test_nothing_to_ask(spark):
    replies = ask_in_rounds(escalation.record_batches(records(spark, 1).limit(0), "row_pos"), answer, "records", escalation.RECORDS_SCHEMA, Asking(rounds=2))
    assert replies.isEmpty()


def test_tables_with_repeated_keys_are_refused(spark):
    old = spark.createDataFrame([("A", "1"), ("B", "2")], "customer_id string, u string")
    twice = spark.createDataFrame([("A", "3"), ("A", "4")], "customer_id string, u string")
    for update in (merging.replace_rows, merging.keyed_update):
        with pytest.raises(Exception, match="customer_id has several rows: A"):
            update(old, twice).collect()
    assert merging.one_per_key(old).count() == 2


def files(path):
    return {p.parent.name + "/" + p.name for p in Path(path).rglob("*.parquet")}


def test_an_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "table")
    old = spark.range(200).select(F.concat(F.lit("C"), "id").alias("customer_id"), F.col("id").cast("string").alias("u"))
    keyed_table.write_keyed(old, path, buckets=16)
    before = files(path)
    new = spark.createDataFrame([("new", "C7"), ("extra", "X1")], "u string, customer_id string")
    touched = keyed_table.upsert(spark, path, new, buckets=16)
    after = files(path)
    assert touched in (1, 2) and len({f.split("/")[0] for f in before - after}) == touched
    assert len(before & after) == len(before) - touched
    got = {r.customer_id: r.u for r in keyed_table.read_keyed(spark, path).collect()}
    assert got == {**{f"C{i}": str(i) for i in range(200)}, "C7": "new", "X1": "extra"}
    with pytest.raises(Exception, match="several rows"):
        keyed_table.upsert(spark, path, new.unionByName(new), buckets=16)
    assert files(path) == after and keyed_table.upsert(spark, path, new.limit(0), buckets=16) == 0


def test_saved_tables_are_counted_by_their_writes(spark, tmp_path, monkeypatch):
    raw = loans(spark).unionByName(loans(spark).withColumn("customer_id", F.concat("customer_id", F.lit("x"))).withColumn("row_pos", F.col("row_pos") + 10))
    done = jobs.clean_loans(raw)
    counts = {(r.stage, r.metric): r.value for r in jobs.save(done, str(tmp_path / "out")).collect()}
    assert counts["final", "rows"] == counts["layer2", "rows"] == counts["final", "null_issue_date"] == 6 and counts["pairs", "rows"] == 0
    assert spark.read.parquet(str(tmp_path / "out" / "final")).count() == 6
    with pytest.raises(Exception, match="exists"):
        jobs.save(done, str(tmp_path / "out"))
