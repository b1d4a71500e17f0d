"""Positions, batches, escalation, merging, generated data and whole jobs."""

import json

import pytest
from pyspark.sql import functions as F

from loanclean import fixture
from loanclean.operators import corrupt, escalation, linkage, merging, positions, quality
from loanclean.plans import jobs
from loanclean.sources.loans import make_loans, row_numbers
from loanclean.sources.staging import stage, staging_path
from loanclean.sources.text_csv import null_cells, read_text_csv, write_csv
from loanclean.streaming.incremental import clean_new_files
from loanclean.values import LOAN_COLUMNS

RECORD = "customer_id string, row_pos long, application_date string, issue_date string, advisor_notes string"


def records(spark, n, partitions):
    rows = [(f"C{i}", (i * 7919) % 100003 - 5000, "2019-01-01", None, f"note {i}") for i in range(n)]
    return spark.createDataFrame(rows, RECORD).repartition(partitions)


@pytest.mark.parametrize("n", [0, 1, 100, 101])
def test_batches_do_not_depend_on_partitions(spark, n, monkeypatch):
    monkeypatch.setattr(positions, "POSITION_BITS", 10)
    got = [sorted(map(tuple, escalation.record_batches(records(spark, n, p), "row_pos").collect())) for p in (1, 8)]
    assert got[0] == got[1]
    assert [b[1] for b in got[0]] == [100] * (n // 100) + ([n % 100] if n % 100 else [])
    flat = [r["customer_id"] for b in got[0] for r in json.loads(b[2])]
    want = [f"C{i}" for i in sorted(range(n), key=lambda i: (i * 7919) % 100003 - 5000)]
    assert flat == want


def test_exact_share(spark):
    df = spark.range(1000).withColumn("d", F.md5(F.col("id").cast("string")))
    for share, want in ((0.0, 0), (0.0155, 15), (0.5, 500), (1.0, 1000)):
        marked = positions.mark_exact_share(df, "d", share, "hit").where("hit")
        assert marked.count() == want
    best = [r.d for r in df.orderBy("d").limit(15).collect()]
    assert sorted(r.d for r in positions.mark_exact_share(df, "d", 0.0155, "hit").where("hit").collect()) == best


def test_resolver_attempts_and_failures(spark):
    def resolver(request):
        found = json.loads(request)
        if any(r["customer_id"] == "C5" for r in found):
            raise RuntimeError("down")
        return json.dumps({"records": found[1:] if any(r["customer_id"] == "C1" for r in found) else found})

    batches = escalation.record_batches(records(spark, 30, 3), "row_pos", size=5)
    done = escalation.resolve_batches(batches, resolver).collect()
    assert len(done) == 6
    bad = [r for r in done if r.status == "failed"]
    assert bad and all(r.attempts == 3 and r.reply is None and r.error for r in bad)
    assert all(r.attempts == 1 for r in done if r.status == "ok")
    missing = {r["customer_id"] for b in bad for r in json.loads(b.request)}
    out = escalation.escalate(records(spark, 30, 3), resolver, "row_pos", size=5)
    assert {r.customer_id for r in out.collect()} == {f"C{i}" for i in range(30)} - missing
    todo = escalation.still_to_do(records(spark, 30, 3), out)
    assert {r.customer_id for r in todo.collect()} == missing


def test_reply_checks(spark):
    def reply(*ids):
        return json.dumps({"records": [{"customer_id": i, "application_date": None} for i in ids]})

    request = json.dumps([{"customer_id": "A"}, {"customer_id": "B"}])
    rows = [(0, 2, request, reply("A", "B")), (1, 2, request, reply("A")), (2, 2, request, reply("A", "B", "C")), (3, 2, request, "{bro"),
            (4, 2, request, None), (5, 2, request, reply("A", "X"))]
    df = spark.createDataFrame(rows, "batch_id long, n long, request string, reply string")
    got = {r.batch_id: (r.status, r.ids_match) for r in escalation.check_replies(df).collect()}
    assert got == {0: ("ok", True), 1: ("incomplete", False), 2: ("incomplete", False), 3: ("broken", False), 4: ("broken", False), 5: ("ok", False)}
    assert escalation.reply_records(df).count() == 4
    verdicts = '{"verdicts":[{"record_a_id":"a","record_b_id":"b","is_duplicate":"True"},{"record_a_id":"c","record_b_id":"d","is_duplicate":"false"},{"record_a_id":"e","record_b_id":"f","is_duplicate":true}]}'
    one = spark.createDataFrame([(0, 3, verdicts)], "batch_id long, n long, reply string")
    assert {r.record_a_id: r.is_duplicate for r in escalation.reply_verdicts(one).collect()} == {"a": True, "c": False, "e": True}


def test_updates(spark):
    old = spark.createDataFrame([("A", "1", "x"), ("B", "2", None)], "customer_id string, u string, v string")
    new = spark.createDataFrame([("A", None, "y"), ("C", "9", "z")], "customer_id string, u string, v string")
    assert {tuple(r) for r in merging.keyed_update(old, new).collect()} == {("A", "1", "y"), ("B", "2", None)}
    assert {tuple(r) for r in merging.replace_rows(old, new).collect()} == {("A", None, "y"), ("B", "2", None), ("C", "9", "z")}


def test_accuracy_counts_nulls_as_wrong(spark):
    schema = "customer_id string, application_date string, issue_date string"
    got = spark.createDataFrame([("A", "2019-01-02", None), ("B", None, "2019-02-03"), ("C", "2019-05-04", "x")], schema)
    truth = spark.createDataFrame([("A", "2019-01-02", None), ("B", None, "2019-02-03"), ("C", "2019-04-05", "2019-06-06")], schema)
    assert {r.column: (r.correct, r.total) for r in quality.accuracy(got, truth).collect()} == {"application_date": (1, 3), "issue_date": (1, 3)}
    errors = quality.date_errors(got, truth)
    assert {r.customer_id for r in errors.collect()} == {"A", "B", "C"}
    assert {r.error_class: r.n for r in quality.error_class_counts(errors).collect()} == {"other": 2, "day_month_swap": 1}


def test_csv_round_trip(spark):
    rows = [("A", "", " padded  ", 'say "hi", you'), ("B", "NULL", "n/a", "x"), ("C", None, "-1", "unknown")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    path = staging_path(spark, "csv")
    write_csv(df, path)
    back = read_text_csv(spark, path, ["a", "b", "c", "d"], position="pos")
    assert {tuple(r)[:4] for r in back.collect()} == {("A", None, " padded  ", 'say "hi", you'), ("B", None, None, "x"), ("C", None, "-1", "unknown")}
    assert back.select("pos").distinct().count() == 3


def test_exact_injection(spark):
    base = corrupt.as_text(make_loans(row_numbers(spark, 1000)))
    out = corrupt.inject_missing(base, "zip_code", 0.0205, ["", "00000"], exact_in=base)
    out = corrupt.inject_grade(out, share=0.1, exact_in=base)
    log = {r.column: r["count"] for r in corrupt.dirt_log(out).groupBy("column").count().collect()}
    assert log == {"zip_code": 20, "grade": 100}


def as_sets(df):
    return {tuple(r) for r in df.collect()}


def test_generated_data_does_not_depend_on_partitions(spark):
    tables = []
    for parts in (1, 8):
        loans = make_loans(row_numbers(spark, 400).repartition(parts))
        dirty, truth, log = corrupt.make_dirty(loans)
        tables.append((as_sets(loans), as_sets(dirty), as_sets(truth), as_sets(log)))
    assert tables[0] == tables[1]


def test_generated_loans_are_consistent(spark):
    df = make_loans(row_numbers(spark, 3000))
    r = df.agg(
        F.min("loan_amnt"), F.max("loan_amnt"), F.max(F.col("loan_amnt") % 50), F.min("int_rate"), F.max("int_rate"), F.min("fico_score"),
        F.max("fico_score"), F.min("dti"), F.max("dti"), F.min(F.datediff("issue_date", "application_date")),
        F.max(F.datediff("issue_date", "application_date")), F.countDistinct("customer_id"),
    ).collect()[0]
    assert r[0] >= 1000 and r[1] <= 40000 and r[2] == 0 and r[3] >= 5.31 and r[4] <= 30.99 and r[5] >= 600 and r[6] <= 850
    assert r[7] >= 0 and r[8] <= 45 and r[9] == 1 and r[10] == 29 and r[11] == 3000
    shares = {x.grade: x["count"] / 3000 for x in df.groupBy("grade").count().collect()}
    assert abs(shares["B"] - 0.29) < 0.04 and abs(shares["G"] - 0.02) < 0.015


def test_dirt_and_cleaning_round_trip(spark):
    clean = stage(make_loans(row_numbers(spark, 3000)), "clean")
    dirty, pair_truth, log = corrupt.make_dirty(clean)
    dirty = stage(dirty, "dirty")
    copies = pair_truth.count()
    assert 20 < copies < 75 and dirty.count() == 3000 + copies
    positions_seen = dirty.agg(F.min("row_pos"), F.max("row_pos"), F.countDistinct("row_pos")).collect()[0]
    assert tuple(positions_seen) == (0, 2999 + copies, 3000 + copies)
    per_kind = {(r.column, r.dirt_type): r["count"] for r in log.groupBy("column", "dirt_type").count().collect()}
    assert abs(per_kind[("annual_inc", "missing_marker")] - 120) < 50 and abs(per_kind[("issue_date", "date_format")] - 1500) < 150

    raw = null_cells(dirty).select(*LOAN_COLUMNS, "row_pos")
    out = jobs.clean_loans(raw)
    final = out.final
    assert final.columns[-5:] == ["application_date", "issue_date", "advisor_notes", "is_duplicate", "duplicate_of"]
    assert len(final.columns) == 28
    rows = final.join(clean.select("customer_id", *[F.col(c).alias(f"t_{c}") for c in LOAN_COLUMNS[1:]]), "customer_id").collect()
    assert len(rows) == 3000
    for r in rows:
        assert r.home_ownership == r.t_home_ownership and r.purpose == r.t_purpose and r.grade == r.t_grade
        assert r.advisor_notes == r.t_advisor_notes
        assert r.phone is None or r.phone == r.t_phone
        for c in ("loan_amnt", "int_rate", "dti", "annual_inc", "fico_score"):
            assert r[c] is None or abs(r[c] - r[f"t_{c}"]) < 1e-9, c
        assert r.application_date is None or r.application_date == str(r.t_application_date)
        assert r.issue_date is None or r.issue_date == str(r.t_issue_date)
    open_dates = sum(r.application_date is None for r in rows)
    assert open_dates <= 15
    found = quality.duplicate_quality(out.link, pair_truth).collect()[0]
    assert found.recall > 0.9 and found.precision > 0.95


def test_second_passes(spark, sf_dir):
    raw = null_cells(fixture.raw_loans(spark, sf_dir))
    layer2, truth = fixture.layer2(spark, sf_dir), fixture.truth(spark, sf_dir)
    true_rows = {r.customer_id: (r.application_date, r.issue_date) for r in truth.collect()}

    def resolver(request):
        out = json.loads(request)
        for r in out:
            r["application_date"], r["issue_date"] = true_rows.get(r["customer_id"], (None, None))
        return json.dumps({"records": out})

    before = {r.column: r.correct for r in quality.accuracy(layer2, truth).collect()}
    fixed = jobs.second_pass(layer2, raw, resolver)
    assert fixed.count() == layer2.count()
    after = {r.column: r.correct for r in quality.accuracy(fixed, truth).collect()}
    assert after["application_date"] > before["application_date"] and after["issue_date"] == before["issue_date"]
    by_gap = {r.column: r.correct for r in quality.accuracy(jobs.min_gap_pass(layer2, raw), truth).collect()}
    assert by_gap["application_date"] > before["application_date"]


def test_escalation_in_the_whole_job(spark, sf_dir):
    raw = null_cells(fixture.raw_loans(spark, sf_dir)).select(*LOAN_COLUMNS, "row_pos")

    def resolver(request):
        out = json.loads(request)
        for r in out:
            r["application_date"] = "asked"
        return json.dumps({"records": out})

    def judge(request):
        return json.dumps({"verdicts": [
            {"record_a_id": p["record_a"]["customer_id"], "record_b_id": p["record_b"]["customer_id"],
             "is_duplicate": p["record_a"]["street_address"] == p["record_b"]["street_address"]} for p in json.loads(request)]})

    out = jobs.clean_loans(raw, resolver=resolver, pair_resolver=judge)
    final = out.final
    assert final.count() == raw.count()
    assert final.where("application_date = 'asked'").count() == 8  # records with no or several readings
    flags = {r.customer_id: r.duplicate_of for r in final.where("is_duplicate").collect()}
    confirmed = out.link.pairs.where("decision = 'gray' and address_score = 1").select("id_a", "id_b")
    assert flags == {r.id: r.duplicate_of for r in linkage.duplicate_flags(out.link, confirmed).collect()}


def test_incremental_cleaning_reads_each_file_once(spark, sf_dir):
    raw = fixture.raw_loans(spark, sf_dir).select(*LOAN_COLUMNS)
    source, target, check = (staging_path(spark, n) for n in ("in", "out", "check"))
    half = F.xxhash64("customer_id") % 2 == 0
    write_csv(raw.where(half), f"{source}/a")
    clean_new_files(spark, f"{source}/*", target, check).awaitTermination()
    first = spark.read.parquet(target).count()
    write_csv(raw.where(~half), f"{source}/b")
    clean_new_files(spark, f"{source}/*", target, check).awaitTermination()
    done = spark.read.parquet(target)
    assert 0 < first < done.count() == raw.count()
    assert done.select("customer_id").distinct().count() == done.count()
    assert done.where("dates_open").count() == 8


def test_every_verdict_flags_its_record(spark):
    """Profile A has the rows A1 and A2, B is alike: a verdict counts for any row and either way round."""
    rows = [("A1", 0, "Ann Lee"), ("A2", 1, "Ann Lee"), ("B", 2, "Anne Lee"), ("C", 3, "Cid Moe")]
    wide = [(i, p, n, "lee@x.org", "123-456-7890", f"{n} street", "12345") for i, p, n in rows]
    raw = spark.createDataFrame(wide, "customer_id string, row_pos long, full_name string, email string, phone string, street_address string, zip_code string")
    link = linkage.find_duplicates(raw)
    link = linkage.Linkage(link.rows, link.profiles, link.pairs.withColumn("decision", F.when(F.col("profile_a") == F.col("profile_b"), F.lit("auto_not")).otherwise(F.lit("gray"))))

    def flags(a, b):
        return {r.id: r.duplicate_of for r in linkage.duplicate_flags(link, spark.createDataFrame([(a, b)], "id_a string, id_b string")).collect()}

    assert flags("B", "A2") == {"B": "A2"} and flags("B", "A1") == {"B": "A1"}
    assert flags("A1", "B")["A1"] == "B" and flags("C", "A1") == {"C": "A1"}


def test_unknown_words_go_to_the_resolver_and_markers_go(spark):
    def resolver(request):
        return json.dumps({"records": [{**r, "advisor_notes": "ok"} for r in json.loads(request)]})

    rows = [("1", 0, "2019-01-02", "2019-01-12", "Incme stable, custmer relible"), ("2", 1, "2019-01-02", "2019-01-12", "unknown"), ("3", 2, "2019-01-02", "2019-01-12", "Incme stable")]
    raw = spark.createDataFrame(rows, "customer_id string, row_pos long, application_date string, issue_date string, advisor_notes string")
    out = jobs.second_layer(raw, resolver, vocabulary=["income", "stable"])
    assert {r.customer_id: r.advisor_notes for r in out.collect()} == {"1": "ok", "2": None, "3": "Income stable"}


def test_calls_run_side_by_side_and_replies_stay(spark, tmp_path):
    batches = spark.range(40).selectExpr("id as batch_id", "1L as n", "'[]' as request").coalesce(1)
    assert escalation.resolve_batches(batches, lambda r: '{"records":[1]}', concurrency=7).rdd.getNumPartitions() == 7
    stage(batches, "replies", str(tmp_path / "r"))
    with pytest.raises(Exception, match="exists"):
        stage(batches, "replies", str(tmp_path / "r"))


def test_new_rows_must_be_whole(spark):
    old = spark.createDataFrame([("A", "x")], "customer_id string, u string")
    with pytest.raises(ValueError, match="lack"):
        merging.replace_rows(old, old.select("customer_id"))


def test_sparse_positions(spark):
    """Positions spread over all 64 bits are numbered like dense ones."""
    df = spark.range(3000).select(F.xxhash64("id").alias("pos"))
    got = {r.pos: r.idx for r in positions.index_by_position(df, "pos").collect()}
    assert got == {p: i for i, p in enumerate(sorted(got))} and len(got) == 3000


def test_the_whole_job_joins_the_flags_only(spark, sf_dir):
    raw = null_cells(fixture.raw_loans(spark, sf_dir)).select(*LOAN_COLUMNS, "row_pos")
    out = jobs.clean_loans(raw)
    joins = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    assert joins(out.final) == joins(linkage.duplicate_flags(out.link)) + 1 and joins(out.layer2) == 0
    clean = jobs.clean_loans(raw, link_on="clean")
    assert clean.link.profiles.where("zip_code = '00000'").isEmpty()
    assert not out.link.profiles.where("zip_code = '00000'").isEmpty()
