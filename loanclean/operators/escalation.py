"""Escalation: rows that rules cannot settle go, in batches, to a resolver.

The resolver is a plain function of the caller: request text in, reply text
out. What it does (a service, a person, a rule) is not known here. Requests and
replies are JSON.

Calls cost money and time, so no batch is asked twice without need. Batches are asked in
slices: a Structured Streaming query takes them one by one (``foreachBatch``) and writes
each slice's replies to a log before the next one begins. The log knows a batch by its
content: a job that was stopped, or one that numbers its batches anew, asks only for
what the log lacks. A batch without a fitting reply is asked again in the next round, as
two halves if it has several items, so a resolver that cannot manage a long request gets
a shorter one. The log keeps the attempts of every round.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce
from math import ceil

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanclean.operators.positions import assign_batches, index_by_digest
from loanclean.sources.staging import stage, staging_path
from loanclean.values import BATCH_SIZE, CONCURRENCY, ESCALATED_COLUMNS, MAX_ATTEMPTS

Resolver = Callable[[str], str]

SLICE = 1000  # batches that are asked before their replies are written, if the caller says nothing
MOST_SLICES = 32  # of a round; a stopped job loses the replies of one slice

RECORDS_SCHEMA = (
    "records array<struct<customer_id:string, application_date:string, issue_date:string, advisor_notes:string>>"
)
VERDICTS_SCHEMA = "verdicts array<struct<record_a_id:string, record_b_id:string, is_duplicate:string>>"
LOG_SCHEMA = (
    "digest string, round int, batch_id bigint, n bigint, request string, reply string, status string, attempts int, error string, "
    "fits boolean, part string"
)
RESULT_SCHEMA = "batch_id bigint, n bigint, request string, reply string, status string, attempts int, error string"


def _requests(numbered: DataFrame, size: int, record) -> DataFrame:
    """One JSON array per batch, elements in index order. A batch has at most ``size`` rows."""
    batch = F.floor(F.col("idx") / size).alias("batch_id")
    rows = F.array_sort(F.collect_list(F.struct("idx", record.alias("record"))))
    request = F.to_json(F.transform(rows, lambda r: r["record"]), {"ignoreNullFields": "false"})
    return numbered.groupBy(batch).agg(F.count("*").alias("n"), request.alias("request"))


def record_batches(
    df: DataFrame, position: str, columns: list[str] | None = None, size: int = BATCH_SIZE, key: str = "customer_id"
) -> DataFrame:
    """Requests of ``size`` records each, in row order: batch_id, n, request."""
    columns = columns or [key, *ESCALATED_COLUMNS]
    numbered = assign_batches(df.select(position, *columns), position, size)
    return _requests(numbered, size, F.struct(*columns))


def pair_batches(payload: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Requests of ``size`` record pairs each, from the payload of the gray pairs."""
    named = payload.withColumn("_digest", F.md5(F.concat_ws("|", "id_a", "id_b")))
    return _requests(index_by_digest(named, "_digest"), size, F.struct("record_a", "record_b"))


def resolve_batches(
    batches: DataFrame, resolver: Resolver, field: str = "records", max_attempts: int = MAX_ATTEMPTS, concurrency: int = CONCURRENCY
) -> DataFrame:
    """Call the resolver for every batch, up to ``max_attempts`` times.

    A reply counts when it is JSON and its ``field`` lists as many items as the
    request. A batch that never gets one ends with status ``failed``. At most
    ``concurrency`` calls run at a time, one per partition. A lost task calls again
    for its batches, so write the result before reading it more than once.
    """

    def attempt(request: str, n: int) -> tuple[str | None, str, int, str | None]:
        error = None
        for i in range(1, max_attempts + 1):
            try:
                reply = resolver(request)
                got = len(json.loads(reply)[field])
                if got != n:
                    raise ValueError(f"expected {n} items, got {got}")
                return reply, "ok", i, None
            except Exception as problem:  # the resolver is foreign code
                error = f"{type(problem).__name__}: {problem}"
        return None, "failed", max_attempts, error

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            done = [attempt(r, n) for r, n in zip(part["request"], part["n"])]
            out = pd.DataFrame(done, columns=["reply", "status", "attempts", "error"], index=part.index)
            yield pd.concat([part[["batch_id", "n", "request"]], out], axis=1)

    return batches.select("batch_id", "n", "request").repartition(concurrency, "batch_id").mapInPandas(run, RESULT_SCHEMA)


def check_replies(replies: DataFrame, schema: str = RECORDS_SCHEMA) -> DataFrame:
    """Parse the replies and say which are broken or of the wrong size.

    ``ids_match`` also compares the ids where the request carries them; it does
    not change the status, which depends on the count alone.
    """
    field = schema.split(" ", 1)[0]
    items = F.from_json("reply", schema, {"mode": "PERMISSIVE"})[field]
    checked = replies.withColumn("items", items)
    got = F.size("items")
    status = F.when(F.col("items").isNull(), "broken").when(got != F.col("n"), "incomplete").otherwise("ok")
    checked = checked.withColumns({"got": got, "status": status})
    if field != "records" or "request" not in replies.columns:
        return checked
    asked = F.from_json("request", "array<struct<customer_id:string>>")
    ids = F.transform(asked, lambda r: r["customer_id"])
    back = F.transform(F.col("items"), lambda r: r["customer_id"])
    return checked.withColumn("ids_match", F.coalesce(F.array_sort(ids) == F.array_sort(back), F.lit(False)))


def reply_records(replies: DataFrame) -> DataFrame:
    """Rows of all complete record replies."""
    return check_replies(replies).where(F.col("status") == "ok").select(F.inline("items"))


def asked_records(replies: DataFrame) -> DataFrame:
    """One row per asked id of the complete record replies.

    Of several rows of one id the first counts. Ids that the request does not hold
    are left out, so a reply never adds rows to the table it is joined with.
    """
    whole = check_replies(replies).where(F.col("status") == "ok")
    asked = F.transform(F.from_json("request", "array<struct<customer_id:string>>"), lambda r: r["customer_id"])
    rows = whole.select(asked.alias("asked"), "items", F.transform("items", lambda r: r["customer_id"]).alias("ids"))
    first = F.filter("items", lambda r, i: F.array_contains(F.col("asked"), r["customer_id"]) & (F.array_position(F.col("ids"), r["customer_id"]) == i + 1))
    return rows.select(F.inline(first))


def reply_verdicts(replies: DataFrame) -> DataFrame:
    """Rows of all complete verdict replies; the flag may come as JSON boolean or as text."""
    rows = check_replies(replies, VERDICTS_SCHEMA).where(F.col("status") == "ok").select(F.inline("items"))
    return rows.withColumn("is_duplicate", F.coalesce(F.lower("is_duplicate") == "true", F.lit(False)))


def incomplete_batches(replies: DataFrame) -> DataFrame:
    """Batches to try again: no reply, broken JSON or a wrong number of records."""
    return check_replies(replies).where(F.col("status") != "ok").drop("items")


def still_to_do(df: DataFrame, done: DataFrame, key: str = "customer_id") -> DataFrame:
    """Rows whose key is not done yet."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def append_done(done: DataFrame, new: DataFrame) -> DataFrame:
    return done.unionByName(new, allowMissingColumns=True)


@dataclass(frozen=True)
class Asking:
    """How a job asks its resolver.

    ``path`` is the folder of the log; without one the log lies in the shared folder under
    a new name. ``rounds`` is how often failed batches are asked anew, each time up to
    ``attempts`` times, ``concurrency`` calls run side by side, and ``slice`` batches are
    asked before their replies are written. Without ``slice`` these are ``SLICE`` batches, or
    more in a round of over ``SLICE * MOST_SLICES``, as each slice costs a job of its own.
    """

    path: str | None = None
    rounds: int = 1
    attempts: int = MAX_ATTEMPTS
    concurrency: int = CONCURRENCY
    slice: int | None = None

    def under(self, name: str) -> Asking:
        """The same with a log of its own for another kind of request."""
        return self if self.path is None else replace(self, path=f"{self.path.rstrip('/')}/{name}")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All attempts so far; empty where there is no log yet."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def halves(batches: DataFrame) -> DataFrame:
    """Each batch of several items as two; the items of the first half are as many or one more."""
    items = F.from_json("request", "array<string>")
    first = F.ceil(F.col("n") / 2).cast("int")
    text = lambda part: F.concat(F.lit("["), F.array_join(part, ","), F.lit("]"))
    parts = F.array(
        F.struct((F.col("batch_id") * 2).alias("batch_id"), first.cast("bigint").alias("n"), text(F.slice("_items", F.lit(1), first)).alias("request")),
        F.struct((F.col("batch_id") * 2 + 1).alias("batch_id"), (F.col("n") - first).alias("n"), text(F.slice("_items", first + 1, F.greatest(F.size("_items") - first, F.lit(0)))).alias("request")),
    )
    return batches.withColumn("_items", items).select(F.explode(parts).alias("p")).select("p.*").where("n > 0")


def _digest(batches: DataFrame) -> DataFrame:
    return batches.select("batch_id", "n", "request", F.sha2("request", 256).alias("digest"))


def _ask(todo: DataFrame, resolver: Resolver, field: str, asking: Asking, path: str, number: int, schema: str) -> None:
    """Ask for all of ``todo`` slice by slice; a slice's replies are in the log when the next one begins."""
    spark = todo.sparkSession
    n = todo.count()
    size = asking.slice or max(SLICE, ceil(n / MOST_SLICES))
    files, most = max(1, ceil(n / size)), asking.slice or 2 * size  # ranges come from a sample, so they differ a little
    source, marker = staging_path(spark, "batches"), staging_path(spark, "slices")
    todo.repartitionByRange(files, "batch_id", "digest").write.option("maxRecordsPerFile", most).parquet(source)
    run = marker.rsplit("-", 1)[-1]

    def answer(part: DataFrame, number_of_slice: int) -> None:
        replies = resolve_batches(part, resolver, field, asking.attempts, asking.concurrency)
        checked = check_replies(replies, schema)
        fits = (F.col("status") == "ok") & (F.col("ids_match") if "ids_match" in checked.columns else F.lit(True))
        out = checked.select(
            F.sha2("request", 256).alias("digest"), F.lit(number).alias("round"), "batch_id", "n", "request", "reply",
            F.when(F.col("reply").isNull(), "failed").otherwise("ok").alias("status"), "attempts", "error", fits.alias("fits"),
        )
        out.write.mode("overwrite").parquet(f"{path}/part={run}-{number_of_slice}")

    # a slice is a file; a stopped run leaves whole slices in the log
    stream = spark.readStream.schema(todo.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = stream.writeStream.foreachBatch(answer).option("checkpointLocation", marker).trigger(availableNow=True).start()
    query.awaitTermination()


def ask_in_rounds(batches: DataFrame, resolver: Resolver, field: str, schema: str, asking: Asking = Asking()) -> DataFrame:
    """Replies (batch_id, n, request, reply, status, attempts, error, fits) that cover the batches so far as any came.

    Batches the log has a fitting reply for are not asked. What does not fit is asked
    again in the next round, in halves. After the last round a reply of the right size
    counts even if its ids are not those of the request.
    """
    spark = batches.sparkSession
    path = asking.path or staging_path(spark, field)
    todo = stage(_digest(batches), f"{field}-asked")
    done = []
    for number in range(max(1, asking.rounds)):
        log = read_log(spark, path)
        known = log.where("fits").dropDuplicates(["digest"])
        open_ = todo.join(known.select("digest"), "digest", "left_anti")
        if not open_.isEmpty():
            _ask(open_.dropDuplicates(["digest"]).select("batch_id", "n", "request", "digest"), resolver, field, asking, path, number, schema)
            log = read_log(spark, path)
        last = log.groupBy("digest").agg(F.max_by(F.struct("reply", "status", "attempts", "error", "fits"), F.struct("fits", F.col("reply").isNotNull(), "round", "part")).alias("r"))
        answered = stage(todo.join(last, "digest").select("batch_id", "n", "request", "digest", "r.*"), f"{field}-answered")
        final = number + 1 >= max(1, asking.rounds)
        done.append(answered if final else answered.where("fits"))
        failed = answered.where("not fits")
        if final or failed.isEmpty():
            break
        single = failed.where("n = 1").select("batch_id", "n", "request")
        todo = stage(_digest(halves(failed.where("n > 1").select("batch_id", "n", "request")).unionByName(single)), f"{field}-asked")
    return reduce(DataFrame.unionByName, done).drop("digest")


def escalate(
    df: DataFrame,
    resolver: Resolver,
    position: str,
    done: DataFrame | None = None,
    size: int = BATCH_SIZE,
    asking: Asking = Asking(),
) -> DataFrame:
    """Resolve the rows that are not done yet and return done and new rows together.

    Replies are in the log first, so nothing that follows calls the resolver again.
    """
    todo = df if done is None else still_to_do(df, done)
    replies = ask_in_rounds(record_batches(todo, position, size=size), resolver, "records", RECORDS_SCHEMA, asking.under("records"))
    new = asked_records(replies)
    return new if done is None else append_done(done, new)


def judge_pairs(payload: DataFrame, resolver: Resolver, size: int = BATCH_SIZE, asking: Asking = Asking()) -> DataFrame:
    """Verdicts of the resolver on the gray pairs."""
    replies = ask_in_rounds(pair_batches(payload, size), resolver, "verdicts", VERDICTS_SCHEMA, asking.under("verdicts"))
    return reply_verdicts(replies)


def recheck_queue(broken: DataFrame, raw: DataFrame, key: str = "customer_id", columns: list[str] | None = None) -> DataFrame:
    """Raw values of the rows that failed a check, for a second attempt from scratch."""
    return raw.join(broken.select(key).distinct(), key, "left_semi").select(*(columns or [key, *ESCALATED_COLUMNS]))
