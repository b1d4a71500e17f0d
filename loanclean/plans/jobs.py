"""The jobs: clean, link, escalate, resolve dates, merge, evaluate.

Every job takes and returns DataFrames. Results that several later steps read
are staged as tables, see ``loanclean.sources.staging``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanclean.operators import quality
from loanclean.operators.cleaning import clean_layer1, null_markers, repair_notes
from loanclean.operators.dating import date_rule_check, overlay_dates, resolve_date_pairs, rule_dates, solver_outcomes
from loanclean.operators.escalation import Asking, Resolver, append_done, escalate, judge_pairs, recheck_queue, still_to_do
from loanclean.operators.linkage import Linkage, duplicate_flags, find_duplicates, pair_payload
from loanclean.operators.merging import flag_rows, keyed_update, overlay_rows, replace_rows
from loanclean.sources.staging import stage_counted
from loanclean.values import ESCALATED_COLUMNS

KEY = "customer_id"


@dataclass
class Cleaned:
    final: DataFrame
    link: Linkage
    layer2: DataFrame


def _rules(layer1: DataFrame, vocabulary: list[str] | None) -> DataFrame:
    """Repaired notes and dates by rule beside all other columns; ``dates_open``, ``needs_review`` say what is left."""
    rows = rule_dates(repair_notes(layer1, vocabulary=vocabulary))
    return rows if vocabulary is not None else rows.withColumn("needs_review", F.lit(False))


def _answers(raw: DataFrame, rules: DataFrame, resolver: Resolver, position: str, escalate_all: bool, asking: Asking) -> DataFrame:
    """The resolver's rows for what rules left open, from the raw values."""
    asked = raw if escalate_all else raw.join(rules.where("dates_open or needs_review").select(KEY), KEY, "left_semi")
    return escalate(asked.select(KEY, position, *ESCALATED_COLUMNS), resolver, position, asking=asking)


def second_layer(
    raw: DataFrame,
    resolver: Resolver | None,
    position: str = "row_pos",
    done: DataFrame | None = None,
    escalate_all: bool = False,
    vocabulary: list[str] | None = None,
    asking: Asking = Asking(),
) -> DataFrame:
    """Dates and notes of every record.

    Rules come first: dates that have one reading and repaired notes need no
    resolver. Records with open dates go to the resolver; with a ``vocabulary``
    also those whose repaired note holds other words, or all records with
    ``escalate_all``. Without a resolver, open dates stay null. Rows in
    ``done`` are taken as they are. ``asking`` says where replies are kept and how
    failed batches are asked again.
    """
    todo = raw if done is None else still_to_do(raw, done)
    rows = _rules(null_markers(todo.select(KEY, *ESCALATED_COLUMNS)), vocabulary)
    if resolver is not None:
        rows = overlay_rows(rows, _answers(todo, rows, resolver, position, escalate_all, asking), keep_rules=True)
    rows = rows.select(KEY, *ESCALATED_COLUMNS)
    return rows if done is None else append_done(done, rows)


def clean_loans(
    raw: DataFrame,
    position: str = "row_pos",
    resolver: Resolver | None = None,
    pair_resolver: Resolver | None = None,
    layer2: DataFrame | None = None,
    verdicts: DataFrame | None = None,
    escalate_all: bool = False,
    grade: str = "token",
    vocabulary: list[str] | None = None,
    link: Linkage | None = None,
    link_on: str = "raw",
    asking: Asking = Asking(),
) -> Cleaned:
    """Raw text table to the final table.

    ``raw`` holds the loan columns as text, CSV nulls already set, and a unique
    ``position``. Earlier results can be given as ``layer2``, ``verdicts`` and
    ``link``; the resolvers are then not asked, but dates with one reading are
    still put right. ``link_on="clean"`` compares the cleaned cells instead of the
    raw ones, so a missing-value marker is no block of its own.

    Both layers' rules are one projection of ``raw``; a given or resolved second
    layer costs one join, the flags another.
    """
    rows = _rules(clean_layer1(raw, grade), vocabulary)
    if link is None:
        link = find_duplicates({"raw": raw, "clean": clean_layer1(raw, grade)}[link_on], KEY, position, staged=True)
    if layer2 is not None:
        rows = overlay_rows(rows, layer2, keep_rules=False)
        layer2 = overlay_dates(layer2, resolve_date_pairs(raw))
    else:
        if resolver is not None:
            rows = overlay_rows(rows, _answers(raw, rows, resolver, position, escalate_all, asking), keep_rules=True)
        layer2 = rows.select(KEY, *ESCALATED_COLUMNS)
    if verdicts is None and pair_resolver is not None:
        gray = link.pairs.where(F.col("decision") == "gray")
        verdicts = judge_pairs(pair_payload(gray, raw, position=position), pair_resolver, asking=asking)
    confirmed = None
    if verdicts is not None:
        confirmed = verdicts.where("is_duplicate").select(F.col("record_a_id").alias("id_a"), F.col("record_b_id").alias("id_b"))
    final = flag_rows(rows.drop(position, "dates_open", "needs_review"), duplicate_flags(link, confirmed))
    return Cleaned(final, link, layer2)


def save(done: Cleaned, folder: str) -> DataFrame:
    """Write a job's tables into ``folder`` and return their counts as (stage, metric, value).

    Each table is written once, and its counts are observed by that write.
    """
    row_pairs = lambda kind: F.coalesce(F.sum(F.when(F.col("decision") == kind, F.col("n_pairs"))), F.lit(0))
    tables = {
        "final": (done.final, {"flagged": F.count_if("is_duplicate"), "null_issue_date": F.count_if(F.col("issue_date").isNull())}),
        "layer2": (done.layer2, {f"null_{c}": F.count_if(F.col(c).isNull()) for c in quality.DATE_COLUMNS}),
        "pairs": (done.link.pairs_once(), {kind: row_pairs(kind) for kind in ("auto_dup", "gray")}),
    }
    counts = []
    for name, (df, metrics) in tables.items():
        _, seen = stage_counted(df, name, {"rows": F.count("*"), **metrics}, f"{folder.rstrip('/')}/{name}")
        counts += [(name, metric, int(value)) for metric, value in seen.items()]
    return done.final.sparkSession.createDataFrame(counts, "stage string, metric string, value long")


def second_pass(layer2: DataFrame, raw: DataFrame, resolver: Resolver, position: str = "row_pos", asking: Asking = Asking()) -> DataFrame:
    """Send the records that break the gap rule once more, from their raw values, and replace them."""
    broken = date_rule_check(layer2, strict=True)
    queue = recheck_queue(broken, raw, columns=[KEY, position, *ESCALATED_COLUMNS])
    return replace_rows(layer2, escalate(queue, resolver, position, asking=asking))


def min_gap_pass(layer2: DataFrame, raw: DataFrame) -> DataFrame:
    """Give the records that break the gap rule the fitting pair with the smallest gap."""
    broken = date_rule_check(layer2, strict=True)
    queue = recheck_queue(broken, raw)
    solved = resolve_date_pairs(queue, policy="min_gap").where(~F.col("is_ambiguous"))
    new = solved.select(KEY, F.col("solved_application_date").alias("application_date"), F.col("solved_issue_date").alias("issue_date"))
    return keyed_update(layer2, new)


@dataclass
class Evaluation:
    accuracy: DataFrame
    error_classes: DataFrame
    outcomes: DataFrame
    solver: DataFrame
    duplicates: DataFrame | None


def evaluate(
    table: DataFrame, raw: DataFrame, truth: DataFrame, link: Linkage | None = None, pair_truth: DataFrame | None = None
) -> Evaluation:
    """All quality tables of a cleaned table against the truth."""
    errors = quality.date_errors(table, truth)
    return Evaluation(
        quality.accuracy(table, truth),
        quality.error_class_counts(errors),
        solver_outcomes(raw),
        quality.solver_accuracy(resolve_date_pairs(raw), truth),
        None if link is None or pair_truth is None else quality.duplicate_quality(link, pair_truth),
    )
