"""Personal data: base patterns and bootstrapped contextual extraction.

Base: emails, IP addresses, payment cards and phone numbers by pattern, each kind
leftmost and non-overlapping; matches that fail the kind's test are dropped.

Bootstrapping finds identifiers that no base pattern has. Base entities are the seeds.
Every occurrence of a seed, and of any other token with a digit, induces lexical
patterns: the words around it. Patterns and instances make a bipartite graph, which
Spark scores in rounds: a pattern's confidence in a kind is the smoothed mean confidence
of its judged instances (those of other kinds give none), an instance's is that of its
best pattern, and seeds stay at 1. Instances not yet found are neutral, so a context may hold
any number of them; confidence falls with every hop. A pattern counts with seeds and
found instances of ``SUPPORT`` together at least.
Occurrences of unseen tokens in patterns of at least ``CONFIDENCE`` are added. A token
added so in ``TEXTS`` different texts is added wherever it stands. Base
spans always stay, and added ones never overlap them.

Null texts are empty. Repeated rows of a document are one occurrence for the scores
and get the same spans each.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from loanclean.llm.base import documents, stage

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
SUPPORT = 4.0
CONFIDENCE = 0.8
TEXTS = 2
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CLUSTER = re.compile(r"[0-9][\x20().0-9-]*")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9]*+[0-9]\S*")  # begins at words only, so a long word without digit is read once
_EDGE = " \t\n\r.,;:!?()[]{}<>\"'"
Span = tuple[int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[list[Span]]:
    """Spans of each kind, in code points, end exclusive. Takes time linear in the text."""
    out: list[list[Span]] = [[], [], [], []]
    if not text:
        return out
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at) if begin < at else None
        if m:
            out[0].append((begin, m.end()))
        done = m.end() if m else at + 1
        at = text.find("@", done)
    for c in _CLUSTER.finditer(text):
        a, b = c.span()
        if b - a < 7:
            continue
        for m in _IP.finditer(text, a, b):
            if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in m.group().split(".")):
                out[1].append(m.span())
        for m in _CARD.finditer(text, a, b):
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out[2].append(m.span())
        if a and text[a - 1] == "+" and (m := _PHONE.match(text, a - 1, b)) and 9 <= sum("0" <= x <= "9" for x in m.group()) <= 15:
            out[3].append(m.span())
    return out


def _contexts(text: str, a: int, b: int) -> list[str]:
    """Lexical patterns around a span: up to three words before, and the words on both sides.

    Words come from the 120 characters before and the 60 behind; a word that is not
    whole within them is left out.
    """
    left, right = text[max(0, a - 120) : a].lower().split(), text[b : b + 60].lower().split()
    if left and a > 120 and not text[a - 120].isspace() and not text[a - 121].isspace():
        left = left[1:]
    if right and b + 60 < len(text) and not text[b + 59].isspace() and not text[b + 60].isspace():
        right = right[:-1]
    before, after = [w.strip(_EDGE) or w for w in left], [w.strip(_EDGE) or w for w in right]
    plain = lambda w: not any("0" <= c <= "9" for c in w)
    out = []
    if len(before) > 1 and plain(before[-1]) and plain(before[-2]):
        out.append(f"{before[-2]} {before[-1]} _")
        if after and plain(after[0]):
            out.append(f"{before[-1]} _ {after[0]}")
    return out


def occurrences(text: str | None) -> list[tuple[str, str, int, int, list[str]]]:
    """(kind or '', value, start, end, patterns) of base entities and of other tokens with a digit."""
    if not text:
        return []
    base = base_spans(text)
    taken = sorted((a, b) for spans in base for a, b in spans)
    out = [(kind, text[a:b], a, b, _contexts(text, a, b)) for kind, spans in zip(KINDS, base) for a, b in spans]
    k = 0
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        while a < b and text[a] in _EDGE:
            a += 1
        while b > a and text[b - 1] in _EDGE:
            b -= 1
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if b - a >= 5 and not any(x < b and a < y for x, y in taken[k : k + 4]):
            out.append(("", text[a:b], a, b, _contexts(text, a, b)))
    return out


def _mined(docs: DataFrame) -> DataFrame:
    """Per document row: counts, base spans as text, and the occurrences with their patterns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t in batch.column(2).to_pylist():
                base = base_spans(t)
                found = [dict(zip(("kind", "value", "start", "stop", "patterns"), (o[0], hashlib.md5(o[1].encode()).hexdigest(), *o[2:]))) for o in occurrences(t)]
                rows.append([*map(len, base), spans_text([(k, a, b) for k, s in zip(KINDS, base) for a, b in s]), found])
            names = ["n_email", "n_ip", "n_card", "n_phone", "base", "found"]
            frame = pd.DataFrame(rows, columns=names)
            kinds = [pa.int64()] * 4 + [pa.string(), _FOUND]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(frame[n].tolist(), k) for n, k in zip(names, kinds)]], names=["doc_id", "digest", *names])

    schema = "doc_id long, digest long, n_email long, n_ip long, n_card long, n_phone long, base string, found array<struct<kind string, value string, start int, stop int, patterns array<string>>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"), "text").mapInArrow(run, schema)


_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("patterns", pa.list_(pa.string()))]))


def spans_text(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end, by kind as listed and then by start, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def confident_patterns(edges: DataFrame, rounds: int = ROUNDS, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(pattern, kind) to trust, from distinct edges (pattern, value, kind); kind '' marks unseen instances.

    An unseen instance takes the kind and the confidence of its best trusted pattern.
    """
    edges = stage(edges, "edges")
    seeds = edges.where("kind <> ''").select("value", "kind", F.lit(1.0).alias("conf")).distinct()
    known, trusted = seeds, None
    links = edges.select("pattern", "value").distinct()
    for _ in range(rounds):
        judged = links.join(stage(known, "known"), "value")
        sizes = judged.groupBy("pattern").agg(F.count_distinct("value").alias("n"))
        scores = judged.groupBy("pattern", "kind").agg(F.sum("conf").alias("mass")).join(sizes, "pattern")
        scores = scores.where(F.col("mass") >= support).select("pattern", "kind", (F.col("mass") / (F.col("n") + 0.5)).alias("conf"))
        trusted = stage(scores.where(F.col("conf") >= confidence), "patterns")
        best = edges.where("kind = ''").join(trusted, "pattern").drop(edges["kind"]).groupBy("value").agg(F.max_by(F.struct(trusted["kind"], "conf"), F.struct("conf", trusted["kind"])).alias("b"))
        known = seeds.unionByName(best.select("value", "b.kind", "b.conf").join(seeds.select("value"), "value", "left_anti"))
    return trusted


def extra_spans(mined: DataFrame) -> DataFrame:
    """(doc_id, digest, extra): the added spans of each document that has any, as a list of (kind, start, stop)."""
    place = ["doc_id", "digest", "start", "stop"]
    found = mined.dropDuplicates(["doc_id", "digest"]).select("doc_id", "digest", F.explode("found").alias("f")).select("doc_id", "digest", "f.*")
    rows = found.select(*place, "kind", "value", F.explode("patterns").alias("pattern"))
    trusted = confident_patterns(rows.select("pattern", "value", "kind").distinct()).withColumnRenamed("kind", "as_kind")
    best = F.max(F.struct("conf", "as_kind")).alias("best")
    local = stage(rows.where("kind = ''").join(trusted, "pattern").groupBy(*place, "value").agg(best).select(*place, "value", "best.*"), "local")
    sure = local.groupBy("value").agg(best, F.count_distinct("digest").alias("texts")).where(F.col("texts") >= TEXTS).select("value", "best.as_kind")
    spread = found.where("kind = ''").join(sure, "value").select(*place, "as_kind", F.lit(False).alias("here"))
    hits = local.select(*place, "as_kind", F.lit(True).alias("here")).unionByName(spread).groupBy(*place).agg(F.max_by("as_kind", "here").alias("kind"))
    return hits.groupBy("doc_id", "digest").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "stop"))).alias("extra"))


@F.pandas_udf(StringType())
def _joined(base: pd.Series, extra: pd.Series) -> pd.Series:
    out = []
    for b, e in zip(base, extra):
        spans = [(k, int(x), int(y)) for k, x, y in (s.split(":") for s in b.split(",") if s)]
        spans += [(s["kind"], int(s["start"]), int(s["stop"])) for s in (e if e is not None else [])]
        out.append(spans_text(spans))
    return pd.Series(out, dtype=object)


def _with_extra(left: DataFrame, extra: DataFrame) -> DataFrame:
    extra = extra.toDF("doc_id__", "digest__", "extra")
    return left.join(extra, F.col("doc_id").cast("long").eqNullSafe(F.col("doc_id__")) & (F.col("digest") == F.col("digest__")), "left")


def detect(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans."""
    mined = stage(_mined(docs), "mined")
    out = _with_extra(mined.drop("found"), extra_spans(mined))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), _joined("base", "extra").alias("spans"))


def op1_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(documents(spark, sf_dir))


def redact(text: str | None, extra: list | None) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    if not text:
        return text
    spans = [(a, b, k) for k, s in zip(KINDS, base_spans(text)) for a, b in s]
    spans += [(int(s["start"]), int(s["stop"]), s["kind"]) for s in (extra if extra is not None else [])]
    out, at = [], 0
    for a, b, kind in sorted(spans):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: personal data in texts is replaced; n_chars follows the text. No document goes."""
    mined = stage(_mined(docs), "mined")
    extra = stage(extra_spans(mined), "extra")

    @F.pandas_udf("string")
    def clean(text: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([redact(t, e) for t, e in zip(text, found)], dtype=object)

    extra = extra.toDF("doc_id__", "digest__", "extra__")
    same = docs["doc_id"].cast("long").eqNullSafe(extra["doc_id__"]) & (F.xxhash64(docs["text"]) == extra["digest__"])
    out = docs.join(extra, same, "left").withColumn("text", clean("text", "extra__"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
