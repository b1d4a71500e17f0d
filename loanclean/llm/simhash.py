"""SimHash near duplicates with pigeonring filtering.

Fingerprints of 64 bits link at 3 or fewer differing bits. They are read as a ring
of four 16-bit segments. If two fingerprints link, some segment starts a chain in
which the first l segments together differ in at most floor(l * 3 / 4) bits, for
l = 1 to 4: the first segment agrees and the second differs in one bit at most, so
one of its bytes agrees too. Segment and byte make a 24-bit key; every fingerprint
has eight. Rows that share a key meet, the chain's budgets are tested in turn, and
the full distance last.

Equal fingerprints are one row before any pairing, whatever their number. A key with
more than ``TILE`` rows is cut into groups that meet pairwise in separate cells, so no
task holds a whole bucket, and every cell returns a spanning forest of its links, not
the links: at most one edge a row. No link between components is lost by that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from loanclean.llm.base import components, documents, shards, stage

TILE = 256
SEED = 42
HASHES = 128
BAND = 5
BITS = 28
_BLOCK = 1 << 16


def tokens(text: str | None) -> list[bytes]:
    """Words of a text, only A-Z lower-cased, cut at ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], n: int) -> Iterator[bytes]:
    """XXH64 of the n-word shingles, repeats included, in blocks of 8-byte big-endian values."""
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = min(n, len(words))
    begin, end = starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist()
    digest = xxhash.xxh64_digest
    for at in range(0, len(begin), _BLOCK):
        yield b"".join([digest(joined[s:e], SEED) for s, e in zip(begin[at : at + _BLOCK], end[at : at + _BLOCK])])


def shingle_set(words: list[bytes], n: int) -> np.ndarray:
    """The distinct shingle hashes in ascending order."""
    return np.unique(np.frombuffer(b"".join(shingle_hashes(words, n)), ">u8").astype(np.uint64))


def fingerprint_of(hashes: Iterable[np.ndarray]) -> int:
    """The fingerprint of blocks of hashes as a signed 64-bit number; 0 without any."""
    ones, total = np.zeros(64, np.int64), 0
    for block in hashes:
        rows = block.astype(">u8").view(np.uint8).reshape(-1, 8)
        for at in range(0, len(rows), _BLOCK):
            ones += np.unpackbits(rows[at : at + _BLOCK], axis=1).sum(axis=0, dtype=np.int64)
        total += len(rows)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big", signed=True)


def fingerprint(words: list[bytes], n: int = 3) -> int:
    """The fingerprint as a signed 64-bit number; 0 without words."""
    return fingerprint_of(np.frombuffer(block, ">u8") for block in shingle_hashes(words, n))


def fingerprint_column(n: int, text: str = "text") -> Column:
    @F.pandas_udf(LongType())
    def of(t: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(tokens(x), n) for x in t], dtype="int64")

    return of(F.col(text))


_RNG = np.random.default_rng(20240)
_MUL, _ADD = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64) | np.uint64(1), _RNG.integers(0, 2**63, HASHES, dtype=np.uint64)


def sketch(hashes: np.ndarray) -> bytes:
    """One byte of each of HASHES minimum hashes of a set of shingle hashes."""
    least = np.full(HASHES, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 2048):
        least = np.minimum(least, (hashes[at : at + 2048, None] * _MUL + _ADD).min(axis=0))
    return (least >> np.uint64(40)).astype(np.uint8).tobytes()


def keys(fp: str = "fp") -> Column:
    """The eight (segment start, segment, byte of the next segment) keys of a fingerprint."""

    def part(low: int, bits: int) -> Column:
        return F.shiftrightunsigned(F.col(fp), low % 64).bitwiseAND((1 << bits) - 1)

    return F.array(*[F.lit((i * 2 + j) << 24) + part(16 * i, 16) * 256 + part(16 * (i + 1) + 8 * j, 8) for i in range(4) for j in range(2)])


def chained(diff: np.ndarray, start: np.ndarray, bits: int = 3) -> np.ndarray:
    """Do the differences pass the budgets of the chain that begins at segment ``start``, and the full check?"""
    shift = (start * 16).astype(np.uint64)
    ring = np.where(shift > 0, (diff >> shift) | (diff << ((np.uint64(64) - shift) % np.uint64(64))), diff)
    ok = np.ones(len(diff), bool)
    for segments in range(1, 5):
        low = ring & np.uint64((1 << (16 * segments)) - 1)
        ok &= np.bitwise_count(low) <= segments * bits // 4
    return ok


def ring_near(diff: np.ndarray, bits: int) -> np.ndarray:
    """Does a chain from any segment pass? True for all differences of ``bits`` bits or fewer."""
    return np.any([chained(diff, np.full(len(diff), s), bits) for s in range(4)], axis=0)


def spanning_forest(u: np.ndarray, v: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Numbers of the links of a heaviest spanning forest (Boruvka's rounds over arrays)."""
    ids, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label, chosen, live = np.arange(len(ids)), [], np.lexsort((b, a, -weight))
    while len(live):
        la, lb = label[a[live]], label[b[live]]
        live, la, lb = live[la != lb], la[la != lb], lb[la != lb]
        if not len(live):
            break
        both, first = np.unique(np.stack([la, lb], 1).ravel(), return_index=True)
        pick = np.unique(first // 2)
        hook = np.arange(len(ids))
        x, y = la[pick], lb[pick]
        chosen.append((live[pick], x, y))
        while True:  # labels of the joined trees
            lo, hi = np.minimum(hook[x], hook[y]), np.maximum(hook[x], hook[y])
            if (lo == hi).all():
                break
            np.minimum.at(hook, hi, lo)
            hook = hook[hook]
            while (hook != hook[hook]).any():
                hook = hook[hook]
        label = hook[label]
    return np.unique(np.concatenate([c[0] for c in chosen])) if chosen else np.zeros(0, np.int64)


def cell_edges(pdf: pd.DataFrame) -> pd.DataFrame:
    """Spanning forest of the links within each cell (column ``cell``)."""
    pdf = pdf.sort_values(["cell", "node"], kind="stable")
    cell, node, fp = pdf["cell"].to_numpy(), pdf["node"].to_numpy(), pdf["fp"].to_numpy().view(np.uint64)
    start = pdf["start"].to_numpy()
    found, live, step = [], np.arange(len(pdf)), 1
    while len(live):
        live = live[live + step < len(pdf)]
        live = live[cell[live] == cell[live + step]]
        good = live[chained(fp[live] ^ fp[live + step], start[live])]
        good = good[node[good] != node[good + step]]
        if len(good):
            found.append((good, good + step))
        step += 1
    if not found:
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    i, j = (np.concatenate(x) for x in zip(*found))
    u, v = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
    pick = spanning_forest(u, v, np.ones(len(u)))
    return pd.DataFrame({"a": u[pick], "b": v[pick]})


def tiled(rows: DataFrame) -> DataFrame:
    """The rows (node, key) whose key has others, with ``crowd``, the number of tiles of the key, and ``own``, the row's tile."""
    sizes = rows.groupBy("key").count().where("count > 1")
    crowd = F.ceil(F.col("count") / TILE).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("crowd")).cast("int")
    return rows.join(sizes, "key").withColumn("crowd", crowd).withColumn("own", own).drop("count")


def in_cells(rows: DataFrame) -> DataFrame:
    """Tiled rows, once for each tile of the key: column ``cell`` names the pair of tiles, ``other`` the other tile."""
    every = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("crowd") - 1)))
    return every.withColumn("cell", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))


def forest_edges(nodes: DataFrame, parts: int) -> DataFrame:
    """Edges (a, b) that connect the nodes (node, fp) as all their links do."""
    rows = nodes.select("node", "fp", F.explode(keys()).alias("key"))
    cells = in_cells(tiled(rows)).select("node", "fp", F.shiftright("key", 25).cast("long").alias("start"), "cell")
    edges = cells.groupBy(F.pmod("cell", F.lit(parts)).alias("part")).applyInPandas(cell_edges, "a long, b long")
    return edges.distinct()


def set_similarity(x: np.ndarray, y: np.ndarray) -> float:
    """Jaccard similarity of two ascending arrays without repeats; 1 if both are empty."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return float(not len(y))
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return both / (len(x) + len(y) - both)


def cell_pairs(cell: np.ndarray, text: np.ndarray, side: np.ndarray, cut: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of texts that share a cell and differ in ``side``, or have none (-1), for rows in order of cell; some cells at a time."""
    ends = np.flatnonzero(np.append(cell[1:] != cell[:-1], True)) + 1
    n = np.diff(ends, prepend=0)
    batch = np.cumsum(n * (n - 1) // 2) // cut
    stops = ends[np.append(batch[1:] != batch[:-1], True)]
    for lo, hi in zip([0, *stops[:-1]], stops):
        c, t, s = cell[lo:hi], text[lo:hi], side[lo:hi]
        live, step, found = np.arange(hi - lo), 1, []
        while len(live):
            live = live[live + step < hi - lo]
            live = live[c[live] == c[live + step]]
            pick = live[(s[live] < 0) | (s[live] != s[live + step])]
            found.append((t[pick], t[pick + step]))
            step += 1
        yield tuple(np.concatenate(x) for x in zip(*found))


def similar_cell_edges(pdf: pd.DataFrame, similarity: float, least: float) -> pd.DataFrame:
    """Edges that connect the texts of a part as all their links do: pairs in a cell of Jaccard similarity ``similarity`` or more.

    A row is a text with its cells. Pairs are taken by the agreement of their sketches, the
    likest first, and compared unless links found before connect them already. A pair that
    fails takes no other's place.
    """
    pdf = pdf.sort_values("node", kind="stable")
    node, root = pdf["node"].to_numpy(), pd.factorize(pdf["component"])[0]
    root = np.unique(root, return_index=True)[1][root]
    fp = pdf["fp"].to_numpy().view(np.uint64)
    marks = np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(len(pdf), HASHES)
    sets = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
    counts = np.array([len(x) for x in pdf["cells"]])
    text, at = np.repeat(np.arange(len(pdf)), counts), [(x["cell"], x["side"]) for cells in pdf["cells"] for x in cells]
    cell, side = np.array([x[0] for x in at], np.int64), np.array([x[1] for x in at], np.int64)
    order = np.lexsort((text, cell))
    links = []
    for x, y in cell_pairs(cell[order], text[order], side[order]):
        for test in (lambda: root[x] != root[y], lambda: ring_near(fp[x] ^ fp[y], BITS)):
            good = test()
            x, y = x[good], y[good]
        like = np.concatenate([(marks[x[k : k + _BLOCK]] == marks[y[k : k + _BLOCK]]).mean(axis=1) for k in range(0, len(x), _BLOCK)] or [np.zeros(0)])
        first = np.lexsort((y, x, -like))
        first = first[like[first] >= least]
        for k in range(0, len(first), 4096):
            u, v = x[first[k : k + 4096]], y[first[k : k + 4096]]
            apart = root[u] != root[v]
            up = root.tolist()
            for i, j in zip(u[apart].tolist(), v[apart].tolist()):
                a, b = i, j
                while up[a] != a:
                    up[a] = a = up[up[a]]
                while up[b] != b:
                    up[b] = b = up[up[b]]
                if a != b and set_similarity(sets[i], sets[j]) >= similarity:
                    up[max(a, b)] = min(a, b)
                    links.append((node[i], node[j]))
            root = np.array(up)
            while (root != root[root]).any():
                root = root[root]
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def band_keys(sketch: str = "sketch") -> Column:
    """A key for each whole run of BAND bytes of a sketch."""
    return F.array(*[F.xxhash64(F.lit(at), F.substring(sketch, at + 1, BAND)) for at in range(0, HASHES - BAND + 1, BAND)])


def similar_edges(nodes: DataFrame, sets: Callable[[DataFrame], DataFrame], parts: int, similarity: float, least: float) -> DataFrame:
    """Edges (a, b) that connect the nodes (node, text, sketch) as all links do whose ends share a band of the sketch.

    ``sets`` gives (text, fp, sketch, shingles) of the nodes (node, text) in need. The tiles of a
    key are linked first, each for itself. Keys whose nodes that leaves in several components
    have their tiles meet pairwise after that.
    """
    rows = stage(tiled(nodes.select("node", "text", F.explode(band_keys()).alias("key"))), "bands")
    known = stage(sets(rows.select("node", "text").distinct()), "sets")

    def linked(cells: DataFrame) -> DataFrame:
        part = F.pmod("cell", F.lit(parts)).alias("part")
        own = cells.groupBy(part, "node", "text", "component").agg(F.collect_list(F.struct("cell", "side")).alias("cells"))
        return own.join(known, "text").groupBy("part").applyInPandas(lambda pdf: similar_cell_edges(pdf, similarity, least), "a long, b long")

    edges = stage(linked(rows.select("node", "text", F.col("node").alias("component"), F.lit(-1).alias("side"), F.xxhash64("key", "own").alias("cell"))), "pairs")
    large = rows.where("crowd > 1")
    if large.isEmpty():
        return edges
    large = stage(large.join(components(edges), "node", "left").withColumn("component", F.coalesce("component", "node")), "large")
    open_ = large.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    cross = in_cells(large.join(open_, "key", "left_semi")).where("own <> other")
    more = linked(cross.select("node", "text", "component", F.col("own").alias("side"), "cell"))
    return stage(edges.union(more), "pairs")


def fingerprint_components(prints: DataFrame, parts: int) -> DataFrame:
    """(doc_id, fp) with component_id, the smallest doc_id reachable over links of fingerprints.

    Repeated rows stay. A row without doc_id takes no part in linking; it gets the
    component of equal fingerprints, or null.
    """
    classes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node is not null"), "classes")
    labels = components(forest_edges(classes, parts))
    found = classes.join(labels, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(found, "fp", "left")


def op3_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    prints = stage(docs.select("doc_id", fingerprint_column(3).alias("fp")), "prints")
    out = fingerprint_components(prints, shards(docs, 4))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_duplicates(docs: DataFrame, n: int = 5, similarity: float = 0.8, slack: float = 0.16) -> DataFrame:
    """(doc_id, component_id) of the documents that have a near or exact copy.

    Candidates share a band of a minimum-hash sketch of their n-word shingles: of pairs
    of Jaccard similarity 0.8, 1 in 20,000 shares none. Fingerprints of the distinct
    shingles prune them by pigeonring to ``BITS`` differing bits (such a pair differs in
    about 10 to 12), sketches to about ``similarity`` less ``slack``. A link is a Jaccard
    similarity of ``similarity`` or more of the sets of n-word shingles, by their 64-bit
    hashes; it is decided before links are thinned to what connects the same documents.
    Texts without words are copies of each other; rows without doc_id take no part.
    """
    docs = docs.select("doc_id", "text").where("doc_id is not null")
    parts = shards(docs, 4)

    @F.pandas_udf("struct<sketch binary, text binary>")
    def marks(t: pd.Series) -> pd.DataFrame:
        rows = []
        for x in t:
            w = tokens(x)
            rows.append([sketch(shingle_set(w, n)), xxhash.xxh3_128_digest(b" ".join(w))])
        return pd.DataFrame(rows, columns=["sketch", "text"])

    rows = stage(docs.select("doc_id", marks("text").alias("m")).select("doc_id", "m.*"), "marks")
    classes = stage(rows.groupBy("text").agg(F.first("sketch").alias("sketch"), F.min("doc_id").alias("node")), "classes")

    @F.pandas_udf("struct<text binary, fp long, sketch binary, shingles binary>")
    def sets(t: pd.Series) -> pd.DataFrame:
        rows = []
        for x in t:
            w = tokens(x)
            h = shingle_set(w, n)
            rows.append([xxhash.xxh3_128_digest(b" ".join(w)), fingerprint_of([h]), sketch(h), h.tobytes()])
        return pd.DataFrame(rows, columns=["text", "fp", "sketch", "shingles"])

    def known(named: DataFrame) -> DataFrame:
        texts = stage(docs.join(named.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi").select("text"), "texts")
        own = texts.select(sets("text").alias("s")).select("s.*")
        return own.join(named.select("text").distinct(), "text", "left_semi").groupBy("text").agg(*[F.first(c).alias(c) for c in ("fp", "sketch", "shingles")])

    labels = components(similar_edges(classes, known, parts, similarity, similarity - slack))
    found = classes.join(labels, "node", "left").select("text", F.coalesce("component", "node").alias("component_id"))
    return rows.select("doc_id", "text").join(found, "text").select("doc_id", "component_id")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group that the fingerprints of 3-word shingles link the smallest doc_id stays.

    Links are those of ``op3_simhash_components``: 3 differing bits or fewer, with no other
    check. Texts without words have fingerprint zero and are linked like any other.
    Repeated rows of one doc_id with equal texts are one document: one of them stays.
    Rows without doc_id stay as they are.
    """
    named = docs.where("doc_id is not null")
    prints = stage(named.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint_column(3).alias("fp")), "prints")
    groups = fingerprint_components(prints, shards(docs, 4))
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    kept = named.join(gone, "doc_id", "left_anti").select(docs.columns)
    doubles = prints.groupBy("doc_id").count().where("count > 1").select("doc_id")
    again = kept.join(doubles, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(docs.columns)
    return kept.join(doubles, "doc_id", "left_anti").select(docs.columns).unionByName(again).unionByName(docs.where("doc_id is null"))
