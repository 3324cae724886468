"""Exact n-gram Jaccard self-join with adaptive multi-match prefixes.

Documents are sets of word shingles. Texts with equal sets form one class; one row of it, that of the
smallest id, is joined. Shingles have one global order: rare ones first, by counts over all documents in a hashed table
of fixed size (collisions change the cost, never the result), ties by hash. Two sets with Jaccard
similarity of at least t share l shingles among the first n - ceil(t n) + l of each, for every l. So
each document picks its own l: its prefix is lengthened while the estimated cost of its candidates
falls, and a pair is verified only if the two prefixes share as many shingles as the smaller l.

How many prefixes hold a shingle is counted exactly. Pairs are counted over the rare ones only, a
bounded number each, and kept where they share enough; documents that share a frequent shingle are
joined to its first document instead. The components of these edges hold every link. Small components are
dealt to tasks whole, many to a task, and large ones are cut by length bands (a link needs sizes within a
factor of t) and then into blocks by a hash, which are joined block by block. Blocks are bounded by the
number of documents and by that of their shingles. A task sees the whole texts of at most about two
blocks, matches prefixes, verifies, and returns a link count per document and the edges of a spanning
forest: no more rows than it was given. Every link between different sets is met in exactly one task.

Rows, not ids, are joined: a row's key is its place in the input, which must give the same rows in the
same order each time it is read, as a scan of files does. If rows are missing the second time, the join
fails; another order of as many rows is not noticed, so materialize inputs that may change.

Defined results: texts that are null, empty or white space have no shingles, link with nothing and are
their own component; a text of fewer words than the width is one shingle; equal sets link; repeated rows
are copies, each of which counts as a link of the others; rows of one id with different texts are joined
each for itself, and the id stands for each; rows with a null id are returned with null component and no
links; an empty table gives no rows; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import math
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.arrow import as_bytes, give_back, sliced
from tessera.llm.shingles import mix, shingle_sets, weighed_sets, word_table
from tessera.plans.components import connected_components
from tessera.session import discard, materialize

WIDTH, PERCENT = 5, 80
#: Sizes of the count tables: words, and shingles by the size of the texts between two bounds.
WORD_BITS, LEAST_BITS, MOST_BITS, PARTS = 20, 16, 23, 32
MOST_MATCHES = 16
BLOCK = 512
#: A document counts in a block once, and once more for so many shingles.
WEIGHT = 4096
#: Shingles in more prefixes than this are frequent; the pairs of the others are counted.
FREQUENT = 64
#: Partial count tables that one task adds up.
FAN_IN = 16


class Prefixes:
    """The global order of shingles, and each set's adaptive prefix.

    A shingle's estimated document count, in quarter powers of two, is the larger of two: what chance
    gives, from the counts of its words, and what its bucket of the shingle table holds beyond its
    usual filling. Both tables have a fixed size and count all documents.
    """

    def __init__(self, shingles: np.ndarray, words: np.ndarray, width: int, percent: int):
        self.width, self.percent = width, percent
        usual = float(np.median(shingles))
        beyond = np.maximum(shingles - usual - 5 * math.sqrt(usual) - 2, 0)
        self.beyond = np.round(4 * np.log2(1 + beyond)).astype(np.uint8)
        self.words = np.round(4 * np.log2(1 + words)).astype(np.uint8)
        self.chance = round(4 * (width - 1) * math.log2(1 + int(words.sum())))

    def sets(self, raws: list[bytes | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each text's shingles and their estimates."""
        out = []
        for shingles, common in weighed_sets(raws, self.width, self.words):
            beyond = self.beyond[(shingles & np.uint64(len(self.beyond) - 1)).astype(np.int64)].astype(np.int32)
            out.append((shingles, np.where(beyond > 0, np.maximum(common - self.chance, beyond), common - self.chance)))
        return out

    def longest(self, shingles: np.ndarray, estimate: np.ndarray) -> np.ndarray:
        """The longest prefix that any number of matches needs, in global order."""
        need = -(-self.percent * len(shingles) // 100)
        return shingles[np.lexsort((shingles, estimate))[: len(shingles) - need + min(MOST_MATCHES, need)]]

    def of(self, shingles: np.ndarray, estimate: np.ndarray) -> tuple[np.ndarray, int]:
        """The prefix of a set in global order, and how many of its shingles a partner must share."""
        n = len(shingles)
        order = np.lexsort((shingles, estimate))
        need = -(-self.percent * n // 100)
        most = min(MOST_MATCHES, need)
        head = order[: n - need + most]
        found = np.cumsum(np.exp2(np.maximum(estimate[head], 0) / 4) - 1)
        matches = np.arange(1, most + 1)
        length = n - need + matches
        # Postings read, and at most found / l documents that can share l of them, to be verified.
        cost = length + found[length - 1] * (1 + (1 + n / 16) / matches)
        best = int(cost.argmin())
        return shingles[head[: length[best]]], best + 1


def _added(tables: DataFrame) -> DataFrame:
    """The compressed tables of each (part, task), added up."""

    def add(table: pa.Table) -> pa.Table:
        total = None
        for x in table["counts"]:
            part = np.frombuffer(zlib.decompress(x.as_buffer()), np.int64)
            total = part.copy() if total is None else np.add(total, part, out=total)
        return pa.table({"part": table["part"].slice(0, 1), "task": table["task"].slice(0, 1), "counts": pa.array([zlib.compress(total, 1)], pa.binary())})

    return tables.groupBy("part", "task").applyInArrow(add, "part int, task int, counts binary")


def _tables(parts: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle and word counts from the compressed partial tables, added up ``FAN_IN`` at a time.

    Two tables of bounded size reach the driver.
    """
    tasks = parts.agg(F.max("task")).first()[0] or 0
    while True:
        parts, tasks = _added(parts.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int"))), tasks // FAN_IN
        if not tasks:
            break
    rows = {r["part"]: zlib.decompress(r["counts"]) for r in parts.select("part", "counts").collect()}
    shingles, words = (
        np.concatenate([np.frombuffer(rows[first + p], np.int64) if first + p in rows else np.zeros((1 << b) // PARTS, np.int64) for p in range(PARTS)])
        for first, b in ((0, bits), (PARTS, WORD_BITS))
    )
    return shingles, words


def _signatures(rows: DataFrame, width: int, bits: int) -> DataFrame:
    """n and a 128-bit signature of each row's set, and each task's tables of shingle and word counts."""
    names = ["row", "doc_id", "n", "k1", "k2", "part", "task", "counts"]
    schema = pa.schema([*((n, pa.int64()) for n in names[:5]), ("part", pa.int32()), ("task", pa.int32()), ("counts", pa.binary())])

    def run(batches):
        shingles, words = np.zeros(1 << bits, dtype=np.uint32), np.zeros(1 << WORD_BITS, dtype=np.uint32)
        for b in sliced(batches):
            raws = b.column("_utf8").to_pylist()
            sets = shingle_sets(raws, width)
            for s in sets:
                at, n = np.unique((s & np.uint64(len(shingles) - 1)).astype(np.int64), return_counts=True)
                shingles[at] += n.astype(np.uint32)
            words += word_table(raws, WORD_BITS).astype(np.uint32)
            joined = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            at = np.cumsum([0, *map(len, sets)])
            with np.errstate(over="ignore"):
                sums = [np.append(np.uint64(0), np.cumsum(mix(joined ^ np.uint64(c)), dtype=np.uint64)) for c in (0x243F6A8885A308D3, 0x13198A2E03707344)]
                keys = [pa.array((s[at[1:]] - s[at[:-1]]).view(np.int64)) for s in sums]
            none = pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), pa.array(np.diff(at)), *keys, *none], schema=schema)
        task = TaskContext.get().partitionId()
        if words.any():
            for first, table in ((0, shingles), (PARTS, words)):
                packed = [zlib.compress(x.astype(np.int64), 1) for x in table.reshape(PARTS, -1)]
                none = pa.nulls(PARTS, pa.int64())
                parts = pa.array(range(first, first + PARTS), pa.int32())
                yield pa.RecordBatch.from_arrays([*[none] * 5, parts, pa.array([task] * PARTS, pa.int32()), pa.array(packed, pa.binary())], schema=schema)
        del shingles, words
        give_back()

    return rows.mapInArrow(run, "row long, doc_id long, n long, k1 long, k2 long, part int, task int, counts binary")


def _prefix_rows(rows: DataFrame, prefixes) -> DataFrame:
    def run(batches):
        for b in sliced(batches):
            heads = [prefixes.value.longest(*s) for s in prefixes.value.sets(b.column("_utf8").to_pylist())]
            at = pa.array(np.cumsum([0, *map(len, heads)]), pa.int32())
            flat = np.concatenate(heads).view(np.int64) if heads else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.ListArray.from_arrays(at, pa.array(flat))], names=["row", "prefix"])
        give_back()

    return rows.mapInArrow(run, "row long, prefix array<long>")


def _candidate_edges(heads: DataFrame, reps: DataFrame, percent: int, frequent: int) -> DataFrame:
    """Edges (x, y) whose components hold every link: pairs that share enough rare shingles, and stars of frequent ones."""
    postings = heads.select("row", F.posexplode("prefix").alias("pos", "token"))
    tokens = postings.groupBy("token").agg(F.count("*").alias("df"), F.min("row").alias("first")).where("df > 1")
    shared = postings.join(tokens, "token").groupBy("row").agg(F.collect_list(F.struct("pos", "token", "df", "first")).alias("own"))
    # Every document picks the number of matches that costs least: postings read, plus at most
    # (sum of partners) / matches documents that can share that many, each verified at a cost by length.
    need = -F.floor(-F.col("n") * percent / 100)
    length = lambda k: F.col("n") - need + k
    partners = lambda k: F.aggregate(F.filter("own", lambda t: t["pos"] < length(k)), F.lit(0.0), lambda a, t: a + t["df"] - 1)
    costs = F.transform(F.sequence(F.lit(1).cast("long"), F.least(F.lit(MOST_MATCHES).cast("long"), need)), lambda k: length(k) + partners(k) * (1 + (1 + F.col("n") / 16) / k))
    picked = shared.join(reps.select("row", "n"), "row").withColumn("costs", costs).withColumn("matches", F.array_position("costs", F.array_min("costs")))
    kept = picked.select("row", "n", "matches", F.explode(F.filter("own", lambda t: t["pos"] < length(F.col("matches")))).alias("t"))
    rare = kept.where(F.col("t.df") <= frequent).groupBy("t.token").agg(F.collect_list(F.struct("row", "n", "matches")).alias("docs"))
    fits = lambda x, y: (x["row"] < y["row"]) & (100 * F.least(x["n"], y["n"]) >= percent * F.greatest(x["n"], y["n"]))
    pair = lambda x, y: F.struct(x["row"].alias("x"), y["row"].alias("y"), F.least(x["matches"], y["matches"]).alias("least"))
    pairs = F.flatten(F.transform("docs", lambda x: F.transform(F.filter("docs", lambda y: fits(x, y)), lambda y: pair(x, y))))
    counted = rare.where(F.size("docs") > 1).select(F.explode(pairs).alias("p")).groupBy("p.x", "p.y").agg(F.count("*").alias("c"), F.min("p.least").alias("least"))
    stars = kept.where(F.col("t.df") > frequent).select(F.col("row").alias("x"), F.col("t.first").alias("y")).where("x <> y")
    return counted.where("c >= least").select("x", "y").unionAll(stars)


def _overlaps(sets: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Intersection sizes of all pairs of ``rows``, by products of incidence matrices in slices."""
    owner = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
    _, token, count = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True, return_counts=True)
    shared = count[token] > 1
    owner, token = owner[shared], token[shared]
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], np.cumsum(np.diff(token[order], prepend=token[order][:1]) > 0)
    out = np.zeros((len(rows), len(rows)), dtype=np.float32)
    for low in range(0, int(token[-1]) + 1 if len(token) else 0, 4096):
        a, b = np.searchsorted(token, [low, low + 4096])
        x = np.zeros((len(rows), 4096), dtype=np.float32)
        x[owner[a:b], token[a:b] - low] = 1
        out += x @ x.T
    return out.astype(np.int64)


def _components_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index of each index's component under the pairs (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links_among(weighed: list[tuple[np.ndarray, np.ndarray]], prefixes: Prefixes, percent: int, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i, j) of linked sets, i < j; with ``side``, only pairs from different sides."""
    sets = [s for s, _ in weighed]
    m = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    heads, least = zip(*[prefixes.of(*s) if len(s[0]) else (s[0], 1) for s in weighed]) if m else ((), ())
    least = np.array(least, dtype=np.int64)
    owner = np.repeat(np.arange(m), [len(h) for h in heads])
    tokens = np.concatenate(heads) if m else np.zeros(0, np.uint64)
    order = np.argsort(tokens, kind="stable")
    owner, tokens = owner[order], tokens[order]
    cuts = np.flatnonzero(np.diff(tokens, prepend=~tokens[:1]) != 0) if m else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(tokens))
    shared = np.zeros((m, m), dtype=np.int32)
    for a, b in zip(cuts[ends - cuts > 1].tolist(), ends[ends - cuts > 1].tolist()):
        v = owner[a:b]
        shared[v[:, None], v] += 1
    good = shared >= np.minimum(least[:, None], least)
    good &= 100 * np.minimum(sizes[:, None], sizes) >= percent * np.maximum(sizes[:, None], sizes)
    good &= sizes[:, None] > 0
    if side is not None:
        good &= side[:, None] != side
    i, j = np.nonzero(np.triu(good, 1))
    part = _components_of(m, i, j)
    pairs_in = np.bincount(part[i], minlength=m)
    members = np.bincount(part, minlength=m)
    dense = pairs_in > 10 * members
    common = np.zeros(len(i), dtype=np.int64)
    for p in np.flatnonzero(dense).tolist():
        rows, own = np.flatnonzero(part == p), np.flatnonzero(part[i] == p)
        table = _overlaps(sets, rows)
        common[own] = table[np.searchsorted(rows, i[own]), np.searchsorted(rows, j[own])]
    for k in np.flatnonzero(~dense[part[i]]).tolist():
        small, large = sorted((sets[i[k]], sets[j[k]]), key=len)
        at = np.searchsorted(large, small)
        at[at == len(large)] = 0
        common[k] = int((large[at] == small).sum())
    linked = 100 * common >= percent * (sizes[i] + sizes[j] - common)
    return i[linked], j[linked]


def _join_task(percent: int, prefixes):
    """applyInArrow function: link counts and forest edges of one task."""

    def run(table: pa.Table) -> pa.Table:
        rows, copies = table["row"].to_numpy(), table["copies"].to_numpy()
        across = table["across"][0].as_py()
        sets = prefixes.value.sets(table["_utf8"].to_pylist())
        i, j = links_among(sets, prefixes.value, percent, table["side"].to_numpy() if across else None)
        links = np.bincount(i, copies[j], len(rows)) + np.bincount(j, copies[i], len(rows))
        root, some = _components_of(len(rows), i, j), np.flatnonzero(links)
        return pa.table({"row": pa.array(rows[some]), "links": pa.array(links[some].astype(np.int64)), "other": pa.array(rows[root[some]])})

    return run


def _tasks(members: DataFrame, percent: int, block: int, partitions: int) -> DataFrame:
    """row, copies, and each task the document takes part in: (kind, a, b), side, across."""
    band = F.floor(F.ln("n") / F.lit(-math.log(percent / 100) * (1 + 1e-9))).cast("int") if percent < 100 else F.col("n").cast("int")
    sizes = members.groupBy("comp").agg(F.sum("weight").alias("size"))
    at = members.withColumn("band", band).join(sizes, "comp")
    one = F.struct(F.lit("comp").alias("kind"), F.pmod(F.xxhash64("comp"), F.lit(partitions)).alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).alias("side"), F.lit(False).alias("across"))
    small = at.where(F.col("size") <= block).select("row", "copies", one.alias("t"))
    big = at.where(F.col("size") > block)
    bands = big.groupBy("comp", "band").agg(F.ceil(F.sum("weight") / block).cast("long").alias("blocks"))
    near = lambda step, name: bands.select("comp", (F.col("band") + step).alias("band"), F.col("blocks").alias(name))
    big = big.join(bands, ["comp", "band"]).join(near(-1, "above"), ["comp", "band"], "left").join(near(1, "below"), ["comp", "band"], "left")
    own = F.pmod(F.xxhash64("row"), F.col("blocks"))
    name = lambda band, blk: F.xxhash64("comp", band, blk)
    here = name(F.col("band"), F.col("own"))

    def meet(blocks, step):
        other = F.when(F.coalesce(blocks, F.lit(0)) > 0, F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(F.array().cast("array<long>"))
        there = lambda t: name(F.col("band") + step, t)
        return F.transform(
            other,
            lambda t: F.struct(
                F.lit("pair").alias("kind"), F.least(here, there(t)).alias("a"), F.greatest(here, there(t)).alias("b"),
                F.when(here <= there(t), 0).otherwise(1).alias("side"), (here != there(t)).alias("across"),
            ),
        )

    pairs = F.concat(meet(F.col("blocks"), 0), meet(F.col("above"), 1), meet(F.col("below"), -1))
    large = big.withColumn("own", own).select("row", "copies", F.explode(pairs).alias("t"))
    return small.unionByName(large).select("row", "copies", "t.*")


def _joined(docs: DataFrame, width: int, percent: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Each row's signature (row, doc_id, n, k1, k2), and per signature: links, the smallest id reachable and that id's row."""
    if not 0 < Fraction(percent, 100) <= 1:
        raise ValueError("percent must be over 0 and at most 100")
    spark = docs.sparkSession
    texts = as_bytes(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    rows = texts.withColumn("row", F.monotonically_increasing_id())
    size = texts.agg(F.sum(F.octet_length("_utf8"))).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(1 + size / 64))))
    found = materialize(_signatures(rows, width, bits), "signatures")
    signed = found.where("part is null").select("row", "doc_id", "n", "k1", "k2")
    order = Prefixes(*_tables(found.where("part is not null").select("part", "task", "counts"), bits), width, percent)
    prefixes = spark.sparkContext.broadcast(order)
    groups = signed.where("doc_id is not null and n > 0").groupBy("n", "k1", "k2").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.count("*").alias("copies"))
    classes = materialize(groups.select("n", "k1", "k2", F.col("first.doc_id").alias("doc_id"), F.col("first.row").alias("row"), "copies"), "classes")
    reps = classes.select("row", "doc_id", "n", "copies", (1 + F.floor(F.col("n") / WEIGHT)).alias("weight"))
    heads = materialize(_prefix_rows(rows, prefixes).join(reps.select("row", "n"), "row").where(F.size("prefix") > 0).select("row", "prefix"), "prefixes")
    if heads.count() != classes.count():
        raise RuntimeError("the input changed between two passes; materialize it first")
    candidates = connected_components(_candidate_edges(heads, reps, percent, FREQUENT), "x", "y")
    members = materialize(candidates.select(F.col("node").alias("row"), F.col("component").alias("comp")).join(reps, "row"), "candidates")
    discard(heads)
    discard(candidates)
    partitions = max(1, math.ceil((members.agg(F.sum("weight")).first()[0] or 0) / block))
    dealt = _tasks(members, percent, block, partitions)
    met = rows.select("row", "_utf8").join(dealt, "row").groupBy("kind", "a", "b").applyInArrow(_join_task(percent, prefixes), "row long, links long, other long")
    met = materialize(met, "links")
    discard(members)
    parts = connected_components(met.select("row", "other"), "row", "other").select(F.col("node").alias("row"), "component")
    linked = reps.join(met.groupBy("row").agg(F.sum("links").alias("links")), "row").join(parts, "row")
    first = linked.groupBy("component").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    linked = linked.join(first, "component").select("row", "links", "first")
    named = classes.join(linked, "row", "left").select(
        "n", "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce(F.col("first.doc_id"), "doc_id").alias("component"), F.coalesce(F.col("first.row"), "row").alias("kept"),
    )
    named = materialize(named, "linked-classes")
    for df in (met, parts, classes):
        discard(df)
    return signed, named


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest linked id) and n_links.

    Documents link when 100 * intersection >= percent * union.
    """
    signed, named = _joined(docs, width, percent, block)
    return signed.join(named, ["n", "k1", "k2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
    )


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """One row of each component, with all columns: one of the smallest id. Rows without an id or without words stay.

    Rows are judged, not ids: rows of one id with different texts stay or go each for itself.
    """
    signed, named = _joined(docs, width, percent, block)
    gone = signed.where("doc_id is not null").join(named, ["n", "k1", "k2"]).where("row <> kept")
    key = "_row"
    while key in map(str.lower, docs.columns):
        key += "_"
    rows = docs.withColumn(key, F.monotonically_increasing_id())
    return rows.join(gone.select(F.col("row").alias(key)), key, "left_anti").select(*docs.columns)
