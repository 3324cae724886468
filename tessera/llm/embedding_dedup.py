"""Near-duplicate vectors by an exact metric range join.

Vectors of one label whose cosine is at least ``threshold`` link. On the unit sphere that is Euclidean
distance at most eps = sqrt(2 - 2 threshold). Pivots partition the vectors: each belongs to its nearest
pivot. Linked vectors of two cells i and j both lie so close to the border that, for the one in cell j,
d(p_i) - d(p_j) <= 2 eps (triangle inequality) and (d(p_i)^2 - d(p_j)^2) / (2 d(p_i, p_j)) <= eps
(distance to the bisecting plane); such a vector is replicated to cell i < j. So every link is met in
exactly one cell, and cells join independently. Cells over ``block`` vectors are cut into blocks by a
hash and joined block by block. A block task returns a count per vector and the edges of a spanning
forest, never all pairs; equal vectors are one class with a count.

Rows, not ids, are counted: equal vectors of one label are one class, whatever ids they have.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows with
a null label, have no links and are components by themselves; vectors of different sizes do not link; equal
vectors of one label link with each other, rows that repeat an id included; vectors with a null id link
like others, but name no component: a component without ids has a null component_id, and all its rows are
kept; an empty table gives no rows; other columns are ignored; vectors may be of any length.
The pivots come from a bounded sample of the vectors; every vector is placed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.components import connected_components
from tessera.session import discard, materialize

THRESHOLD = 0.98
CELL, MAX_PIVOTS, BLOCK, PIVOT_SAMPLE = 2048, 64, 512, 2048
#: Widens the placement bounds so that rounding loses no link.
SLACK = 1e-9


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow or underflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def choose_pivots(sample: list[list[float]], k: int) -> np.ndarray:
    """Farthest-first traversal from the first vector of the sample; vectors of its size only."""
    size = len(sample[0])
    x = _unit(np.array([v for v in sample if len(v) == size], dtype=np.float64))
    chosen, near = [0], np.full(len(x), np.inf)
    while len(chosen) < min(k, len(x)):
        near = np.minimum(near, 2 - 2 * (x @ x[chosen[-1]]))
        if near.max() < 1e-6:
            break
        chosen.append(int(near.argmax()))
    return x[chosen]


def _place(pivots: np.ndarray, eps: float):
    """mapInArrow function: the home cell of each vector and the lower cells that it may link into."""
    gaps = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))

    def run(batches):
        for b in (x.slice(i, 2000) for x in batches for i in range(0, x.num_rows, 2000)):
            vectors = b.column("embedding")
            sizes = vectors.value_lengths().to_numpy()
            flat, at = vectors.flatten().to_numpy().astype(np.float64), np.append(0, np.cumsum(sizes))
            rows, cells, homes, units = [], [], [], [b""] * len(sizes)
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                x = _unit(flat[at[own][:, None] + np.arange(size)])
                for r, v in zip(own.tolist(), x):
                    units[r] = v.tobytes()
                if size != pivots.shape[1]:  # without pivots of that size: one cell
                    rows += own.tolist()
                    cells += [0] * len(own)
                    homes += [True] * len(own)
                    continue
                d2 = np.maximum(2 - 2 * x @ pivots.T, 0)
                d, home = np.sqrt(d2), d2.argmin(axis=1)
                dh = d[np.arange(len(x)), home][:, None]
                with np.errstate(divide="ignore", invalid="ignore"):
                    plane = (d2 - dh**2) / (2 * gaps[home])
                near = (d - dh <= 2 * eps + SLACK) & (plane <= eps + SLACK) & (np.arange(len(pivots)) < home[:, None])
                near[np.arange(len(x)), home] = True
                i, j = np.nonzero(near)
                rows += own[i].tolist()
                cells += j.tolist()
                homes += (j == home[i]).tolist()
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("cls").take(take), b.column("label").take(take), b.column("copies").take(take), pa.array(sizes[rows] if rows else [], pa.int32()),
                 pa.array(cells, pa.int32()), pa.array(homes, pa.bool_()), pa.array([units[r] for r in rows], pa.binary())],
                names=["cls", "label", "copies", "size", "cell", "home", "unit"],
            )

    return run


def _forest(linked: np.ndarray) -> np.ndarray:
    """The smallest row index of each row's component, for a symmetric boolean matrix."""
    label = np.arange(len(linked))
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label)))
        if (new == label).all():
            return label
        label = new


def _join_block(threshold: float):
    """applyInArrow function: links inside a block or between two blocks of a cell."""

    def run(table: pa.Table) -> pa.Table:
        ids, copies = table["cls"].to_numpy(), table["copies"].to_numpy()
        side, same = table["side"].to_numpy(), table["same"][0].as_py()
        x = np.frombuffer(b"".join(table["unit"].to_pylist()), np.float64).reshape(len(ids), -1)
        linked = x @ x.T >= threshold
        if same:
            np.fill_diagonal(linked, False)
        else:
            linked &= side[:, None] != side[None, :]
        some = np.flatnonzero(linked.any(axis=1))
        linked, ids, copies = linked[np.ix_(some, some)], ids[some], copies[some]
        root = _forest(linked) if len(ids) else np.zeros(0, np.int64)
        return pa.table({"cls": pa.array(ids, pa.int64()), "links": pa.array(linked @ copies if len(ids) else [], pa.int64()), "other": pa.array(ids[root], pa.int64())})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, cell: int = CELL, max_pivots: int = MAX_PIVOTS, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept (whether it is its component's smallest id)."""
    spark = vectors.sparkSession
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    usable &= F.forall("embedding", finite) & F.exists("embedding", lambda v: v != 0)
    keys = [F.xxhash64(F.lit(s), "label", "embedding").alias(n) for s, n in ((1, "k1"), (2, "k2"))]
    valid = given.where(F.coalesce(usable, F.lit(False)))
    groups = valid.select("vec_id", "label", "embedding", *keys).groupBy("label", "k1", "k2")
    groups = groups.agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    classes = materialize(groups.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    chosen = classes.select("cls", "label", "copies", "embedding")
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    sample = chosen.orderBy(F.xxhash64("embedding"), "cls").limit(PIVOT_SAMPLE).select("embedding").collect() if most else []
    pivots = choose_pivots([r[0] for r in sample], min(max_pivots, math.ceil(most / cell))) if sample else np.ones((1, 1))
    eps = math.sqrt(max(2 - 2 * threshold, 0))
    placed = materialize(
        chosen.mapInArrow(_place(pivots, eps), f"cls long, label {vectors.schema['label'].dataType.simpleString()}, copies long, size int, cell int, home boolean, unit binary"),
        "vector-cells",
    )
    cells = placed.groupBy("label", "size", "cell").agg(F.ceil(F.count_if("home") / block).cast("int").alias("homes"), F.ceil(F.count_if(~F.col("home")) / block).cast("int").alias("guests"))
    at = placed.join(cells, ["label", "size", "cell"])
    own = F.pmod(F.xxhash64("cls"), F.greatest(F.when(F.col("home"), F.col("homes")).otherwise(F.col("guests")), F.lit(1))).cast("int")
    at = at.withColumn("own", own)
    # Homes meet every block of homes, the own one included, and every block of guests; guests meet every block of homes.
    other = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    task = lambda a, b, guests, side: F.struct(a.alias("a"), b.alias("b"), F.lit(guests).alias("guests"), side.cast("int").alias("side"))
    o = F.col("own")
    with_homes = F.transform(other(F.col("homes")), lambda t: task(F.least(o, t), F.greatest(o, t), False, F.when(o <= t, F.lit(0)).otherwise(F.lit(1))))
    with_guests = F.transform(other(F.col("guests")), lambda t: task(o, t, True, F.lit(0)))
    as_guest = F.transform(other(F.col("homes")), lambda t: task(t, o, True, F.lit(1)))
    dealt = at.select(
        "cls", "label", "copies", "size", "cell", "unit", F.explode(F.when(F.col("home"), F.concat(with_homes, with_guests)).otherwise(as_guest)).alias("t")
    ).select("*", "t.a", "t.b", "t.guests", "t.side", (~F.col("t.guests") & (F.col("t.a") == F.col("t.b"))).alias("same")).drop("t")
    met = dealt.groupBy("label", "size", "cell", "a", "b", "guests").applyInArrow(_join_block(threshold), "cls long, links long, other long")
    met = materialize(met, "vector-links")
    parts = connected_components(met.select("cls", "other"), "cls", "other").select(F.col("node").alias("cls"), "component")
    linked = classes.select("cls", "rep").join(met.groupBy("cls").agg(F.sum("links").alias("links")), "cls").join(parts, "cls")
    linked = linked.join(linked.groupBy("component").agg(F.min("rep").alias("first")), "component").select("cls", "links", "first", F.lit(True).alias("met"))
    named = materialize(
        classes.join(linked, "cls", "left").select(
            "label", "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.when(F.col("met"), F.col("first")).otherwise(F.col("rep")).alias("component"), F.lit(True).alias("usable")
        ),
        "linked-vectors",
    )
    for df in (classes, placed, met, parts):
        discard(df)
    return (
        given.select("vec_id", "label", F.coalesce(usable, F.lit(False)).alias("usable"), *keys)
        .join(named, ["label", "k1", "k2", "usable"], "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))
    )
