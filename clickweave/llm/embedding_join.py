"""Embedding near-duplicates by an epsilon grid order join.

Vectors of unit length have a cosine of t or more exactly if their Euclidean
distance is at most eps = sqrt(2 - 2t), and no projection makes a distance
longer. The vectors are projected on their leading principal dimensions, laid
on a grid with cells of width eps and sorted by cell, dimension by dimension
(the epsilon grid order). The sequence is cut into blocks. From the root down,
pairs of sequence intervals are split into pairs of their parts; a pair whose
bounding boxes lie further apart than eps is skipped. Inside a block pair this
goes on down to intervals of LEAF vectors, with boxes in all axes kept and in
the length of what the axes leave over. What is left are leaf pairs. There the
projections and the lengths left over bound each pair's cosine from above, and
only pairs whose bound reaches the threshold are compared in double precision.

Equal vectors are one entry with a multiplicity, so a vector that a third of
all rows share is compared once. A block pair emits, for each vector that has
links in it, their number and one edge of a spanning star, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import checkpoint, levels
from clickweave.llm.components import connected_components

THRESHOLD = 0.9
# Principal dimensions of the grid order and of the blocks' bounding boxes, and
# those that bound cosines inside a block pair.
LEADING, BOUNDING = 8, 32
# Components that the axes are computed from; longer vectors are seen by their first.
AXES_OF = 1024
# Bytes of a block, of one vector at least: a block pair is shuffled whole, so
# larger ones shuffle less.
BLOCK_BYTES = 6 << 20
LEAF = 256
# Parts that an interval of the sequence is split into.
FANOUT = 8


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """(k, vec_id, copies, embedding): the usable distinct vectors. k hashes the
    vector, vec_id is the smallest id that has it, copies its number of rows.

    A vector is usable if its id is not null and it has a length above zero, no null and no
    non-finite component."""
    e = F.col("embedding")
    ok = (F.col("vec_id").isNotNull() & e.isNotNull()
          & F.forall(e, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists(e, lambda x: x != 0))
    return (keyed(vectors).where(ok).groupBy("k")
            .agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")))


def keyed(vectors: DataFrame) -> DataFrame:
    v = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
    return v.withColumn("k", F.struct(F.xxhash64(F.lit(1), "embedding").alias("a"), F.xxhash64(F.lit(2), "embedding").alias("b")))


def unit(rows) -> np.ndarray:
    """Vectors of one length, scaled to unit length."""
    out = np.array([np.asarray(r, float) for r in rows])
    out /= np.abs(out).max(axis=1, keepdims=True)  # no overflow in the squares
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def by_size(embeddings: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, unit vectors) for each number of components in a batch."""
    size = embeddings.map(len).to_numpy()
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        yield at, unit(embeddings.iloc[at])


def projected(embeddings: pd.Series, axes: np.ndarray) -> np.ndarray:
    """Projections on the axes; components beyond those of the axes count as none,
    which makes no distance longer either."""
    out = np.zeros((len(embeddings), axes.shape[1]))
    for at, x in by_size(embeddings):
        n = min(x.shape[1], len(axes))
        out[at] = x[:, :n] @ axes[:n]
    return out


def _moments(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    total = np.zeros((width, width + 1))
    for b in batches:
        for _, x in by_size(b["embedding"]):
            x = x[:, :width]
            n = x.shape[1]
            total[:n, :n] += x.T @ x
            total[:n, width] += x.sum(axis=0)
    yield pd.DataFrame({"i": np.arange(width), "m": list(total)})


def principal_axes(distinct: DataFrame, width: int, leading: int) -> np.ndarray:
    """width x leading, from sums over all distinct vectors; what reaches the
    driver has the size of the covariance matrix."""
    parts = distinct.select("embedding").mapInPandas(partial(_moments, width=width), "i int, m array<double>")
    rows = parts.select("i", F.posexplode("m").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).collect()
    m, n = np.zeros((width, width + 1)), distinct.count()
    for i, j, x in rows:
        m[i, j] = x
    mean = m[:, width] / n
    values, axes = np.linalg.eigh(m[:, :width] / n - np.outer(mean, mean))
    return np.ascontiguousarray(axes[:, np.argsort(-values)[:leading]])


def _project(batches: Iterator[pd.DataFrame], axes: np.ndarray, eps: float) -> Iterator[pd.DataFrame]:
    for b in batches:
        p = projected(b["embedding"], axes)
        out = b[["vec_id", "copies", "embedding"]].copy()
        out["size"] = out["embedding"].map(len).astype(np.int32)
        cells = np.floor(p / eps).astype(np.int32)
        for d in range(axes.shape[1]):
            out[f"c{d}"] = cells[:, d]
        yield out


def _cut(batches: Iterator[pd.DataFrame], axes: np.ndarray, block: int | None) -> Iterator[pd.DataFrame]:
    """One sorted partition -> its blocks, each of vectors of one length."""
    from pyspark import TaskContext
    place, at, rest = TaskContext.get().partitionId(), 0, None

    def made(b):
        nonlocal at
        p, size = projected(b["embedding"], axes), float(len(b["embedding"].iloc[0]))
        out = pd.DataFrame({
            "part": [place], "nr": [at], "ids": [b["vec_id"].to_numpy()], "copies": [b["copies"].to_numpy()],
            "vectors": [np.concatenate([np.asarray(v, float) for v in b["embedding"]]).tobytes()],
            "lo": [np.append(p.min(axis=0), size)], "hi": [np.append(p.max(axis=0), size)]})
        at += 1
        return out

    for b in chain(batches, [None]):
        rest = b if rest is None else rest if b is None else pd.concat([rest, b], ignore_index=True)
        while rest is not None and len(rest):
            size = int(rest["size"].iloc[0])
            same = int((rest["size"] == size).sum())  # sorted by size
            most = block or max(1, BLOCK_BYTES // (8 * size))
            if b is not None and same == len(rest) < most:
                break
            yield made(rest.iloc[:min(most, same)])
            rest = rest.iloc[min(most, same):]


def blocks(distinct: DataFrame, axes: np.ndarray, eps: float, block: int | None = None) -> DataFrame:
    """(block, ids, copies, vectors, lo, hi), numbered along the sequence, which
    is ordered by length first. The boxes have the length as their last axis."""
    spark = distinct.sparkSession
    size = distinct.agg(F.sum(F.size("embedding") * F.lit(8).cast("long"))).first()[0] or 0
    # a block each, nearly
    ranges = max(1, -(-distinct.count() // block) if block else -(-size // BLOCK_BYTES))
    cells = [f"c{d}" for d in range(axes.shape[1])]
    laid = distinct.mapInPandas(
        partial(_project, axes=axes, eps=eps),
        "vec_id long, copies long, embedding array<double>, size int, " + ", ".join(f"{c} int" for c in cells))
    order = ["size", *cells, "vec_id"]
    cut = checkpoint(laid.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInPandas(
        partial(_cut, axes=axes, block=block),
        "part int, nr int, ids array<long>, copies array<long>, vectors binary, lo array<double>, hi array<double>"))
    # one row a partition
    before, offsets = 0, []
    for part, n in cut.groupBy("part").agg(F.count("*")).orderBy("part").collect():
        offsets.append((part, before))
        before += n
    if not offsets:
        return cut.withColumn("block", F.lit(0).cast("long")).drop("part", "nr")
    known = spark.createDataFrame(offsets, "part int, before long")
    return cut.join(F.broadcast(known), "part").withColumn("block", F.col("before") + F.col("nr")).drop("part", "nr", "before")


def near_blocks(boxes: DataFrame, n: int, dims: int, eps: float, fanout: int = FANOUT) -> DataFrame:
    """(a, b), a <= b: the block pairs whose boxes are at most ``eps`` apart,
    found by splitting interval pairs from the root down."""
    spark = boxes.sparkSession
    depth = levels(n, fanout)
    lohi = [f(F.col(k)[d]).alias(f"{k}{d}") for d in range(dims) for k, f in (("lo", F.min), ("hi", F.max))]
    pairs = spark.createDataFrame([(0, 0)], "a long, b long")
    step = F.sequence(F.lit(0), F.lit(fanout - 1))
    for level in range(depth - 1, -1, -1):
        box = boxes.groupBy(F.expr(f"block div {fanout ** level}").alias("at")).agg(*lohi)
        parts = pairs.select(F.col("a"), F.col("b"), F.explode(step).alias("i")).select(
            (F.col("a") * fanout + F.col("i")).alias("a"), "b", F.explode(step).alias("j")).select(
            "a", (F.col("b") * fanout + F.col("j")).alias("b")).where("a <= b")
        x = box.select(F.col("at").alias("a"), *[F.col(c).alias(f"x_{c}") for c in box.columns if c != "at"])
        y = box.select(F.col("at").alias("b"), *[F.col(c).alias(f"y_{c}") for c in box.columns if c != "at"])
        gap = sum(F.pow(F.greatest(F.col(f"x_lo{d}") - F.col(f"y_hi{d}"), F.col(f"y_lo{d}") - F.col(f"x_hi{d}"), F.lit(0.0)), 2)
                  for d in range(dims))
        pairs = parts.join(x, "a").join(y, "b").where(gap <= eps * eps).select("a", "b")
    return pairs


class Side:
    """A loaded block with what bounds its cosines: projections, lengths left over
    (raised a little, for rounding), and both of each leaf as boxes."""

    def __init__(self, ids, copies, vectors: bytes, axes: np.ndarray):
        self.ids, self.copies = np.asarray(ids, np.int64), np.asarray(copies, np.int64)
        self.vectors = unit(np.frombuffer(vectors, float).reshape(len(self.ids), -1))
        n = min(self.vectors.shape[1], len(axes))
        self.seen = self.vectors[:, :n] @ axes[:n]
        rest = np.sqrt(np.maximum(0.0, 1.0 - (self.seen * self.seen).sum(axis=1)) + 1e-12)
        self.rest = rest + 1e-9
        self.starts = range(0, len(self.ids), LEAF)
        box = np.column_stack([self.seen, rest])
        self.low = np.minimum.reduceat(box, list(self.starts))
        self.high = np.maximum.reduceat(box, list(self.starts))


def leaf_pairs(x: Side, y: Side, same: bool, eps: float):
    """(leaf of x, leaf of y) that are not provably further apart than eps: halves
    of the two sequences of leaves are paired, and provably distant pairs dropped."""
    def box(side, lo, hi):
        return side.low[lo:hi].min(axis=0), side.high[lo:hi].max(axis=0)

    todo = [(0, len(x.starts), 0, len(y.starts))]
    while todo:
        a, b, c, d = todo.pop()
        if same and d <= a:
            continue
        (xl, xh), (yl, yh) = box(x, a, b), box(y, c, d)
        gap = np.maximum(0.0, np.maximum(xl - yh, yl - xh))
        if (gap * gap).sum() > (eps + 1e-6) ** 2:
            continue
        if b - a == 1 and d - c == 1:
            yield a, c
        elif b - a >= d - c:
            m = (a + b) // 2
            todo += [(a, m, c, d), (m, b, c, d)]
        else:
            m = (c + d) // 2
            todo += [(a, b, c, m), (a, b, m, d)]


def pair_links(x: Side, y: Side, same: bool, threshold: float) -> tuple[pd.DataFrame, dict]:
    """Links between two blocks: (node, links, other), a row for each vector that
    has any: their number, and a vector of the same piece; and how many pairs
    of leaves, and of vectors, were looked at."""
    x_links, y_links = np.zeros(len(x.ids), np.int64), np.zeros(len(y.ids), np.int64)
    # labels: the positions in x, then those in y (one set if it is one block)
    shift = 0 if same else len(x.ids)
    label = np.arange(shift + len(y.ids))
    edges, looked = [], {"leaves": 0, "compared": 0}
    eps = math.sqrt(max(0.0, 2 - 2 * threshold))
    for k, m in leaf_pairs(x, y, same, eps):
        if same and m < k:
            continue
        looked["leaves"] += 1
        lo, other = x.starts[k], y.starts[m]
        p, q = slice(lo, lo + LEAF), slice(other, other + LEAF)
        bound = x.seen[p] @ y.seen[q].T + x.rest[p, None] * y.rest[None, q]
        i, j = np.nonzero(bound >= threshold - 1e-9)
        if same and k == m:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        looked["compared"] += len(i)
        if 16 * len(i) > bound.size:
            cos = (x.vectors[p] @ y.vectors[q].T)[i, j]
        else:
            cos = np.einsum("ij,ij->i", x.vectors[lo + i], y.vectors[other + j])
        i, j = i + lo, j + other
        near = cos >= threshold
        for n in np.flatnonzero(np.abs(cos - threshold) < 1e-12):  # rounding may decide: sum with one rounding
            near[n] = math.fsum(x.vectors[i[n]] * y.vectors[j[n]]) >= threshold
        i, j = i[near], j[near]
        np.add.at(x_links, i, y.copies[j])
        np.add.at(x_links if same else y_links, j, x.copies[i])
        edges.append((i, j + shift))
        if sum(len(e[0]) for e in edges) > 1 << 20:
            _settle(label, edges)
            edges = []
    _settle(label, edges)
    nodes = x.ids if same else np.concatenate([x.ids, y.ids])
    links = x_links if same else np.concatenate([x_links, y_links])
    some = links > 0
    return pd.DataFrame({"node": nodes[some], "links": links[some], "other": nodes[label[some]]}), looked


def _settle(label: np.ndarray, edges: list) -> None:
    """Lowers labels until both ends of every edge have the same one."""
    if not edges:
        return
    i, j = (np.concatenate(e) for e in zip(*edges))
    while True:
        a, b = label[i], label[j]
        if (a == b).all():
            return
        low = np.minimum(a, b)
        for at in (a, b):
            np.minimum.at(label, at, low)
        while (label[label] != label).any():
            label[:] = label[label]


def _join(group: pd.DataFrame, axes: np.ndarray, threshold: float) -> pd.DataFrame:
    """One block pair: two rows, or one of a block with itself."""
    sides = [Side(r.ids, r.copies, r.vectors, axes) for r in group.sort_values("side").itertuples(index=False)]
    return pair_links(sides[0], sides[-1], len(sides) == 1, threshold)[0]


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, leading: int = LEADING,
                    block: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row.

    Vectors link with a cosine of ``threshold`` or more in double precision.
    Every row is a vector of its own, so n_links counts repeated rows too.
    Vectors that are null, empty, zero or hold null or non-finite components,
    and rows with a null vec_id, link with nothing: they have no links and are
    their own component (kept; null id: null component and kept). Vectors of
    different length never link. Other columns are ignored. An empty table
    gives an empty result.
    """
    eps = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    distinct = checkpoint(distinct_vectors(vectors))
    width = min(AXES_OF, distinct.agg(F.max(F.size("embedding"))).first()[0] or 1)
    leading = min(leading, width)
    axes = principal_axes(distinct, width, max(leading, min(BOUNDING, width))) if distinct.take(1) else np.eye(width, leading)
    cut = checkpoint(blocks(distinct, axes[:, :leading], eps, block))
    n = cut.count()
    pairs = near_blocks(cut.select("block", "lo", "hi"), n, leading + 1, eps)
    sides = pairs.select("a", "b", F.col("a").alias("block"), F.lit(0).alias("side")).union(
        pairs.where("a <> b").select("a", "b", F.col("b").alias("block"), F.lit(1).alias("side")))
    # the blocks of a pair are shuffled once, to the pair
    met = cut.select("block", "ids", "copies", "vectors").join(sides, "block")
    found = checkpoint(met.groupBy("a", "b").applyInPandas(
        lambda g: _join(g, axes, threshold), "node long, links long, other long"))
    comp = connected_components(found.select("node", "other"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    label = (distinct.select("k", F.col("vec_id").alias("node"), "copies").join(links, "node", "left")
             .join(comp, "node", "left")
             .select("k", F.coalesce("component", "node").alias("component"),
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    out = keyed(vectors).select("vec_id", "k").join(label, "k", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return out.select("vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
                      component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
