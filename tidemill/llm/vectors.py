"""Embedding near-dedup with a forest of random-projection trees."""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, materialize


@dataclass
class _Node:
    """A split by a direction: below `low` goes left, above `high` right, between goes to both."""

    direction: np.ndarray
    low: float
    high: float
    left: "_Node | int"
    right: "_Node | int"


def grow(sample: np.ndarray, rows: int, leaf: int, spill: float, rng: np.random.Generator, least: int = 32) -> _Node | int:
    """A tree for `rows` rows of which sample is a sample: splits until a node should hold at most leaf rows.

    A node is split along a random direction at the sample's median; the middle `spill` share goes both ways. A node
    with fewer than `least` of the sample is not split here: near_vectors splits such leaves again on their own rows.
    """
    if rows <= leaf or len(sample) < least:
        return 0
    a, b = sample[rng.integers(len(sample), size=2)]
    direction = a - b if np.any(a != b) else rng.standard_normal(sample.shape[1])
    direction = direction + rng.standard_normal(len(direction)) * np.linalg.norm(direction) / np.sqrt(len(direction)) * 0.5
    along = sample @ direction
    low, high = np.quantile(along, [0.5 - spill / 2, 0.5 + spill / 2])
    part = int(rows * (0.5 + spill / 2)) + 1
    halves = (sample[along <= high], sample[along >= low])
    if min(len(sample) - len(h) for h in halves) < len(sample) // 8:  # ties: the split would part nothing
        return 0
    return _Node(direction, float(low), float(high), *(grow(h, part, leaf, spill, rng, least) for h in halves))


def leaves_of(tree: _Node | int, x: np.ndarray, rows: np.ndarray, name: np.uint64, out: list[tuple[np.ndarray, np.uint64]]) -> None:
    """Appends (rows, leaf name) for each leaf that holds some of the rows."""
    if not len(rows):
        return
    if not isinstance(tree, _Node):
        out.append((rows, name))
        return
    along = x[rows] @ tree.direction
    with np.errstate(over="ignore"):
        leaves_of(tree.left, x, rows[along <= tree.high], name * np.uint64(2), out)
        leaves_of(tree.right, x, rows[along >= tree.low], name * np.uint64(2) + np.uint64(1), out)


def usable(vec, label):
    """Rows that may link: a label, and a vector with finite components, not all zero."""
    return label.isNotNull() & vec.isNotNull() & (F.size(vec) > 0) & F.coalesce(F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False)) & F.coalesce(F.exists(vec, lambda v: v != 0), F.lit(False))


def _roots(close: np.ndarray) -> np.ndarray:
    """The first row of each row's component, by breadth-first search over a symmetric matrix."""
    root = np.full(len(close), -1)
    root[~close.any(axis=1)] = np.flatnonzero(~close.any(axis=1))
    for i in range(len(close)):
        if root[i] < 0:
            front = np.array([i])
            while len(front):
                root[front] = i
                front = np.flatnonzero(close[front].any(axis=0) & (root < 0))
    return root


def _unit(vs) -> np.ndarray:
    m = np.array(list(vs), np.float64)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _leaf_name(tree: int, node: int, path: int) -> int:
    """A leaf's number, the tree in its upper bits."""
    mixed = pd.util.hash_array(np.array([np.uint64(node & (1 << 64) - 1) ^ np.uint64(path * 0x9E3779B97F4A7C15 & (1 << 64) - 1)], np.uint64))[0]
    return tree << 55 | int(mixed) >> 9


_LEFT = "point long, tree int, node long, last boolean, leaf int, spill double, parent long"


def forest_leaves(points: DataFrame, trees: int, leaf: int, copies: float, sample: int, rounds: int = 12, seed: int = 11) -> DataFrame:
    """From (point, label, v) to (point, node): the leaves that each point is in, over all trees of its label.

    A label of n points has leaves of min(leaf, n / 4), 16 at least, so all but the smallest labels grow trees. The
    share that a split sends both ways is what keeps a point's mean number of leaves in one tree at `copies`,
    whatever the depth. A node of at most `sample` points is split to its leaves in one task, on all of them. A larger
    one is split as far as a sample of about that many of its own points bears, its points are dealt out by tasks of
    bounded size, and those of its leaves that are still too large are split again in the next round; each round is a
    table in the shared folder. A node that a round hardly made smaller holds ties and stays.
    """
    n = points.groupBy("label").agg(F.count("*").alias("n"))
    size = F.least(F.lit(leaf), F.greatest(F.lit(16), F.ceil(F.col("n") / 4))).cast("int")
    n = n.withColumn("leaf", size).withColumn("spill", F.log(F.lit(copies)) / F.greatest(F.ceil(F.log2(F.col("n") / F.col("leaf"))), F.lit(1)))
    todo = points.select("point", "label", "v").join(n, "label").select("point", "v", F.lit(-1).alias("tree"), F.xxhash64("label").alias("node"), "n", "leaf", "spill")

    def grown(pdf: pd.DataFrame) -> dict[int, _Node | int]:
        """The trees of a group of rows of one node; the name of the node seeds them."""
        tree, node, rows, limit, spill = (pdf[c].iloc[0] for c in ("tree", "node", "n", "leaf", "spill"))
        m = _unit(pdf.sort_values("point")["v"])
        return {t: grow(m, int(rows), int(limit), float(spill), np.random.default_rng([seed, t, int(node) & (1 << 63) - 1])) for t in (range(trees) if tree < 0 else [int(tree)])}

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"tree": pdf["tree"].iloc[:1], "node": pdf["node"].iloc[:1], "forest": [pickle.dumps(grown(pdf))]})

    def dealt(pdf: pd.DataFrame, forest: dict[int, _Node | int], last: bool) -> pd.DataFrame:
        m, point, node = _unit(pdf["v"]), pdf["point"].to_numpy(), int(pdf["node"].iloc[0])
        made = []
        for t, tree in forest.items():
            out: list[tuple[np.ndarray, np.uint64]] = []
            leaves_of(tree, m, np.arange(len(m)), np.uint64(1), out)
            made += [pd.DataFrame({"point": point[rows], "tree": t, "node": _leaf_name(t, node, int(path))}) for rows, path in out]
        return pd.concat(made).assign(last=last, leaf=int(pdf["leaf"].iloc[0]), spill=float(pdf["spill"].iloc[0]), parent=int(pdf["n"].iloc[0]))

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        return dealt(pdf, grown(pdf), True)

    def place(pdf: pd.DataFrame, fitted: pd.DataFrame) -> pd.DataFrame:
        return dealt(pdf, pickle.loads(fitted["forest"].iloc[0]), False) if len(pdf) else pd.DataFrame(columns=["point", "tree", "node", "last", "leaf", "spill", "parent"])

    done: list[DataFrame] = []
    for _ in range(rounds):
        small = todo.where(F.col("n") <= sample).groupBy("tree", "node").applyInPandas(whole, _LEFT)
        big = todo.where(F.col("n") > sample)
        chance = F.pmod(F.xxhash64("point", F.lit(seed)), F.lit(1 << 20)) < (1 << 20) * sample / F.col("n")
        fitted = big.where(chance).groupBy("tree", "node").applyInPandas(fit, "tree int, node long, forest binary")
        salts = F.ceil(F.col("n") / sample).cast("int")
        big = big.withColumn("salt", F.pmod(F.xxhash64("point", F.lit(-seed)), salts).cast("int"))
        fitted = fitted.join(big.groupBy("tree", "node").agg(F.max(salts).alias("s")), ["tree", "node"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
        keys = ("tree", "node", "salt")
        large = big.groupBy(*keys).cogroup(fitted.groupBy(*keys)).applyInPandas(place, _LEFT)
        made = materialize(small.unionByName(large), "leaves")
        sizes = made.where("not last").groupBy("node").agg(F.count("*").alias("n"), F.max("leaf").alias("leaf"), F.max("parent").alias("parent"))
        again = materialize(sizes.where("n > 2 * leaf and n < 0.9 * parent").select("node", "n"), "again")
        done.append(made.join(again.select("node"), "node", "left_anti").select("point", "node"))
        if again.isEmpty():
            break
        todo = made.join(again, "node").join(points.select("point", "v"), "point").select("point", "v", "tree", "node", "n", "leaf", "spill")
    else:
        raise RuntimeError(f"leaves did not get small in {rounds} rounds")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _shared(earlier: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which of the rows share one of their earlier leaves with which row; -1 stands for none."""
    out = np.zeros((len(rows), len(earlier)), bool)
    for a in range(earlier.shape[1]):
        mine = earlier[rows, a]
        for b in range(earlier.shape[1]):
            if len(have := np.flatnonzero(mine >= 0)):
                out[have] |= mine[have, None] == earlier[None, :, b]
    return out


def near_vectors(
    vectors: DataFrame, cosine: float = 0.93, trees: int = 6, leaf: int = 2048, copies: float = 1.35, sample: int = 4096, block: int = 2048, seed: int = 11,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """All rows of vectors with n_links, component_id and kept.

    Rows link within a label if their cosine, in double precision, is at least `cosine`. Equal vectors of a label
    are one point with a weight; all of its rows link. Points are compared within the leaves of a forest of `trees`
    trees a label, of at most about `leaf` points each (see forest_leaves). A pair is counted in the first leaf that it
    shares, so counts need no list of pairs, and components take one edge a point and leaf. A leaf of more than
    `block` points, which splits could not part, is compared block by block, each pair of blocks a task's group. A
    point is in about trees * copies leaves, however many points there are; what is missed is missed by all trees.

    Null, zero and non-finite vectors and null labels link with nothing. Rows that share an id are separate rows
    but one node of a component. Vectors of another length than others link with those of their own length.
    Columns of vectors with the added names are replaced.
    """
    own = [c for c in vectors.columns if c not in ("n_links", "component_id", "kept", "_point")]
    v = F.col(vector).cast("array<double>")
    unit = F.transform(v, lambda x: x + F.lit(0.0))
    x = vectors.select(*own, F.when(usable(v, F.col(label)), F.xxhash64(F.col(label).cast("string"), unit)).alias("_point"))
    points = x.where("_point is not null").groupBy("_point").agg(F.count("*").alias("weight"), F.min(vec_id).cast("long").alias("least"), F.any_value(label).cast("string").alias("label"), F.any_value(v).alias("v"))
    points = materialize(points.select(F.col("_point").alias("point"), "weight", "least", F.concat_ws(":", "label", F.size("v")).alias("label"), "v"), "points")
    leaves = forest_leaves(points, trees, leaf, copies, sample, seed=seed).groupBy("point").agg(F.array_sort(F.collect_set("node")).alias("leaves"))
    placed = materialize(points.select("v", "point", "weight", "least").join(leaves, "point"), "placed")
    full = materialize(placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1"), "leaves")
    rows = placed.select("*", F.explode("leaves").alias("leaf")).join(full, "leaf")
    rows = rows.withColumn("leaves", F.filter("leaves", lambda y: y < F.col("leaf")))  # pairs that share one of these are counted there
    rows = rows.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).withColumn("own", F.expr("cast(pmod(xxhash64(point), blocks) as int)"))
    # A block meets every block: the pair (lower, higher) of blocks is a group.
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = pdf["lo"].iloc[0], pdf["hi"].iloc[0]
        pdf = pdf.sort_values("point", kind="stable")
        m = np.array(pdf["v"].tolist(), np.float64)
        norm = np.linalg.norm(m, axis=1)
        own, weight, point = pdf["own"].to_numpy(), pdf["weight"].to_numpy(), pdf["point"].to_numpy()
        earlier = np.full((len(m), max(map(len, pdf["leaves"]))), -1, np.int64)
        for i, y in enumerate(pdf["leaves"]):
            earlier[i, : len(y)] = y
        links, close = np.zeros(len(m), np.int64), np.zeros((len(m), len(m)), bool)
        for s in range(0, len(m), 256):
            near = (m[s : s + 256] @ m.T) / (norm[s : s + 256, None] * norm[None, :]) >= cosine
            near &= (own[s : s + 256, None] == lo) & (own[None, :] == hi) | (own[s : s + 256, None] == hi) & (own[None, :] == lo)
            near &= point[s : s + 256, None] != point[None, :]
            close[s : s + 256] = near
            some = np.flatnonzero(near.any(axis=1))
            near[some] &= ~_shared(earlier, s + some)
            links[s : s + 256] += near @ weight
        root = _roots(close)
        return pd.DataFrame({"point": point, "links": links, "root": point[root]})

    found = rows.select("leaf", "lo", "hi", "own", "point", "weight", "v", "leaves").groupBy("leaf", "lo", "hi").applyInPandas(compare, "point long, links long, root long")
    found = materialize(found.where("links > 0 or point <> root"), "found")
    links = found.groupBy("point").agg(F.sum("links").alias("links"))
    label_of = components(found.where("point <> root").select(F.col("point").alias("a"), F.col("root").alias("b")))
    named = points.select("point", "weight", "least").join(links, "point", "left").join(label_of.withColumnRenamed("node", "point").withColumnRenamed("label", "group"), "point", "left")
    named = named.withColumn("group", F.coalesce("group", "point"))
    first = named.groupBy("group").agg(F.min("least").alias("component_id"))
    named = named.join(first, "group").select(F.col("point").alias("_point"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"), "component_id")
    x = x.join(named, "_point", "left")
    x = x.withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long"))).withColumn("component_id", F.coalesce("component_id", F.col(vec_id).cast("long")))
    return x.select(*own, "n_links", "component_id", F.col(vec_id).eqNullSafe(F.col("component_id")).alias("kept"))
