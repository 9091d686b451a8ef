"""Embedding near-dedup: all pairs above a cosine threshold, by dual traversal of cover trees.

On unit vectors a cosine threshold is a distance, so the triangle inequality holds. Vectors of one
label are one task to begin with. A task too large for one tree is split, level by level: centres
are drawn from it, those close to another are left out, and each vector goes to the cell of its
nearest centre. Two vectors of different cells can only link if both lie within the threshold of the
plane half-way between the centres, so a vector is sent to the other cells that it can reach in this
sense, and to no more. Vectors within half the threshold of a centre are a ball, all linked with each
other, whose links are counted without comparing any. What a split does not make smaller is dealt
into parts by hash, each part against each.
A small enough task builds the cover tree of its cell or of its two sides: nested levels with halving
radii, where each node knows the radius that covers all below it. The trees are traversed together,
node pairs beyond the bounds are pruned, and node pairs that lie within the threshold as a whole are
accepted without comparing their members. All other pairs are compared in double precision. Equal
vectors count as one with a weight. Tasks return link counts and a spanning forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shedlake.llm.common import stored
from shedlake.llm.components import components

COSINE = 0.98
BLOCK = 2048  # vectors in one tree
CELLS = 64  # cells that one split aims at, at most
SLICE = 16384  # rows that are dealt to the cells of their task together
LEVELS = 20  # splits below each other; what is too large after them is dealt by hash
SHRUNK = 0.75  # a task that has more of its parent's rows than this is dealt by hash
LEAF = 32
_SLACK = 1e-6  # bounds give way by this much, which rounding stays far below; comparisons do not


def _unit(values: object) -> bytes | None:
    """The vector at length 1 in double precision; None if it has no direction."""
    if values is None or len(values) == 0:
        return None
    vector = np.array([np.nan if v is None else v for v in values], dtype=np.float64)
    top = np.abs(vector).max()
    if not np.isfinite(top) or top == 0:
        return None
    vector /= top
    return (vector / np.sqrt(vector @ vector)).tobytes()


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


@dataclass
class _Node:
    centre: int
    radius: float
    members: np.ndarray
    children: list[_Node] = field(default_factory=list)


def cover_tree(vectors: np.ndarray) -> _Node:
    """Nested levels over unit vectors; a node's centre stays a centre below it, radii halve."""

    def build(members: np.ndarray, reach: np.ndarray, scale: float) -> _Node:
        node = _Node(int(members[0]), float(reach.max()), members)
        if len(members) <= LEAF or node.radius < 1e-7:
            return node
        scale = min(scale, node.radius) / 2
        left, away = members, reach
        while len(left):
            near = away <= scale
            near[0] = True  # the next centre, at distance 0 but for rounding
            node.children.append(build(left[near], away[near], scale))
            left = left[~near]
            if len(left):
                away = _distance(vectors[left] @ vectors[left[0]])
        return node

    everything = np.arange(len(vectors))
    return build(everything, _distance(vectors @ vectors[0]), 2.0)


class _Links:
    """What a traversal finds: link counts of members, by weight, and a spanning forest."""

    def __init__(self, weights: np.ndarray) -> None:
        self.weights, self.counts = weights, np.zeros(len(weights), np.int64)
        self.parent, self.forest = list(range(len(weights))), []

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> None:
        ra, rb = self.root(a), self.root(b)
        if ra != rb:
            self.parent[rb] = ra
            self.forest.append((a, b))

    def all_pairs(self, left: np.ndarray, right: np.ndarray, same: bool) -> None:
        self.counts[left] += self.weights[right].sum()
        if same:
            self.counts[left] -= self.weights[left]
        else:
            self.counts[right] += self.weights[left].sum()
        for m in [*left[1:].tolist(), *([] if same else right.tolist())]:
            self.join(int(left[0]), m)

    def where(self, left: np.ndarray, right: np.ndarray, linked: np.ndarray, same: bool) -> None:
        if same:
            linked = np.triu(linked, 1)
        if not linked.any():
            return
        np.add.at(self.counts, left, linked @ self.weights[right])
        np.add.at(self.counts, right, linked.T @ self.weights[left])
        rows, columns = np.nonzero(linked)
        for a, b in zip(left[rows].tolist(), right[columns].tolist(), strict=True):
            self.join(a, b)


def traverse(vectors: np.ndarray, first: _Node, second: _Node, links: _Links, cosine: float) -> None:
    """Find all pairs of members of two trees, or within one, whose cosine reaches the threshold."""
    limit = float(_distance(np.array(cosine)))
    todo = [(first, second)]
    while todo:
        p, q = todo.pop()
        same = p is q
        if not p.children and not q.children:
            links.where(p.members, q.members, vectors[p.members] @ vectors[q.members].T >= cosine, same)
            continue
        ps, qs = p.children or [p], q.children or [q]
        centres_p, centres_q = (vectors[[n.centre for n in side]] for side in (ps, qs))
        apart = _distance(centres_p @ centres_q.T)
        spread = np.add.outer([n.radius for n in ps], [n.radius for n in qs])
        near = apart <= spread + limit + _SLACK
        if same:
            near = np.triu(near)
        inside = apart + spread <= limit - _SLACK
        single = np.logical_and.outer([len(n.members) == 1 for n in ps], [len(n.members) == 1 for n in qs])
        if same:
            inside[np.diag_indices(len(ps))] = [2 * n.radius <= limit - _SLACK for n in ps]
            single[np.diag_indices(len(ps))] = False
        alone = near & single & ~inside
        if alone.any():
            rows, columns = np.nonzero(alone)
            a, b = centres_p[rows], centres_q[columns]
            hit = np.einsum("ij,ij->i", a, b) >= cosine
            for r, c in zip(rows[hit].tolist(), columns[hit].tolist(), strict=True):
                links.all_pairs(ps[r].members, qs[c].members, False)
        for r, c in np.argwhere(near & ~alone).tolist():
            if inside[r, c]:
                links.all_pairs(ps[r].members, qs[c].members, same and r == c)
            else:
                todo.append((ps[r], qs[c]))


def _search(cosine: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Rows (task, side, node, weight, unit), sorted, to counts (a, null, n) and links (a, b, 0)."""

    def solve(rows: list[tuple[int, str, int, bytes]]) -> pd.DataFrame:
        vectors = np.frombuffer(b"".join(r[3] for r in rows)).reshape(len(rows), -1)
        cut = sum(r[0] < 2 for r in rows)
        links = _Links(np.array([r[2] for r in rows], np.int64))
        if rows[0][0] == 0:
            tree = cover_tree(vectors)
            traverse(vectors, tree, tree, links, cosine)
        elif 0 < cut < len(rows):
            left, right = cover_tree(vectors[:cut]), cover_tree(vectors[cut:])
            _move(right, cut)
            traverse(vectors, left, right, links, cosine)
        hit = np.flatnonzero(links.counts)
        found = [(rows[i][1], None, int(links.counts[i])) for i in hit.tolist()]
        found += [(rows[a][1], rows[b][1], 0) for a, b in links.forest]
        return pd.DataFrame(found, columns=["a", "b", "n"])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, rows = None, []
        for batch in batches:
            for t, *row in batch[["task", "side", "node", "weight", "unit"]].itertuples(index=False, name=None):
                if t != task:
                    if rows:
                        yield solve(rows)
                    task, rows = t, []
                rows.append(tuple(row))
        if rows:
            yield solve(rows)

    return search


def _move(node: _Node, by: int) -> None:
    todo = [node]
    while todo:
        n = todo.pop()
        n.centre += by
        n.members = n.members + by
        todo.extend(n.children)


def _net(units: list[bytes], apart: float) -> np.ndarray:
    """The vectors that are further than ``apart`` from all kept before them."""
    kept: list[np.ndarray] = []
    for vector in map(np.frombuffer, units):
        if not kept or float(_distance(np.stack(kept) @ vector).min()) > apart:
            kept.append(vector)
    return np.stack(kept)


def _cells(centres: np.ndarray, vectors: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cell of each vector, whether it lies in the ball of its centre, and which cells it can reach."""
    cosines = vectors @ centres.T
    own = cosines.argmax(axis=1)
    nearest = cosines[np.arange(len(own)), own]
    between = _distance(centres @ centres.T)
    reach = nearest[:, None] - cosines <= limit * between[own] + _SLACK
    reach[np.arange(len(own)), own] = False
    return own, _distance(nearest) <= limit / 2 - _SLACK, reach


def _targets(task: str, side: int, own: int, ball: bool, others: list[int]) -> list[tuple[str, int]]:
    """Tasks and sides below ``task`` that take a vector.

    Every two vectors that had to be compared in ``task`` and can link meet in exactly one of them. The
    name of a ball ends in ``o``.
    """
    if side == 0:
        found = [(f"{task}|{min(own, j)}-{max(own, j)}", 1 if own < j else 2) for j in others]
        if ball:
            return [*found, (f"{task}|{own}o", 0), (f"{task}|{own}x", 1)]
        return [*found, (f"{task}|{own}", 0), (f"{task}|{own}x", 2)]
    if side == 1:
        found = [(f"{task}|{own}>{j}", 1) for j in others]
        return [*found, *([(f"{task}|{own}o", 1), (f"{task}|{own}x", 1)] if ball else [(f"{task}|{own}y", 1)])]
    found = [(f"{task}|{j}>{own}", 2) for j in others]
    inner = [(f"{task}|{own}o", 2)] if ball else [(f"{task}|{own}x", 2)]
    return [*found, *inner, (f"{task}|{own}y", 2)]


def _deal(limit: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Rows sorted by task and slice, centres first (side -1), to rows of the tasks below."""

    def frames(task: str, centres: np.ndarray, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        vectors = np.frombuffer(b"".join(rows["unit"])).reshape(len(rows), -1)
        own, ball, reach = _cells(centres, vectors, limit)
        found: list[tuple] = []
        columns = ["task", "side", "node", "weight", "unit", "above"]
        for n, (side, node, weight, unit, count) in enumerate(
            rows[["side", "node", "weight", "unit", "n"]].itertuples(index=False, name=None)
        ):
            for name, at in _targets(task, side, int(own[n]), bool(ball[n]), np.flatnonzero(reach[n]).tolist()):
                found.append((name, at, node, weight, unit, count))
            if len(found) >= 4096:
                yield pd.DataFrame(found, columns=columns)
                found = []
        if found:
            yield pd.DataFrame(found, columns=columns)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, drawn, centres = None, [], None
        for batch in batches:
            for key, rows in batch.groupby(["task", "slice"], sort=False):
                if key != held:
                    held, drawn, centres = key, [], None
                here = rows["side"] < 0
                drawn += rows.loc[here, "unit"].tolist()
                rows = rows[~here]
                if len(rows):
                    if centres is None:  # a task that drew none is one cell, of one centre in all its slices
                        axis = np.eye(1, len(rows["unit"].iloc[0]) // 8).tobytes()
                        centres = _net(drawn or [axis], limit / 2)
                    yield from frames(key[0], centres, rows)

    return deal


def _by_hash(rows: DataFrame, block: int) -> DataFrame:
    """Rows of tasks that a split does not make smaller, dealt into parts, each part against each."""
    across = F.col("side") > 0
    mine = F.when(F.col("side") == 1, F.col("n_1")).when(F.col("side") == 2, F.col("n_2")).otherwise(F.col("n"))
    theirs = F.when(F.col("side") == 1, F.col("n_2")).when(F.col("side") == 2, F.col("n_1")).otherwise(F.col("n"))
    many = lambda n: F.ceil(n * 2 / block).cast("long")
    parted = rows.withColumn("part", F.pmod(F.xxhash64("node"), many(mine))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), many(theirs) - 1))
    )
    first = F.when(across, F.when(F.col("side") == 1, F.col("part")).otherwise(F.col("other")))
    first = F.coalesce(first, F.least("part", "other"))
    second = F.when(across, F.when(F.col("side") == 1, F.col("other")).otherwise(F.col("part")))
    second = F.coalesce(second, F.greatest("part", "other"))
    side = F.when(across, F.col("side")).when(F.col("part") == F.col("other"), 0)
    return parted.select(
        F.concat_ws("|", "task", first, second).alias("task"),
        side.when(F.col("part") < F.col("other"), 1).otherwise(2).alias("side"),
        "node", "weight", "unit",
    )


def _tasks(nodes: DataFrame, limit: float, block: int) -> tuple[DataFrame, DataFrame]:
    """Rows (task, side, node, weight, unit) of tasks that fit one tree, and those of balls."""
    columns = ["task", "side", "node", "weight", "unit"]
    rows = nodes.select(  # a hash, so that no label looks like the name of a task below another
        F.md5("group").alias("task"), F.lit(0).alias("side"), "node", "weight", "unit", F.lit(2**62).alias("above")
    )
    ready, balls = [], []
    for level in range(LEVELS + 1):
        sides = [F.count_if(F.col("side") == i).alias(f"n_{i}") for i in range(3)]
        sizes = rows.groupBy("task").agg(F.count(F.lit(1)).alias("n"), *sides, F.max("above").alias("above"))
        shrunk = (F.col("n") <= F.col("above") * SHRUNK) & F.lit(level < LEVELS)
        way = (
            F.when((F.col("n_0") == 0) & (F.least("n_1", "n_2") == 0), "none")  # one side alone
            .when(F.col("task").endswith("o") & F.lit(level > 0), "ball")
            .when(F.greatest("n_0", "n_1", "n_2") <= block, "tree")
            .when(shrunk, "split")
            .otherwise("hash")
        )
        # One row per task, stored: where they are few Spark broadcasts them by their size, and moves no vector.
        sizes = stored(sizes.withColumn("way", way).drop("above"), f"vector-sizes-{level}")
        sized = rows.drop("above").join(sizes, "task")
        ways = {r.way for r in sizes.select("way").distinct().collect()}
        if "ball" in ways:
            balls.append(sized.where("way = 'ball'").select(*columns))
        if "hash" in ways:
            ready.append(_by_hash(sized.where("way = 'hash'"), block))
        if "tree" in ways:
            ready.append(sized.where("way = 'tree'").select(*columns))
        if "split" not in ways:
            break
        split = sized.where("way = 'split'").withColumn("slices", F.ceil(F.col("n") / SLICE))
        share = F.least(F.lit(float(CELLS)), F.ceil(F.col("n") / block) + 1) / F.col("n")
        drawn = split.where(F.pmod(F.xxhash64(F.lit(level), "node"), F.lit(2**31)) < share * F.lit(float(2**31)))
        sent = ["task", "slice", "side", "node", "weight", "unit", "n"]
        centres = drawn.withColumn("side", F.lit(-1)).withColumn(
            "slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))
        )
        dealt = split.withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices")))
        rows = stored(
            dealt.select(*sent)
            .unionByName(centres.select(*sent))
            .repartition("task", "slice")
            .sortWithinPartitions("task", "slice", "side", "node")
            .mapInPandas(_deal(limit), "task string, side int, node string, weight long, unit binary, above long"),
            f"vector-level-{level}",
        )
    nothing = rows.select(*columns).limit(0)
    return reduce(DataFrame.unionByName, ready, nothing), reduce(DataFrame.unionByName, balls, nothing)


def _ball_links(balls: DataFrame) -> DataFrame:
    """Counts (a, null, n) and links (a, b, 0) of balls, in which every vector links with every other one."""
    balls = stored(balls.drop("unit"), "vector-balls")
    weight = lambda side: F.sum(F.when(F.col("side") == side, F.col("weight"))).alias(f"w_{side}")
    totals = stored(
        balls.groupBy("task").agg(weight(0), weight(1), weight(2), F.min("node").alias("first")), "vector-ball-totals"
    )
    told = balls.join(totals, "task")
    n = F.when(F.col("side") == 0, F.col("w_0") - F.col("weight")).when(F.col("side") == 1, F.col("w_2")).otherwise(F.col("w_1"))
    none = F.lit(None).cast("string")
    return told.select(F.col("node").alias("a"), none.alias("b"), n.alias("n")).unionByName(
        told.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"), F.lit(0).cast("long").alias("n"))
    )


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Units (vec_id, node), link counts of nodes (node, n, weight) and links (a, b) of a spanning forest.

    A node is a distinct unit vector of a label. Vectors are linked if their labels are equal and not
    null and their cosine reaches the threshold; vectors of different length never are.
    """

    def units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            unit = [_unit(v) for v in batch["embedding"]]
            yield pd.DataFrame({"vec": batch["vec"], "no_id": batch["no_id"], "label": batch["label"], "unit": unit})

    # A null among longs would make doubles of them in pandas, and large ids would be rounded.
    raw = vectors.select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(0).cast("long")).alias("vec"),
        F.col("vec_id").cast("long").isNull().alias("no_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    united = raw.mapInPandas(units, "vec long, no_id boolean, label string, unit binary").withColumn(
        "vec_id", F.when(~F.col("no_id"), F.col("vec"))
    )
    group = F.concat_ws(":", F.octet_length("unit"), "label")
    usable = F.col("label").isNotNull() & F.col("unit").isNotNull()
    node = F.when(usable, F.sha2(F.concat(F.col("unit"), F.encode(group, "UTF-8")), 256))
    rows = stored(united.select("vec_id", group.alias("group"), node.alias("node"), "unit"), "units")
    nodes = stored(
        rows.where("node IS NOT NULL")
        .groupBy("node", "group", "unit")
        .agg(F.count(F.lit(1)).alias("weight")),
        "vector-nodes",
    )
    tasks, balls = _tasks(nodes, float(np.sqrt(2 - 2 * cosine)), block)
    compared = (
        tasks.repartition("task")
        .sortWithinPartitions("task", "side", "node")
        .mapInPandas(_search(cosine), "a string, b string, n long")
    )
    found = stored(compared.unionByName(_ball_links(balls)), "vector-links")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    weighed = nodes.select("node", "weight").join(counts, "node", "left").select(
        "node", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "weight"
    )
    return rows.select("vec_id", "node"), weighed, found.where("b IS NOT NULL").select("a", "b")


def dedup_vectors(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors``.

    Null labels, null, empty or zero vectors and vectors with null or non-finite components link with
    nothing. Repeated rows are vectors of their own, linked with each other if they can link at all. A
    null vec_id counts as larger than any other: it names a component only if no other member can, and
    is never kept. Further columns are ignored.
    """
    rows, counts, links = near_vectors(vectors, cosine, block)
    groups = components(links)
    named = counts.join(groups, "node", "left").select(
        "node", "n", "weight", F.coalesce("component", "node").alias("component")
    )
    holders = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("vec_id").alias("least"))
    least = (
        named.select("node", "component").join(holders, "node").groupBy("component").agg(F.min("least").alias("component_id"))
    )
    least = stored(least, "vector-components")  # read back, so that the join below can be split at a large component
    told = named.join(least, "component").select("node", "n", "weight", "component_id")
    result = rows.join(told, "node", "left").select(
        "vec_id",
        F.coalesce(F.col("n") + F.col("weight") - 1, F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return result.withColumn("kept", _same("vec_id", "component_id"))


def _same(a: str, b: str) -> Column:
    return F.coalesce(F.col(a) == F.col(b), F.lit(False))
