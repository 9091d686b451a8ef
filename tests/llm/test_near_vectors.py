import math

import numpy as np
import pytest
from shedlake.llm import near_vectors as near_vectors_module
from shedlake.llm.near_vectors import cover_tree, dedup_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, node string, unit string, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "x", "y", 1) for i, v, y in rows], SCHEMA)


def plain(rows, cosine=0.98):
    """All pairs, and the closure over their links."""
    def usable(v):
        return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)

    units = [np.array(v, np.float32).astype(float) if y is not None and usable(v) else None for _, v, y in rows]
    units = [None if u is None else u / np.linalg.norm(u) for u in units]
    links = {n: set() for n in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a):
            if units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= cosine:
                links[a].add(b)
                links[b].add(a)
    out = []
    for n, (vec_id, _, _) in enumerate(rows):
        reached, todo = {n}, [n]
        while todo:
            for m in links[todo.pop()] - reached:
                reached.add(m)
                todo.append(m)
        ids = [rows[m][0] for m in reached if rows[m][0] is not None]
        least = min(ids) if ids else None
        out.append((vec_id, len(links[n]), least, vec_id is not None and vec_id == least))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def clustered(count, size, seed, spread=0.06, labels=3):
    random = np.random.default_rng(seed)
    middles = random.normal(size=(count, 16))
    rows = []
    for n in range(count * size):
        v = middles[n % count] + spread * random.normal(size=16) * random.integers(0, 4)
        rows.append((int(n * 7 % 10007), [float(np.float32(x)) for x in v], int(n % count % labels)))
    return rows


@pytest.mark.parametrize("block", [4, 64, 2048])
def test_pairs_are_exact_whatever_the_blocks(spark, block):
    rows = clustered(12, 25, seed=block)
    rows += [(20_000 + i, rows[3][1], rows[3][2]) for i in range(9)]  # exact copies
    assert result(dedup_vectors(frame(spark, rows), block=block)) == plain(rows)


def test_what_does_not_shrink_is_dealt_by_hash(spark, monkeypatch):
    rows = clustered(5, 30, seed=2, labels=1)
    monkeypatch.setattr(near_vectors_module, "SHRUNK", 0.2)
    assert result(dedup_vectors(frame(spark, rows), block=10)) == plain(rows)
    monkeypatch.setattr(near_vectors_module, "LEVELS", 0)
    assert result(dedup_vectors(frame(spark, rows), block=10)) == plain(rows)


@pytest.mark.parametrize("size", [7, 40])
def test_levels_and_slices_lose_no_pair(spark, monkeypatch, size):
    """Cells that are split again, by few centres, with the rows of a task in several slices."""
    rows = clustered(9, 40, seed=size, spread=0.03, labels=2)
    monkeypatch.setattr(near_vectors_module, "CELLS", 3)
    monkeypatch.setattr(near_vectors_module, "SLICE", size)
    monkeypatch.setattr(near_vectors_module, "SHRUNK", 0.99)
    assert result(dedup_vectors(frame(spark, rows), block=8)) == plain(rows)


def rows_and_tasks(spark, rows, block):
    """Numbers of nodes, rows of tasks, tasks, and rows of balls."""
    data = [(f"{y}", f"{n:06d}", np.array(v) / np.linalg.norm(v)) for n, (_, v, y) in enumerate(rows)]
    nodes = spark.createDataFrame(
        [(g, n, bytearray(u.tobytes()), 1) for g, n, u in data], "group string, node string, unit binary, weight long"
    )
    tasks, balls = near_vectors_module._tasks(nodes, 0.2, block)
    return len(rows), tasks.count(), tasks.select("task").distinct().count(), balls.count()


def test_tasks_grow_in_proportion_on_clustered_data(spark):
    _, rows_one, tasks_one, _ = rows_and_tasks(spark, clustered(20, 50, seed=4, spread=0.1, labels=1), 50)
    _, rows_four, tasks_four, _ = rows_and_tasks(spark, clustered(80, 50, seed=4, spread=0.1, labels=1), 50)
    assert rows_four < 6 * rows_one and tasks_four < 6 * tasks_one


def test_a_dense_group_costs_its_size(spark):
    """Near copies of one vector are a ball: one row each, not one for every part of the group."""
    n, compared, _, balls = rows_and_tasks(spark, clustered(1, 2000, seed=5, spread=0.005, labels=1), 50)
    assert balls == n and compared == 0


def test_dense_group_is_accepted_as_a_whole(spark):
    rows = clustered(1, 200, seed=9, spread=0.01, labels=1)
    found = result(dedup_vectors(frame(spark, rows), block=50))
    assert found == plain(rows) and all(r[1] == 199 for r in found)


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, [1.0, 0.0], 2), (5, None, 1), (6, [], 1),
        (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (11, [1.0, 0.0, 0.0], 1),
        (None, [1.0, 0.001], 1), (None, [0.0, 1.0], 5), (2, [2.0, 0.0], 1), (12, [1e-38, 0.0], 1), (13, [3e38, 0.0], 1),
        (14, [-0.0, 1.0], 1), (15, [0.0, 1.0], 1),
    ]
    assert result(dedup_vectors(frame(spark, rows))) == plain(rows)


def test_labels_that_look_like_tasks(spark):
    """A label may hold any character, also what names of tasks are made of."""
    some = clustered(4, 30, seed=8, labels=1)
    rows = [(i, v, "a") for i, v, _ in some] + [(30_000 + i, v, f"a|{i % 3}") for i, v, _ in some[:40]]
    rows += [(50_000 + i, v, "no") for i, v, _ in some[:9]]
    texts = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    assert result(dedup_vectors(texts, block=12)) == plain(rows)


def test_empty_table(spark):
    assert dedup_vectors(frame(spark, clustered(1, 2, 1)).limit(0)).count() == 0


def test_tree_covers_and_halves():
    random = np.random.default_rng(0)
    v = random.normal(size=(500, 6))
    v /= np.linalg.norm(v, axis=1, keepdims=True)

    def look(node):
        far = np.sqrt(np.maximum(0, 2 - 2 * v[node.members] @ v[node.centre])).max()
        assert far <= node.radius + 1e-7
        if node.children:
            assert sorted(m for c in node.children for m in c.members) == sorted(node.members)
            assert node.children[0].centre == node.centre
            for c in node.children:
                assert c.radius <= node.radius / 2 + 1e-7
                look(c)

    look(cover_tree(v))


def test_large_ids_stay_beside_a_null_id(spark):
    """9007199254740993 is no double; a null id in its batch must not round it."""
    near = [1.0, 2.0, 3.0]
    rows = [(2**53 + 1, near, 0), (2**53 + 2, near, 0), (None, near, 0), (2**60 + 7, [-3.0, 1.0, 0.0], 0), (2**62 + 1, [], 0)]
    one_batch = frame(spark, rows).coalesce(1)
    assert result(dedup_vectors(one_batch)) == plain(rows)
