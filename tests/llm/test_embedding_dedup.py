import math

import numpy as np
import pytest

from flowlab.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.98):
    """(vec_id, n_links, component_id, kept) of each row by comparing all of them."""
    def usable(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def linked(p, q):
        if p[2] != q[2] or len(p[1]) != len(q[1]):
            return False
        a, b = (np.array(v, np.float32).astype(float) for v in (p[1], q[1]))
        return a @ b / math.sqrt((a @ a) * (b @ b)) >= cosine

    good = sorted({(i, tuple(v), k) for i, v, k in rows if i is not None and k is not None and usable(v)})
    links = {p: [q for q in good if q != p and linked(p, q)] for p in good}
    least = {i: i for i, _, _ in rows}
    while True:
        before = dict(least)
        for p, others in links.items():
            for q in others:
                least[p[0]] = least[q[0]] = min(least[p[0]], least[q[0]])
        if least == before:
            break
    out = []
    for i, v, k in rows:
        n = len(links.get((i, None if v is None else tuple(v), k), ()))
        out.append((i, n, None if i is None else least[i], i is not None and least[i] == i))
    return sorted(out, key=repr)


def clustered(seed, count, size, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(count // 8 + 1, size))
    x = centres[rng.integers(0, len(centres), count)] + spread * rng.normal(size=(count, size))
    return [(i, [float(v) for v in row], int(i % 3)) for i, row in enumerate(x.astype(np.float32))]


@pytest.mark.parametrize("size, spread", [(2, 0.1), (8, 0.05), (8, 0.2), (64, 0.1)])
def test_tree_links_equal_brute_force(size, spread):
    x = np.array([v for _, v, _ in clustered(size, 700, size, spread)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.98
    np.fill_diagonal(near, False)
    weights = np.arange(700) % 3 + 1
    found = E.Found(weights)
    E.traverse(x, E.cover_tree(x), None, 0.98, found)
    assert (found.linked == near @ weights).all()
    across = E.Found(weights)
    a, b = np.arange(300), np.arange(300, 700)
    E.traverse(x, E._shifted(E.cover_tree(x[a]), a), E._shifted(E.cover_tree(x[b]), b), 0.98, across)
    near[:300, :300] = near[300:, 300:] = False
    assert (across.linked == near @ weights).all()


def test_tree_has_halving_levels_that_cover():
    x = np.array([v for _, v, _ in clustered(3, 400, 4, 0.3)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    open_nodes = [E.cover_tree(x)]
    seen = []
    while open_nodes:
        node = open_nodes.pop()
        assert E.distances(x[[node.centre]], x[node.members]).max() <= node.radius + E.SLACK
        if node.children:
            assert sorted(np.concatenate([c.members for c in node.children])) == sorted(node.members)
            apart = E.distances(x[[c.centre for c in node.children]], x[[c.centre for c in node.children]])
            np.fill_diagonal(apart, 9)
            # No centre is within the level's radius of another, and the levels halve.
            level = max(r for r in (2.0 ** -i for i in range(30)) if r < node.radius)
            assert apart.min() > level - E.SLACK and max(c.radius for c in node.children) <= level + E.SLACK
            open_nodes += node.children
        else:
            seen += node.members.tolist()
    assert sorted(seen) == list(range(400))


def test_unprunable_pairs_are_not_visited(monkeypatch):
    """Two far clusters: their nodes are compared once, their members never."""
    rng = np.random.default_rng(0)
    x = np.concatenate([np.eye(16)[i] + 0.02 * rng.normal(size=(200, 16)) for i in (0, 1)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    asked = []
    monkeypatch.setattr(E, "distances", lambda a, b, f=E.distances: asked.append(len(a) * len(b)) or f(a, b))
    a, b = np.arange(200), np.arange(200, 400)
    trees = [E._shifted(E.cover_tree(x[r]), r) for r in (a, b)]
    asked.clear()
    found = E.Found(np.ones(400, np.int64))
    E.traverse(x, *trees, 0.98, found)
    assert sum(asked) <= sum(len(t.children) or 1 for t in trees) ** 2 and not found.linked.any()


@pytest.mark.parametrize("cell", [8, 40, 8192])
def test_query_equals_brute_force(spark, rows, cell):
    data = clustered(5, 240, 8, 0.08)
    data += [(1000 + i, data[0][1], 0) for i in range(60)] + [(5000 + i, data[1][1], 0) for i in range(20)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(E.near_vectors(df, 0.98, cell=cell)) == brute(data)


def test_odd_rows(spark, rows, with_clashes):
    one, near, other = [1.0, 0.0], [1.0, 0.1], [0.0, 1.0]
    data = [(1, one, 1), (2, near, 1), (3, one, 2), (4, one, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1),
            (8, [float("nan"), 1.0], 1), (9, [float("inf"), 1.0], 1), (10, [None, 1.0], 1), (None, one, 1),
            (None, None, None), (2, near, 1), (11, other, 1), (12, [1.0, 0.0, 0.0], 1), (13, [1e30, 1e29], 1),
            (14, [-0.0, 5.0], 1), (15, [0.0, 5.0], 1), (11, near, 3), (16, near, 3), (5, other, 1)]
    df = spark.createDataFrame(data, SCHEMA)
    got = rows(E.near_vectors(df))
    want = brute([(i, None if v is None else [np.float32(x) if x is not None else None for x in v], k) for i, v, k in data])
    assert got == want
    assert rows(E.near_vectors(with_clashes(df.withColumnRenamed("vec_id", "v")).withColumnRenamed("v", "vec_id"))) == got
    assert rows(E.near_vectors(df.limit(0))) == []


def test_a_third_of_all_rows_equal(spark):
    data = [(i, [1.0, 2.0, 3.0], 0) for i in range(3000)] + [r for r in clustered(9, 300, 3, 0.3)]
    data = [(i, v, k) for i, (_, v, k) in enumerate(data)]
    got = {r["vec_id"]: r for r in E.near_vectors(spark.createDataFrame(data, SCHEMA), cell=64).collect()}
    assert len(got) == 3300 and all(got[i]["component_id"] == 0 for i in range(3000))
    assert {got[i]["n_links"] for i in range(3000)} == {got[0]["n_links"]} and got[0]["n_links"] >= 2999
