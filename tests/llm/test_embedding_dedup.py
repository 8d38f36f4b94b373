import numpy as np

from finmart.llm import embedding_dedup
from finmart.llm.embedding_dedup import embedding_components
from finmart.llm.hnsw import Graph

SHAPE = "vec_id long, embedding array<float>, label int, n long"


def clustered(seed=0):
    random = np.random.default_rng(seed)
    rows = []
    for label in range(3):
        for _ in range(25):
            base = random.normal(size=16)
            for _ in range(int(random.integers(1, 12))):
                rows.append((label, base + random.normal(scale=0.04, size=16) * np.linalg.norm(base) / 4))
    return [(i, [float(np.float32(x)) for x in v], label, 0) for i, (label, v) in enumerate(rows)]


def expected(rows):
    links, parent = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(rows):
        for b in rows[i + 1:]:
            if a[2] == b[2]:
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.98:
                    links[a[0]] += 1
                    links[b[0]] += 1
                    p, q = root(a[0]), root(b[0])
                    parent[max(p, q)] = min(p, q)
    return {i: (links[i], root(i)) for i in links}


def test_matches_brute_force_over_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARD_ROWS", 40)
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 30)
    rows = clustered()
    found = {r.vec_id: (r.n_links, r.component_id) for r in embedding_components(spark.createDataFrame(rows, SHAPE)).collect()}
    assert found == expected(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1, 0), (2, [2.0, 0.0], 1, 0), (2, [2.0, 0.0], 1, 0), (3, [1.0, 0.0], 2, 0), (4, [1.0, 0.0], None, 0),
        (5, None, 1, 0), (6, [0.0, 0.0], 1, 0), (7, [nan, 1.0], 1, 0), (8, [inf, 1.0], 1, 0), (9, [None, 1.0], 1, 0),
        (None, [1.0, 0.0], 1, 0), (10, [1.0, 0.0, 0.0], 1, 0), (11, [], 1, 0),
    ]
    frame = spark.createDataFrame(rows, SHAPE)
    found = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_components(frame).collect()), key=str)
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)]
    assert found == sorted([(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (None, 0, None, False), *alone], key=str)
    assert embedding_components(spark.createDataFrame([], SHAPE)).collect() == []


def test_graph_recall_on_large_dense_group():
    random = np.random.default_rng(1)
    points = np.concatenate((random.normal(size=(1500, 32)), np.ones((700, 32)) + random.normal(scale=0.05, size=(700, 32))))
    points = (points / np.linalg.norm(points, axis=1, keepdims=True)).astype(np.float32)[random.permutation(2200)]
    exact = points @ points.T >= 0.98
    found = Graph(points).within(points, 0.98, 32)
    assert sum(exact[i, x].sum() for i, x in enumerate(found)) >= 0.999 * exact.sum()


def test_graphs_of_one_and_two_nodes():
    for n in (1, 2):
        found = Graph(np.eye(4, dtype=np.float32)[:n]).within(np.eye(4, dtype=np.float32)[:n], 0.98, 32)
        assert [list(x) for x in found] == [[i] for i in range(n)]
