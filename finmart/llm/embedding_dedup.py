"""Embedding near-duplicates by small-world graphs per shard.

Equal vectors of one label are one node first. The nodes of a label are dealt to shards by a
hash of their id; every shard builds one graph, whose beam is widened until an audit against
brute force passes. Every node then queries every shard of its label, in blocks, so that a task
holds one shard and one block. Neighbours are verified by the cosine in double precision; a
task reports counts and a spanning forest of its links, never all pairs of a group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from finmart.llm.hnsw import GROUND_NEIGHBOURS, NEIGHBOURS, Graph
from finmart.llm.tables import Scratch, components, long_id

COSINE = 0.98
#: Nodes of a shard and queries of a block, at most about; both bound a task's memory.
SHARD_ROWS = 8192
BLOCK_ROWS = 2048
#: First beam of a search, queries audited per shard, neighbours of each, recall that passes.
BEAM = 64
AUDITED = 64
AUDIT_NEIGHBOURS = 8
AUDIT_RECALL = 0.98
#: Single precision may lose this much before the exact check.
SLACK = 1e-5

GRAPHS = "label string, width int, shard int, blocks int, ids binary, members binary, vectors binary, links binary, levels int, beam int"
FOUND = "a long, b long, n long"


def audited_beam(graph: Graph, queries: np.ndarray) -> int:
    """Smallest doubling of BEAM whose recall of the nearest neighbours passes."""
    n, k = len(graph.vectors), min(AUDIT_NEIGHBOURS, len(graph.vectors))
    exact = np.partition(-(queries @ graph.vectors.T), k - 1, axis=1)[:, :k]
    least = -exact.max(axis=1) - 1e-6
    beam = BEAM
    while beam < n:
        _, sims = graph.search(queries, beam)
        hits = np.minimum((sims >= least[:, None]).sum(axis=1), k).sum()
        if hits >= AUDIT_RECALL * k * len(queries):
            break
        beam *= 2
    return beam


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten(), dtype=np.float64).reshape(-1, width)


def _build(table: pa.Table) -> pa.Table:
    table = table.take(pc.sort_indices(table, sort_keys=[("place", "ascending"), ("id", "ascending")]))
    width = table["width"][0].as_py()
    vectors = _matrix(table["vector"], width)
    graph = Graph(_unit(vectors))
    picked = np.unique(np.linspace(0, len(vectors) - 1, min(AUDITED, len(vectors))).astype(np.int64))
    beam = audited_beam(graph, graph.vectors[picked])
    links = np.concatenate([level.reshape(-1) for level in graph.links])
    row = {
        "label": table["label"][0].as_py(), "width": width, "shard": table["shard"][0].as_py(), "blocks": table["blocks"][0].as_py(),
        "ids": table["id"].to_numpy().astype(np.int64).tobytes(), "members": table["members"].to_numpy().astype(np.int64).tobytes(),
        "vectors": vectors.tobytes(), "links": links.astype(np.int32).tobytes(), "levels": len(graph.links), "beam": int(beam),
    }
    return pa.Table.from_pylist([row], schema=_GRAPH_SCHEMA)


_GRAPH_SCHEMA = pa.schema([
    ("label", pa.string()), ("width", pa.int32()), ("shard", pa.int32()), ("blocks", pa.int32()), ("ids", pa.binary()),
    ("members", pa.binary()), ("vectors", pa.binary()), ("links", pa.binary()), ("levels", pa.int32()), ("beam", pa.int32())])


def _restore(row: dict) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    vectors = np.frombuffer(row["vectors"], dtype=np.float64).reshape(-1, row["width"])
    graph = Graph.__new__(Graph)
    graph.vectors = np.ascontiguousarray(_unit(vectors), dtype=np.float32)
    flat, n, graph.links = np.frombuffer(row["links"], dtype=np.int32), len(vectors), []
    at = 0
    for level in range(row["levels"]):
        width = GROUND_NEIGHBOURS if level == 0 else NEIGHBOURS
        graph.links.append(flat[at:at + n * width].reshape(n, width))
        at += n * width
    return graph, np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(row["members"], dtype=np.int64), vectors


def _query(graphs: pa.Table, block: pa.Table) -> pa.Table:
    """Counts and a spanning forest of the links between one shard and one block of queries."""
    if not graphs.num_rows or not block.num_rows:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    row = graphs.to_pylist()[0]
    graph, ids, members, vectors = _restore(row)
    keys = block["id"].to_numpy().astype(np.int64)
    queries = _matrix(block["vector"], row["width"])
    units, whole = _unit(queries), _unit(vectors)
    near = graph.within(units.astype(np.float32), COSINE - SLACK, row["beam"])
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    left, right, counts = [], [], []
    for i, candidates in enumerate(near):
        candidates = candidates[ids[candidates] != keys[i]]
        linked = candidates[whole[candidates] @ units[i] >= COSINE]
        if not len(linked):
            continue
        left.append(int(keys[i]))
        right.append(None)
        counts.append(int(members[linked].sum()))
        for other in ids[linked].tolist():
            a, b = root(int(keys[i])), root(other)
            if a != b:
                parent[max(a, b)] = min(a, b)
                left.append(int(keys[i]))
                right.append(other)
                counts.append(0)
    return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64()), "n": pa.array(counts, pa.int64())})


def embedding_components(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                         label: str = "label") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors``.

    Two vectors link if their labels are equal and not NULL, their lengths are equal and their
    cosine is COSINE or more. NULL, empty and zero vectors, those with a NULL or non-finite
    component, and rows without label or id link with nothing; the latter have a NULL component
    and are not kept. Rows that repeat an id are one node of a component, and each row counts
    as one linked vector. Other columns are not read; an empty table gives no rows.
    """
    scratch = Scratch(vectors.sparkSession, "embeddings")
    rows = vectors.select(
        long_id(F.col(vec_id)).alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(embedding).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
        & F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False)))
    nodes = scratch.keep(
        rows.where(sound).groupBy("label", "vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("members"))
        .withColumn("width", F.size("vector")), "nodes")
    sizes = nodes.groupBy("label", "width").agg(F.count("*").alias("size")).select(
        F.col("label").alias("_l"), F.col("width").alias("_w"),
        F.ceil(F.col("size") / SHARD_ROWS).cast("int").alias("shards"), F.ceil(F.col("size") / BLOCK_ROWS).cast("int").alias("blocks"))
    dealt = nodes.join(sizes, (F.col("label") == F.col("_l")) & (F.col("width") == F.col("_w"))).drop("_l", "_w")
    place = F.xxhash64("id", F.lit("place"))
    graphs = scratch.keep(
        dealt.withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards")).cast("int")).withColumn("place", place)
        .groupBy("label", "width", "shard").applyInArrow(_build, GRAPHS), "graphs")
    asked = dealt.withColumn("block", F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks")).cast("int")).select(
        "label", "width", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "block", "id", "vector")
    served = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = ("label", "width", "shard", "block")
    found = scratch.keep(served.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_query, FOUND), "found")
    scratch.drop("graphs")

    groups = components(found.where(F.col("b").isNotNull()).select("a", "b"), scratch, "groups")
    counts = found.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("others"))
    placed = (
        nodes.join(counts, "id", "left").join(groups, F.col("id") == F.col("node"), "left")
        .select(F.col("label").alias("_label"), F.col("vector").alias("_vector"),
                (F.coalesce("others", F.lit(0)) + F.col("members") - 1).alias("n_links"),
                F.coalesce("component", "id").alias("part"))
    )
    joined = rows.withColumn("sound", sound).join(
        placed, F.col("sound") & (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector")), "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("part", "vec_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
