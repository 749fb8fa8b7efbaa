import numpy as np
from pyspark.sql import functions as F

from tickloom.llm.hnsw import Graph, build_index, exact_cosines, search, unit_rows
from tickloom.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumn("shard", F.lit(1)).withColumn("ids", F.lit(2))


def brute(rows, queries, k):
    good = [(i, np.array(v)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    by_id = dict(good)
    out = {}
    for q in queries:
        if q in by_id:
            others = [(i, v) for i, v in good if i != q and len(v) == len(by_id[q])]
            if others:
                s = exact_cosines(np.stack([v for _, v in others]), by_id[q])
                out[q] = sorted((-x, i) for x, (i, _) in zip(s, others, strict=True))[:k]
    return out


def test_graph_recall_and_shape():
    units = unit_rows(np.random.default_rng(4).normal(size=(3000, 16)))
    graph = Graph.built(units, seed=1)
    assert all(len(layer) == 3000 and layer.max() < 3000 for layer in graph.layers) and len(graph.layers) > 1
    asked = units[::30]
    truth = np.argsort(-(asked @ units.T), axis=1)[:, :10]
    found = graph.nearest(asked, 10, 96)
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(found, truth, strict=True)]) > 0.95


def test_small_table_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(30)] + [(200, [2.0, 4.0, 6.0, 8.0])]
    rows += [(300, None), (301, []), (302, [0.0] * 4), (303, [1.0, None, 0.0, 0.0]), (304, [float("nan"), 1.0, 0.0, 0.0]),
             (305, [float("inf"), 0.0, 0.0, 1.0]), (400, [1.0, 2.0]), (401, [2.0, 1.0]), (402, [1e200, 1e200]), (403, [1e-300, 0.0])]
    vectors = table(spark, rows + [rows[0]])
    queries = [0, 1, 100, 129, 200, 300, 302, 304, 400, 402]
    found = search(build_index(vectors, keep=6, rows_per_shard=25), vectors.where(F.col("vec_id").isin(queries)), k=5).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    want = brute(rows, queries, 5)
    assert got.keys() == want.keys()
    for q, pairs in want.items():
        assert [i for _, i in got[q]] == [i for _, i in pairs], q
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in pairs], atol=1e-15)


def test_empty_table(spark):
    empty = table(spark, [])
    assert search(build_index(empty, keep=6), empty, k=5).count() == 0


def test_recall_on_the_table(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r[0], list(r[1])) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    truth = brute(rows, [i for i, _ in rows if i % 50 == 0], 5)
    found = {}
    for r in QUERIES["op7_small_world"](spark, folder).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = sum(len(found[q] & {i for _, i in pairs}) for q, pairs in truth.items())
    assert hits / sum(map(len, truth.values())) >= 0.95
