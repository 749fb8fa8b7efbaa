import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm.queries import QUERIES
from tickloom.llm.whitening import clusters, eigenpairs, refine, whitened_rows

SCHEMA = "vec_id long, embedding array<float>"


def table(spark, rows):
    """With columns of names that the operator uses itself."""
    return spark.createDataFrame(rows, SCHEMA).withColumns({
        n: F.lit(7) for n in ("x", "dim", "n", "whitened", "component", "label")})


def whole(vectors):
    return np.floor(64 * np.array(vectors, dtype=np.float32).astype(np.float64)).astype(np.int64) + 1_000_000


def brute(vectors, components=32):
    """Plain double-precision whitening of the whole table in memory; signs are free."""
    x = whole(vectors)
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    cov = sum(np.outer(row, row) for row in centred) / n
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1], vecs[:, ::-1]
    k = min(components, x.shape[1])
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return deviation, centred @ vecs[:, :k] / np.sqrt(values[:k]), values[:k] / np.trace(cov)


def compare(found, ids, vectors, components=32):
    deviation, whitened, explained = brute(vectors, components)
    k = whitened.shape[1]
    found = found.set_index(["vec_id", "component"]).sort_index()
    assert len(found) == len(ids) * k
    got = found["whitened"].to_numpy().reshape(len(ids), k)
    order = np.argsort(ids)
    want = whitened[order]
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * signs).max() < 1e-6
    assert found["deviation"].to_numpy().reshape(len(ids), k)[:, 0].tolist() == [deviation[i] for i in order]
    assert np.allclose(found["explained"].to_numpy().reshape(len(ids), k)[0], explained, rtol=1e-9)
    assert (found["n"] == len(ids)).all() and (found["identity_error"] < 1e-9).all()
    return found


def test_small_tables_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5)) * 3).tolist()
    rows = list(enumerate(vectors))
    odd = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0]), (902, [float("nan")] * 5), (903, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (904, [])]
    found = whitened_rows(table(spark, rows + odd)).toPandas().astype({"deviation": object})
    compare(found, list(range(300)), vectors)
    # Fewer components than dimensions.
    found = whitened_rows(table(spark, rows), 2).toPandas()
    compare(found, list(range(300)), vectors, 2)


def test_huge_means_do_not_cancel(spark):
    rng = np.random.default_rng(8)
    vectors = (rng.integers(-40, 40, size=(200, 3)) / 64 + np.array([4096.0, -8192.0, 0.0])).tolist()
    compare(whitened_rows(table(spark, list(enumerate(vectors)))).toPandas(), list(range(200)), vectors)


def test_lengths_apart_ties_nulls_and_empty(spark):
    rows = [(1, [1.0]), (1, [1.0]), (None, [3.0]), (5, [1.0, 2.0]), (6, [3.0, 6.0]), (7, [2.0, 4.0]), (8, [0.0, 0.0])]
    found = whitened_rows(table(spark, rows)).toPandas()
    one = found[found["n"] == 3]
    assert sorted(one["vec_id"].fillna(-1)) == [-1, 1, 1]
    assert np.isclose(np.abs(one["whitened"]).sum(), 2 * np.sqrt(0.5) + np.sqrt(2))
    two = found[found["n"] == 4]
    # The second direction has no variance.
    assert len(two) == 8 and two[two["component"] == 2]["whitened"].isna().all()
    assert (two[two["component"] == 2]["explained"] == 0).all() and (two["identity_error"] < 1e-12).all()
    assert whitened_rows(table(spark, [])).count() == 0
    assert whitened_rows(table(spark, [(1, None)])).count() == 0
    alone = whitened_rows(table(spark, [(2**60 + 1, [1.0, 2.0])])).toPandas()
    assert alone["vec_id"].tolist() == [2**60 + 1] * 2 and alone["whitened"].isna().all() and (alone["deviation"] == 0).all()


def test_large_entries_stay_exact(spark):
    rows = [(1, [2.0**50, 1.0]), (2, [-(2.0**50), 2.0]), (3, [0.0, 2.0**53])]
    found = whitened_rows(table(spark, rows)).toPandas()
    assert sorted(found["vec_id"].unique()) == [1, 2]
    assert {int(d) for d in found["deviation"]} == {(2 * 64 * 2**50) ** 2 + 64**2}


def plain_error(matrix, values, vectors):
    wide = matrix.astype(np.longdouble)
    return float(np.abs(wide @ vectors - vectors * values).max()), float(np.abs(vectors.T @ vectors - np.eye(len(matrix))).max())


@pytest.mark.parametrize("spectrum", [
    np.arange(1, 33) / 32,
    np.concatenate([[1.0], np.full(6, 0.5), 0.5 + 1e-7 * np.arange(1, 7), 0.25 + 1e-12 * np.arange(5), 1e-6 * np.arange(1, 8)]),
    np.concatenate([np.full(10, 0.75), np.full(10, 0.75 + 1e-15), [0.1]]),
])
def test_refinement_reaches_extended_precision(spectrum):
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.normal(size=(len(spectrum),) * 2))[0].astype(np.longdouble)
    q = q + q @ (np.eye(len(q)) - q.T @ q) / 2
    matrix = (q * spectrum) @ q.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = refine(matrix)
    residual, orthogonal = plain_error(matrix, values, vectors)
    assert residual < 1e-17 and orthogonal < 1e-17
    assert np.abs(np.sort(values) - np.sort(spectrum)).max() < 1e-17
    # float32 alone is ten digits worse.
    start = np.linalg.eigh(matrix.astype(np.float32))[1]
    assert np.abs(start.T @ matrix.astype(np.float64) @ start - np.diag(np.diag(start.T @ matrix @ start))).max() > 1e-9


def test_vectors_of_near_eigenvalues_are_told_apart():
    """float32 cannot see gaps of 1e-9; the refined vectors equal the exact ones."""
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(12, 12)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q + q @ (np.eye(12) - q.T @ q) / 2
    spectrum = 0.5 + 1e-9 * np.arange(12)
    _, vectors = refine((q * spectrum) @ q.T)
    overlap = np.abs(q.T @ vectors).astype(np.float64)
    assert np.abs(np.sort(overlap, axis=0)[-1] - 1).max() < 1e-15 and np.sort(overlap, axis=0)[-2].max() < 1e-8


def test_clusters_and_zero_matrix():
    assert [g.tolist() for g in clusters(np.array([3.0, 1.0, 1.05, 2.0]), 0.1)] == [[1, 2], [3], [0]]
    values, vectors = eigenpairs({(0, 0): 0, (0, 1): 0, (1, 1): 0}, 4, 2)
    assert values.tolist() == [0, 0] and vectors.tolist() == np.eye(2).tolist()
    assert eigenpairs({(0, 0): 9}, 4, 1)[0].tolist() == [2.25]


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    found = QUERIES["op11_whitening"](spark, folder)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(found.dtypes)["deviation"] == "bigint" and dict(found.dtypes)["component"] == "int"
    ok = [v is not None and np.isfinite(np.array(v, dtype=float)).all() for v in rows["embedding"]]
    compare(found.toPandas(), rows["vec_id"][ok].tolist(), rows["embedding"][ok].tolist())
