import numpy as np
import pytest
from pyspark.sql import functions as F

from askloom.operators.knn import ann_join, knn_join, read_cells, recall_at_k, write_cells
from askloom.session import scratch_path

NAMES = dict(query_key="id", query_vec="v", index_key="id", index_vec="v")


def frame(spark, vectors, start=0):
    rows = [(i + start, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "id long, v array<float>")


def brute(queries, index, k):
    q = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    i = index / np.linalg.norm(index, axis=1, keepdims=True)
    scores = np.round(q @ i.T, 9)
    return {
        (row, int(col), rank + 1)
        for row in range(len(q))
        for rank, col in enumerate(np.argsort(-scores[row], kind="stable")[:k])
    }


def found(df):
    return {(r.query_key, r.index_key, r.rank) for r in df.collect()}


def clustered(rng, n, centres, spread=0.05, dim=8):
    points = centres[rng.integers(0, len(centres), n)] + spread * rng.standard_normal((n, dim))
    return points.astype(np.float32).astype(np.float64)


@pytest.mark.parametrize("options", [{}, dict(cells=12), dict(cells=12, probes=3, block=17)])
def test_exact_on_clusters_with_copies(spark, options):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((10, 8))
    index = clustered(rng, 400, centres)
    index[100:240] = index[100]  # a third of the index is one vector
    queries = np.concatenate([clustered(rng, 60, centres), np.repeat(index[100:101], 30, axis=0)])
    got = knn_join(frame(spark, queries), frame(spark, index), k=7, **NAMES, **options)
    assert found(got) == brute(queries, index, 7)


def test_exact_on_scattered_vectors(spark):
    rng = np.random.default_rng(5)
    index = rng.standard_normal((300, 16)).astype(np.float32).astype(np.float64)
    queries = rng.standard_normal((50, 16)).astype(np.float32).astype(np.float64)
    got = knn_join(frame(spark, queries), frame(spark, index), k=4, cells=20, **NAMES)
    assert found(got) == brute(queries, index, 4)


def test_fewer_rows_than_k(spark):
    index = np.eye(3)
    got = knn_join(frame(spark, index), frame(spark, index), k=5, cells=2, **NAMES)
    assert found(got) == brute(index, index, 5)


def test_rows_without_direction_take_no_part(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [1.0, 1.0])],
        "id long, v array<float>",
    )
    got = knn_join(df, df, k=3, **NAMES)
    assert {(r.query_key, r.index_key) for r in got.collect()} == {(1, 1), (1, 5), (5, 5), (5, 1)}


def test_empty_sides(spark):
    some, none = frame(spark, np.eye(2)), frame(spark, np.eye(2)).where("id < 0")
    for a, b in [(some, none), (none, some), (none, none)]:
        got = knn_join(a, b, k=2, **NAMES)
        assert got.count() == 0
        assert got.columns == ["query_key", "index_key", "score", "rank"]


def test_text_keys_and_columns(spark):
    index = frame(spark, np.eye(3)).select(F.concat(F.lit("k"), "id").alias("id"), "v",
                                           F.col("id").alias("extra"))
    queries = frame(spark, np.eye(3)[:2]).withColumn("ask", F.lit("x"))
    got = knn_join(queries, index, k=1, query_cols=["ask"], index_cols=["extra"], **NAMES)
    assert got.columns == ["query_key", "ask", "index_key", "extra", "score", "rank"]
    assert {(r.query_key, r.index_key, r.extra, r.ask) for r in got.collect()} == {
        (0, "k0", 0, "x"), (1, "k1", 1, "x")
    }


def test_stored_cells(spark):
    rng = np.random.default_rng(9)
    index = clustered(rng, 200, rng.standard_normal((6, 8)))
    df = frame(spark, index)
    path = scratch_path(spark, "cells")
    write_cells(df, path, key="id", vec="v", cells=6)
    cells = read_cells(spark, path)
    assert cells.sizes.sum() == 200
    got = knn_join(df, df, k=3, cells=cells, **NAMES)
    assert found(got) == brute(index, index, 3)


def test_ann_finds_near_neighbours_of_clusters(spark):
    rng = np.random.default_rng(11)
    index = clustered(rng, 500, rng.standard_normal((10, 8)))
    df = frame(spark, index)
    truth = knn_join(df, df, k=3, **NAMES)
    got = ann_join(df, df, k=3, cells=10, probes=3, **NAMES)
    assert recall_at_k(got, truth).first().recall > 0.95
    every = ann_join(df, df, k=3, cells=10, probes=10, **NAMES)
    assert found(every) == found(truth)


def test_vectors_of_other_length_are_an_error(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0])], "id long, v array<float>")
    with pytest.raises(Exception, match="vectors differ in length"):
        knn_join(df, df, k=1, **NAMES).count()
