"""An inverted file over vectors: trained cells on two levels, several cells per vector.

Spherical k-means on a bounded sample gives coarse centroids, and k-means within each coarse cell the fine
ones. Every vector is filed under its ``copies`` nearest cells, so that a neighbour just beyond a border is
found from either side. A search visits the ``probes`` nearest cells of a query. How many
that takes for a wanted recall is measured against exact neighbours and kept with the file.

The number of cells is a parameter and does not follow from the number of rows; a cell of any size
is searched in blocks. What every task holds are the centroids.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from askloom.functions.vectors import dot
from askloom.operators.vectors import key_type, keyed, usable
from askloom.session import cut

#: Vectors that training sees at most, about.
SAMPLE_ROWS = 200_000
#: Queries that the number of probes is chosen on, about.
TRIAL_QUERIES = 256
TARGET_RECALL = 0.93
COARSE, FINE, COPIES = 16, 16, 2
#: Coarse cells in which a vector looks for its cells.
ASSIGN_COARSE = 4


class Centroids(NamedTuple):
    """Unit vectors; cell i lies in the coarse cell ``parent[i]``."""

    coarse: np.ndarray
    fine: np.ndarray
    parent: np.ndarray

    def nearest(self, vectors: np.ndarray, wide: int) -> np.ndarray:
        """Cells of the ``wide`` nearest coarse cells of each vector, nearest first; -1 where there are no more."""
        near = np.argsort(-(vectors @ self.coarse.T), axis=1, kind="stable")[:, :wide]
        members = [np.flatnonzero(self.parent == c) for c in range(len(self.coarse))]
        width = max(map(len, members))
        cells = np.full((len(vectors), near.shape[1] * width), -1)
        scores = np.full(cells.shape, -np.inf)
        for c in np.unique(near):
            row, place = np.nonzero(near == c)
            at = place[:, None] * width + np.arange(len(members[c]))
            cells[row[:, None], at] = members[c]
            scores[row[:, None], at] = vectors[row] @ self.fine[members[c]].T
        return np.take_along_axis(cells, np.argsort(-scores, axis=1, kind="stable"), axis=1)


class Ivf(NamedTuple):
    """``rows`` holds (index_key, vec, cell), a row per copy."""

    rows: DataFrame
    centroids: Centroids
    sizes: np.ndarray
    copies: int
    wide: int
    probes: int


def share_of(df: DataFrame, key: str, rows: int, n: int) -> DataFrame:
    """About ``rows`` of the ``n`` rows of ``df``, the same ones each time."""
    part = min(1.0, rows / max(1, n))
    return df.where(F.pmod(F.xxhash64(key, F.lit(23)), F.lit(1 << 20)) < int(part * (1 << 20)))


def lloyd(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means of a few vectors; starts from farthest points."""
    centroids = vectors[:1]
    for _ in range(min(k, len(vectors)) - 1):
        centroids = np.vstack([centroids, vectors[[(vectors @ centroids.T).max(axis=1).argmin()]]])
    for _ in range(rounds):
        home = (vectors @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, vectors)
        norms = np.linalg.norm(sums, axis=1)
        centroids = np.where(norms[:, None] > 0, sums / np.maximum(norms, 1e-12)[:, None], centroids)
    return centroids


def train_centroids(index: DataFrame, coarse: int, fine: int, n: int, sample_rows: int = SAMPLE_ROWS) -> Centroids:
    """Two levels of centroids from about ``sample_rows`` of the ``n`` rows ``index_key, vec``."""
    square = dot(F.col("vec"), F.col("vec"))
    known = share_of(index, "index_key", sample_rows, n).where((square > 0) & (square < float("inf")))
    sample = cut(known.select("index_key", "vec"))
    points = sample.select(array_to_vector("vec").alias("features"))
    model = KMeans(k=coarse, maxIter=12, seed=1, distanceMeasure="cosine").fit(points)
    top = np.array(model.clusterCenters())
    top = top / np.maximum(np.linalg.norm(top, axis=1), 1e-12)[:, None]

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, vectors = usable(pa.Table.from_batches([batch]))
            if table.num_rows:
                found = (vectors @ top.T).argmax(axis=1).astype(np.int32)
                yield from table.append_column("parent", pa.array(found)).to_batches()

    def split(group: pa.Table) -> pa.Table:
        parent = group["parent"][0].as_py()
        found = lloyd(usable(group.sort_by("index_key"))[1], fine)
        return pa.table({"parent": pa.array([parent] * len(found), pa.int32()), "centroid": pa.array(found.tolist())})

    placed = sample.mapInArrow(home, f"index_key {key_type(index, 'index_key')}, vec array<float>, parent int")
    # One row per cell.
    rows = placed.groupBy("parent").applyInArrow(split, "parent int, centroid array<double>").collect()
    rows = sorted(rows, key=lambda r: (r["parent"], r["centroid"]))
    return Centroids(top, np.array([r["centroid"] for r in rows]), np.array([r["parent"] for r in rows]))


def file_rows(index: DataFrame, centroids: Centroids, copies: int) -> DataFrame:
    """``index_key, vec, cell``: every usable row under its ``copies`` nearest cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, vectors = usable(pa.Table.from_batches([batch]))
            if not table.num_rows:
                continue
            cells = centroids.nearest(vectors, ASSIGN_COARSE)[:, :copies]
            row, column = np.nonzero(cells >= 0)
            out = table.select(["index_key", "vec"]).take(pa.array(row))
            yield from out.append_column("cell", pa.array(cells[row, column].astype(np.int32))).to_batches()

    return index.mapInArrow(run, f"index_key {key_type(index, 'index_key')}, vec array<float>, cell int")


def _places(neighbours: DataFrame, centroids: Centroids) -> np.ndarray:
    """For each ``vec, cells`` (a query and the cells of a true neighbour): the place of the first coarse cell and of
    the first cell among all of the query's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, vectors = usable(pa.Table.from_batches([batch]))
            if not table.num_rows:
                continue
            order = centroids.nearest(vectors, len(centroids.coarse))
            coarse = np.argsort(-(vectors @ centroids.coarse.T), axis=1, kind="stable")
            out = []
            for i, cells in enumerate(table["cells"].to_pylist()):
                place = np.flatnonzero(np.isin(order[i], cells))[0]
                out.append((int(np.flatnonzero(coarse[i] == centroids.parent[order[i][place]])[0]), int(place)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in zip(*out)], names=["wide", "place"])

    # At most k rows per trial query.
    found = neighbours.select("vec", "cells").mapInArrow(run, "wide int, place int").collect()
    return np.array([(r["wide"], r["place"]) for r in found]).reshape(-1, 2)


def choose_probes(neighbours: DataFrame, centroids: Centroids, target: float) -> tuple[int, int]:
    """(wide, probes): the fewest coarse cells and cells that hold ``target`` of the true neighbours."""
    places = _places(neighbours, centroids)
    if not len(places):
        return len(centroids.coarse), len(centroids.fine)
    # A quarter of what may be missed is left to the upper level.
    wide = int(np.quantile(places[:, 0], 1 - (1 - target) / 4, method="higher")) + 1
    within = np.sort(places[places[:, 0] < wide, 1])
    return wide, int(within[int(np.ceil(target * len(places))) - 1]) + 1


def make_ivf(
    index: DataFrame, *, key: str, vec: str, k: int = 10, coarse: int = COARSE, fine: int = FINE, copies: int = COPIES,
    recall: float = TARGET_RECALL, sample_rows: int = SAMPLE_ROWS, trial_queries: int = TRIAL_QUERIES,
) -> Ivf:
    """File the vectors of ``index``, with as many probes as ``recall`` of the ``k`` nearest take.

    Probes are chosen on about ``trial_queries`` rows of the index itself, the row left out of its neighbours.
    """
    from askloom.operators.knn import knn_join

    rows = cut(keyed(index, key, vec, "index_key"))
    n = rows.count()
    square = dot(F.col("vec"), F.col("vec"))
    if rows.where((square > 0) & (square < float("inf"))).isEmpty():
        raise ValueError("no usable vectors")
    centroids = train_centroids(rows, coarse, fine, n, sample_rows)
    filed = cut(file_rows(rows, centroids, copies))
    # One row per cell.
    sizes = np.zeros(len(centroids.fine), dtype=np.int64)
    for cell, size in filed.groupBy("cell").agg(F.count(F.lit(1))).collect():
        sizes[cell] = size
    trial = share_of(rows, "index_key", trial_queries, n).withColumnsRenamed({"index_key": "query_key", "vec": "asked"})
    true = knn_join(trial, rows, k=k + 1, query_key="query_key", query_vec="asked", index_key="index_key", index_vec="vec")
    true = true.where("query_key <> index_key").select("query_key", "index_key")
    cells = filed.join(true.select("index_key").distinct(), "index_key", "left_semi")
    cells = cells.groupBy("index_key").agg(F.collect_list("cell").alias("cells"))
    neighbours = true.join(cells, "index_key").join(trial.withColumnRenamed("asked", "vec"), "query_key")
    return Ivf(filed, centroids, sizes, copies, *choose_probes(neighbours, centroids, recall))


def write_ivf(ivf: Ivf, path: str) -> None:
    """Lay the file down by coarse cell, each file sorted by cell, and what is needed to search it."""
    spark = ivf.rows.sparkSession
    parents = spark.createDataFrame(list(enumerate(ivf.centroids.parent.tolist())), "cell int, coarse int")
    # Adaptive execution gives a large coarse cell to several tasks.
    ivf.rows.join(parents, "cell").hint("rebalance", "coarse").sortWithinPartitions("coarse", "cell").write.mode(
        "errorifexists"
    ).partitionBy("coarse").parquet(f"{path}/rows")
    cells = [(int(p), v.tolist(), int(s)) for p, v, s in zip(ivf.centroids.parent, ivf.centroids.fine, ivf.sizes)]
    spark.createDataFrame(
        [(i, *c) for i, c in enumerate(cells)], "cell int, parent int, centroid array<double>, size bigint"
    ).coalesce(1).write.parquet(f"{path}/cells")
    settings = json.dumps({"copies": ivf.copies, "wide": ivf.wide, "probes": ivf.probes})
    spark.createDataFrame(
        [(i, v.tolist(), settings) for i, v in enumerate(ivf.centroids.coarse)], "coarse int, centroid array<double>, settings string"
    ).coalesce(1).write.parquet(f"{path}/coarse")


def read_ivf(spark: SparkSession, path: str) -> Ivf:
    """What :func:`write_ivf` has written."""
    cells = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()
    top = spark.read.parquet(f"{path}/coarse").orderBy("coarse").collect()
    centroids = Centroids(
        np.array([r["centroid"] for r in top]), np.array([r["centroid"] for r in cells]), np.array([r["parent"] for r in cells])
    )
    rows = spark.read.parquet(f"{path}/rows").select("index_key", "vec", "cell")
    return Ivf(rows, centroids, np.array([r["size"] for r in cells]), **json.loads(top[0]["settings"]))


def ivf_visits(queries: DataFrame, ivf: Ivf, k: int, probes: int | None = None) -> DataFrame:
    """``query_key, vec, cell`` of the cells to visit: ``probes``, or more until they hold k rows for sure."""
    centroids, sizes, copies, wide = ivf.centroids, ivf.sizes, ivf.copies, ivf.wide
    probes = probes or ivf.probes

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, vectors = usable(pa.Table.from_batches([batch]))
            if not table.num_rows:
                continue
            cells = centroids.nearest(vectors, wide)
            held = np.where(cells >= 0, sizes[cells], 0)
            before = np.cumsum(held, axis=1) - held
            visit = (cells >= 0) & (held > 0) & ((np.arange(cells.shape[1]) < probes) | (before < k * copies))
            row, column = np.nonzero(visit)
            out = table.select(["query_key", "vec"]).take(pa.array(row))
            yield from out.append_column("cell", pa.array(cells[row, column].astype(np.int32))).to_batches()

    return queries.mapInArrow(choose, f"query_key {key_type(queries, 'query_key')}, vec array<float>, cell int")


def rows_read(queries: DataFrame, ivf: Ivf, *, k: int, key: str, vec: str) -> DataFrame:
    """``pairs, read``: all pairs of queries and filed rows (copies once), and the pairs a search looks at (copies counted)."""
    visits = ivf_visits(keyed(queries, key, vec, "query_key"), ivf, k)
    # One row per cell.
    n = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    read = sum(int(ivf.sizes[c]) * m for c, m in n.items())
    pairs = queries.select(key).count() * ivf.rows.select("index_key").distinct().count()
    return ivf.rows.sparkSession.createDataFrame([(pairs, read)], "pairs bigint, read bigint")
