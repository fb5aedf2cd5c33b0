"""Nearest-neighbour joins between a table of query vectors and a table of index vectors.

* ``knn_join`` is exact. By default it searches 16-bit codes of the vectors (:mod:`askloom.operators.codes`).
* ``ann_join`` searches the nearest cells of a trained inverted file (:mod:`askloom.operators.ivf`).

Both also take cells around pivots (a small sample of the index): a visited cell is worked through in
square blocks of bounded size, spread evenly over the cluster by hashed keys, and each block hands
on only its k best per query. Cells that hold many rows simply have many blocks. ``knn_join`` then
visits every cell that could, by the triangle inequality on angles, hold something better than the k-th best
found so far. Such cells may be laid down once with ``write_cells``: later joins then read the files
of the visited cells only.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from askloom.functions.vectors import dot
from askloom.operators.codes import block_rows, coded_hits, slices, square_side
from askloom.operators.ivf import Ivf, ivf_visits, make_ivf
from askloom.operators.keys import look_up
from askloom.operators.vectors import DIGITS, keyed, rank_hits, usable
from askloom.session import cut

SLACK = 1e-6  # float error allowed for when a cell is ruled out
FILE_ROWS = 1_000_000  # rows per file of stored cells aimed at


class Cells(NamedTuple):
    """An index cut into cells: ``rows`` holds (index_key, vec, cell)."""

    rows: DataFrame
    pivots: np.ndarray
    sizes: np.ndarray
    radii: np.ndarray  # largest angle between the pivot and a vector of its cell


# --- inside tasks ----------------------------------------------------------------------

def _angles(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ pivots.T, -1.0, 1.0))


def _first_k(q: np.ndarray, i: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(column, score) arrays of the k best columns per row; equal scores in column order."""
    n, k = len(i), min(k, len(i))
    units = np.rint(q @ i.T * 10**DIGITS).astype(np.int64)
    # One whole number per pair that orders by score, then column: no ties, no full sort.
    order = units * n - np.arange(n)
    top = np.argpartition(order, n - k, axis=1)[:, n - k:]
    best_first = np.argsort(-np.take_along_axis(order, top, axis=1), axis=1)
    top = np.take_along_axis(top, best_first, axis=1)
    return top, np.take_along_axis(units, top, axis=1) / 10**DIGITS


# --- cells -----------------------------------------------------------------------------

def _pick_pivots(index: DataFrame, cells: int) -> np.ndarray:
    """``cells`` vectors of the index, chosen by the hash of their key."""
    square = dot(F.col("vec"), F.col("vec"))
    place = F.md5(F.col("index_key").cast("string"))
    known = index.where((square > 0) & (square < float("inf")))
    rows = known.orderBy(place, "index_key").limit(cells).select("vec").collect()
    vectors = pa.table({"vec": pa.array([r["vec"] for r in rows], pa.list_(pa.float32()))})
    return usable(vectors)[1]


def _assign(index: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(index_key, vec, cell, angle): the nearest pivot and the angle to it."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, vectors = usable(pa.Table.from_batches([batch]))
            if not table.num_rows:
                continue
            angles = _angles(vectors, pivots)
            cell = angles.argmin(axis=1).astype(np.int32)
            table = table.append_column("cell", pa.array(cell))
            table = table.append_column("angle", pa.array(angles[np.arange(len(cell)), cell]))
            yield from table.to_batches()

    key_type = index.schema["index_key"].dataType.simpleString()
    return index.mapInArrow(
        nearest, f"index_key {key_type}, vec array<float>, cell int, angle double"
    )


def _measure(placed: DataFrame, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes, radii = np.zeros(len(pivots), dtype=np.int64), np.zeros(len(pivots))
    # One row per cell.
    for cell, n, angle in placed.groupBy("cell").agg(F.count(F.lit(1)), F.max("angle")).collect():
        sizes[cell], radii[cell] = n, angle
    return sizes, radii


def _make_cells(index: DataFrame, n: int, cells: int) -> Cells:
    """Cells for one join. A small index is a single cell, which takes no preparation."""
    if cells == 1:
        rows = index.withColumn("cell", F.lit(0))
        return Cells(rows, np.zeros((1, 0)), np.array([n]), np.array([np.pi]))
    # Read several times below: written once, so that vectors are not made again each time.
    index = cut(index)
    pivots = _pick_pivots(index, cells)
    if not len(pivots):
        return _make_cells(index, n, 1)
    placed = _assign(index, pivots)
    return Cells(placed.drop("angle"), pivots, *_measure(placed, pivots))


def write_cells(
    index: DataFrame, path: str, *, key: str, vec: str, cells: int
) -> None:
    """Lay the vectors of ``index`` down by cell, for many joins to come."""
    rows = cut(keyed(index, key, vec, "index_key"))
    pivots = _pick_pivots(rows, cells)
    if not len(pivots):
        raise ValueError("no usable vectors")
    placed = _assign(rows, pivots)
    sizes, radii = _measure(placed, pivots)
    spark = index.sparkSession
    # A cell that holds many rows is written by many tasks. One row per cell is broadcast.
    tasks = spark.createDataFrame(
        [(c, 1 + int(n) // FILE_ROWS) for c, n in enumerate(sizes)], "cell int, tasks int"
    )
    (
        placed.drop("angle").join(F.broadcast(tasks), "cell")
        .withColumn("task", F.pmod(F.xxhash64("index_key"), "tasks"))
        .repartition("cell", "task").drop("task", "tasks")
        .write.mode("errorifexists").partitionBy("cell").parquet(f"{path}/rows")
    )
    table = [
        (c, p.tolist(), int(n), float(r)) for c, (p, n, r) in enumerate(zip(pivots, sizes, radii))
    ]
    spark.createDataFrame(table, "cell int, pivot array<double>, size bigint, radius double")\
        .coalesce(1).write.mode("errorifexists").parquet(f"{path}/pivots")


def read_cells(spark: SparkSession, path: str) -> Cells:
    """Cells written by :func:`write_cells`."""
    table = spark.read.parquet(f"{path}/pivots").orderBy("cell").collect()
    return Cells(
        spark.read.parquet(f"{path}/rows").select("index_key", "vec", F.col("cell").cast("int")),
        np.array([r["pivot"] for r in table]),
        np.array([r["size"] for r in table]),
        np.array([r["radius"] for r in table]),
    )


# --- search ----------------------------------------------------------------------------

def _visits(queries: DataFrame, index: Cells, k: int, probes: int, rest: bool) -> DataFrame:
    """(query_key, vec, cell) of the cells to visit.

    ``rest=False``: the ``probes`` nearest cells, or more until they hold k rows.
    ``rest=True``: of all other cells those that may beat the query's column ``worst``.
    """
    pivots, sizes, radii = index.pivots, index.sizes, index.radii
    if len(sizes) == 1:
        return queries.select("query_key", "vec", F.lit(0).alias("cell"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, vectors = usable(pa.Table.from_batches([batch]))
            if not table.num_rows:
                continue
            angles = _angles(vectors, pivots)
            order = angles.argsort(axis=1, kind="stable")
            held_before = np.cumsum(sizes[order], axis=1) - sizes[order]
            visit = np.zeros(angles.shape, dtype=bool)
            wanted = (held_before < k) | (np.arange(len(sizes)) < probes)
            np.put_along_axis(visit, order, wanted, axis=1)
            if rest:
                reach = np.cos(np.maximum(angles - radii, 0.0))
                worst = table["worst"].fill_null(-2.0).to_numpy()
                visit = ~visit & (reach >= worst[:, None] - SLACK)
            row, cell = np.nonzero(visit & (sizes > 0))
            out = table.select(["query_key", "vec"]).take(pa.array(row))
            yield from out.append_column("cell", pa.array(cell.astype(np.int32))).to_batches()

    key_type = queries.schema["query_key"].dataType.simpleString()
    return queries.mapInArrow(choose, f"query_key {key_type}, vec array<float>, cell int")


def _search(
    visits: DataFrame, index: Cells, k: int, block: int, n_queries: int, *, copies: int = 1
) -> DataFrame:
    """The k best of every query among the cells it visits; ``copies`` of a row may lie in different cells."""
    spark = visits.sparkSession
    # One row per cell, here and in the broadcast.
    asked = [(0, n_queries)]
    if len(index.sizes) > 1:
        asked = visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()

    def parts(n: int) -> int:
        return max(1, int(np.ceil(n / block)))

    blocks = [(cell, parts(n), parts(index.sizes[cell])) for cell, n in asked]

    def sized(df: DataFrame) -> DataFrame:
        """Adds the numbers of query and index blocks of the row's cell."""
        if len(index.sizes) == 1:
            return df.withColumns({"qb": F.lit(blocks[0][1]), "ib": F.lit(blocks[0][2])})
        return df.join(F.broadcast(spark.createDataFrame(blocks, "cell int, qb int, ib int")), "cell")

    rows = index.rows
    if len(asked) < len(index.sizes):
        rows = rows.where(F.col("cell").isin([cell for cell, _ in asked]))

    def spread(df: DataFrame, key: str, own: str, own_no: str, other: str, other_no: str):
        """Own block by hashed key, one copy for every block of the other side."""
        return sized(df).select(
            "cell", key, "vec",
            F.pmod(F.xxhash64(key, F.lit(11)), own).cast("int").alias(own_no),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other_no),
        )

    grid = ["cell", "qblock", "iblock"]
    left = spread(visits, "query_key", "qb", "qblock", "ib", "iblock")
    right = spread(rows, "index_key", "ib", "iblock", "qb", "qblock")

    def best(q: pa.Table, i: pa.Table) -> pa.Table:
        q, asked_for = usable(q)
        i, held = usable(i.sort_by("index_key"))
        if not q.num_rows or not i.num_rows:
            return pa.table(
                [q["query_key"].slice(0, 0), i["index_key"].slice(0, 0), pa.array([], pa.float64())],
                names=["query_key", "index_key", "score"],
            )
        found = [_first_k(asked_for[part], held, k) for part in slices(len(asked_for), len(held))]
        top, scores = (np.concatenate(parts) for parts in zip(*found))
        row = np.repeat(np.arange(q.num_rows), top.shape[1])
        return pa.table(
            [
                q["query_key"].take(pa.array(row)),
                i["index_key"].take(pa.array(top.ravel())),
                pa.array(scores.ravel()),
            ],
            names=["query_key", "index_key", "score"],
        )

    types = (visits.schema["query_key"].dataType, rows.schema["index_key"].dataType)
    schema = "query_key {}, index_key {}, score double".format(*(t.simpleString() for t in types))
    hits = left.groupBy(*grid).cogroup(right.groupBy(*grid)).applyInArrow(best, schema)
    if copies > 1:
        hits = hits.groupBy("query_key", "index_key").agg(F.max("score").alias("score"))
    return rank_hits(hits, k)


def _neighbours(
    queries: DataFrame,
    index: Cells,
    k: int,
    probes: int,
    exact: bool,
    block: int | None,
    n_queries: int,
) -> DataFrame:
    if len(index.sizes) > 1:
        queries = cut(queries)  # read up to four times below
    if block is None:
        # Enough blocks to keep all cores busy, of a bounded size.
        slots = 4 * queries.sparkSession.sparkContext.defaultParallelism
        block = min(block_rows(queries), max(128, square_side(n_queries, int(index.sizes.sum()), slots)))
    near = _visits(queries, index, k, probes, rest=False)
    found = _search(near, index, k, block, n_queries)
    if not exact or len(index.sizes) <= probes:
        return found
    found = cut(found)
    kth = found.where(F.col("rank") == k).select("query_key", F.col("score").alias("worst"))
    still = queries.join(kth, "query_key", "left")
    more = _search(_visits(still, index, k, probes, rest=True), index, k, block, n_queries)
    return rank_hits(found.unionByName(more).drop("rank"), k)


def _join(
    queries: DataFrame,
    index: DataFrame,
    k: int,
    keys: tuple[str, str],
    vecs: tuple[str, str],
    query_cols: list[str],
    index_cols: list[str],
    cells: int | Cells | Ivf | None,
    probes: int | None,
    exact: bool,
    block: int | None,
) -> DataFrame:
    # Only the keys are counted: vectors that are yet to be computed are not touched.
    n_queries = queries.select(keys[0]).count()
    asked, held = keyed(queries, keys[0], vecs[0], "query_key"), keyed(index, keys[1], vecs[1], "index_key")
    if exact and cells is None:
        hits = rank_hits(coded_hits(asked, held, k, n_queries, index.select(keys[1]).count(), block), k)
    elif cells is None or isinstance(cells, Ivf):
        ivf = cells or make_ivf(held, key="index_key", vec="vec", k=k)
        asked, filed = cut(asked), Cells(ivf.rows, ivf.centroids.fine, ivf.sizes, np.zeros(len(ivf.sizes)))
        hits = _search(
            ivf_visits(asked, ivf, k, probes), filed, k, block or block_rows(asked), n_queries, copies=ivf.copies
        )
    else:
        if not isinstance(cells, Cells):
            cells = _make_cells(held, index.select(keys[1]).count(), cells)
        hits = _neighbours(asked, cells, k, probes or 8, exact, block, n_queries)
    hits = hits.select("query_key", "index_key", "score", "rank")
    if index_cols:
        # The hits are k small rows per query, written once.
        hits = look_up(cut(hits), index.select(F.col(keys[1]).alias("index_key"), *index_cols), "index_key")
    if query_cols:
        wanted = queries.select(F.col(keys[0]).alias("query_key"), *query_cols)
        hits = hits.join(wanted, "query_key")
    return hits.select("query_key", *query_cols, "index_key", *index_cols, "score", "rank")


def knn_join(
    queries: DataFrame,
    index: DataFrame,
    *,
    k: int = 3,
    query_key: str,
    query_vec: str,
    index_key: str,
    index_vec: str,
    query_cols: list[str] = (),
    index_cols: list[str] = (),
    probes: int = 1,
    cells: int | Cells | None = None,
    block: int | None = None,
) -> DataFrame:
    """The k most similar index rows (cosine) of every query row, exactly.

    Returns ``query_key``, the asked-for query columns, ``index_key``, the asked-for index
    columns, ``score`` and ``rank`` (1 is best; ties go to the smaller key). Keys have to be
    unique on each side. Rows without a vector, or with the zero vector, take no part.

    Without ``cells`` the index is searched by 16-bit codes (:mod:`askloom.operators.codes`), which prune
    at any distribution of the vectors. ``cells``, a number of cells to make or cells read from storage,
    rules out whole cells instead, which pays where vectors are clustered.
    """
    return _join(
        queries, index, k, (query_key, index_key), (query_vec, index_vec),
        list(query_cols), list(index_cols), cells, probes, True, block,
    )


def ann_join(
    queries: DataFrame,
    index: DataFrame,
    *,
    k: int = 3,
    query_key: str,
    query_vec: str,
    index_key: str,
    index_vec: str,
    query_cols: list[str] = (),
    index_cols: list[str] = (),
    probes: int | None = None,
    cells: int | Cells | Ivf | None = None,
    block: int | None = None,
) -> DataFrame:
    """As :func:`knn_join`, but only the ``probes`` nearest cells are searched.

    Without ``cells`` an inverted file is trained (:func:`askloom.operators.ivf.make_ivf`), whose probes
    are chosen for a recall; one made or stored before may be given. A number of cells, with ``probes``,
    stands for cells around pivots.
    """
    return _join(
        queries, index, k, (query_key, index_key), (query_vec, index_vec),
        list(query_cols), list(index_cols), cells, probes, False, block,
    )


def recall_at_k(found: DataFrame, truth: DataFrame) -> DataFrame:
    """Share of the true neighbours that ``found`` also has, over all queries."""
    keys = ["query_key", "index_key"]
    hit = found.select(*keys).withColumn("hit", F.lit(1))
    return truth.select(*keys).join(hit, keys, "left").agg(
        F.try_divide(F.sum(F.coalesce("hit", F.lit(0))), F.count(F.lit(1))).alias("recall")
    )
