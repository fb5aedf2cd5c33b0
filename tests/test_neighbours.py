"""8-bit codes and the inverted file against brute force."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from hypothesis.extra import numpy as hnp

from askloom.operators import codes
from askloom.operators.ivf import Centroids, choose_probes, lloyd, make_ivf, read_ivf, rows_read, write_ivf
from askloom.operators.knn import ann_join, knn_join, recall_at_k
from askloom.session import scratch_path

KEYS = dict(query_key="q", query_vec="v", index_key="i", index_vec="v")


def frame(spark, name, vectors, parts=3):
    rows = [(n, None if v is None else [float(x) for x in v]) for n, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"{name} long, v array<float>").repartition(parts)


def brute(queries, index, k):
    out = set()
    unit = lambda v: np.asarray(v, dtype=np.float32).astype(float) / np.linalg.norm(np.asarray(v, dtype=np.float32).astype(float))
    known = [(n, unit(v)) for n, v in enumerate(index) if v is not None and np.any(v)]
    for q, v in enumerate(queries):
        if v is None or not np.any(v):
            continue
        best = sorted((-np.rint(unit(v) @ x * 1e9), n) for n, x in known)[:k]
        out |= {(q, n, r) for r, (_, n) in enumerate(best, 1)}
    return out


def found(hits):
    return {(r["query_key"], r["index_key"], r["rank"]) for r in hits.collect()}


VECTORS = hnp.arrays(np.float64, st.tuples(st.integers(1, 12), st.just(7)), elements=st.floats(-1e3, 1e3).map(lambda x: x if abs(x) > 1e-6 else 0.0))


@settings(max_examples=200, deadline=None)
@given(VECTORS, VECTORS)
def test_scores_lie_within_their_bounds(a, b):
    a, b = (m[np.linalg.norm(m, axis=1) > 0] for m in (a, b))
    if not len(a) or not len(b):
        return
    a, b = (m / np.linalg.norm(m, axis=1)[:, None] for m in (a, b))
    low, high = codes.bounds(a, *codes.encode(b))
    scores = a @ b.T
    assert (low <= scores).all() and (scores <= high).all() and (high - low).max() < 0.05


@pytest.mark.parametrize("block", [None, 7])
def test_codes_give_the_exact_neighbours(spark, block):
    draw = np.random.RandomState(0)
    index = list(draw.normal(size=(150, 8)))
    index += [index[3]] * 40 + [index[5] * 2.5, np.zeros(8), None, index[3] + 1e-7 * draw.normal(size=8)]
    queries = [*draw.normal(size=(20, 8)), index[3], index[5], np.zeros(8), None]
    for k in (1, 5, 500):
        hits = knn_join(frame(spark, "q", queries), frame(spark, "i", index), k=k, block=block, **KEYS)
        got = found(hits)
        assert hits.count() == len(got) and got == brute(queries, index, k)


def test_codes_with_an_empty_side(spark):
    some, none = frame(spark, "q", [[1, 0]]), frame(spark, "i", [[1, 0]]).limit(0)
    assert knn_join(some, none, **KEYS).collect() == []
    assert knn_join(some.limit(0), frame(spark, "i", [[1, 0]]), **KEYS).collect() == []
    assert knn_join(some, frame(spark, "i", [[0, 0], None]), **KEYS).collect() == []


def test_few_pairs_are_scored_exactly(spark):
    draw = np.random.RandomState(1)
    index = frame(spark, "i", draw.normal(size=(1000, 32)))
    pairs = codes.checked_pairs(frame(spark, "q", draw.normal(size=(50, 32))), index, k=10, block=256, **KEYS).first()
    assert pairs["pairs"] == 50_000 and 500 <= pairs["checked"] < 2_500


def clusters(n, groups=40, dim=16, seed=2):
    draw = np.random.RandomState(seed)
    centres = draw.normal(size=(groups, dim))
    return centres[draw.randint(groups, size=n)] + 0.05 * draw.normal(size=(n, dim))


def test_inverted_file_on_clustered_vectors(spark):
    vectors = clusters(1500)
    index = frame(spark, "i", vectors)
    queries = frame(spark, "q", vectors[:200] + 0.01)
    path = scratch_path(spark, "ivf")
    write_ivf(make_ivf(index, key="i", vec="v", coarse=8, fine=8), path)
    ivf = read_ivf(spark, path)
    assert ivf.copies == 2 and ivf.sizes.sum() == 3000
    hits = ann_join(queries, index, k=10, cells=ivf, **KEYS).cache()
    assert hits.count() == hits.select("query_key", "index_key").distinct().count() == 2000
    assert recall_at_k(hits, knn_join(queries, index, k=10, **KEYS)).first()[0] >= 0.9
    read = rows_read(queries, ivf, k=10, key="q", vec="v").first()
    assert read["pairs"] == 300_000 and read["read"] < 0.3 * read["pairs"]


def test_inverted_file_by_default_and_with_odd_rows(spark):
    vectors = [*clusters(60, groups=3), np.zeros(16), None] + [np.ones(16)] * 60
    index = frame(spark, "i", vectors)
    queries = frame(spark, "q", [np.ones(16), vectors[0], np.zeros(16), None])
    hits = ann_join(queries, index, k=70, **KEYS).collect()
    by_query = {q: [r for r in hits if r["query_key"] == q] for q in range(4)}
    assert [len(by_query[q]) for q in range(4)] == [70, 70, 0, 0]
    assert sorted(r["index_key"] for r in by_query[0] if r["rank"] <= 60) == list(range(62, 122))
    with pytest.raises(ValueError):
        make_ivf(frame(spark, "i", [np.zeros(3), None]), key="i", vec="v")


def test_nearest_cells_of_two_levels():
    draw = np.random.RandomState(3)
    unit = lambda m: m / np.linalg.norm(m, axis=1)[:, None]
    c = Centroids(unit(draw.normal(size=(5, 4))), unit(draw.normal(size=(17, 4))), np.sort(draw.randint(0, 5, 17)))
    vectors = unit(draw.normal(size=(9, 4)))
    all_cells = c.nearest(vectors, 5)
    for v, cells in zip(vectors, all_cells):
        assert [x for x in cells if x >= 0] == list(np.argsort(-(c.fine @ v), kind="stable"))
    for v, cells in zip(vectors, c.nearest(vectors, 2)):
        near = set(np.argsort(-(c.coarse @ v))[:2])
        assert {x for x in cells if x >= 0} == {i for i in range(17) if c.parent[i] in near}


def test_probes_follow_the_wanted_recall(spark):
    c = Centroids(np.eye(3), np.vstack([np.eye(3), np.eye(3)]), np.array([0, 1, 2, 0, 1, 2]))
    rows = [([1.0, 0.1, 0.0], [0])] * 8 + [([1.0, 0.1, 0.0], [1])] * 2
    neighbours = spark.createDataFrame(rows, "vec array<float>, cells array<int>")
    assert choose_probes(neighbours, c, 0.8) == (2, 1)
    wide, probes = choose_probes(neighbours, c, 0.99)
    assert wide == 2 and probes == 3
    assert choose_probes(neighbours.limit(0), c, 0.9) == (3, 6)


def test_lloyd_separates_clusters():
    v = clusters(300, groups=4, seed=5)
    v = v / np.linalg.norm(v, axis=1)[:, None]
    found_ = lloyd(v, 4)
    assert np.allclose(np.linalg.norm(found_, axis=1), 1) and (v @ found_.T).max(axis=1).min() > 0.9
    assert len(lloyd(v[:2], 5)) == 2


def test_large_blocks_are_scored_in_slices(spark, monkeypatch):
    from askloom.operators.codes import block_rows, slices, square_side

    assert [s.start for s in slices(10, 1 << 19)] == [0, 4, 8] and len(list(slices(3, 1 << 30))) == 3
    assert block_rows(frame(spark, "i", [None, [1.0] * 64]).withColumnRenamed("v", "vec")) == 1 << 16
    # Six times the rows: copies of a row do not become more.
    copies = [n / square_side(n, n, 48) for n in (50_000, 300_000)]
    assert abs(copies[0] - copies[1]) < 0.01
    draw = np.random.RandomState(3)
    index, queries = list(draw.normal(size=(300, 8))), list(draw.normal(size=(60, 8)))
    for cells in (None, 4):
        hits = knn_join(frame(spark, "q", queries), frame(spark, "i", index), k=3, cells=cells, block=128, **KEYS)
        assert found(hits) == brute(queries, index, 3)


def test_close_vectors_are_told_apart(spark):
    """Counts of letters: all vectors point into nearly the same direction."""
    draw = np.random.RandomState(4)
    index = frame(spark, "i", 1 + 0.02 * draw.normal(size=(2000, 26)))
    queries = frame(spark, "q", 1 + 0.02 * draw.normal(size=(20, 26)))
    pairs = codes.checked_pairs(queries, index, k=3, **KEYS).first()
    assert 60 <= pairs["checked"] < 400


def test_rows_that_no_code_tells_apart_leave_a_block_by_the_k_best(spark):
    """Near copies: every pair of the group lies within the bounds, and none but k per query and block is handed on."""
    draw = np.random.RandomState(5)
    rows = 1000 + draw.randint(0, 2, size=(600, 26))
    index, queries = frame(spark, "i", rows), frame(spark, "q", rows[:60])
    q, i = (f.withColumnsRenamed({n: f"{side}_key", "v": "vec"}) for f, n, side in ((queries, "q", "query"), (index, "i", "index")))
    handed = codes.block_hits(q, i, 3, 60, 600, 200).cache()
    assert handed.count() <= 60 * 3 * handed.select("query_key", "checked").where("checked > 0").count() / 60
    assert handed.agg({"checked": "sum"}).first()[0] > 10_000
    assert found(knn_join(queries, index, k=3, block=200, **KEYS)) == brute(list(rows[:60]), list(rows), 3)


def test_hits_of_rows_that_share_a_key(spark):
    index = frame(spark, "i", [[1, 0], [0, 1], [1, 1]])
    queries = frame(spark, "q", [[1, 0]])
    got = [tuple(r)[:2] + (r["rank"],) for r in knn_join(queries, index.union(index.where("i = 0")), k=3, **KEYS).collect()]
    assert sorted(got) == [(0, 0, 1), (0, 0, 2), (0, 0, 3)]
