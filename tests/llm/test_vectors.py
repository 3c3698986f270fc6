import numpy as np
import pytest

from termloom.llm import embedding_dedup as ed
from termloom.llm import pivot_search as ps

from . import helpers

NAN, INF = float("nan"), float("inf")


def vectors(n=300, d=16, seed=1):
    r = helpers.rng(seed)
    centres = r.normal(size=(8, d))
    x = centres[r.integers(0, 8, n)] + r.normal(size=(n, d)) * 0.25
    x[n // 2 : n // 2 + 40] = x[0]
    return x.astype(np.float32)


def frame(spark, x, labels, extra=()):
    rows = [(i, v.tolist(), None if labels is None else int(labels[i])) for i, v in enumerate(x)] + list(extra)
    return helpers.clash(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).drop("n")


@pytest.mark.parametrize("block", [8192, 37])
def test_search_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(ps, "RANGES", 3)
    monkeypatch.setattr(ps, "QUERIES", 6)
    monkeypatch.setattr(ps, "RUN", 2)
    x = vectors()
    extra = [(1000, None, 1), (1020, [1.0, None] + [0.0] * 14, 1), (1040, [NAN] * 16, 1), (1060, [INF] * 16, 1), (1080, [0.5, 0.25], 1), (1081, [0.5, 0.5], 1), (None, [0.1] * 16, 1)]
    got = {}
    for r in ps.search(frame(spark, x, np.ones(len(x)), extra), block=block).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    whole = np.floor(64 * x.astype(np.float64)).astype(np.int64)
    ids = np.arange(len(x))
    for q in range(0, len(x), 20):
        s = whole @ whole[q]
        order = np.lexsort((ids, -s))
        order = order[order != q][:20]
        assert got[q] == {k + 1: (int(i), int(s[i])) for k, i in enumerate(order)}
    assert set(got) == {*range(0, len(x), 20), 1080}
    assert got[1080] == {1: (1081, 32 * 32 + 16 * 32)}  # fewer candidates than k


def test_search_stops_early_and_is_exact_for_large_numbers():
    x = np.floor(64 * vectors(2000, 32, 3).astype(np.float64))
    pivots = ps.choose_pivots(x[:500])
    best, done = [ps.Best(5)], 0
    q = x[:1]
    done = ps.search_block(best, np.array([0]), q, ps.distances(q, pivots), np.arange(2000), x, ps.distances(x, pivots))
    assert 0 < done < 1999
    assert ps.products(np.array([2.0**40]), np.array([[2.0**40], [1.0], [-(2.0**40)]])).tolist() == [2**63 - 1, 2**40, -(2**63)]


def test_ranges_bound_what_blocks_hold():
    """Two far groups: the ranges of one's blocks rule them out for queries of the other."""
    x = np.concatenate([vectors(400, 16, 5) + 20, vectors(400, 16, 6) - 20]).astype(np.float32)
    q = np.floor(64 * x[::20].astype(np.float64))
    whole = np.floor(64 * x.astype(np.float64))
    pivots = ps.choose_pivots(whole[::5])
    d = ps.distances(whole, pivots)
    top = np.array([(whole[a : a + 100] ** 2).sum(1).max() for a in range(0, 800, 100)])
    lo, hi = (np.array([f(d[a : a + 100], axis=0) for a in range(0, 800, 100)]) for f in (np.min, np.max))
    limit = ps.limits((q * q).sum(1), ps.distances(q, pivots), top, lo, hi)
    best = np.array([(whole[a : a + 100] @ q.T).max(0) for a in range(0, 800, 100)]).T
    assert (limit >= best).all()
    floor = np.sort(whole @ q.T, axis=0)[-21]
    assert 0 < (limit >= floor[:, None]).sum() < 0.6 * limit.size


def test_search_of_nothing(spark):
    df = frame(spark, vectors(3), np.ones(3))
    assert ps.search(df.limit(0)).count() == 0
    assert ps.search(df.where("vec_id = 0")).count() == 0


def brute_links(x, labels, threshold=0.93):
    x = x.astype(np.float64)
    n = np.linalg.norm(x, axis=1)
    c = (x @ x.T) / n[:, None] / n[None, :]
    a = (c >= threshold) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(a, False)
    return a


@pytest.mark.parametrize("tile", [2048, 16])
def test_links_equal_brute_force(spark, tile):
    x = vectors(260, 16, 5)
    labels = np.arange(len(x)) % 2
    extra = [(500, None, 1), (501, [0.0] * 16, 1), (502, [NAN] * 16, 0), (503, [None] + [1.0] * 15, 0), (504, x[0].tolist(), None), (505, [INF] * 16, 0), (None, x[0].tolist(), 0), (506, [1.0, 2.0], 0), (507, [2.0, 4.0], 0)]
    got = ed.near_duplicate_vectors(frame(spark, x, labels, extra), tile=tile).collect()
    assert len(got) == len(x) + len(extra)
    a = brute_links(x, labels)
    i, j = np.nonzero(a)
    comp = helpers.components(range(len(x)), list(zip(i.tolist(), j.tolist(), strict=True)))
    by = {r.vec_id: r for r in got}
    for k in range(len(x)):
        assert (by[k].n_links, by[k].component_id, by[k].kept) == (int(a[k].sum()), comp[k], comp[k] == k)
    assert all(by[k].n_links == 0 and by[k].component_id == k and by[k].kept for k in (500, 501, 502, 503, 504, 505))
    assert (by[None].n_links, by[None].component_id, by[None].kept) == (0, None, True)
    assert (by[506].n_links, by[507].component_id, by[507].kept) == (1, 506, False)
    assert ed.near_duplicate_vectors(frame(spark, x, labels).limit(0)).count() == 0


def test_bounded_products_lose_nothing():
    x = vectors(200, 32, 9).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turned = x @ ed.axes(x)
    i, j, c = ed.linked_pairs(turned, turned, 0.93, True)
    full = x @ x.T
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(full >= 0.93, 1)), strict=True)}
    assert {(int(a), int(b)) for a, b, v in zip(i, j, c, strict=True) if v >= 0.93} == want


def test_threshold_is_met_in_double_precision(spark):
    a = [1.0, 0.0]
    at = [0.93, float(np.sqrt(1 - 0.93**2))]
    df = spark.createDataFrame([(0, a, 1), (1, at, 1), (2, [0.9299, float(np.sqrt(1 - 0.9299**2))], 1)], "vec_id long, embedding array<double>, label int")
    want = [np.dot(a, v) / (np.linalg.norm(a) * np.linalg.norm(v)) >= 0.93 for v in (at, [0.9299, float(np.sqrt(1 - 0.9299**2))])]
    got = {r.vec_id: r for r in ed.near_duplicate_vectors(df).collect()}
    assert got[0].n_links == sum(want) and want == [True, False]
