"""Exact top-k search against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from hotdesk.llm import exact_search
from hotdesk.llm.tables import read


def brute_force(ids: np.ndarray, vectors: np.ndarray, k: int) -> list[tuple]:
    out = []
    for j in np.flatnonzero(ids % 50 == 0):
        scores, others = vectors @ vectors[j], np.flatnonzero(ids != ids[j])
        best = others[np.lexsort((ids[others], -scores[others]))[:k]]
        out += [(int(ids[j]), place + 1, int(ids[b]), int(scores[b])) for place, b in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("tile", [8192, 100])
def test_given_vectors(spark, sf_dir, monkeypatch, tile):
    monkeypatch.setattr(exact_search, "TILE_ROWS", tile)
    monkeypatch.setattr(exact_search, "TILE_QUERIES", max(3, tile // 100))
    table = read(spark, sf_dir, "embeddings")
    rows = table.select("vec_id", "embedding").collect()
    vectors = np.floor(np.array([r.embedding for r in rows], np.float64) * 256).astype(np.int64)
    expected = brute_force(np.array([r.vec_id for r in rows]), vectors, 5)
    assert sorted(map(tuple, exact_search.nearest(table).collect())) == expected


def test_ties_and_wide_numbers():
    rng = np.random.default_rng(0)
    for scale in (2, 1 << 29):
        vectors = rng.integers(-scale, scale, (300, 40))
        vectors[::3] = vectors[0]
        ids = rng.permutation(300)
        q, at, score = exact_search.best(vectors.T.copy(), ids, vectors[:20].T.copy(), ids[:20], 5)
        for query in range(20):
            scores, others = vectors @ vectors[query], np.flatnonzero(ids != ids[query])
            best = others[np.lexsort((ids[others], -scores[others]))[:5]]
            assert at[q == query].tolist() == best.tolist() and (score[q == query] == scores[best]).all()


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, [1.0]), (3, [float("nan")]), (4, None), (None, [1.0])]
    rows += [(7, []), (100, [float("inf"), 1.0]), (8, [None])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted(map(tuple, exact_search.nearest(table).collect()))
    own = [(0, 1, 50, 65536), (0, 2, 7, 0)]
    assert found == sorted([*own, *own, (50, 1, 0, 65536), (50, 2, 0, 65536), (50, 3, 7, 0)])
    assert exact_search.nearest(table.limit(0)).collect() == []


def test_scores_beyond_floats_are_exact():
    """Large dimensions first, small ones behind them: scores differ below the precision of a float."""
    for seed in range(200):
        rng = np.random.default_rng(seed)
        large = rng.integers(180_000_000, 200_000_000, (1, 16)) + rng.integers(0, 2, (60, 16))
        vectors = np.column_stack([large, rng.integers(-300, 300, (60, 32))])
        ids = rng.permutation(60)
        q, at, score = exact_search.best(vectors.T.copy(), ids, vectors[:2].T.copy(), ids[:2], 5)
        for query in range(2):
            scores, others = vectors @ vectors[query], np.flatnonzero(ids != ids[query])
            best = others[np.lexsort((ids[others], -scores[others]))[:5]]
            assert at[q == query].tolist() == best.tolist() and (score[q == query] == scores[best]).all()
            assert abs(scores).max() > 1 << 53
