"""Links among vectors against all pairs."""

import numpy as np
import pytest
from test_minhash import merged

from stratalake.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def vectors(seed, fresh, dim):
    rng = np.random.default_rng(seed)
    out = list(rng.standard_normal((fresh, dim)))
    for i in range(fresh // 4):
        for _ in range(rng.integers(1, 12)):
            out.append(out[i] * rng.uniform(0.5, 2) + 0.2 * np.linalg.norm(out[i]) / np.sqrt(dim) * rng.standard_normal(dim))
    out += [out[0]] * 30
    return np.array(out)[rng.permutation(len(out))].astype(np.float32)


@pytest.mark.parametrize("seed, fresh, dim", [(0, 600, 64), (1, 40, 8)])
def test_against_all_pairs(spark, seed, fresh, dim):
    own = vectors(seed, fresh, dim)
    odd = [None, [], [0.0] * dim, [float("nan")] * dim, [1.0, None], [float("inf"), 1.0], [3.0, 4.0], [6.0, 8.0]]
    data = [(i, v, 0, "x") for i, v in enumerate([*map(np.ndarray.tolist, own), *odd])] + [(None, own[0].tolist(), 0, "x")]
    got = {r.vec_id: r for r in embeddings.near_vectors(spark.createDataFrame(data, SCHEMA).repartition(3)).collect()}
    unit = own.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= embeddings.COSINE
    np.fill_diagonal(linked, False)
    wanted = linked.sum(axis=1)
    found = np.array([got[i].n_links for i in range(len(own))])
    assert (found <= wanted).all() and found.sum() >= 0.99 * wanted.sum() > 0
    if found.sum() == wanted.sum():
        part = merged(range(len(own)), zip(*np.nonzero(linked)))
        assert {i: got[i].component_id for i in range(len(own))} == part
    n = len(own)
    assert [got[n + i].n_links for i in range(8)] == [0] * 6 + [1, 1]
    assert got[n + 7].component_id == n + 6 and not got[n + 7].kept and got[n].kept and got[n].component_id == n
    assert tuple(got[None]) == (None, 0, None, True)


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    own = vectors(2, 80, 16)
    data = [(i, v.tolist(), 0, "x") for i, v in enumerate(own)]
    got = embeddings.near_vectors(spark.createDataFrame(data, SCHEMA))
    unit = own / np.linalg.norm(own.astype(np.float64), axis=1, keepdims=True)
    wanted = (unit @ unit.T >= embeddings.COSINE).sum() - len(own)
    assert 0.98 * wanted <= sum(r.n_links for r in got.collect()) <= wanted
    assert embeddings.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_traversal_visits_the_nearest_cells():
    rng = np.random.default_rng(4)
    sample = rng.standard_normal((400, 6))
    grid = embeddings.Grid(sample / np.linalg.norm(sample, axis=1, keepdims=True), 6400, 0.95, 0.9)
    grid.visits = 7
    one, two = (embeddings._distances(p, b) for p, b in zip((sample[:, :3], sample[:, 3:]), grid.books))
    every = (one[:, :, None] + two[:, None, :]).reshape(len(sample), -1)
    for row, cells in zip(every, grid.nearest(sample)):
        assert np.allclose(np.sort(row)[:7], row[cells])


def test_one_dense_cell_and_repeated_rows(spark, monkeypatch):
    """A third of all vectors in one cell, in many parts; rows given twice; an id with two vectors."""
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rng = np.random.default_rng(7)
    center = rng.standard_normal(12)
    near = [center + 0.1 * np.linalg.norm(center) / np.sqrt(12) * rng.standard_normal(12) for _ in range(150)]
    own = np.array(near + list(rng.standard_normal((300, 12)))).astype(np.float32)
    data = [(i, v.tolist(), 0, "x") for i, v in enumerate(own)]
    data += data[:20] + [(200, own[0].tolist(), 0, "x"), (None, own[0].tolist(), 0, "x")]
    got = {r.vec_id: r for r in embeddings.near_vectors(spark.createDataFrame(data, SCHEMA).repartition(4)).collect()}
    unit = own.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= embeddings.COSINE
    np.fill_diagonal(linked, False)
    linked[200, :150] |= linked[0, :150]
    linked[:150, 200] |= linked[:150, 0]
    found = sum(r.n_links for i, r in got.items() if i is not None)
    assert 0.99 * linked.sum() <= found <= linked.sum() + 400
    assert got[5].component_id == 0 and got[200].component_id == 0 and not got[200].kept


def test_vectors_in_double_precision(spark):
    own = vectors(3, 60, 8).astype(np.float64)
    data = [(i, v.tolist()) for i, v in enumerate(own)]
    got = embeddings.near_vectors(spark.createDataFrame(data, "vec_id int, embedding array<double>"))
    unit = own / np.linalg.norm(own, axis=1, keepdims=True)
    wanted = (unit @ unit.T >= embeddings.COSINE).sum() - len(own)
    assert 0.98 * wanted <= sum(r.n_links for r in got.collect()) <= wanted
