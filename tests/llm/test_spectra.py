"""Whitening against numpy on the exact covariance, and the rank-one update on hard cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterline.llm import spectra
from rosterline.llm.queries import QUERIES, table

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>"


def brute(vectors, components=32):
    """n, x, S, covariance, eigenvalues by falling size."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    off = np.array((x * n - sums), dtype=float) / n
    values, vectors = np.linalg.eigh(off.T @ off / n)
    order = np.argsort(-values)[:components]
    return n, x, sums, off, values[order], vectors[:, order], values.sum()


def check(rows, vectors, ids):
    n, x, sums, off, values, basis, trace = brute(vectors)
    assert len(rows) == n * len(values)
    by_component = {}
    for r in rows:
        by_component.setdefault(r["component"], {})[r["vec_id"]] = r
    for k, value in enumerate(values, 1):
        got = by_component[k]
        whitened = np.array([got[i]["whitened"] for i in ids])
        want = off @ basis[:, k - 1] / math.sqrt(value)
        assert min(np.abs(whitened - want).max(), np.abs(whitened + want).max()) < 1e-8
        assert all(abs(got[i]["explained"] / (value / trace) - 1) < 1e-9 and got[i]["n"] == n for i in ids)
        deviations = [sum((int(a) * n - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
        assert [got[i]["deviation"] for i in ids] == deviations
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9


def test_query_matches_numpy(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").collect()
    check(QUERIES["op11_spectra"](spark, sf_dir).collect(), [r["embedding"] for r in rows], [r["vec_id"] for r in rows])


def test_many_partitions_with_one_vector_in_a_third_of_all_rows(spark):
    rng = np.random.default_rng(5)
    vectors = [list(map(float, v)) for v in rng.normal(0, 3, (300, 7)) * np.arange(1, 8)]
    vectors += [vectors[0]] * 150
    df = spark.createDataFrame(list(enumerate(vectors)), SCHEMA).repartition(23)
    kept = [[float(np.float32(c)) for c in v] for v in vectors]
    check(spectra.whiten(df).collect(), kept, list(range(len(kept))))


def test_rows_that_do_not_take_part(spark):
    rng = np.random.default_rng(6)
    good = [[float(np.float32(c)) for c in v] for v in rng.normal(0, 1, (20, 3))]
    bad = [None, [1.0, None, 2.0], [1.0, float("nan"), 0.0], [float("inf"), 0.0, 0.0], [1.0, 2.0], []]
    df = spark.createDataFrame(list(enumerate(good + bad)), SCHEMA)
    clash = df.select("*", *[F.lit(9).alias(c) for c in ("id", "vector", "component", "n", "whitened", "size", "number", "spectrum")])
    check(spectra.whiten(clash).collect(), good, list(range(20)))
    assert spectra.whiten(df.limit(0)).collect() == [] and spectra.whiten(df.where("vec_id = 20")).collect() == []


def test_no_variance(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0])], SCHEMA)
    rows = spectra.whiten(one).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["identity_error"]) for r in rows] == [(1, 1, 0, None, 0.0), (2, 1, 0, None, 0.0)]
    flat = spark.createDataFrame([(None, [1.0, 2.0]), (None, [3.0, 2.0]), (3, [5.0, 2.0])], SCHEMA)
    rows = sorted(spectra.whiten(flat).collect(), key=lambda r: (r["component"], r["deviation"]))
    assert [r["whitened"] is None for r in rows] == [False] * 3 + [True] * 3
    assert [r["explained"] for r in rows] == pytest.approx([1.0] * 3 + [0.0] * 3)


def test_deviations_beyond_64_bits_are_null(spark):
    df = spark.createDataFrame([(1, [1e9]), (2, [-1e9]), (3, [1e30])], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    rows = {r["vec_id"]: r["deviation"] for r in spectra.whiten(df).collect()}
    assert rows[3] is None and rows[1] is None
    mean3 = -64 * 10**9 * 3 - (1 << 40)
    assert mean3 * mean3 > 1 << 63 and rows[2] is None


@pytest.mark.parametrize("rows", [
    np.ones((5, 4)),
    np.repeat(np.eye(5), 7, axis=0),
    np.random.default_rng(1).integers(0, 2, (40, 6)) @ np.ones((6, 6)),
    np.random.default_rng(2).integers(-3, 3, (50, 8)),
    np.random.default_rng(3).normal(0, 1, (60, 9)) * 10.0 ** -np.arange(9),
], ids=["equal", "copies", "one direction", "small numbers", "graded"])
def test_rank_one_updates_and_merges(rows):
    rows = np.asarray(rows, float)
    size = rows.shape[1]
    whole, parts = spectra.Spectrum.empty(size), [spectra.Spectrum.empty(size) for _ in range(3)]
    for i, row in enumerate(rows):
        whole.add(row[None])
        parts[i % 3].add(row[None])
    parts[0].merge(parts[1])
    parts[0].merge(parts[2])
    want = np.cov(rows.T, bias=True)
    scale = max(1.0, np.abs(want).max())
    for got in (whole, parts[0], spectra.Spectrum.unpacked(whole.packed(), size)):
        assert got.n == len(rows)
        assert np.abs(got.vectors @ np.diag(got.values / got.n) @ got.vectors.T - want).max() < 1e-13 * scale
        assert np.abs(got.vectors.T @ got.vectors - np.eye(size)).max() < 1e-13
        assert (np.diff(got.values) >= -1e-12).all()


def test_secular_roots_lie_between_the_poles():
    poles, weights = np.array([0.0, 1e-9, 1.0, 2.0]), np.array([0.5, 0.5, 0.1, np.sqrt(0.49)])
    distance, roots = spectra.secular_roots(poles, weights, 3.0)
    assert (roots >= poles).all() and (roots[:-1] <= poles[1:]).all() and roots[-1] <= poles[-1] + 3.0
    want = np.linalg.eigvalsh(np.diag(poles) + 3.0 * np.outer(weights, weights))
    assert np.allclose(roots, want, atol=1e-12)
    assert np.allclose(distance, poles[None, :] - roots[:, None], atol=1e-12)
