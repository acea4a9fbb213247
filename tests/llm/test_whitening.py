"""Whitening against plain eigenvectors of the covariance of whole tables."""

import math
from fractions import Fraction

import numpy as np
import pytest

pytest.importorskip("gleaner.llm.whitening")
from gleaner.llm import queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, x string, n int"


def plain(vectors, components):
    """(n, deviations, whitened, explained) by numpy, deviations in whole numbers of any size."""
    x = np.array([[math.floor(256 * float(c)) for c in v] for v in vectors], object)
    fit = sorted(set(map(tuple, x.tolist())))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    mean = np.array([float(Fraction(s, n)) for s in sums])
    centred = np.array(fit, float) - mean
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return n, deviations, (x.astype(float) - mean) @ axes / np.sqrt(values), values / (centred**2).sum() * n


def held_against_plain(rows, vectors, components, close=1e-9):
    n, deviations, wanted, explained = plain([v for _, v in vectors], components)
    got = rows.toPandas()
    assert len(got) == len(vectors) * components and set(got["n"]) == {n}
    table = got.pivot(index="vec_id", columns="component", values="whitened").loc[[i for i, _ in vectors]].to_numpy()
    assert np.abs(table * np.sign((table * wanted).sum(axis=0)) - wanted).max() < close
    assert got[got["component"] == 1].set_index("vec_id")["deviation"].loc[[i for i, _ in vectors]].tolist() == deviations
    assert np.allclose(got.groupby("component")["explained"].first(), explained, rtol=1e-9)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9


def test_query_equals_plain_eigenvectors(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    held_against_plain(queries.QUERIES["op13_whitening"](spark, SF), [(r.vec_id, r.embedding) for r in rows], 4)


def test_odd_rows_and_copies(spark):
    chance = np.random.default_rng(3)
    good = [(i, [float(np.float32(v)) for v in chance.normal(size=6) * [5, 4, 3, 2, 1, 0.5]]) for i in range(300)]
    good += [(300 + i, good[7][1]) for i in range(400)]  # one vector with most rows counts once
    bad = [(-1, None), (-2, []), (-3, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (-4, [float("nan")] * 6), (-5, [float("inf")] + [0.0] * 5), (-6, [1.0, 2.0]), (-7, [0.0] * 7)]
    table = spark.createDataFrame([(i, v, None, "x", 1) for i, v in good + bad], SCHEMA)
    for parts in (1, 9):
        held_against_plain(whitening.whitened(table.repartition(parts), 4), good, 4, 1e-6)


def test_many_tasks_sum_in_two_steps(spark):
    chance = np.random.default_rng(5)
    x = [(i, [int(v) for v in chance.integers(-500, 500, 5)]) for i in range(400)]
    rows = spark.createDataFrame(x, "vec_id long, x array<long>")
    n, sums = whitening.exact_sums(rows.repartition(90), 5)
    assert n == 400 and sums == np.array([v for _, v in x]).sum(axis=0).tolist()


@pytest.mark.parametrize("d", [3, 40])
def test_columns_that_are_nearly_or_wholly_dependent(spark, d):
    """Small directions keep their precision, where the covariance itself has lost them; one that isn't there has no variance."""
    chance = np.random.default_rng(d)
    base = chance.integers(-(10**6), 10**6, (200, d))
    base[:, 1] = base[:, 0] + chance.integers(0, 2, 200)  # differs by one in a million
    base[:, 2] = 2 * base[:, 0]
    rows = spark.createDataFrame([(i, [int(c) for c in v]) for i, v in enumerate(base)], "vec_id long, x array<long>")
    found = whitening.fit(rows.repartition(3))
    assert found.n == len(np.unique(base, axis=0)) and (found.variances > 0).sum() == d - 1 and found.variances[-1] == 0
    fitted = np.unique(base, axis=0)
    small = np.linalg.svd(fitted - fitted.mean(axis=0), compute_uv=False)[d - 2] ** 2 / found.n
    assert found.variances[d - 2] == pytest.approx(small, rel=1e-5) and small < 1
    assert found.identity_error < 1e-4
    got = whitening.project(rows, found).toPandas()
    assert got[got["component"] == d]["whitened"].isna().all() and not got[got["component"] < d]["whitened"].isna().any()
    assert (got[got["component"] == d]["explained"] == 0).all()


def test_orthogonal_columns_after_the_passes():
    a = np.random.default_rng(1).normal(size=(500, 70)) @ np.diag(np.logspace(0, -9, 70))
    r = np.linalg.qr(a)[1]
    assert np.abs(whitening.divided(a, r).T @ whitening.divided(a, r) - np.eye(70)).max() < 1e-5
    assert np.allclose(whitening.divided(a, r) @ r, a)


def test_tables_without_variance_or_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whitened(spark.createDataFrame([], schema), 4).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, None)], schema), 4).count() == 0
    one = whitening.whitened(spark.createDataFrame([(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [0.5, 1.0])], schema), 4).collect()
    assert len(one) == 6 and all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, None, 0.0, 0.0) for r in one)
    assert sorted({r.component for r in one}) == [1, 2]


def test_numbers_at_the_limits(spark):
    table = spark.createDataFrame([(1, [1e30, 1.0]), (2, [-1e30, 2.0]), (3, [0.0, -0.001])], "vec_id long, embedding array<double>")
    x = dict(map(tuple, whitening.whole_numbers(table).collect()))
    assert x[1] == [2**63 - 1, 256] and x[2] == [-(2**63), 512] and x[3] == [0, -1]
    got = whitening.whitened(table, 1).collect()
    assert len(got) == 3 and {r.vec_id: r.deviation for r in got}[1] is None
