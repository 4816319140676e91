"""Whitening and vector codes against plain integer arithmetic."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_vectors import BAD, SCHEMA
from veridra.llm import codes, whitening

SF = "/root/testdata/sf0.01"


def made(n=300, d=16, seed=3):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) * np.geomspace(1, 0.02, d) + 3).astype(np.float32)


def frame(spark, x, labels=None):
    rows = [(i, [float(v) for v in r], None if labels is None else labels[i]) for i, r in enumerate(x)]
    bad = [b for b in BAD if b[0] not in (None, 902)]
    return spark.createDataFrame([*rows, *bad, (906, [1.0, 2.0], 0)], SCHEMA).withColumns({"id": F.lit(1), "vec": F.lit(2), "component": F.lit(3), "salt": F.lit(4), "a": F.lit(5), "b": F.lit(6)})


def covariance(x):
    """Exact, as fractions."""
    n = len(x)
    s = [sum(c) for c in zip(*x, strict=True)]
    return [[Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n**3) for j in range(len(s))] for i in range(len(s))], s


def test_whitening_against_exact_integers(spark):
    x = made()
    ints = [[math.floor(64 * float(v)) + 1_000_000 for v in r] for r in x]
    v, s = covariance(ints)
    v = np.array([[float(c) for c in r] for r in v])
    e = np.linalg.eigvalsh(v)[::-1]
    got = whitening.whiten(frame(spark, x), components=10).toPandas()
    assert sorted(got.vec_id.unique()) == list(range(len(x))) and len(got) == 10 * len(x) and set(got.n) == {len(x)}
    dev = {i: sum((len(x) * c - t) ** 2 for c, t in zip(r, s, strict=True)) for i, r in enumerate(ints)}
    assert (got.deviation == got.vec_id.map(dev)).all()
    assert np.allclose(got.groupby("component").explained.first(), e[:10] / e.sum(), rtol=1e-10)
    w = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(np.cov(w.T, bias=True) - np.eye(10)).max() < 1e-9 and got.identity_error.max() < 1e-9 and got.identity_error.nunique() == 1
    assert abs(w.mean(axis=0)).max() < 1e-9
    z = np.array(ints, float) - np.array(s) / len(x)
    axes = np.linalg.lstsq(z, w * np.sqrt(e[:10]), rcond=None)[0]
    assert np.allclose(axes.T @ axes, np.eye(10), atol=1e-9) and np.allclose(v @ axes, axes * e[:10], atol=1e-6)


@pytest.mark.parametrize("d", [1, 2, 7, 40])
def test_jacobi_keeps_small_eigenvalues(d):
    rng = np.random.default_rng(d)
    scale = np.geomspace(1, 1e-9, d)
    a = rng.normal(size=(d, d))
    a = (a @ a.T + d * np.eye(d)) * np.outer(scale, scale)
    e, axes = whitening.jacobi(a)
    assert (np.diff(e) <= 0).all() and (e > 0).all()
    assert np.abs(axes.T @ axes - np.eye(d)).max() < 1e-13
    assert np.abs(a @ axes - axes * e).max() <= 1e-14 * e[0] * d
    # scaled diagonally dominant: each eigenvalue is right to a few digits of a double, also the least
    assert math.isclose(float(np.prod(e / scale**2)), float(np.linalg.det(a / np.outer(scale, scale))), rel_tol=1e-10)


def test_whitening_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty).collect() == [] and whitening.whiten(spark.createDataFrame(BAD[:2], SCHEMA)).collect() == []
    same = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], SCHEMA)
    assert whitening.whiten(same).collect() == []
    flat = spark.createDataFrame([(1, [1.0, 2.0], 0), (1, [0.0, 2.0], 0), (None, [-1.0, 2.0], 0)], SCHEMA)
    got = whitening.whiten(flat).collect()
    assert [r["component"] for r in got] == [1, 1, 1] and sorted(r["deviation"] for r in got) == [0, 192**2, 192**2]
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e30, 2.0], 0), (2, [1.0, 1.0], 0)], SCHEMA)).collect()


def plain_codes(x, parts, entries, rounds):
    ints = [[math.floor(256 * float(v)) for v in r] for r in x]
    w = len(ints[0]) // parts
    cut = [[r[p * w : (p + 1) * w] for p in range(parts)] for r in ints]
    books = [[r[p] for r in cut[:entries]] for p in range(parts)]

    def nearest(r, p):
        far = [sum((a - b) ** 2 for a, b in zip(r[p], c, strict=True)) for c in books[p]]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        at = [[nearest(r, p)[0] for p in range(parts)] for r in cut]
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [r[p] for r, a in zip(cut, at, strict=True) if a[p] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    last = [[nearest(r, p) for p in range(parts)] for r in cut]
    flat = ",".join(str(v) for b in books for c in b for v in c)
    return ["".join(f"{a:02x}" for a, _ in r) for r in last], [sum(f for _, f in r) for r in last], hashlib.sha256(flat.encode()).hexdigest()


def test_codes_against_plain_integers(spark):
    x = made() - 3
    x[50:60] = x[3]
    labels = [None if i % 7 == 0 else i % 3 for i in range(len(x))]
    df = frame(spark, x, labels)
    for entries, parts in ((64, 16), (256, 4), (3, 1)):
        code, error, sha = plain_codes(x, parts, entries, 2)
        out, books = codes.compress(df, parts, entries)
        got = {r["vec_id"]: r for r in out.collect()}
        assert sorted(got) == list(range(len(x))) and codes.digest(books) == sha
        total = {}
        for k, e in zip(labels, error, strict=True):
            total[k] = total.get(k, 0) + e
        assert all((got[i]["code"], got[i]["error"], got[i]["label_error"]) == (code[i], error[i], total[labels[i]]) for i in got)


def test_codes_edges(spark):
    for df in (spark.createDataFrame([], SCHEMA), spark.createDataFrame(BAD[:2], SCHEMA)):
        out, books = codes.compress(df)
        assert out.collect() == [] and books.size == 0
    few = spark.createDataFrame([(5, [1.0] * 16, None), (5, [1.0] * 16, None), (None, [-1.0] * 16, 1)], SCHEMA)
    out, books = codes.compress(few)
    assert books.shape == (16, 3, 1) and sorted((r["code"], r["error"], r["label_error"]) for r in out.collect()) == [("00" * 16, 0, 0)] * 2 + [("02" * 16, 0, 0)]
    with pytest.raises(ValueError, match="equal parts"):
        codes.compress(few, parts=5)


def test_queries_over_the_test_table(spark):
    from veridra.llm.queries import QUERIES

    pdf = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    pdf = pdf[[v is not None and np.isfinite(v).all() for v in pdf.embedding]].sort_values("vec_id")
    code, error, sha = plain_codes(np.stack(pdf.embedding)[:200], 16, 64, 0)
    got = QUERIES["op13_codes"](spark, SF).toPandas().set_index("vec_id")
    assert len(got) == len(pdf) and got.codebooks_sha256.nunique() == 1 and got.error.sum() <= 1.0 * got.label_error.max() * pdf.label.nunique(dropna=False)
    white = QUERIES["op12_whitening"](spark, SF).toPandas()
    assert len(white) == 32 * len(pdf) and white.identity_error.max() < 1e-9
