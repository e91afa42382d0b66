"""Vectors whose vec_id repeats with other vectors are told apart, against all cosines."""

import numpy as np
import pytest

from barloom.llm import embedding_dedup


def brute(rows, threshold=0.95):
    """For each row of distinct (id, vector) its links and the smallest id reachable."""
    distinct = sorted({(i, tuple(v)) for i, v in rows})
    x = np.array([v for _, v in distinct])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    comp = list(range(len(distinct)))
    changed = True
    while changed:
        new = [min([comp[i], *(comp[j] for j in np.flatnonzero(near[i]))]) for i in range(len(comp))]
        changed, comp = new != comp, new
    name = {}
    for c, (i, _) in zip(comp, distinct, strict=True):
        name[c] = min(name.get(c, i), i)
    return {d: (int(near[k].sum()), name[comp[k]]) for k, d in enumerate(distinct)}


@pytest.mark.parametrize("kind", ["float", "double"])
def test_one_id_and_several_vectors(spark, kind):
    rng = np.random.default_rng(6)
    a, b = rng.normal(size=(2, 24))
    rows = [(5, a), (5, b), (8, a), (9, b), (6, a + rng.normal(size=24) * 0.05), (7, b + rng.normal(size=24) * 0.05), (8, a), (4, rng.normal(size=24))]
    for k in range(40):
        c = rng.normal(size=24)
        rows += [(int(i), c + rng.normal(size=24) * 0.04) for i in rng.integers(100, 130, rng.integers(1, 4))]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    want = brute(rows)
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(df).collect())
    assert got == sorted((i, *want[i, tuple(v)], i == want[i, tuple(v)][1]) for i, v in rows)
