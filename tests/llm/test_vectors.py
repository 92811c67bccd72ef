"""Near copies among embeddings and centroid clustering, against brute force."""

import hashlib
import math

import numpy as np
import pytest

from commentlens.llm import centroids, vector_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, node long, kept string, cluster string"
NAN, INF = float("nan"), float("inf")


def _table(spark, rows, kind="float"):
    schema = SCHEMA.replace("array<float>", f"array<{kind}>")
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], lab, 7, "clash", "clash") for i, v, lab in rows], schema)


def _good(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)


def _linked(rows, cosine):
    """``(id, links, smallest id reached)`` of each row, sorted."""
    n = len(rows)
    links = [[] for _ in range(n)]
    for i, (_, v, a) in enumerate(rows):
        for j, (_, w, b) in enumerate(rows):
            if i != j and a is not None and a == b and _good(v) and _good(w) and len(v) == len(w):
                x, y = (np.asarray(z, np.float32).astype(float) for z in (v, w))
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
                    links[i].append(j)
    ids = [-math.inf if r[0] is None else r[0] for r in rows]
    low = list(ids)
    for _ in range(n):
        new = [min([low[i], *(low[j] for j in links[i])]) for i in range(n)]
        if new == low:
            break
        low = new
    return sorted((ids[i], len(links[i]), low[i], low[i] == ids[i]) for i in range(n))


def _found(df, **kw):
    got = vector_dedup.linked_vectors(df, **kw).collect()
    lift = lambda x: -math.inf if x is None else x
    return sorted((lift(r.vec_id), r.n_links, lift(r.component_id), r.kept) for r in got)


def _near(rng, base, cosine):
    other = rng.normal(size=len(base))
    other -= other @ base * base
    return cosine * base + math.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


def _unit(rng, d=64):
    x = rng.normal(size=d)
    return x / np.linalg.norm(x)


def test_links_odd_rows(spark):
    rng = np.random.default_rng(1)
    a, b = _unit(rng), _unit(rng, 5)
    rows = [
        (1, a, 0), (2, a * 3, 0), (3, a, 0), (3, a, 0), (4, a, 1), (5, a, None), (6, None, 0), (7, [], 0), (8, [0.0] * 64, 0),
        (9, [NAN, *a[1:]], 0), (10, [None, *a[1:]], 0), (11, [INF, *a[1:]], 0), (12, b, 0), (13, _near(rng, b, 0.95), 0), (14, a[:63], 0),
        (None, -a, 0), (None, -a * 2, 0), (15, _near(rng, a, 0.931), 0), (16, _near(rng, a, 0.92), 0), (17, a * 1e-20, 0),
        (3, _unit(rng), 0), (18, [1.0], 2), (19, [2.0], 2), (20, [-1.0], 2),
    ]
    assert _found(_table(spark, rows)) == _linked(rows, 0.93)
    assert _found(_table(spark, rows, "double"), block=2) == _linked(rows, 0.93)
    assert _found(_table(spark, [])) == []
    assert _found(_table(spark, [(1, None, None), (2, [0.0], 3)])) == [(1, 0, 1, True), (2, 0, 2, True)]


@pytest.mark.parametrize("block", [3, 4096])
def test_links_of_groups(spark, block):
    """A dense ball, members beyond its half angle, a chain, and a second label with the same vectors."""
    rng = np.random.default_rng(2)
    centre, rows = _unit(rng), []
    for i in range(40):
        rows.append((i, _near(rng, centre, rng.choice([0.999, 0.97, 0.95, 0.94])), i % 2))
    step = _unit(rng)
    for i in range(12):  # each links with the next ones only
        rows.append((100 + i, step, 0))
        step = _near(rng, step, 0.96)
    rows += [(200 + i, _unit(rng), i % 2) for i in range(150)]
    rows += [(400 + i, rows[0][1], 0) for i in range(9)]
    expected = _linked(rows, 0.93)
    assert any(not r[3] for r in expected)
    assert _found(_table(spark, rows), block=block) == expected


def test_recall_at_the_threshold():
    """Pairs exactly at the threshold, with codes as long as for a million vectors of one label."""
    rng = np.random.default_rng(3)
    base = np.array([_unit(rng) for _ in range(1500)])
    near = np.array([_near(rng, x, 0.93) for x in base])
    widths = vector_dedup.code_widths(20 + vector_dedup.SLACK, 64)
    met = np.zeros(len(base), bool)
    for t in range(vector_dedup.TABLES):
        x, y = (vector_dedup.bucket_codes(v, t, widths, vector_dedup.PROBES) for v in (base, near))
        assert x.shape == (len(base), vector_dedup.PROBES + 1)
        met |= (x == y[:, :1]).any(axis=1) | (y == x[:, :1]).any(axis=1)
    assert met.mean() >= 0.93


def test_hadamard_is_orthogonal():
    x = vector_dedup.hadamard(np.eye(16))
    assert np.allclose(x @ x.T, np.eye(16)) and set(np.round(np.abs(x).ravel(), 12)) == {0.25}
    assert vector_dedup.code_widths(17, 64) == [64, 64, 4] and vector_dedup.code_widths(3, 64) == [4]


def _clustered(rows, k, d, rounds, scale, seed):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v, _ in rows if v is not None and len(v) == d and _good([*v, 1.0])]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centres = [list(x) for _, x in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    gap = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    for turn in range(rounds + 1):
        of = [min(range(len(centres)), key=lambda c: (gap(x, centres[c]), c)) for _, x in kept]
        if turn < rounds:
            for c in range(len(centres)):
                own = [x for (_, x), o in zip(kept, of) if o == c]
                if own:
                    centres[c] = [sum(col) // len(own) for col in zip(*own)]
    dist = [gap(x, centres[o]) for (_, x), o in zip(kept, of)]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(
        ((str(i), o, g, sum(h for h, p in zip(dist, of) if p == o), sum(dist), digest[o]) for (i, _), o, g in zip(kept, of, dist))
    )


@pytest.mark.parametrize("k", [1, 3, 7, 60])
def test_centroids(spark, k):
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-3, 4, 4) / 4, 0) for i in range(40)]
    rows += [(40, [0.1] * 3, 0), (41, None, 0), (42, [NAN, 0, 0, 0], 1), (43, [None, 0, 0, 0], 1), (44, [INF, 0, 0, 0], 1), (45, [], None)]
    rows += [(7, [0.5, -0.5, 0.25, 9.0], 0), (7, rows[7][1], 0), (None, [-7.3, 2.2, 0.0, 0.01], None), (46, [0.0] * 4, 0), (47, [-0.0] * 4, 0)]
    got = centroids.cluster_vectors(_table(spark, rows), k, 4, 3, 10, "s").collect()
    assert sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got) == _clustered(rows, k, 4, 3, 10, "s")


def test_centroids_of_nothing(spark):
    assert centroids.cluster_vectors(_table(spark, [(1, [1.0], 0)]), 2, 4).collect() == []
    with pytest.raises(ValueError):
        centroids.cluster_vectors(_table(spark, [(1, [1e30, 0.0], 0)]), 2, 2)


def test_products_are_updated():
    rng = np.random.default_rng(5)
    x, before, after = rng.integers(-9, 9, (20, 6)), rng.integers(-9, 9, (4, 6)), rng.integers(-9, 9, (4, 6))
    after[2], after[3, 1:] = before[2], before[3, 1:]  # one stays, one moves in a component
    assert (centroids.updated(x @ before.T, x, after - before) == x @ after.T).all()
