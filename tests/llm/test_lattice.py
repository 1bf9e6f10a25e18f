"""Lattice hashing: the nearest point by search, links and groups by all pairs."""

import numpy as np
import pytest

from pricelake.llm import lattice as L


def test_nearest_point_is_the_nearest():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)) * 2
    points = L.nearest(x)
    twice = 2 * points
    assert (twice == np.rint(twice)).all() and (points.sum(1) % 2 == 0).all()
    assert (np.ptp(twice % 2, axis=1) == 0).all()
    own = ((x - points) ** 2).sum(1)
    around = ((x[:, None] - (points[:, None] + L.shortest()[None])) ** 2).sum(2)
    assert (own <= around.min(1) + 1e-9).all() and len(L.shortest()) == 240 and own.max() <= 1 + 1e-9


def vectors():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(300, 32))
    near = base[:40] + 0.12 * rng.normal(size=(40, 32))
    dense = rng.normal(size=32) + 0.08 * rng.normal(size=(700, 32))  # a group that takes several blocks
    rows = [(int(i), [float(np.float32(v)) for v in x]) for i, x in enumerate(np.concatenate([base, near, dense]))]
    odd = [(5000, None), (5001, [0.0] * 32), (5002, [float("nan")] * 32), (5003, [None] * 32), (5004, []), (5005, [1.0, 2.0]), (5006, [2.0, 4.0]), (None, rows[0][1]), (0, rows[0][1]), (5007, [1e300] * 32), (5008, [1e-300] * 32)]
    return rows + odd


def test_links_and_groups(spark, monkeypatch):
    monkeypatch.setattr(L, "SHORT", 16)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS label", "'x' AS node", "'y' AS id", "'z' AS unit")
    got = L.near_groups(df).collect()
    assert len(got) == len(rows)
    real = {(i, None if x is None else tuple(x)) for i, x in rows}
    items = sorted(((i, np.array(x)) for i, x in real if x and None not in x and np.isfinite(x).all() and any(x)), key=lambda p: (p[0] is None, p[0] or 0))
    units = [x / np.abs(x).max() for _, x in items]
    units = [x / np.linalg.norm(x) for x in units]
    links = np.array([[a.shape == b.shape and float(a @ b) >= 0.9 for b in units] for a in units])
    np.fill_diagonal(links, False)
    true = {items[k][0]: int(links[k].sum()) for k in range(len(items))}
    found = {r["vec_id"]: r["n_links"] for r in got}
    assert all(found[i] <= true.get(i, 0) for i in found)
    assert sum(found.values()) >= 0.97 * sum(true.values())
    labels = list(range(len(items)))
    for _ in range(len(items)):
        new = [min([labels[k], *(labels[j] for j in np.flatnonzero(links[k]))]) for k in range(len(items))]
        if new == labels:
            break
        labels = new
    component = {items[k][0]: items[labels[k]][0] for k in range(len(items))}
    agree = [r["component_id"] == component.get(r["vec_id"], r["vec_id"]) for r in got]
    assert sum(agree) >= 0.99 * len(agree)
    by_id = {r["vec_id"]: r for r in got}
    assert by_id[5005]["component_id"] == by_id[5006]["component_id"] == 5005
    assert by_id[None]["component_id"] == 0 and not by_id[None]["kept"] and by_id[5007]["component_id"] == by_id[5008]["component_id"]
    assert all((by_id[i]["n_links"], by_id[i]["kept"]) == (0, True) for i in (5000, 5001, 5002, 5003, 5004))
    assert L.near_groups(df.limit(0)).collect() == []


def test_more_vectors_take_more_groups():
    assert L.design(500, 64)[1] == 1 and L.design(10**7, 64)[1] == 3
    with pytest.raises(Exception):
        L.Tables(0, 1, 1).keys(np.zeros((1, 3)), 0)


@pytest.mark.parametrize("cosine", [0.8, 0.85, 0.9, 0.95])
def test_tables_follow_the_threshold(cosine):
    tables, groups = L.design(2000, 32, cosine)
    rng = np.random.default_rng(9)
    a, b = rng.normal(size=(2, 400, 32))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(1)[:, None] * a
    b = cosine * a + np.sqrt(1 - cosine**2) * b / np.linalg.norm(b, axis=1)[:, None]
    made = L.Tables(32, tables, groups)
    met = np.zeros(400, bool)
    for table in range(tables):
        x, y = made.keys(a, table), made.keys(b, table)
        met |= (x[:, :, None] == y[:, None, :]).any((1, 2))
    assert met.mean() > 0.9
