"""Grid algorithms against brute force, including crowded cells and crowded places."""

import numpy as np
import pytest

from sirenlake.operators import spatial


def sample(seed):
    """Two dense blobs, a bridge, a crowd at one place and scattered noise."""
    rng = np.random.default_rng(seed)
    blobs = [rng.normal((0, 0), 0.15, (150, 2)), rng.normal((2, 0.4), 0.15, (120, 2))]
    bridge = np.column_stack([np.linspace(0.4, 1.1, 8), np.zeros(8)])
    crowd = np.repeat([[5.0, 5.0]], 40, axis=0)
    return np.vstack([*blobs, bridge, crowd, rng.uniform(-6, 9, (40, 2))])


def frame(spark, xy):
    return spark.createDataFrame([(f"p{i:04d}", float(x), float(y)) for i, (x, y) in enumerate(xy)], "id string, x double, y double")


def brute_neighbours(xy, eps):
    return ((xy[:, None] - xy[None]) ** 2).sum(axis=2) <= eps * eps


def brute_dbscan(xy, eps, least):
    near = brute_neighbours(xy, eps)
    core = near.sum(axis=1) >= least
    label = np.full(len(xy), -1)
    found = 0
    for i in range(len(xy)):
        if not core[i] or label[i] >= 0:
            continue
        todo = [i]
        label[i] = found
        while todo:
            for j in np.flatnonzero(near[todo.pop()]):
                if label[j] < 0:
                    label[j] = found
                    if core[j]:
                        todo.append(j)
        found += 1
    return label


@pytest.mark.parametrize("pair_limit", [4096, 6])
def test_neighbour_counts(spark, monkeypatch, pair_limit):
    monkeypatch.setattr(spatial, "PAIR_LIMIT", pair_limit)
    xy, eps = sample(1), 0.21
    got = {r.id: r.neighbours for r in spatial.neighbour_count(frame(spark, xy), eps, "x", "y").collect()}
    want = brute_neighbours(xy, eps).sum(axis=1)
    assert [got[f"p{i:04d}"] for i in range(len(xy))] == want.tolist()


@pytest.mark.parametrize("pair_limit, seed", [(4096, 1), (6, 1), (6, 2)])
def test_dbscan_labels_equal_brute_force(spark, monkeypatch, pair_limit, seed):
    monkeypatch.setattr(spatial, "PAIR_LIMIT", pair_limit)
    xy, eps, least = sample(seed), 0.21, 5
    got = {r.id: r.cluster for r in spatial.dbscan(frame(spark, xy), eps, least, "id", "x", "y").collect()}
    assert [got[f"p{i:04d}"] for i in range(len(xy))] == brute_dbscan(xy, eps, least).tolist()
    assert len(set(got.values())) > 3


def test_long_chain_is_one_cluster(spark):
    xy = np.column_stack([np.arange(300) * 0.9, np.zeros(300)])
    got = spatial.dbscan(frame(spark, xy), 1.0, 2, "id", "x", "y")
    assert {r.cluster for r in got.select("cluster").distinct().collect()} == {0}


def test_nothing_dense_is_all_noise(spark):
    got = spatial.dbscan(frame(spark, np.array([[0.0, 0], [5, 5], [9, 0]])), 1.0, 2, "id", "x", "y")
    assert {r.cluster for r in got.collect()} == {-1} and got.count() == 3


@pytest.mark.parametrize("block", [512, 37])
def test_silhouette_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(spatial, "BLOCK_POSITIONS", block)
    xy, eps = sample(1), 0.21
    label = brute_dbscan(xy, eps, 5)
    dist = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(axis=2))
    scores = []
    for i, c in enumerate(label):
        size = (label == c).sum()
        if size == 1:
            scores.append(0.0)
            continue
        a = dist[i, label == c].sum() / (size - 1)
        b = min(dist[i, label == o].mean() for o in set(label) - {c})
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    pts = spark.createDataFrame([(float(x), float(y), int(c)) for (x, y), c in zip(xy, label)], "latitude double, longitude double, cluster int")
    got = spatial.silhouette_exact(pts).first()
    assert got.silhouette == pytest.approx(np.mean(scores), abs=1e-9)
    assert got.clusters == len(set(label)) - 1


def test_two_blobs_separate_well(spark):
    rng = np.random.default_rng(0)
    xy = np.vstack([rng.normal((40.4, -80), 0.01, (20, 2)), rng.normal((40.9, -79.5), 0.01, (20, 2))])
    got = spatial.dbscan(frame(spark, xy), 0.05, 3, "id", "x", "y")
    s = spatial.silhouette_exact(got, "x", "y").first()
    assert s.clusters == 2 and s.silhouette > 0.4


def test_one_cluster_scores_zero(spark):
    pts = spark.createDataFrame([(0.0, 0.0, 0), (0.1, 0.0, 0), (9.0, 9.0, -1)], "latitude double, longitude double, cluster int")
    assert spatial.silhouette_exact(pts).first().silhouette == 0.0
