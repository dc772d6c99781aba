import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators.clusters import (
    ClusterModel,
    find_optimal_clusters,
    load_model,
    predict,
    reduced_points,
    save_model,
    train,
)
from corpusloom.operators.mixture import Mixture, fit_mixtures, memberships, mixture_from_labels, mixture_step, one_pass
from corpusloom.operators.project import explained_variance, fit_projection, project
from corpusloom.operators.report import (
    cluster_composition,
    confidence_bands,
    membership_check,
    top_three_report,
)
from corpusloom.operators.sample import hash_sample
from corpusloom.operators.selection import select_k, silhouette
from corpusloom.sources.tables import save_composition, save_selection


def blobs(k=4, n=400, d=6, seed=0, spread=0.3):
    rng = np.random.default_rng(seed)
    centers = rng.normal(scale=3, size=(k, d))
    label = rng.integers(k, size=n)
    return centers[label] + rng.normal(scale=spread, size=(n, d)), label


def points_table(spark, x, label=None, column="features", parts=3):
    rows = [(i, v.tolist(), int(label[i]) if label is not None else 0) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, f"doc_id bigint, {column} array<double>, label int").repartition(parts, "doc_id")


def log_density(x, mixture):
    """Direct formula per row and component."""
    out = np.empty((len(x), mixture.k))
    for j in range(mixture.k):
        var = mixture.variances[j]
        out[:, j] = np.log(mixture.weights[j]) - 0.5 * (
            np.log(2 * np.pi * var) + (x - mixture.means[j]) ** 2 / var
        ).sum(axis=1)
    return out


def test_memberships_and_likelihood(spark):
    x, label = blobs()
    table = points_table(spark, x, label)
    mixture = mixture_from_labels(table, features="features")
    joint = log_density(x, mixture)
    expected = np.exp(joint - joint.max(axis=1, keepdims=True))
    expected /= expected.sum(axis=1, keepdims=True)
    rows = table.select("doc_id", memberships(F.col("features"), mixture).alias("p")).orderBy("doc_id").collect()
    assert np.allclose([r.p for r in rows], expected, atol=1e-9)
    total = one_pass(table, {0: mixture})[0].log_likelihood
    top = joint.max(axis=1)
    assert np.isclose(total, (top + np.log(np.exp(joint - top[:, None]).sum(axis=1))).sum())


def test_memberships_of_missing_vectors(spark):
    x, label = blobs(n=20)
    mixture = mixture_from_labels(points_table(spark, x, label), features="features")
    df = spark.createDataFrame([(0, None), (1, x[0].tolist()), (2, None)], "i int, v array<double>").coalesce(1)
    rows = df.select("i", memberships(F.col("v"), mixture).alias("p")).orderBy("i").collect()
    assert rows[0].p is None and rows[2].p is None and np.isclose(sum(rows[1].p), 1)


def test_one_step_from_labels(spark):
    x, label = blobs()
    table = points_table(spark, x, label)
    start = mixture_from_labels(table, features="features")
    step, _ = mixture_step(table, start)
    joint = log_density(x, start)
    p = np.exp(joint - joint.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    assert np.allclose(step.weights, p.mean(axis=0))
    means = p.T @ x / p.sum(axis=0)[:, None]
    assert np.allclose(step.means, means)
    assert np.allclose(step.variances, p.T @ (x * x) / p.sum(axis=0)[:, None] - means**2 + 1e-6)


def test_fit_finds_blobs_and_likelihood_never_falls(spark):
    x, label = blobs()
    history = {}

    def watch(fits):
        for i, value in fits.items():
            history.setdefault(i, []).append(value)

    fit = fit_mixtures(points_table(spark, x), [4], n_init=3, on_round=watch)[4]
    assert fit.converged and np.isclose(fit.mixture.weights.sum(), 1)
    for values in history.values():
        assert np.all(np.diff(values) > -1e-9)
    found = log_density(x, fit.mixture).argmax(axis=1)
    assert len({(a, b) for a, b in zip(label, found)}) == 4


def test_fit_does_not_depend_on_partitions(spark):
    x, _ = blobs(n=200)
    one = fit_mixtures(points_table(spark, x, parts=1), [3], n_init=2)[3].mixture
    many = fit_mixtures(points_table(spark, x, parts=5), [3], n_init=2)[3].mixture
    assert np.allclose(one.means, many.means, atol=1e-8)


def test_more_components_than_rows(spark):
    x, _ = blobs(n=3)
    with pytest.raises(ValueError):
        fit_mixtures(points_table(spark, x), [4])


def test_identical_points(spark):
    fit = fit_mixtures(points_table(spark, np.ones((50, 3))), [2], n_init=1)[2]
    assert np.isfinite(fit.log_likelihood) and np.isfinite(fit.mixture.means).all()


def test_projection_centers_and_explains(spark):
    x, _ = blobs(n=300, d=8)
    table = points_table(spark, x, column="embedding")
    model = fit_projection(table, 3)
    z = np.array([r.features for r in project(table, model).orderBy("doc_id").collect()])
    centered = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(np.cov(centered.T))
    assert np.allclose(np.abs(z), np.abs(centered @ axes[:, ::-1][:, :3]), atol=1e-6)
    assert np.allclose(explained_variance(model), values[::-1][:3] / values.sum())


def plain_silhouette(x, label):
    distance = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    out = []
    for i in range(len(x)):
        same = (label == label[i]) & (np.arange(len(x)) != i)
        if not same.any():
            out.append(0.0)
            continue
        a = distance[i, same].mean()
        b = min(distance[i, label == other].mean() for other in set(label) - {label[i]})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_silhouette(spark):
    x, label = blobs(n=90, spread=2.0)
    label[0] = 9
    table = points_table(spark, x, label).withColumn("one", F.lit(1))
    rows = {r.labelling: r for r in silhouette(table, ["label", "one"]).collect()}
    assert np.isclose(rows["label"].silhouette, plain_silhouette(x, label)) and rows["label"].n == 90
    assert rows["one"].silhouette is None


def test_silhouette_of_blocks_that_lie_in_many_partitions(spark):
    x, label = blobs(n=90, spread=2.0)
    table = points_table(spark, x, label)
    settings = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        row = silhouette(table, ["label"], block_rows=20).first()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert np.isclose(row.silhouette, plain_silhouette(x, label)) and row.n == 90


def test_sample_is_repeatable(spark):
    x, _ = blobs(n=200)
    picks = [
        sorted(r.doc_id for r in hash_sample(points_table(spark, x, parts=p), 50, seed).collect())
        for p, seed in [(1, 42), (4, 42), (1, 43)]
    ]
    assert picks[0] == picks[1] != picks[2] and len(set(picks[0])) == 50
    assert hash_sample(points_table(spark, x), 5000).count() == 200


def test_selection(spark, tmp_path):
    x, _ = blobs(k=3, n=300, d=4)
    selection = select_k(points_table(spark, x), [2, 3, 4], n_init=2, sample_rows=100)
    rows = {r.k: r for r in selection.table.collect()}
    assert selection.optimal_k == min(rows, key=lambda k: (rows[k].bic, k)) == 3
    for k, row in rows.items():
        assert np.isclose(row.bic - row.aic, (2 * k * 4 + k - 1) * (np.log(300) - 2))
        assert row.optimal == (k == 3) and not row.at_edge
    save_selection(selection.table, str(tmp_path / "selection"))
    assert spark.read.json(str(tmp_path / "selection")).count() == 3


def test_winner_at_the_edge_is_flagged(spark):
    x, _ = blobs(k=3, n=200, d=4)
    rows = select_k(points_table(spark, x), [2, 3], n_init=2).table.collect()
    assert [r.k for r in rows if r.at_edge] == [3]


def test_train_predict_save_load(spark, tmp_path):
    x, label = blobs(n=200, d=8)
    table = points_table(spark, x, column="embedding")
    reduced = reduced_points(table, 3)
    model = train(table, 4, reduced=reduced, n_init=2)
    assigned = model.predict(table)
    check = membership_check(assigned).first()
    assert check.is_distribution and check.n_documents == 200 and check.n_clusters == 4
    path = str(tmp_path / "model")
    with pytest.raises(FileNotFoundError):
        load_model(spark, path)
    save_model(model, spark, path)
    loaded, probs = load_model(spark, path)
    assert probs is None
    save_model(model, spark, path, assigned)
    again, probs = load_model(spark, path)
    assert probs.count() == 200
    first = {r.doc_id: r.cluster_probs for r in assigned.collect()}
    for row in loaded.predict(table).collect():
        assert np.allclose(row.cluster_probs, first[row.doc_id])
    with pytest.raises(RuntimeError):
        predict(table, None)
    assert predict(table, again).columns == [*table.columns, "cluster_probs", "dominant_cluster"]


def test_find_optimal_clusters(spark):
    x, _ = blobs(k=3, n=200, d=6)
    selection, model = find_optimal_clusters(points_table(spark, x, column="embedding"), [2, 3, 4], 3, n_init=2)
    assert model.mixture.k == selection.optimal_k == 3


def assigned_table(spark, rows):
    return spark.createDataFrame(rows, "category string, dominant_cluster int, cluster_probs array<double>")


def test_bands_keep_their_gap(spark):
    tops = [0.71, 0.7, 0.6, 0.5, 0.3, 0.29]
    row = confidence_bands(assigned_table(spark, [("c", 0, [t]) for t in tops])).first()
    assert (row.high_confidence_count, row.other_count, row.boundary_count, row.uncertain_count) == (1, 2, 2, 1)
    assert row.high_confidence_pct == "16.7%" and row.n_documents == 6
    assert confidence_bands(assigned_table(spark, [])).first().n_documents == 0


def test_composition(spark, tmp_path):
    rows = [(c, 0, [1.0]) for c in "aabbbcdefgg"] + [("z", 2, [1.0])]
    composition = cluster_composition(assigned_table(spark, rows), 3)
    found = {r.cluster: (r.total_docs, [tuple(e) for e in r.top_categories]) for r in composition.collect()}
    assert found[0] == (11, [("b", 3), ("a", 2), ("g", 2), ("c", 1), ("d", 1)])
    assert found[1] == (0, []) and found[2] == (1, [("z", 1)])
    report = {r.cluster: r.top_categories for r in top_three_report(composition).collect()}
    assert report == {0: "b(3), a(2), g(2)", 1: "", 2: "z(1)"}
    save_composition(confidence_bands(assigned_table(spark, rows)), composition, str(tmp_path / "report"))
    lines = (tmp_path / "report" / "clusters").glob("*.json")
    assert sorted(json.loads(line)["cluster"] for f in lines for line in f.read_text().splitlines()) == [0, 1, 2]


def test_parameter_table(spark):
    mixture = Mixture(np.array([0.25, 0.75]), np.zeros((2, 3)), np.ones((2, 3)))
    rows = ClusterModel(mixture).parameters(spark).orderBy("k").collect()
    assert [r.weight for r in rows] == [0.25, 0.75] and mixture.parameter_count == 2 * 6 + 1


def test_starting_centers_are_drawn_with_the_package_sent(spark, monkeypatch):
    """Workers of a cluster know the package only once it was sent, and drawing is the first that needs it."""
    from corpusloom.operators import mixture

    sent = []
    plain = mixture.ship
    monkeypatch.setattr(mixture, "ship", lambda *args: sent.append(1) or plain(*args))
    points = spark.createDataFrame([(i, [float(i), float(i % 3)]) for i in range(20)], "doc_id long, features array<double>")
    drawn = mixture._draw(points, {0: mixture.Centers(np.zeros((1, 2)))}, {0: 4}, 0)
    assert len(drawn[0]) == 4 and sent
