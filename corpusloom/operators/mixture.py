"""Diagonal Gaussian mixtures fitted by distributed expectation-maximization."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.blocks import row_blocks, to_lists, to_matrix
from corpusloom.session import ship

VARIANCE_FLOOR = 1e-6
#: Rounds in which candidates for starting centers are drawn, about this often as many as centers in each.
SEED_ROUNDS = 4
SEED_FACTOR = 2
#: Centers that move less have converged.
CENTER_TOLERANCE = 1e-4
DIRECT_BYTES = 32 * 1024 * 1024


@dataclass(frozen=True)
class Mixture:
    """Weights ``(k,)``, means and variances ``(k, d)`` of a diagonal mixture."""

    weights: np.ndarray
    means: np.ndarray
    variances: np.ndarray

    @property
    def k(self) -> int:
        return len(self.weights)

    @property
    def parameter_count(self) -> int:
        return 2 * self.means.size + self.k - 1

    def log_joint(self, x: np.ndarray) -> np.ndarray:
        """``log(weight * density)`` per row and component."""
        precision = 1.0 / self.variances
        constant = (
            np.log(np.maximum(self.weights, 1e-300))
            - 0.5 * np.log(2 * np.pi * self.variances).sum(axis=1)
            - 0.5 * (self.means**2 * precision).sum(axis=1)
        )
        return constant - 0.5 * (x * x) @ precision.T + x @ (self.means * precision).T

    def soft(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Membership probabilities and the log-likelihood per row."""
        joint = self.log_joint(x)
        top = joint.max(axis=1, keepdims=True)
        shifted = np.exp(joint - top)
        total = shifted.sum(axis=1, keepdims=True)
        return shifted / total, (top + np.log(total))[:, 0]


@dataclass(frozen=True)
class Centers:
    """Cluster centers of a k-means round, the start of a mixture."""

    means: np.ndarray

    @property
    def k(self) -> int:
        return len(self.means)

    def soft(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Memberships of 0 and 1 by nearest center, and the negative squared distance to it."""
        distance = (self.means**2).sum(axis=1) - 2 * x @ self.means.T
        nearest = distance.argmin(axis=1)
        return np.eye(self.k)[nearest], -distance[np.arange(len(x)), nearest] - (x * x).sum(axis=1)


@dataclass(frozen=True)
class Statistics:
    """Sums over a pass: responsibilities, weighted vectors and squares, log-likelihood."""

    n: int
    weight: np.ndarray
    sums: np.ndarray
    squares: np.ndarray
    log_likelihood: float

    @staticmethod
    def unpack(flat: np.ndarray, k: int) -> Statistics:
        d = (len(flat) - k - 2) // (2 * k)
        parts = np.split(flat, [2, 2 + k, 2 + k + k * d])
        return Statistics(
            int(round(flat[0])), parts[1], parts[2].reshape(k, d), parts[3].reshape(k, d), float(flat[1])
        )

    def mixture(self) -> Mixture:
        weight = self.weight + 10 * np.finfo(float).eps
        means = self.sums / weight[:, None]
        variances = np.maximum(self.squares / weight[:, None] - means**2, 0.0) + VARIANCE_FLOOR
        return Mixture(weight / weight.sum(), means, variances)

    def centers(self, before: Centers) -> Centers:
        """New centers; one that lost every row stays where it was."""
        empty = self.weight[:, None] == 0
        return Centers(np.where(empty, before.means, self.sums / np.where(empty, 1.0, self.weight[:, None])))


def _pack(model, x: np.ndarray) -> np.ndarray:
    memberships, fit = model.soft(x)
    return np.concatenate(
        [[len(x), fit.sum()], memberships.sum(axis=0), (memberships.T @ x).ravel(), (memberships.T @ (x * x)).ravel()]
    )


def one_pass(
    points: DataFrame, models: dict[int, Mixture | Centers], tasks: int | None = None
) -> dict[int, Statistics]:
    """Statistics of every model from one pass over ``points(features)``.

    A task keeps one sum per model and sends that alone; Spark adds them up and the driver receives
    ``k * (2d + 1)`` numbers per model. Where the number of ``tasks`` is known and all their sums
    stay below ``DIRECT_BYTES``, the driver adds them itself and the shuffle is saved.
    """
    spark = points.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            x = to_matrix(batch["features"])
            for name, model in shared.value.items():
                for part in row_blocks(len(x), model.k):
                    packed = _pack(model, x[part])
                    totals[name] = totals[name] + packed if name in totals else packed
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.int32()), pa.array(list(totals.values()), pa.list_(pa.float64()))],
                names=["model", "statistics"],
            )

    sums = points.select("features").mapInArrow(run, "model int, statistics array<double>")
    size = sum(model.k * (2 * model.means.shape[1] + 1) * 8 for model in models.values())
    if tasks is None or tasks * size > DIRECT_BYTES:
        total = Summarizer.sum(array_to_vector("statistics"))
        sums = sums.groupBy("model").agg(vector_to_array(total).alias("statistics"))
    totals: dict[int, np.ndarray] = {}
    rows = sums.toArrow()
    for name, statistics in zip(rows["model"].to_pylist(), rows["statistics"]):
        flat = statistics.values.to_numpy()
        totals[name] = totals[name] + flat if name in totals else flat
    shared.destroy()
    return {name: Statistics.unpack(flat, models[name].k) for name, flat in totals.items()}


def _uniform(keys: np.ndarray, job: int, round_: int) -> np.ndarray:
    """A number in [0, 1) for each key, job and round, by mixing bits."""
    mixed = keys.view(np.uint64) + np.uint64((job * 1009 + round_ + 1) * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return (mixed ^ (mixed >> np.uint64(31))) / 2.0**64


def _draw(points: DataFrame, centers: dict[int, Centers], sizes: dict[int, int], round_: int) -> dict[int, np.ndarray]:
    """As many rows as ``sizes`` tells for each job, drawn with chances that grow with the squared distance to the nearest center.

    One pass without a total: every row has the priority ``-log(u) / distance``, and the rows of least priority are a weighted
    sample. A task keeps as many as are wanted, and so does the merge.
    """
    spark = points.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(centers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {job: (np.zeros(0), np.zeros(0, np.int64), np.zeros((0, model.means.shape[1]))) for job, model in shared.value.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, keys = to_matrix(batch["features"]), batch["_key"].to_numpy(zero_copy_only=False)
            for job, model in shared.value.items():
                for part in row_blocks(len(x), model.k):
                    distance = np.maximum(-model.soft(x[part])[1], 0.0)
                    with np.errstate(divide="ignore"):
                        priority = -np.log(_uniform(keys[part], job, round_)) / distance
                    far = np.flatnonzero(np.isfinite(priority))
                    least, own, rows = kept[job]
                    priority, key = np.append(least, priority[far]), np.append(own, keys[part][far])
                    best = np.lexsort((key, priority))[: sizes[job]]
                    old, new = best[best < len(least)], best[best >= len(least)] - len(least)
                    order = np.concatenate([old, new + len(least)])
                    kept[job] = priority[order], key[order], np.concatenate([rows[old], x[part][far[new]]])
        for job, (priority, key, rows) in kept.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(key), job, np.int32)), pa.array(priority), pa.array(key), to_lists(rows, pa.float64())],
                names=["job", "priority", "key", "features"],
            )

    fields = "job int, priority double, key bigint, features array<double>"
    drawn = points.select(F.xxhash64("doc_id").alias("_key"), "features").mapInArrow(run, fields)
    place = F.row_number().over(Window.partitionBy("job").orderBy("priority", "key"))
    wanted = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])[F.col("job")]
    found = drawn.withColumn("place", place).filter(F.col("place") <= wanted).select("job", "features").toArrow()
    shared.destroy()
    job, rows = found["job"].to_numpy(), to_matrix(found["features"])
    return {i: rows[job == i] for i in centers}


def spread_centers(points: DataFrame, jobs: list[tuple[int, int]], seed: int, tasks: int | None = None) -> dict[int, Centers]:
    """Starting centers for every ``(k, start)`` of ``jobs``, drawn from all rows.

    Rows far from the candidates so far are drawn in a few rounds, all jobs in the same passes; the
    candidates, a few times ``k`` however many rows there are, are weighted by the rows nearest to
    them, and the driver spreads ``k`` centers over them.
    """
    first = points.agg(
        *[
            F.min_by("features", F.struct(F.xxhash64("doc_id", F.lit(seed), F.lit(k), F.lit(start)), "doc_id")).alias(f"j{i}")
            for i, (k, start) in enumerate(jobs)
        ]
    ).first()
    found = {i: Centers(np.array([first[f"j{i}"]], dtype=float)) for i in range(len(jobs))}
    sizes = {i: int(SEED_FACTOR * k) for i, (k, _) in enumerate(jobs)}
    for round_ in range(SEED_ROUNDS):
        drawn = _draw(points, found, sizes, round_)
        # In a fixed order, whatever the partitions.
        found = {i: Centers(np.unique(np.concatenate([c.means, drawn[i]]) if len(drawn[i]) else c.means, axis=0)) for i, c in found.items()}
    weights = {i: s.weight for i, s in one_pass(points, found, tasks).items()}
    return {i: _spread(found[i].means, weights[i], k, np.random.default_rng([seed, k, start])) for i, (k, start) in enumerate(jobs)}


def _spread(rows: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> Centers:
    """``k`` of the rows, each drawn with a chance that grows with its weight and its distance to those before."""
    chosen = [rng.choice(len(rows), p=weight / weight.sum())]
    nearest = ((rows - rows[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k:
        share = weight * nearest if (weight * nearest).sum() > 0 else weight
        chosen.append(rng.choice(len(rows), p=share / share.sum()))
        nearest = np.minimum(nearest, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
    return Centers(rows[chosen])


@dataclass(frozen=True)
class Fit:
    """A mixture after its last round, with the log-likelihood that round started from."""

    mixture: Mixture
    log_likelihood: float
    n: int
    rounds: int
    converged: bool

    @property
    def k(self) -> int:
        return self.mixture.k


def expectation_maximization(
    points: DataFrame,
    starts: dict[int, Mixture],
    max_iter: int = 300,
    tol: float = 1e-3,
    tasks: int | None = None,
    on_round: Callable[[dict[int, float]], None] | None = None,
) -> dict[int, Fit]:
    """Improve every mixture until its mean log-likelihood gains less than ``tol``.

    All of them share the pass of a round; finished ones leave it.
    """
    fits: dict[int, Fit] = {}
    active, last = dict(starts), dict.fromkeys(starts, -np.inf)
    for round_ in range(1, max_iter + 1):
        statistics = one_pass(points, active, tasks)
        mean_fit = {i: s.log_likelihood / s.n for i, s in statistics.items()}
        if on_round:
            on_round(mean_fit)
        for i, s in statistics.items():
            done = abs(mean_fit[i] - last[i]) < tol
            if done or round_ == max_iter:
                fits[i] = Fit(s.mixture(), s.log_likelihood, s.n, round_, done)
        active = {i: s.mixture() for i, s in statistics.items() if i not in fits}
        last = mean_fit
        if not active:
            break
    return fits


def fit_mixtures(
    points: DataFrame,
    ks: Sequence[int],
    n_init: int = 5,
    max_iter: int = 300,
    tol: float = 1e-3,
    seed: int = 42,
    starts: dict[int, Centers] | None = None,
    on_round: Callable[[dict[int, float]], None] | None = None,
) -> dict[int, Fit]:
    """Fit a mixture for every ``k`` over ``points(doc_id, features)``, keeping the best of ``n_init`` starts.

    All component counts and starts advance in the same pass, so the table is read once per round
    rather than once per round, start and count; finished ones leave the pass. ``points`` should be
    a staged table. Starting centers are drawn from all rows and moved until they stay, ``max_iter``
    rounds at most; ``starts`` gives centers for each ``k`` instead, which are taken as they are.
    """
    if points.count() < max(ks):
        raise ValueError(f"too few rows for {max(ks)} components")
    tasks = points.rdd.getNumPartitions()
    jobs = [(k, start) for k in ks for start in range(1 if starts else n_init)]
    settled: dict[int, Mixture | Centers] = {i: starts[k] for i, (k, _) in enumerate(jobs)} if starts else {}
    active: dict[int, Mixture | Centers] = {} if starts else dict(spread_centers(points, jobs, seed, tasks))
    for _ in range(max_iter):
        if not active:
            break
        statistics = one_pass(points, active, tasks)
        moved = {i: statistics[i].centers(model) for i, model in active.items()}
        still = {i for i in active if not np.allclose(moved[i].means, active[i].means, rtol=0, atol=CENTER_TOLERANCE)}
        settled |= {i: moved[i] for i in active if i not in still}
        active = {i: moved[i] for i in still}
    statistics = one_pass(points, settled | active, tasks)
    mixtures = {i: s.mixture() for i, s in sorted(statistics.items())}

    fits = expectation_maximization(points, mixtures, max_iter, tol, tasks, on_round)
    best: dict[int, Fit] = {}
    for i, (k, _) in enumerate(jobs):
        # Starts that end in the same optimum differ by rounding only: the first of them is kept.
        if k not in best or fits[i].log_likelihood - best[k].log_likelihood > 1e-9 * abs(best[k].log_likelihood):
            best[k] = fits[i]
    return best


def mixture_step(points: DataFrame, mixture: Mixture) -> tuple[Mixture, Statistics]:
    """One round of expectation and maximization."""
    statistics = one_pass(points, {0: mixture})[0]
    return statistics.mixture(), statistics


def memberships(features: Column, mixture: Mixture) -> Column:
    """Membership probabilities of each vector as ``ARRAY<DOUBLE>``; null for a missing vector."""
    ship()

    @F.arrow_udf("array<double>")
    def soft(vectors: pa.Array) -> pa.Array:
        present = vectors.is_valid()
        probs = np.zeros((0, mixture.k))
        if present.true_count:
            probs = mixture.soft(to_matrix(vectors.filter(present)))[0]
        lists = to_lists(probs, pa.float64())
        if vectors.null_count == 0:
            return lists
        place = np.cumsum(present.to_numpy(zero_copy_only=False)) - 1
        return lists.take(pa.array(place, mask=~present.to_numpy(zero_copy_only=False)))

    return soft(features)


def mixture_from_labels(points: DataFrame, label: str = "label", features: str = "embedding") -> Mixture:
    """A mixture whose components are the rows of each label: size, mean and variance.

    Labels must run from 0 without gaps. Copies of a label merge inside the tasks; the driver
    receives one row per label.
    """
    vector = array_to_vector(F.col(features).cast("array<double>"))
    squares = array_to_vector(F.transform(features, lambda x: x.cast("double") * x.cast("double")))
    rows = (
        points.groupBy(label)
        .agg(
            F.count(F.lit(1)).alias("n"),
            vector_to_array(Summarizer.mean(vector)).alias("mean"),
            vector_to_array(Summarizer.mean(squares)).alias("square"),
        )
        .orderBy(label)
        .collect()
    )
    if [row[label] for row in rows] != list(range(len(rows))):
        raise ValueError("labels must run from 0 without gaps or nulls")
    n = np.array([row.n for row in rows], dtype=float)
    means = np.array([row["mean"] for row in rows])
    variances = np.array([row["square"] for row in rows]) - means**2 + VARIANCE_FLOOR
    return Mixture(n / n.sum(), means, variances)
