"""Full-batch logistic regression whose weights, gradients and search points are columns of tables.

Rows are (id, term, weight) with labels (id, label). The model is a table (term, w), the
intercept its row with the empty term, so neither the vocabulary nor a coefficient vector
has to fit on one machine. All points and folds of a search share each scan: a point and fold is one column.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.operators import parts
from lexmill.session import stage

INTERCEPT = ""


@dataclass(frozen=True)
class Task:
    """One column: a penalty with its strength, and the fold that it does not learn from."""

    penalty: str
    C: float
    point: int = 0
    fold: int | None = None


@dataclass
class Design:
    """Training rows as they are scanned in each step.

    ``rows`` (part, id, label, fold, at, weight) and ``links`` (of, term, place) are bucketed by part, so that margins and
    gradients of a part's rows need no shuffle and only its distinct terms meet the weights; ``curvature`` (term, d) bounds
    the second derivative of the summed loss in each term.
    """

    rows: DataFrame
    links: DataFrame
    curvature: DataFrame
    counts: dict[int, int]

    def learned(self, task: Task) -> int:
        return sum(n for fold, n in self.counts.items() if task.fold is None or fold != task.fold)


def design(features: DataFrame, labels: DataFrame, row_id: str = "id", label: str = "label",
           fold: str | None = None, buckets: int | None = None) -> Design:
    """Pack the features of each row, with a one for the intercept; a row without features keeps that alone.

    A repeated term of a row counts with the sum of its weights. The bound on the curvature is that of separable
    surrogates: a quarter of the sum over the rows of a term's size times the sizes of all terms in the row.
    """
    packed, _, _ = parts.pack(features, labels, row_id, label, fold, buckets)
    rows, terms = parts.rows_of(packed), parts.terms_of(packed)
    links = terms.select("part", "first", F.posexplode(F.arrays_zip("terms", "size")).alias("k", "x")).select(
        F.col("part").alias("of"), F.col("x.terms").alias("term"), F.greatest(F.col("first") + F.col("k"), F.lit(-1)).alias("place"),
        F.col("x.size").alias("size"))
    curvature = links.groupBy("term").agg((0.25 * F.sum("size")).alias("d"))
    counts = {r["fold"]: r["count"] for r in rows.groupBy("fold").count().collect()}
    return Design(rows, links.drop("size"), stage(curvature.where("d > 0"), "curvature"), counts)


def start_state(data: Design, tasks: Sequence[Task]) -> DataFrame:
    """(term, d, w0.., v0..): all weights and search places are zero."""
    zeros = [F.lit(0.0).alias(f"{c}{j}") for c in "wv" for j in range(len(tasks))]
    return data.curvature.select("term", "d", *zeros)


def _meet(data: Design, state: DataFrame, columns: Sequence[str], apply: Callable, schema: str) -> DataFrame:
    """``apply`` on the rows of each part and what the weight columns hold for its terms."""
    entries = data.links.join(state.select("term", *columns), "term")
    return data.rows.groupBy("part").cogroup(entries.groupBy("of")).applyInArrow(apply, schema)


def _margins(rows, entries, columns):
    """(place of each term, row and term and weight of each entry, whether a row has an id, margins of the rows for each column).

    A margin is that of an id, over all its rows; rows with a null id are not learned from.
    """
    import numpy as np

    place = entries.column("place").to_numpy().astype(np.int64)
    n, row, at, weight = parts.entries_of(rows)
    ids = parts.one(rows.column("id")).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    known, found = place >= 0, []
    for c in columns:
        w = np.nan_to_num(parts.floats(entries.column(c)))
        held = np.zeros(max(int(at.max(initial=-1)), int(place.max(initial=-1))) + 1)
        held[place[known]] = w[known]
        margin = np.bincount(row, weights=weight * held[at], minlength=n) + w[~known].sum()
        found.append(np.bincount(ids, weights=margin)[ids])
    return place, row, at, weight, parts.one(rows.column("id")).is_valid().to_numpy(zero_copy_only=False), found


def gradients(data: Design, state: DataFrame, tasks: Sequence[Task], columns: Sequence[str]) -> DataFrame:
    """(term, g0..): the gradient of the summed loss of each task at its column, from one scan for all.

    A part gives one sum for each of its terms; only those are shuffled.
    """
    columns = list(columns)

    def slopes(rows, entries):
        import numpy as np
        import pyarrow as pa

        place, row, at, weight, with_id, margins = _margins(rows, entries, columns)
        label, fold, out = parts.floats(rows.column("label")), parts.floats(rows.column("fold")), {"term": entries.column("term")}
        for j, (t, m) in enumerate(zip(tasks, margins)):
            learns = with_id & ((t.fold is None) | ~np.isnan(fold) & (fold != t.fold))
            # As in a sum over entries: a label that is null says nothing, and a term without any other has no gradient.
            says = with_id & ~(learns & np.isnan(label))
            wrong = np.where(learns & says, parts.probability(m) - label, 0.0)
            sums = np.bincount(at, weights=weight * wrong[row], minlength=int(place.max(initial=-1)) + 1)
            heard = np.bincount(at, weights=says[row], minlength=int(place.max(initial=-1)) + 1)
            g, silent = np.full(len(place), wrong.sum()), np.full(len(place), not says.any())
            g[place >= 0], silent[place >= 0] = sums[place[place >= 0]], heard[place[place >= 0]] == 0
            out[f"g{j}"] = pa.array(g, mask=silent)
        return pa.table(out)

    names = [f"g{j}" for j in range(len(tasks))]
    partial = _meet(data, state, columns, slopes, "term string, " + ", ".join(f"{g} double" for g in names))
    return partial.groupBy("term").agg(*[F.sum(g).alias(g) for g in names])


def step(data: Design, state: DataFrame, tasks: Sequence[Task], momentum: float | Sequence[float] = 0.0) -> DataFrame:
    """The state after one proximal step of all tasks, with momentum (of each) for the place of the next gradient.

    Beside it stand the weights and places before the step (o0.., u0..).

    Each weight goes to the least of the quadratic bound with its penalty: l2 shrinks it, l1 sets it to zero within a margin.
    The loss is the mean over the rows, the penalty strength one over C times their number; the intercept is free.
    """
    numbers = range(len(tasks))
    momenta = [momentum] * len(tasks) if isinstance(momentum, float) else momentum
    g = gradients(data, state, tasks, [f"v{j}" for j in numbers])
    new = ["term", "d"]
    for j, t in enumerate(tasks):
        n = max(data.learned(t), 1)
        strength = F.when(F.col("term") == INTERCEPT, 0.0).otherwise(1.0 / (t.C * n))
        d, at = F.col("d") / n, F.col(f"v{j}") * F.col("d") / n - F.col(f"g{j}") / n
        if t.penalty == "l1":
            moved = F.signum(at) * F.greatest(F.abs(at) - strength, F.lit(0.0)) / d
        elif t.penalty == "l2":
            moved = at / (d + strength)
        else:
            raise ValueError(f"unknown penalty: {t.penalty}")
        new += [F.col(f"w{j}").alias(f"o{j}"), F.col(f"v{j}").alias(f"u{j}"), moved.alias(f"w{j}")]
    moved = state.join(g, "term").select(*new)
    places = [(F.col(f"w{j}") + momenta[j] * (F.col(f"w{j}") - F.col(f"o{j}"))).alias(f"v{j}") for j in numbers]
    return moved.select("term", "d", *[f"w{j}" for j in numbers], *places, *[f"{c}{j}" for c in "ou" for j in numbers])


def run_steps(data: Design, state: DataFrame, tasks: Sequence[Task], steps: int, tol: float = 1e-5,
              done: int = 0) -> tuple[DataFrame, int]:
    """(state, steps taken in all): accelerated proximal gradient until no task moves by more than ``tol``.

    The momentum of a task follows its number of steps and starts anew when a step goes against the one before
    (B. O'Donoghue and E. Candes, "Adaptive restart for accelerated gradient schemes", 2015). Each step is one written table;
    one row of it, the size of each task's move and its direction, is collected.
    """
    numbers, ages = range(len(tasks)), [done] * len(tasks)
    for _ in range(steps):
        made = stage(step(data, state, tasks, [a / (a + 3.0) for a in ages]), "state")
        moves = [F.sqrt(F.sum(F.col("d") * F.pow(F.col(f"w{j}") - F.col(f"o{j}"), 2)) / max(data.learned(t), 1)).alias(f"c{j}")
                 for j, t in enumerate(tasks)]
        back = [F.sum(F.col("d") * (F.col(f"u{j}") - F.col(f"w{j}")) * (F.col(f"w{j}") - F.col(f"o{j}"))).alias(f"b{j}")
                for j in numbers]
        row, done = made.agg(*moves, *back).first(), done + 1
        again = [(row[f"b{j}"] or 0.0) > 0 for j in numbers]
        ages = [0 if again[j] else ages[j] + 1 for j in numbers]
        state = made.select("term", "d", *[f"w{j}" for j in numbers],
                            *[F.col(f"{'w' if again[j] else 'v'}{j}").alias(f"v{j}") for j in numbers])
        if max([row[f"c{j}"] or 0.0 for j in numbers]) <= tol:
            break
    return state, done


def weights_of(state: DataFrame, j: int = 0) -> DataFrame:
    """(term, w) of one task, without zeros."""
    return state.select("term", F.col(f"w{j}").alias("w")).where((F.col("w") != 0) | (F.col("term") == INTERCEPT))


def fit_logistic(features: DataFrame, labels: DataFrame, penalty: str = "l2", C: float = 1.0, max_iter: int = 100,
                 tol: float = 1e-5, row_id: str = "id", label: str = "label") -> DataFrame:
    """(term, w): logistic regression on (id, term, weight) and (id, label), the intercept under the empty term.

    Rows that have no features learn the intercept alone; features without a label are not learned from; without rows
    the model is empty.
    """
    data = design(features, labels, row_id, label)
    tasks = [Task(penalty, C)]
    return weights_of(run_steps(data, start_state(data, tasks), tasks, max_iter, tol)[0])


def word_weights(weights: DataFrame, k: int = 10) -> DataFrame:
    """(word, weight, side): the ``k`` most positive and ``k`` most negative words of a model table."""
    words = weights.where(F.col("term") != INTERCEPT).select(F.col("term").alias("word"), F.col("w").alias("weight"))
    top = words.orderBy(F.desc("weight"), "word").limit(k).withColumn("side", F.lit("positive"))
    low = words.orderBy("weight", "word").limit(k).withColumn("side", F.lit("negative"))
    return top.unionByName(low)


def fold_scores(data: Design, state: DataFrame, tasks: Sequence[Task]) -> list[tuple[float, float]]:
    """(accuracy, log loss) of each task on the rows of the fold that it does not know; one scan for all."""
    columns = [f"w{j}" for j in range(len(tasks))]

    def scores(rows, entries):
        import numpy as np
        import pyarrow as pa

        *_, with_id, margins = _margins(rows, entries, columns)
        label, fold, found = parts.floats(rows.column("label")), parts.floats(rows.column("fold")), []
        for j, (t, m) in enumerate(zip(tasks, margins)):
            held = with_id if t.fold is None else with_id & (fold == t.fold)
            known = held & ~np.isnan(label)
            signed = np.where(label == 1, -m, m)
            loss = np.maximum(signed, 0) + np.log1p(np.exp(-np.abs(signed)))
            found.append((j, int(known.sum()), int(((m > 0) == label)[known].sum()), int(held.sum()), float(np.where(held, loss, 0.0).sum())))
        return pa.table({c: pa.array(x) for c, x in zip(("task", "n", "hits", "held", "loss"), zip(*found))})

    made = _meet(data, state, columns, scores, "task long, n long, hits long, held long, loss double")
    sums = made.groupBy("task").agg(*[F.sum(c).alias(c) for c in ("n", "hits", "held", "loss")])
    found = {r["task"]: (r["hits"] / r["n"] if r["n"] else None, r["loss"] / r["held"] if r["held"] else None) for r in sums.collect()}
    return [found.get(j, (None, None)) for j in range(len(tasks))]


def search(features: DataFrame, labels: DataFrame, points: Sequence[Mapping], fold: str = "fold",
           first_steps: int = 8, halve: bool = True, tol: float = 1e-4, refit: bool = True, row_id: str = "id",
           label: str = "label") -> tuple[DataFrame | None, DataFrame, DataFrame]:
    """(weights, scores, rungs): successive halving of (penalty, C) points by cross-validated accuracy.

    Every rung takes steps for all open points and folds together, so the number of jobs does not grow with the points;
    after it the worse half goes, and the rest goes on from where it is with twice the steps, until one is left
    or a point's ``max_iter`` is reached. Ties go to the lower loss, then to the earlier point. Without ``halve`` no
    point goes. ``rungs`` holds (rung, trial, steps, accuracy, log_loss, kept); ``scores`` the last of each point. The winner is refitted
    on all rows, unless ``refit`` is off.
    """
    spark = labels.sparkSession
    data = design(features, labels, row_id, label, fold)
    folds = sorted(data.counts)
    limit = max([int(p.get("max_iter", 100)) for p in points])
    open_points = list(range(len(points)))

    def tasks_of(which):
        return [Task(points[p].get("penalty", "l2"), float(points[p].get("C", 1.0)), p, k) for p in which for k in folds]

    tasks = tasks_of(open_points)
    state, done, steps, rungs, scores, rung = start_state(data, tasks), 0, first_steps, [], {}, 0
    while True:
        state, done = run_steps(data, state, tasks, min(steps, limit - done), tol, done)
        found = fold_scores(data, state, tasks)
        for p in open_points:
            own = [found[j] for j, t in enumerate(tasks) if t.point == p]
            scores[p] = (sum(a for a, _ in own) / len(own), sum(b for _, b in own) / len(own), done)
        ranked = sorted(open_points, key=lambda p: (-scores[p][0], scores[p][1], p))
        kept = sorted(ranked[:max(1, (len(ranked) + 1) // 2)]) if halve else open_points
        last = done >= limit or (halve and len(open_points) == 1) or not halve
        rungs += [(rung, p, done, *scores[p][:2], p in kept) for p in open_points]
        if last:
            break
        # The columns of the points that stay, under new numbers.
        stay = [j for j, t in enumerate(tasks) if t.point in kept]
        state = state.select("term", "d", *[F.col(f"{c}{j}").alias(f"{c}{i}") for c in "wv" for i, j in enumerate(stay)])
        open_points, tasks, steps, rung = kept, [tasks[j] for j in stay], 2 * steps, rung + 1
    best = min(open_points, key=lambda p: (-scores[p][0], scores[p][1], p))
    whole = [Task(points[best].get("penalty", "l2"), float(points[best].get("C", 1.0)), best)]
    weights = weights_of(run_steps(data, start_state(data, whole), whole, limit, tol)[0]) if refit else None
    table = spark.createDataFrame(
        [(p, points[p].get("penalty", "l2"), float(points[p].get("C", 1.0)), scores[p][2], scores[p][0], p == best)
         for p in range(len(points))], "trial int, penalty string, C double, steps int, accuracy double, best boolean")
    steps_table = spark.createDataFrame(
        rungs, "rung int, trial int, steps int, accuracy double, log_loss double, kept boolean")
    return weights, table, steps_table
