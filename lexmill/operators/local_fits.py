"""Fits of a search side by side, each by one task that passes over all rows by itself.

The steps are those of ``lbfgs``, from the same parts and blocks. A fit keeps its weights, gradient and history where it
runs, so a round is a pass over the task's own copy of the rows and no job. A task streams the rows once; a copy that is too large
for memory lies in a file without a name, which goes with the task. Above ``MOST_ENTRIES`` or ``MOST_TERMS`` the fits take their
rounds together in ``lbfgs``, where no task holds all rows or a whole vector.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.operators import lbfgs, parts
from lexmill.session import new_path

MOST_ENTRIES = 67_108_864  # 12 bytes each in a task's copy of the rows
MOST_TERMS = 4_194_304  # some 40 numbers each in a fit, 20 of them in the history
IN_MEMORY = 268_435_456  # bytes of a copy and a history that a task may hold in memory
AT_ONCE = 262_144  # entries to a chunk, on average
# Few chunks to an Arrow batch; and the copies of a union stay tasks of their own, though each is a single partition.
SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4", "spark.sql.unionOutputPartitioning": "false"}


def accuracies(data: lbfgs.Spread, fits: Sequence[lbfgs.Fit], held: Sequence[int]) -> list[float]:
    """The share of right predictions of each fit on the rows of its fold in ``held``."""
    blocks = {r["block"]: r["n"] for r in data.vectors([]).where("part = -1 and col = 0").select("block", (F.size("x") - 1).alias("n")).collect()}
    entries, terms = data.rows.agg(F.coalesce(F.sum(F.size("at")), F.lit(0))).first()[0], sum(blocks.values())
    if entries > MOST_ENTRIES or terms > MOST_TERMS:
        return lbfgs.accuracies(data, fits, lbfgs.solve(data, fits), held)
    order = sorted(blocks)
    first = dict(zip(order, accumulate([0, *[blocks[b] for b in order]])))
    spark = data.rows.sparkSession
    path = new_path(spark, "rows")
    _coded(data, first).write.parquet(path)
    scales = data.vectors([]).where("part = -1").select("block", "col", "x", "g")
    rows = spark.read.parquet(path)
    every = scales.select("*", *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns]).unionByName(
        rows, allowMissingColumns=True).coalesce(1)
    large = entries * 12 + terms * 320 > IN_MEMORY
    cores = spark.sparkContext.defaultParallelism
    tasks = min(len(fits), max(1, cores // 2) if large else len(fits))
    learned = {c: [sum(n for (f, y), n in data.counts.items() if y == k and f >= 0 and f != fit.fold) for k in (0, 1)] for c, fit in enumerate(fits)}
    # Weak penalties take the most rounds and begin first.
    turn = sorted(range(len(fits)), key=lambda c: fits[c].strength)
    given = [[(c, fits[c], data.variants.index(fits[c].fold), learned[c], held[c]) for c in turn[t::tasks]] for t in range(tasks)]
    made = reduce(DataFrame.union, [every.mapInArrow(_task(own, first, terms, large), "fit int, accuracy double") for own in given])
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    try:
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
        found = dict(tuple(r) for r in made.collect())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return [found[c] for c in range(len(fits))]


def _coded(data: lbfgs.Spread, first: dict):
    """The rows in chunks of one fold: sizes and labels of the rows, and the numbers of all terms with their weights."""
    def coded(rows, routes):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        blocks = routes.column("block").to_numpy()
        lists = parts.one(routes.column("pos"))
        place = [first[int(blocks[i])] + lists[int(i)].values.to_numpy(zero_copy_only=False).astype(np.int64) for i in np.argsort(blocks)]
        place = np.concatenate([*place, np.zeros(0, dtype=np.int64)])
        # A chunk holds rows of one fold, so that a fit passes over those it learns from and no others.
        rows = rows.take(pc.sort_indices(parts.one(rows.column("fold"))))
        n, row, at, weight = parts.entries_of(rows)
        sizes = np.bincount(row, minlength=n)
        ends = np.cumsum(sizes)
        pa.default_memory_pool().release_unused()
        label, fold = (parts.one(rows.column(c)).to_numpy(zero_copy_only=False).astype("int32") for c in ("label", "fold"))
        cuts = np.searchsorted(ends, np.arange(AT_ONCE, ends[-1], AT_ONCE)) + 1 if n else []
        cuts = sorted({0, n, *[int(i) for i in cuts if i < n], *[int(i) for i in np.flatnonzero(np.diff(fold)) + 1]})
        out = []
        for i, k in zip(cuts, cuts[1:]):
            if i < k:
                a, b = ends[i] - sizes[i], ends[k - 1]
                out.append((sizes[i:k].astype("int32"), label[i:k], int(fold[i]), place[at[a:b]].astype("int32"), weight[a:b].astype("float64")))
        names = "sizes", "labels", "fold", "at", "weight"
        return pa.table({c: pa.array([x[j] for x in out], pa.int32()) if c == "fold" else pa.array([x[j].tobytes() for x in out], pa.binary())
                         for j, c in enumerate(names)})

    routes = data.vectors([]).where("part >= 0").select("block", "part", "pos")
    return data.rows.groupBy("part").cogroup(routes.groupBy("part")).applyInArrow(
        coded, "sizes binary, labels binary, fold int, at binary, weight binary")


def _task(given, first, terms, large):
    """The fits of one task over all rows, one after the other: (number, accuracy)."""
    def run(batches):
        import tempfile

        import numpy as np
        import pyarrow as pa

        pa.default_memory_pool().release_unused()
        file = tempfile.TemporaryFile() if large else None
        wanted = {v for _, _, v, _, _ in given}
        mean, scale = ({v: np.zeros(terms + 1) for v in wanted} for _ in range(2))
        chunks = []
        for r in (batch.slice(i, 1) for batch in batches for i in range(batch.num_rows)):
            block, v = r.column("block")[0].as_py(), r.column("col")[0].as_py()
            if block is not None:
                if v in wanted:
                    x, g = (r.column(c)[0].values.to_numpy(zero_copy_only=False) for c in "xg")
                    mean[v][first[block]:first[block] + len(x) - 1], scale[v][first[block]:first[block] + len(x) - 1] = x[:-1], g[:-1]
                continue
            # Copies, so that no batch stays.
            sizes, label, at = (np.frombuffer(r.column(c)[0].as_buffer(), dtype="int32").copy() for c in ("sizes", "labels", "at"))
            fold = r.column("fold")[0].as_py()
            weight, full = np.frombuffer(r.column("weight")[0].as_buffer()).copy(), np.flatnonzero(sizes)
            starts = (np.cumsum(sizes, dtype=np.int64) - sizes)[full]
            if large and len(at):
                at, weight = _kept(file, at), _kept(file, weight)
            chunks.append((full, starts, sizes, label.astype(float), fold, at, weight))
        for v in wanted:
            scale[v][-1] = 1.0
        for c, fit, v, learned, fold in given:
            found = _Alone(chunks, mean[v], scale[v], fit, learned, large).accuracy(fold)
            yield pa.RecordBatch.from_pydict({"fit": pa.array([c], pa.int32()), "accuracy": [found]})
        chunks.clear()
        mean.clear()
        scale.clear()
        _give_back()

    return run


def _give_back() -> None:
    """Return freed memory to the system: the worker outlives the fit, and would hold the pages of its vectors."""
    import contextlib
    import ctypes
    import gc

    gc.collect()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def _kept(file, values):
    """``values`` as a view of the file."""
    import os

    import numpy as np

    start = file.seek(0, os.SEEK_END)
    file.write(values.tobytes())
    file.flush()
    return np.memmap(file, dtype=values.dtype, mode="r", offset=start, shape=values.shape)


class _Alone:
    """One fit: what ``lbfgs`` keeps in blocks is here in whole vectors, the intercept last.

    The history lies in slots of two matrices, with the products of all slots; ``at`` holds weights and gradient of the point
    that trials start from and of the last two trials, one of which is accepted.
    """

    def __init__(self, chunks, mean, scale, fit, learned, large):
        import tempfile

        import numpy as np

        self.chunks, self.mean, self.fit, self.learned = chunks, mean, fit, learned
        self.inverse = np.where(scale > 0, 1 / np.where(scale > 0, scale, 1), 0)
        self.reg = fit.strength * self.inverse
        self.reg[-1] = 0.0
        shape = lbfgs.MEMORY, len(mean)
        s, y = ((np.memmap(tempfile.TemporaryFile(), dtype=float, mode="w+", shape=shape) if large else np.zeros(shape)) for _ in range(2))
        self.s, self.y = s, y
        self.ss, self.sy, self.yy = (np.zeros((lbfgs.MEMORY, lbfgs.MEMORY)) for _ in range(3))
        self.slots, self.base, self.at, self.met = [], None, {}, {}

    def margins(self, x, which):
        """(chunk, margins of its rows) under the weights ``x``, for chunks of folds with ``which``."""
        import numpy as np

        w = x * self.inverse
        shift = float(w[-1] - w[:-1] @ self.mean[:-1])
        for chunk in self.chunks:
            full, starts, sizes, _, fold, at, weight = chunk
            if not which(fold):
                continue
            margin = np.full(len(sizes), shift)
            if len(full):
                margin[full] += np.add.reduceat(weight * w[at], starts)
            yield chunk, margin

    def accuracy(self, held) -> float:
        import numpy as np

        of = self.learned
        x = np.zeros(len(self.mean))
        if all(of):
            x = self.solved(math.log(of[1] / of[0]))
        else:
            x[-1] = math.inf if of[1] else -math.inf
        n = hits = 0
        for (_, _, _, label, _, _, _), margin in self.margins(x, lambda fold: fold == held):
            n += len(label)
            hits += int(((margin > 0) == label).sum())
        return hits / n if n else 0.0

    def solved(self, start):
        running, number = lbfgs.steps(self.fit), 0
        ask = next(running)
        while True:
            try:
                ask = running.send(self.trial(number, ask, start))
            except StopIteration as end:
                return self.at[end.value][0]
            number += 1

    def accept(self, last, alone: bool) -> None:
        """Trials go on from the point of round ``last``; ``alone``: without the history."""
        if alone:
            self.slots = []
        elif last != self.base:
            (x0, g0), (x, g) = self.at[self.base], self.at[last]
            slot = self.slots.pop(0) if len(self.slots) == lbfgs.MEMORY else next(i for i in range(lbfgs.MEMORY) if i not in self.slots)
            self.s[slot], self.y[slot] = x - x0, g - g0
            ss, ys, sy, yy, own = self.met[last]
            self.ss[slot] = self.ss[:, slot] = ss
            self.yy[slot] = self.yy[:, slot] = yy
            self.sy[slot], self.sy[:, slot] = ys, sy
            self.ss[slot, slot], self.sy[slot, slot], self.yy[slot, slot] = own[0, 0], own[0, 1], own[1, 1]
            self.slots.append(slot)
        self.base, self.at, self.met = last, {last: self.at[last]}, {}

    def adjusted(self, x, g):
        import numpy as np

        if self.fit.penalty != "l1":
            return g
        up, down = g + self.reg, g - self.reg
        rest = np.where(down > 0, down, np.where(up < 0, up, 0.0))
        return np.where(self.reg == 0, g, np.where(x == 0, rest, g + np.sign(x) * self.reg))

    def placed(self, ask, start):
        """(weights of the trial, direction, adjusted gradient before it)."""
        import numpy as np

        rounds, d, alpha = ask
        zero = np.zeros(len(self.mean))
        if not rounds:
            x = zero.copy()
            x[-1] = start
            return x, zero, zero
        self.accept(rounds[-1], len(rounds) == 1)
        x, g = self.at[rounds[-1]]
        before, n = self.adjusted(x, g), len(self.slots)
        shares, changes = np.zeros(lbfgs.MEMORY), np.zeros(lbfgs.MEMORY)
        shares[self.slots], changes[self.slots] = d[:n], d[n:2 * n]
        direction = shares @ self.s + changes @ self.y + d[-1] * before
        if self.fit.penalty != "l1":
            return x + alpha * direction, direction, before
        direction = np.where(direction * before < 0, direction, 0.0)
        new = x + direction * alpha
        orthant = np.where(x != 0, np.sign(x), np.sign(-before))
        return np.where(np.sign(new) == orthant, new, 0.0), direction, before

    def trial(self, number, ask, start):
        """What ``lbfgs.steps`` receives for its trial."""
        import numpy as np

        x, direction, before = self.placed(ask, start)
        fit, n = self.fit, max(sum(self.learned), 1)
        total, loss, off = np.zeros(len(x)), 0.0, 0.0
        for (_, _, sizes, label, _, at, weight), margin in self.margins(x, lambda fold: fold >= 0 and fold != fit.fold):
            wrong = parts.probability(margin) - label
            signed = np.where(label == 1, -margin, margin)
            loss += float((np.maximum(signed, 0) + np.log1p(np.exp(-np.abs(signed)))).sum())
            off += float(wrong.sum())
            np.add.at(total, at, weight * np.repeat(wrong, sizes))
        g = total * self.inverse / n - self.mean * self.inverse * (off / n)
        g[-1] = off / n
        l2 = l1 = 0.0
        if fit.penalty == "l1":
            l1 = float(self.reg @ np.abs(x))
        else:
            pull = fit.strength * x * self.inverse ** 2
            pull[-1] = 0.0
            l2, g = 0.5 * float(pull @ x), g + pull
        a = self.adjusted(x, g)
        value = loss / n + l2
        found = number, value, value + l1, float(a @ direction), float(before @ direction), float(g @ g), self.products(number, x, g, a)
        for r in [r for r in self.at if r != self.base][:-1]:
            del self.at[r], self.met[r]
        self.at[number] = x, g
        return found

    def products(self, number, x, g, a):
        """Those of the steps, the changes of the gradient and the adjusted gradient, as if the trial were accepted."""
        import numpy as np

        if self.base is None:
            return np.array([[float(a @ a)]])
        x0, g0 = self.at[self.base]
        new = x - x0, g - g0, a
        own = np.array([[float(u @ v) for u in new] for v in new])
        (ss, ys), (sy, yy), (sa, ya) = ((self.s @ v, self.y @ v) for v in new)
        self.met[number] = ss, ys, sy, yy, own
        old = self.slots[-(lbfgs.MEMORY - 1):]
        n = len(old) + 1
        gram = np.zeros((2 * n + 1, 2 * n + 1))
        steps, changes, last = slice(0, n - 1), slice(n, 2 * n - 1), [n - 1, 2 * n - 1, 2 * n]
        both = np.ix_(old, old)
        gram[steps, steps], gram[steps, changes], gram[changes, changes] = self.ss[both], self.sy[both], self.yy[both]
        gram[changes, steps] = gram[steps, changes].T
        gram[np.ix_(last, last)] = own
        for k, s, y in zip(last, (ss, sy, sa), (ys, yy, ya)):
            gram[steps, k] = gram[k, steps] = s[old]
            gram[changes, k] = gram[k, changes] = y[old]
        return gram
