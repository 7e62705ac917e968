"""Near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import map_rows
from lexmill.llm.components import connected_components
from lexmill.session import stage

BLOCK = 512  # rows compared at a time; each row meets its own and at least the next block
PASSES_PER_JOB = 6
MEMBERS = 512  # rows of a block when links inside a component are counted


def _unit(raw: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of little-endian 64-bit floats, scaled to length one."""
    x = np.frombuffer(b"".join(raw.to_pylist()), dtype="<f8").reshape(len(raw), -1)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _usable(label, v) -> bytes | None:
    if label is None or not v or any(c is None for c in v):
        return None
    x = np.array(v, dtype="<f8")
    return x.tobytes() if np.isfinite(x).all() and x.any() else None


def _pack(batches):
    """(id, label, vector) to (id, label, bytes); no bytes for a vector that links with nothing."""
    for batch in batches:
        ids, labels, vectors = (batch.column(k) for k in range(3))
        packed = [_usable(*x) for x in zip(labels.to_pylist(), vectors.to_pylist())]
        yield pa.RecordBatch.from_arrays([ids, labels, pa.array(packed, pa.binary())],
                                         names=["vec_id", "label", "vec"])


def _sums(batches):
    """Sum of the unit vectors and their number per label and size, over the rows of a task."""
    sums: dict[tuple[str, int], list] = {}

    def out():
        keys = list(sums)
        totals = pa.array([sums[k][0].tolist() for k in keys], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([sums[k][1] for k in keys], pa.int64()), totals], names=["label", "size", "n", "total"])

    for batch in batches:
        labels = np.array(batch.column(1).to_pylist(), dtype=object)
        sizes = np.array([len(v) for v in batch.column(2).to_pylist()])
        for label, size in sorted(set(zip(labels.tolist(), sizes.tolist()))):
            rows = np.flatnonzero((labels == label) & (sizes == size))
            x = _unit(batch.column(2).take(pa.array(rows)))
            held = sums.setdefault((label, size), [0.0, 0])
            sums[label, size] = [held[0] + x.sum(axis=0), held[1] + len(x)]
        if len(sums) > 1_000:  # rare labels go on, so memory is bounded
            yield out()
            sums = {}
    if sums:
        yield out()


def _with_means(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vec) with the mean of the unit vectors of equal label and size, as an array."""
    parts = map_rows(vectors.select("vec_id", "label", "vec"), _sums, "label string, size int, n long, total array<double>")
    means = (parts.select("label", "size", "n", F.posexplode("total").alias("at", "x"))
             .groupBy("label", "size", "at").agg((F.sum("x") / F.sum("n")).alias("x"))
             .groupBy("label", "size").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("mean"))
             .select("label", "size", F.col("mean.x").alias("mean")))
    means = stage(means, "means")
    return vectors.withColumn("size", F.octet_length("vec")).join(means, ["label", "size"]).select(
        "vec_id", "label", "vec", "mean")


def _hashes(passes: list[int], seed: int):
    """Signs on random planes through the mean of the label, which split its vectors evenly however close they lie."""

    def rows(batches):
        for batch in batches:
            raw = batch.column(2)
            for size in sorted({len(v) for v in raw.to_pylist()}):
                part = batch.filter(pa.array([len(v) == size for v in raw.to_pylist()]))
                x = _unit(part.column(2)) - part.column(3).flatten().to_numpy().reshape(part.num_rows, -1)
                for p in passes:
                    planes = np.random.default_rng([seed, p, size]).standard_normal((size // 8, 64))
                    bits = np.packbits(x @ planes > 0, axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), p, np.int32)), part.column(1),
                         pa.array(np.full(len(x), size, np.int32)),
                         pa.array([b.tobytes() for b in bits], pa.binary()), part.column(0), part.column(2)],
                        names=["pass", "label", "size", "hash", "vec_id", "vec"])
    return rows


class _Forest:
    """Links between blocks of one sorted run, reported only if they join what was apart in the run so far."""

    def __init__(self, threshold: float):
        self.threshold, self.parent = threshold, {}

    def root(self, a: int) -> int:
        parent = self.parent
        while parent.setdefault(a, a) != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    def links(self, ids, x, to_ids, to_x) -> list[tuple[int, int]]:
        """A block with itself if both are the same, otherwise all rows of one with all of the other."""
        close = x @ to_x.T >= self.threshold
        if ids is to_ids:
            close &= np.tri(len(ids), k=-1, dtype=bool)
        out = []
        for i, j in zip(*(k.tolist() for k in np.nonzero(close))):
            a, b = self.root(int(ids[i])), self.root(int(to_ids[j]))
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                out.append((int(ids[i]), int(to_ids[j])))
        return out


_FOUND = "u long, v long, boundary int, head boolean, pass int, label string, size int, vec_id long, vec binary"
_ARROW_FOUND = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("boundary", pa.int32()), ("head", pa.bool_()),
                          ("pass", pa.int32()), ("label", pa.string()), ("size", pa.int32()), ("vec_id", pa.int64()),
                          ("vec", pa.binary())])


def _sweep(threshold: float):
    """Compare each row with the following ones in sort order; yield links, and the first and last rows of the task.

    A row meets its own and the next block. A block meets further ones as long as each of
    them joins with it what was apart, so there are at most as many such meetings as links.
    """

    def rows(batches):
        here = TaskContext.get().partitionId()
        held_key, blocks, forest = None, [], None
        pending, n_pending, first = [], 0, True

        def found(pairs):
            u, v = zip(*pairs)
            return pa.RecordBatch.from_arrays(
                [pa.array(u, pa.int64()), pa.array(v, pa.int64()), *(pa.nulls(len(u), f.type) for f in list(_ARROW_FOUND)[2:])],
                schema=_ARROW_FOUND)

        def ends(batch, boundary, head):
            n = batch.num_rows
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(np.full(n, boundary, np.int32)),
                 pa.array([head] * n, pa.bool_()), *(batch.column(k) for k in (0, 1, 2, 4, 5))], schema=_ARROW_FOUND)

        def compare(key, ids, x):
            nonlocal held_key, blocks, forest
            if key != held_key:
                held_key, blocks, forest = key, [], _Forest(threshold)
            pairs, still = forest.links(ids, x, ids, x), []
            for oi, ox in blocks:
                more = forest.links(ids, x, oi, ox)
                pairs += more
                if more:
                    still.append((oi, ox))
            blocks = [*still, (ids, x)]
            return pairs

        def work(table):
            keys = list(zip(*(table.column(k).to_pylist() for k in range(3))))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for lo, hi in zip(cuts, cuts[1:]):
                pairs = compare(keys[lo], table.column(4).slice(lo, hi - lo).to_numpy(),
                                _unit(table.column(5).slice(lo, hi - lo)))
                if pairs:
                    yield found(pairs)

        last = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                pending.append(batch.slice(at, BLOCK))
                n_pending += pending[-1].num_rows
                if n_pending < BLOCK:
                    continue
                whole = pa.Table.from_batches(pending).combine_chunks().to_batches()[0]
                block, rest = whole.slice(0, BLOCK), whole.slice(BLOCK)
                pending, n_pending = ([rest] if rest.num_rows else []), rest.num_rows
                if first:
                    yield ends(block, here, True)
                    first = False
                yield from work(block)
                last = block
        if n_pending:
            block = pa.Table.from_batches(pending).combine_chunks().to_batches()[0]
            if first:
                yield ends(block, here, True)
            yield from work(block)
            if last is not None:
                block = pa.Table.from_batches([last, block]).combine_chunks().to_batches()[0]
                block = block.slice(max(0, block.num_rows - BLOCK))
            last = block
        if last is not None:
            yield ends(last, here + 1, False)

    return rows


def _meet(threshold: float):
    """Links between the last rows of one task and the first of the next."""

    def rows(group):
        forest, pairs = _Forest(threshold), []
        group = group.combine_chunks()
        keys = list(zip(*(group.column(c).to_pylist() for c in ("pass", "label", "size"))))
        head = group.column("head").to_pylist()
        for key in sorted(set(keys)):
            sides = [group.take(pa.array([i for i, k in enumerate(keys) if k == key and head[i] is side], pa.int64()))
                     for side in (False, True)]
            if all(s.num_rows for s in sides):
                (ids, x), (to_ids, to_x) = ((s.column("vec_id").to_numpy(), _unit(s.column("vec"))) for s in sides)
                pairs += forest.links(ids, x, to_ids, to_x)
        u, v = zip(*pairs) if pairs else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return rows


def _count_links(threshold: float):
    """Links between the two member blocks of a group, per member, weighted by the copies of the other side."""

    def rows(key, left, right):
        a, b = left.to_pydict(), right.to_pydict()
        if not a["vec_id"] or not b["vec_id"]:
            return pa.table({"vec_id": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        x, y = _unit(left.column("vec")), _unit(right.column("vec"))
        close = x @ y.T >= threshold
        same = np.array(a["vec_id"])[:, None] == np.array(b["vec_id"])[None, :]
        n = (close & ~same) @ np.array(b["copies"], dtype=np.int64)
        return pa.table({"vec_id": pa.array(a["vec_id"], pa.int64()), "n": pa.array(n, pa.int64())})

    return rows


def near_duplicate_vectors(df: DataFrame, threshold: float = 0.98, passes: int = 24, seed: int = 11,
                           id_col: str = "vec_id", vector_col: str = "embedding",
                           label_col: str | None = "label", rest: float = 0.001) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row: links are pairs with cosine >= ``threshold``.

    Only vectors of equal, non-null label and equal size are compared (all of them if
    ``label_col`` is None). Null, empty and zero vectors and those with null or non-finite
    parts link with nothing. Exact copies are one class: a representative is compared, and
    its links count with the copies. Each pass orders the representatives by the signs on
    64 random planes through the mean of their label and compares neighbours in blocks, over
    the ends of tasks too; pairs verified in any pass are united. A pass can miss a pair, and
    how often depends on the number of rows and on how close together they lie, so the number
    of passes follows what they find: ``passes`` at least, then six at a time until six
    further ones join no more than the share ``rest`` of all that has been joined.
    ``n_links`` is then counted exactly: links lie inside components, and the members of a
    component meet block by block; only counts leave a task.

    Repeated ids are taken as one vector each row; an empty table stays empty.
    """
    label = F.col(f"`{label_col}`").cast("string") if label_col else F.lit("")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), label.alias("label"),
                     F.col(f"`{vector_col}`").alias("vec"))
    packed = stage(map_rows(rows, _pack, "vec_id long, label string, vec binary"), "vectors")
    usable = packed.where("vec is not null and vec_id is not null")
    classes = stage(usable.groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")),
                    "classes")
    vectors = _with_means(classes.select(F.col("rep").alias("vec_id"), "label", "vec"))

    def links(at: int) -> DataFrame:
        hashed = map_rows(vectors, _hashes(list(range(at, at + PASSES_PER_JOB)), seed),
                          "pass int, label string, size int, hash binary, vec_id long, vec binary")
        order = ["pass", "label", "size", "hash", "vec_id"]
        swept = stage(map_rows(hashed.repartitionByRange(*order).sortWithinPartitions(*order), _sweep(threshold), _FOUND),
                      "links")
        # At most two blocks for each boundary between tasks.
        across = swept.where("boundary is not null").drop("u", "v").groupBy("boundary").applyInArrow(
            _meet(threshold), "u long, v long")
        return stage(swept.where("u is not null").select("u", "v").unionByName(across), "links")

    edges, at = links(0), PASSES_PER_JOB
    while at < passes - PASSES_PER_JOB:
        edges, at = edges.unionByName(links(at)), at + PASSES_PER_JOB
    parts = stage(connected_components(edges), "components")
    while True:
        more, at = links(at), at + PASSES_PER_JOB
        ends = [parts.select(F.col("node").alias(c), F.col("component").alias(f"{c}_of")) for c in ("u", "v")]
        crossing = stage(more.join(ends[0], "u", "left").join(ends[1], "v", "left")
                         .select(F.coalesce("u_of", "u").alias("u"), F.coalesce("v_of", "v").alias("v"))
                         .where("u <> v"), "crossing")
        joined = crossing.select(F.least("u", "v"), F.greatest("u", "v")).distinct().count()
        if joined:
            forest = parts.where("node <> component").toDF("u", "v")
            parts = stage(connected_components(forest.unionByName(crossing)), "components")
        if joined <= rest * parts.where("node <> component").count():
            break
    members = stage(parts.join(classes, parts["node"] == classes["rep"])
                    .select("component", F.col("node").alias("vec_id"), "vec", "copies"), "members")
    # Blocks of one component meet each other; a component of one block meets itself.
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / F.lit(MEMBERS)).cast("int").alias("blocks"))
    blocked = members.join(sizes, "component").withColumn(
        "block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    left = blocked.select("component", F.col("block").alias("i"), others.alias("j"), "vec_id", "vec")
    # New names for every column, or Spark takes the two sides for one.
    right = blocked.select(*[F.col(c).alias(f"{c}2") for c in ("component", "block", "vec_id", "vec", "copies")],
                           others).toDF("component", "j", "vec_id", "vec", "copies", "i")
    keys = ["component", "i", "j"]
    counted = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _count_links(threshold), "vec_id long, n long").groupBy("vec_id").agg(F.sum("n").alias("n"))
    linked = members.join(counted, "vec_id", "left").select(
        F.col("vec_id").alias("rep"), F.col("component"), F.coalesce("n", F.lit(0)).alias("n"))
    reps = classes.join(linked, "rep", "left").select(
        "label", "vec", F.coalesce("component", "rep").alias("component_id"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    known = usable.join(reps, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    lone = packed.where("vec is null or vec_id is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return known.unionByName(lone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
