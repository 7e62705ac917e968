"""Exact nearest neighbours by cosine, with cells around pivots that the triangle inequality rules out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.session import stage

SLACK = 1e-6  # similarity by which a bound may be off through rounding
BLOCK_ROWS = 16_384  # rows to a ring, on average: each query that asks one is sent there
SLICE = 512  # queries that meet a block at once


def choose_pivots(table: DataFrame, row_id: str, vec: str, pivots: int = 64, sample_rows: int = 4096):
    """Rows of a matrix of unit vectors, far from each other (None for a table without vectors).

    They come from at most ``sample_rows`` rows, the first by a hash of the id: each next pivot is the row farthest from
    those there are. A poor choice costs time, not results.
    """
    import numpy as np

    rows = table.select(vec).where(F.col("_size") > 0).orderBy(F.xxhash64(row_id)).limit(sample_rows).collect()
    if not rows:
        return None
    m = np.array([r[0] for r in rows], dtype="float64")
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    chosen, gap = [0], 1 - m @ m[0]
    while len(chosen) < min(pivots, len(m)):
        k = int(gap.argmax())
        if gap[k] <= 1e-9:
            break
        chosen.append(k)
        gap = np.minimum(gap, 1 - m @ m[k])
    return m[chosen]


def _placed(pivots, dim: int):
    """(id, vec) to (id, unit, cell, gap, gaps): the nearest pivot, the distance to it, and those to all."""
    def rows(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            m = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, dim)
            m = m / np.linalg.norm(m, axis=1, keepdims=True)
            gaps = np.sqrt(np.maximum(2 - 2 * (m @ pivots.T), 0))
            cell = gaps.argmin(axis=1)

            def lists(x):
                return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]),
                                                pa.array(x.reshape(-1)))

            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists(m), pa.array(cell.astype(np.int32)), pa.array(gaps[np.arange(len(m)), cell]),
                 lists(gaps)], names=["id", "unit", "cell", "gap", "gaps"])
    return rows


def _best_in_block(left, right):
    """The nearest row of one block for each of its queries; ties go to the smaller id."""
    import numpy as np
    import pyarrow as pa

    def matrix(t):
        c = t.column("unit").combine_chunks()
        return c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1)

    empty = left.num_rows == 0 or right.num_rows == 0
    q = left.column("id").to_numpy() if not empty else None
    if empty:
        return pa.table({"id": left.column("id").slice(0, 0), "neighbour": left.column("id").slice(0, 0),
                         "similarity": pa.array([], pa.float64())})
    right = right.sort_by("id")
    t, vectors = right.column("id").to_numpy(), matrix(right).T
    asked, found = matrix(left), []
    for start in range(0, len(q), SLICE):
        ids = q[start:start + SLICE]
        scores = np.round(asked[start:start + SLICE] @ vectors, 12)
        scores[ids[:, None] == t[None, :]] = -np.inf
        at = scores.argmax(axis=1)
        best = scores[np.arange(len(at)), at]
        ok = np.isfinite(best)
        found.append(pa.table({"id": pa.array(ids[ok]), "neighbour": pa.array(t[at][ok]), "similarity": pa.array(best[ok])}))
    return pa.concat_tables(found)


def _meet(pairs: DataFrame, asked: DataFrame, blocks: DataFrame, kind: str, block_rows: int) -> DataFrame:
    """(id, neighbour, similarity) of pairs (id, cell, ring) of the rows ``asked`` with the rows of their blocks.

    A block that many queries ask is dealt out to several tasks, so no group grows with the queries. The vectors join
    only here, so a pair carries one to its block once.
    """
    parts = pairs.groupBy("cell", "ring").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("parts"))
    parts = stage(parts, "parts")
    dealt = pairs.join(parts, ["cell", "ring"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    held = blocks.join(parts, ["cell", "ring"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    keys = ["cell", "ring", "part"]
    return dealt.select(*keys, "id").join(asked.select("id", "unit"), "id").groupBy(*keys).cogroup(
        held.select(*keys, "id", "unit").groupBy(*keys)).applyInArrow(
        _best_in_block, f"id {kind}, neighbour {kind}, similarity double")


def _best(found: DataFrame) -> DataFrame:
    return found.groupBy("id").agg(F.min_by(F.struct("neighbour", "similarity"),
                                            F.struct(-F.col("similarity"), "neighbour")).alias("b")).select("id", "b.*")


def _reach(gap: Column, low: Column, high: Column) -> Column:
    """The least distance to rows whose distances to a pivot lie between ``low`` and ``high``."""
    return F.greatest(gap - high, low - gap, F.lit(0.0))


def neighbour_search(queries: DataFrame, table: DataFrame, row_id: str, vec: str, block_rows: int = BLOCK_ROWS,
                     pivots: int | None = None) -> tuple[DataFrame, DataFrame]:
    """((id, neighbour, similarity), (round, products)): exact search, and how many products it took.

    Each table row belongs to the cell of its nearest pivot; a cell is cut into rings of about ``block_rows`` rows by
    the distance to the pivot. In the first round a query asks the ring of its own cell where it would lie itself.
    Its best similarity then bounds what can be better: by the triangle inequality no row of a cell is nearer than
    the gap between the query's distance to any pivot and the distances found in the cell, and likewise for a ring.
    The second round asks the rings that stay open. Cells and their bounds are a table of pivots squared; rows
    are never compared all with all unless the bounds rule nothing out, as with evenly spread vectors of many dimensions.

    By default there are four pivots for a block of rows, 64 at most.

    A vector of zeros has the similarity 0 with every row, so those of the table count as one candidate and those of the
    queries take the smallest other id. Null vectors are left out, ids must be unique; a table without another row gives none.
    """
    kind = table.schema[row_id].dataType.simpleString()

    def sized(df: DataFrame) -> DataFrame:
        norm = F.aggregate(vec, F.lit(0.0), lambda a, x: a + x * x)
        return df.where(F.col(vec).isNotNull()).select(row_id, F.col(vec).cast("array<double>").alias(vec), norm.alias("_size"))

    q_rows, t_rows = sized(queries), sized(table)
    if pivots is None:
        pivots = max(1, min(64, 4 * t_rows.count() // block_rows))
    chosen = choose_pivots(t_rows, row_id, vec, pivots)
    ids = t_rows.select(F.col(row_id).alias("neighbour"))

    def others(df: DataFrame, candidates: DataFrame) -> DataFrame:
        """Every row of ``df`` with the smallest candidate that is not itself, at similarity 0."""
        two = [r[0] for r in candidates.orderBy("neighbour").limit(2).collect()] + [None, None]
        own = F.col(row_id)
        pick = F.when(own == F.lit(two[0]), F.lit(two[1])).otherwise(F.lit(two[0])).cast(kind)
        return df.select(own.alias("id"), pick.alias("neighbour"), F.lit(0.0).alias("similarity")).where(
            F.col("neighbour").isNotNull())

    zero_found = others(q_rows.where("_size = 0"), ids)
    if chosen is None:
        empty = table.sparkSession.createDataFrame([], "round int, products long")
        return zero_found.withColumnRenamed("id", row_id), empty
    zero_found = zero_found.unionByName(others(q_rows.where("_size > 0"), t_rows.where("_size = 0").select(
        F.col(row_id).alias("neighbour"))))
    schema = f"id {kind}, unit array<double>, cell int, gap double, gaps array<double>"
    place = _placed(chosen, chosen.shape[1])
    rows = stage(t_rows.where("_size > 0").select(row_id, vec).mapInArrow(place, schema), "cells")
    asked = stage(q_rows.where("_size > 0").select(row_id, vec).mapInArrow(place, schema), "queries")

    # Rings: ranges of the distance to the pivot, from a bounded sketch of it for each cell.
    steps = 256
    edges = rows.groupBy("cell").agg(
        F.count("*").alias("n"), F.percentile_approx("gap", [k / steps for k in range(1, steps)], 10_000).alias("q"))
    n_rings = F.least(F.ceil(F.col("n") / block_rows), F.lit(steps)).cast("int")
    edges = stage(edges.select("cell", F.transform(F.sequence(F.lit(1), n_rings), lambda i: F.when(
        i < n_rings, F.get("q", F.floor(i * steps / n_rings).cast("int") - 1)).otherwise(F.lit(1e9))).alias("edges")), "edges")

    def banded(df: DataFrame) -> DataFrame:
        return df.join(edges, "cell").withColumn("band", F.size(F.filter("edges", lambda e: e < F.col("gap")))).drop("edges")

    # A ring is a band, or a hashed part of one that holds more rows than a block should.
    bands = banded(rows)
    parts = bands.groupBy("cell", "band").agg(F.ceil(F.count("*") / (2 * block_rows)).cast("long").alias("parts"))
    blocks = stage(bands.join(parts, ["cell", "band"]).withColumn(
        "ring", F.col("band") + steps * F.pmod(F.xxhash64("id"), F.col("parts"))).drop("parts"), "blocks")
    rings = stage(blocks.groupBy("cell", "band", "ring").agg(
        F.min("gap").alias("low"), F.max("gap").alias("high"), F.count("*").alias("n")), "rings")
    first = stage(banded(asked).join(rings.select("cell", "band", "ring"), ["cell", "band"]).select(
        "id", "cell", "ring"), "first")
    one = stage(_best(_meet(first, asked, blocks, kind, block_rows).unionByName(zero_found)), "round-one")
    limit = F.coalesce("similarity", F.lit(-1.0)) - SLACK
    gaps = blocks.select("cell", F.posexplode("gaps").alias("pivot", "g")).groupBy("cell", "pivot").agg(
        F.min("g").alias("low"), F.max("g").alias("high"))
    bounds = stage(gaps.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("pivot", "low", "high"))).alias("b")), "bounds")
    # All cells' bounds are one row of pivots squared; each query keeps the cells that its bounds leave open.
    whole = bounds.agg(F.collect_list(F.struct("cell", "b")).alias("cells"))
    bound = asked.join(one.select("id", "similarity"), "id", "left").withColumn("limit", limit)
    reach = F.aggregate(F.zip_with("gaps", "c.b", lambda g, b: _reach(g, b["low"], b["high"])), F.lit(0.0), lambda a, x: F.greatest(a, x))
    open_cells = (bound.select("id", "gaps", "limit", F.explode(whole.scalar()).alias("c"))
                  .where(1 - reach * reach / 2 >= F.col("limit"))
                  .select("id", "limit", F.col("c.cell").alias("cell"), F.get("gaps", F.col("c.cell")).alias("gap")))
    near = _reach(F.col("gap"), F.col("low"), F.col("high"))
    second = open_cells.join(rings.drop("band"), "cell").where(1 - near * near / 2 >= F.col("limit")).select("id", "cell", "ring")
    second = stage(second.join(first, ["id", "cell", "ring"], "left_anti"), "second")
    two = _meet(second, asked, blocks, kind, block_rows)
    best = _best(one.select("id", "neighbour", "similarity").unionByName(two))
    work = None
    for k, pairs in ((1, first), (2, second)):
        part = pairs.groupBy("cell", "ring").agg(F.count("*").alias("asked")).join(rings, ["cell", "ring"]).agg(
            F.coalesce(F.sum(F.col("asked") * F.col("n")), F.lit(0)).alias("products")).select(F.lit(k).alias("round"), "products")
        work = part if work is None else work.unionByName(part)
    return best.withColumnRenamed("id", row_id), work


def nearest_neighbours(queries: DataFrame, table: DataFrame, row_id: str, vec: str, min_similarity: float = -1.0,
                       block_rows: int = BLOCK_ROWS, pivots: int | None = None) -> DataFrame:
    """(id, neighbour, similarity): the closest other row of ``table`` for each query row.

    Similarities are rounded to 12 digits, ties go to the smaller id.
    """
    found, _ = neighbour_search(queries, table, row_id, vec, block_rows, pivots)
    return found.where(F.col("similarity") > min_similarity)
