"""Embedding near-duplicates: Euclidean p-stable hashing, then exact cosine checks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rtml.llm.common import components, prepare, stored
from rtml.llm.jaccard import Union

#: Vectors in one side of a checking task.
BLOCK = 256
#: Width of a quantisation cell in units of the distance between unit vectors.
CELL = 2.0
_MISS = 0.02


def _same_cell(distance: float, width: float = CELL) -> float:
    """Chance that a Gaussian projection puts two points of this distance into one cell."""
    r = width / distance
    phi = 0.5 * (1 + math.erf(-r / math.sqrt(2)))
    return 1 - 2 * phi - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def hash_plan(n: int, cosine: float) -> tuple[int, int]:
    """(projections per table, tables) for ``n`` vectors: unrelated vectors share fewer than one
    bucket in eight per vector and table, and a pair at the threshold is missed with chance 0.02."""
    far, near = _same_cell(math.sqrt(2.0)), _same_cell(math.sqrt(2 - 2 * cosine))
    k = max(4, math.ceil(math.log(max(n, 2) * 8) / -math.log(far)))
    return k, max(1, math.ceil(math.log(_MISS) / math.log(1 - near ** k)))


def signatures(unit: np.ndarray, k: int, tables: int, seed: int = 7) -> np.ndarray:
    """(vectors, tables) bucket hashes of quantised random projections."""
    draw = np.random.default_rng(seed)
    planes = draw.standard_normal((unit.shape[1], k * tables))
    cells = np.floor((unit @ planes + draw.uniform(0, CELL, k * tables)) / CELL).astype(np.int64)
    out = np.full((len(unit), tables), unit.shape[1], np.uint64)  # unlike lengths never meet
    for i in range(k):
        out = (out ^ cells[:, i::k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out


def _hashed(rows: DataFrame, k: int, tables: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            by_size: dict[int, list[int]] = {}
            values = batch.column(1).to_pylist()
            for i, v in enumerate(values):
                if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
                    by_size.setdefault(len(v), []).append(i)
            ids, units, sigs = [], [], []
            names = batch.column(0).to_pylist()
            for at in by_size.values():
                x = np.array([values[i] for i in at], float)
                x /= np.abs(x).max(1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                s = signatures(x, k, tables)
                ids += [names[i] for i in at]
                units += [r.astype("<f8").tobytes() for r in x]
                sigs += list(s.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(units, pa.binary()),
                 pa.array(sigs, pa.list_(pa.int64()))], names=["id", "unit", "sigs"])

    return rows.mapInArrow(run, "id long, unit binary, sigs array<long>")


def _checked(tasks: DataFrame, cosine: float) -> DataFrame:
    """Per checking task: weighted link counts and spanning links.

    A pair counts in the first table where its buckets agree, so no pair counts twice.
    """
    def check(rows, out):
        table = rows[0][0]
        a = [r for r in rows if r[7] != 2]
        b = [r for r in rows if r[7] != 1]
        if not a or not b:
            return
        own = rows[0][7] == 3
        x = np.stack([np.frombuffer(r[4], "<f8") for r in a])
        y = x if own else np.stack([np.frombuffer(r[4], "<f8") for r in b])
        near = x @ y.T >= cosine
        if own:
            near = np.triu(near, 1)
        i, j = np.nonzero(near)
        if not len(i):
            return
        if table:
            p = np.array([r[5][:table] for r in a])
            q = p if own else np.array([r[5][:table] for r in b])
            fresh = np.ones(len(i), bool)
            for t in range(table):
                fresh &= p[i, t] != q[j, t]
            i, j = i[fresh], j[fresh]
            if not len(i):
                return
        wa = np.array([r[6] for r in a])
        wb = wa if own else np.array([r[6] for r in b])
        ida = np.array([r[3] for r in a])
        idb = ida if own else np.array([r[3] for r in b])
        counts: dict[int, int] = {}
        for ids, at, w in ((ida, i, wb[j]), (idb, j, wa[i])):
            total = np.bincount(at, weights=w, minlength=len(ids))
            for k in np.flatnonzero(total):
                counts[int(ids[k])] = counts.get(int(ids[k]), 0) + int(total[k])
        trees = Union()
        for u, v in zip(ida[i].tolist(), idb[j].tolist()):
            trees.join(u, v)
        out += [(u, n, trees.find(u)) for u, n in counts.items()]

    def run(batches):
        held, task = [], None
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                key = row[0], row[8], row[1], row[2]
                if key != task:
                    if held:
                        check(held, out)
                    held, task = [], key
                held.append(row)
            yield _rows(out)
        out = []
        if held:
            check(held, out)
        yield _rows(out)

    def _rows(out):
        cols = list(zip(*out)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                          names=["id", "n", "b"])

    return tasks.mapInArrow(run, "id long, n long, b long")


def vector_links(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """Per row: id, ``n_links`` (other vectors at ``cosine`` or more), ``component_id`` (smallest id
    that links reach, itself included) and ``kept``.

    Unit vectors in double precision; equal ones are one weighted point. Each is hashed into several
    tables of quantised Gaussian projections, and the vectors of a bucket are compared exactly; large
    buckets are cut into blocks of ``BLOCK``, one task per pair of blocks. All linked pairs are counted
    but only sums per vector and spanning links leave a task. Recall of pairs is set by ``hash_plan``;
    precision is exact. Work inside a bucket grows with the pairs of its blocks.

    Null, empty and all-zero vectors, and those with null or non-finite members, link with nothing;
    vectors of unlike length do not link. Ids are longs; rows that repeat an id are one vector if
    equal, and their links add up otherwise; a null id gets no links and a null component. An empty
    table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    k, tables = hash_plan(rows.count(), cosine)
    hashed = stored(_hashed(rows.where("id IS NOT NULL").distinct(), k, tables), "hashed")
    exact = stored(hashed.groupBy("unit").agg(F.min("id").alias("rep"),
                                              F.count(F.lit(1)).alias("w")), "points")
    weights = exact.select(F.col("rep").alias("id"), "w", F.col("unit").alias("u"))
    points = stored(hashed.join(weights, "id").where("unit = u")
                    .select("id", "unit", "sigs", "w"), "weighted")
    keys = points.select("id", F.posexplode("sigs").alias("t", "bucket"))
    crowded = stored(keys.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias("m"))
                     .where("m > 1").withColumn("nb", F.ceil(F.col("m") / BLOCK)).drop("m"), "buckets")
    placed = keys.join(crowded, ["t", "bucket"]) \
        .withColumn("blk", F.pmod(F.xxhash64("id"), F.col("nb"))) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
    side = F.when(F.col("blk") == F.col("other"), 3).when(F.col("blk") < F.col("other"), 1) \
        .otherwise(2)
    tasks = placed.select("t", F.least("blk", "other").alias("i"),
                          F.greatest("blk", "other").alias("j"), "id", side.alias("side"), "bucket") \
        .join(points, "id").select("t", "i", "j", "id", "unit", "sigs", "w", "side", "bucket") \
        .repartition("t", "bucket", "i", "j").sortWithinPartitions("t", "bucket", "i", "j")
    found = stored(_checked(tasks, cosine), "found")
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    copies = hashed.join(exact.where("w > 1"), "unit").select("id", "rep", "w")
    comps = components(found.select(F.col("id").alias("a"), "b")
                       .union(copies.select(F.col("id").alias("a"), F.col("rep").alias("b"))))
    copies = stored(copies, "copies")
    own = rows.select("id").join(copies, "id", "left") \
        .withColumn("point", F.coalesce("rep", "id"))
    out = own.join(counts.withColumnRenamed("id", "point"), "point", "left") \
        .join(comps.withColumnRenamed("node", "id"), "id", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col),
                      (F.coalesce("n", F.lit(0)) + F.coalesce("w", F.lit(1)) - 1).cast("long")
                      .alias("n_links"), component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))

