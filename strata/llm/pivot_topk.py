"""Exact top-k search by inner product with pivot-table elimination.

Vectors are turned into integers, floor(scale * x). The pivot table holds, for
every vector, what its distances to the pivots determine: its coordinates in
the pivots' span, the length of the rest, and its squared length (the squared
distance to any pivot p is |c - c_p|^2 + rest^2). From these, the largest
lower bound of the distance of a query q and a vector x that follows from all
pivots together is |c_q - c_x|^2 + (rest_q - rest_x)^2: no single pivot's
|d(q, p) - d(x, p)| exceeds it. It bounds the inner product from above by
c_q . c_x + rest_q * rest_x.

Pivots are vectors of a bounded seeded sample, each the farthest from the span
of those before: as many as ``PIVOTS``, but at most ``SPAN`` of the width. The
sample also gives every query a floor, its k-th best score in the sample.

The table and the queries are written, with a group number for rows
(``GROUP_ROWS`` each) and a block number for queries (``QUERY_BLOCK`` each).
Each task takes one group and one block: it puts the group's rows in the order
of their bounds for each query and evaluates exactly until the next bound is
below the query's k-th best score so far, at first its floor. It returns k
rows a query at most; the last step ranks those. The result is exact: bounds
only end the evaluation (they are widened by more than their rounding), and
scores are integer products (64-bit where they fit, else Python integers).

Defined cases: vectors that are null or hold null, NaN or infinite components
take no part; shorter vectors count as padded with zeros; a row with a null
id is a candidate (after all others in ties), never a query; rows that repeat
a query's id are not its candidates, rows that repeat another id are each
candidates, and a repeated query is asked once, with its smallest vector;
components beyond 64 bits, and scores beyond them, are held at the largest or
smallest 64-bit integer (scores are ranked before that); an empty table gives
an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import Scratch, stage

PIVOTS = 256
SPAN = 0.75
PIVOT_SAMPLE = 1024        # vectors the pivots are chosen from
QUERY_BLOCK = 512
GROUP_ROWS = 16_384
ROWS = 2048                # table rows bounded at once
STEP = 64                  # candidates evaluated at once
LONG = np.iinfo(np.int64)


def integers(vector: Column, scale: int = 256) -> Column:
    """array<long> floor(scale * x); null when the vector takes no part."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(ok, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def choose_pivots(sample: list, most: int = PIVOTS, span: float = SPAN) -> np.ndarray:
    """Orthonormal basis (rows) of the span of the chosen sample vectors."""
    width = max(map(len, sample), default=0)
    rest = _matrix(sample, width).astype(float)
    basis = np.zeros((0, width))
    while len(basis) < min(most, int(np.ceil(span * width))):
        far = (rest ** 2).sum(1)
        k = int(far.argmax()) if len(far) else 0
        if not len(far) or far[k] <= 1e-9:
            break
        e = rest[k] / np.sqrt(far[k])
        e -= basis.T @ (basis @ e)                         # orthogonal again, whatever was rounded
        basis = np.vstack([basis, e / np.sqrt(e @ e)])
        rest -= np.outer(rest @ basis[-1], basis[-1])
    return basis


def _matrix(vectors, width: int) -> np.ndarray:
    """Integer rows padded or cut to ``width`` (a cut part meets only zeros)."""
    out = np.zeros((len(vectors), width), np.int64)
    for k, v in enumerate(vectors):
        n = min(width, len(v))
        out[k, :n] = v[:n]
    return out


def products(x: np.ndarray, q: np.ndarray, largest: float) -> np.ndarray:
    """Exact inner products; ``largest`` bounds their size."""
    return x @ q if largest < 2.0 ** 62 else x.astype(object) @ q.astype(object)


def pivot_table(vectors: DataFrame, basis: np.ndarray) -> DataFrame:
    """``vectors`` with c (coordinates), rest and norm."""
    shared = vectors.sparkSession.sparkContext.broadcast(basis)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        basis = shared.value
        for b in batches:
            norm2 = np.array([float(v @ v) for v in (np.asarray(v, float) for v in b["v"])])
            c = _matrix(b["v"].tolist(), basis.shape[1]).astype(float) @ basis.T     # pivots are zero beyond their width
            rest = np.sqrt(np.maximum(norm2 - (c ** 2).sum(1), 0))
            yield b.assign(c=list(c), rest=rest, norm=np.sqrt(norm2))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields)
    return vectors.mapInPandas(run, f"{schema}, c array<double>, rest double, norm double")


def _floor(queries: dict, sample_ids: np.ndarray, sample: np.ndarray, k: int) -> list:
    """Each query's k-th best score among the sample's other rows, None if
    there are fewer."""
    out = []
    for i, v, norm in zip(queries["id"], queries["v"], queries["norm"], strict=True):
        width = max(len(v), sample.shape[1])
        scores = products(_matrix(sample, width), _matrix([v], width)[0], norm * float(np.sqrt((sample.astype(float) ** 2).sum(1)).max(initial=0)))
        scores = sorted(scores[sample_ids != i].tolist(), reverse=True)
        out.append(scores[k - 1] if len(scores) >= k else None)
    return out


def search(rows: dict, queries: dict, k: int) -> tuple[list, int]:
    """([(query id, row id, whether the row has an id, score)], number of
    products evaluated) of one group of rows and one block of queries."""
    width = max(max(map(len, rows["v"])), max(map(len, queries["v"])))
    q, qc = _matrix(queries["v"], width), np.stack(queries["c"])
    best: list[list] = [[] for _ in queries["id"]]           # (-score, no id, id), ascending
    floor = np.array([-np.inf if f is None else float(f) for f in queries["floor"]])
    evaluated = 0
    for s in range(0, len(rows["id"]), ROWS):
        part = {n: c[s:s + ROWS] for n, c in rows.items()}
        x, xc = _matrix(part["v"], width), np.stack(part["c"])
        sizes = np.outer(queries["norm"], part["norm"])
        bounds = qc @ xc.T + np.outer(queries["rest"], part["rest"]) + 1e-6 * sizes + 1e-3
        for j in np.flatnonzero((bounds >= floor[:, None]).any(1)):
            bound, top = bounds[j], best[j]
            order = np.flatnonzero((bound >= floor[j]) & ((part["id"] != queries["id"][j]) | ~part["known"]))
            order = order[np.argsort(-bound[order], kind="stable")]
            for a in range(0, len(order), STEP):
                if bound[order[a]] < floor[j]:
                    break                                     # no later candidate can enter
                at = order[a:a + STEP]
                scores = products(x[at], q[j], float(sizes[j].max()))
                evaluated += len(at)
                top = sorted([*top, *((-int(v), not part["known"][h], int(part["id"][h])) for h, v in zip(at, scores, strict=True))])[:k]
                if len(top) == k:
                    floor[j] = max(floor[j], np.nextafter(float(-top[-1][0]), -np.inf))
            best[j] = top
    return [(int(queries["id"][j]), i, not none, -s) for j, top in enumerate(best) for s, none, i in top], evaluated


def _columns(df: pd.DataFrame) -> dict:
    out = {n: df[n].to_numpy() for n in df.columns if n not in ("v", "c", "floor")} | {n: df[n].tolist() for n in ("v", "c")}
    if "floor" in df.columns:
        out["floor"] = [None if f is None else int(f) for f in df["floor"]]
    return out


def top_k(table: DataFrame, *, id_col="vec_id", vector_col="embedding", k: int = 5, every: int = 50, scale: int = 256,
          group_rows: int = GROUP_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for all rows whose id is divisible by ``every``."""
    spark, scratch = table.sparkSession, Scratch()
    vectors = (table.select(F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.col(id_col).isNotNull().alias("known"),
                            integers(F.col(vector_col), scale).alias("v")).filter("v IS NOT NULL"))
    sample = vectors.orderBy(F.xxhash64("id", F.lit(3)), "id", "v").limit(PIVOT_SAMPLE).collect()
    basis = choose_pivots([r["v"] for r in sample])
    rows = scratch.stage(pivot_table(vectors, basis).withColumn("serial", F.monotonically_increasing_id()), "topk-pivots")
    wanted = rows.filter(F.col("known") & (F.col("id") % every == 0))
    counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(F.when(F.col("known") & (F.col("id") % every == 0), F.col("id"))).alias("queries")).first()
    groups, blocks = max(1, -(-counts["rows"] // group_rows)), max(1, -(-counts["queries"] // query_block))

    known = [r for r in sample if r["known"]]                # of rows without an id it isn't known whether they repeat the query's
    shared = spark.sparkContext.broadcast((np.array([r["id"] for r in known], np.int64), _matrix([r["v"] for r in known], basis.shape[1])))

    def floors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = _floor(_columns(b), *shared.value, k)
            yield b.assign(floor=pd.Series([None if f is None else str(f) for f in found], dtype=object))

    asked = wanted.groupBy("id").agg(F.min(F.struct("v", "c", "rest", "norm")).alias("x")).select("id", "x.*")
    asked = asked.mapInPandas(floors, "id long, v array<long>, c array<double>, rest double, norm double, floor string")
    asked = scratch.stage(asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(blocks)).cast("int")), "topk-queries")

    # every group of rows meets every block of the stated queries
    left = rows.withColumn("group", F.pmod("serial", F.lit(groups)).cast("int")).drop("serial").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def one(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found, _ = search(_columns(rows), _columns(queries), k) if len(rows) and len(queries) else ([], 0)
        return pd.DataFrame({"query_id": np.array([f[0] for f in found], np.int64), "id": np.array([f[1] for f in found], np.int64),
                             "known": np.array([f[2] for f in found], bool), "score": pd.Series([str(f[3]) for f in found], dtype=object)})

    found = left.groupBy("group", "block").cogroup(right.groupBy("group", "block")).applyInPandas(
        one, "query_id long, id long, known boolean, score string")
    # scores as decimals: wide enough for any product of 64-bit integers
    exact = F.col("score").cast("decimal(38,0)")
    order = Window.partitionBy("query_id").orderBy(exact.desc(), F.desc("known"), F.asc("id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    held = F.greatest(F.least(exact, F.lit(LONG.max).cast("decimal(38,0)")), F.lit(LONG.min).cast("decimal(38,0)")).cast("long")
    out, _ = stage(ranked.select("query_id", "rank", F.when(F.col("known"), F.col("id")).alias("vec_id"), held.alias("score")), "topk")
    scratch.drop(spark)
    return out
