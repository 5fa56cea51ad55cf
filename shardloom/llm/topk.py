"""Exact top-k inner-product search: tiled matrix products and a tree merge of per-query lists.

Rows become integer vectors floor(64 x). Queries and candidates are packed into tiles (one row per
tile, a matrix as bytes); a join on the group number brings every query tile to every group of
candidate tiles, one group at a time per task row. Each pair of tiles is one matrix product,
from which the k best of every query are selected (partial selection, ties to the smaller id);
the lists of a query are merged in rounds of ``FAN`` lists until one is left.

Exactness: products run in float32 or float64 where the largest possible sum is exactly
representable, else in Python integers. Work is queries x rows by definition of the task; no
row is skipped, and only tiles, never all pairs, are formed.

Defined results: vectors that are null, empty, of another length than the table's most frequent
one, or that hold a null or non-finite component take no part; a row is never its own candidate,
other rows of the same id are; null ids are candidates that rank last among equals; scores
beyond 64 bits raise an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shardloom.llm import common as C

TILE = 4096
FAN = 16
K = 20
NULL_ID = 2**63 - 1
TILE_SCHEMA = "ids binary, keys binary, matrix binary, rows int, kind string"


def clean_vectors(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(_uid, vec_id, v): integer components as doubles, one unique key per row, rows that take part only."""
    parts = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = (table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector), F.size(vector).alias("dim"))
            .filter(F.col(vector).isNotNull() & (F.col("dim") > 0) & finite)
            .select("vec_id", "dim", F.transform(parts, lambda x: x * F.lit(64.0)).alias("v")))
    rows = C.with_row_key(rows)
    dims = rows.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(1).select("dim")
    return rows.join(F.broadcast(dims), "dim", "left_semi").drop("dim")  # one row


def _joined(batches):
    """Batches of TILE rows at least (but for the last)."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= TILE:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _tiles(batches):
    """Matrices of at most TILE rows; integers in the narrowest type that holds them exactly."""
    for batch in _joined(batches):
        for i in range(0, batch.num_rows, TILE):
            part = batch.slice(i, TILE)
            v = np.floor(part.column("v").flatten().to_numpy()).reshape(part.num_rows, -1)
            top = np.abs(v).max(initial=0)
            kind = "<i2" if top < 2**15 else "<f8"  # beyond, a double is itself an integer
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.column("vec_id").fill_null(NULL_ID).to_numpy().astype("<i8").tobytes()], pa.binary()),
                 pa.array([part.column("_uid").to_numpy().astype("<i8").tobytes()], pa.binary()),
                 pa.array([v.astype(kind).tobytes()], pa.binary()), pa.array([part.num_rows], pa.int32()), pa.array([kind])],
                names=["ids", "keys", "matrix", "rows", "kind"])


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer rows as int64, exact."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if bound < 2**24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m.tolist()], object)
    out = whole(a) @ whole(b).T
    if max(abs(x) for x in out.ravel()) >= 2**63:
        raise OverflowError("a score does not fit 64 bits")
    return out.astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, keys: np.ndarray, skip: np.ndarray, k: int) -> list[np.ndarray]:
    """Candidate indices of each query's k best: score falling, id rising, row key rising."""
    order = np.lexsort((keys, ids))
    scores = scores[:, order]
    own = keys[order][None, :] == skip[:, None]
    # The k-th largest score bounds what has to be sorted; ties at the bound are settled by column order.
    take = min(k + 1, scores.shape[1])
    bound = np.partition(scores, scores.shape[1] - take, axis=1)[:, scores.shape[1] - take] if take else None
    out = []
    for i in range(len(scores)):
        at = np.flatnonzero((scores[i] >= bound[i]) & ~own[i])
        at = at[np.argsort(-scores[i][at], kind="stable")][:k]
        out.append(order[at])
    return out


def _search(k: int):
    def run(batches):
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                read = lambda side: (np.frombuffer(row[f"{side}_matrix"], row[f"{side}_kind"]).reshape(row[f"{side}_rows"], -1),
                                     np.frombuffer(row[f"{side}_ids"], "<i8"), np.frombuffer(row[f"{side}_keys"], "<i8"))
                (q, q_ids, q_keys), (c, c_ids, c_keys) = read("q"), read("c")
                scores = exact_products(q, c)
                picked = best(scores, c_ids, c_keys, q_keys, k)
                n = [len(p) for p in picked]
                at = np.concatenate(picked) if picked else np.zeros(0, np.int64)
                of = np.repeat(np.arange(len(n)), n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_keys[of]), pa.array(q_ids[of]), pa.array(np.full(len(at), row["tile"])), pa.array(c_ids[at]), pa.array(c_keys[at]),
                     pa.array(scores[of, at])], names=["query_key", "query_id", "list", "vec_id", "vec_key", "score"])
    return run


def top_k(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``rows`` for each row of ``queries`` (both from ``clean_vectors``)."""
    spark = rows.sparkSession
    shards = C.materialize(rows.mapInArrow(_tiles, TILE_SCHEMA).withColumn("tile", F.monotonically_increasing_id()), "tiles")
    n_tiles = shards.count()
    asked = queries.coalesce(max(1, min(n_tiles, 64))).mapInArrow(_tiles, TILE_SCHEMA)
    named = lambda side: [F.col(c).alias(f"{side}_{c}") for c in ("ids", "keys", "matrix", "rows", "kind")]
    # As many groups as tiles (up to 1024): each group has its own copy of the query tiles.
    groups = max(1, min(n_tiles, 1024))
    left = asked.select(*named("q"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    right = shards.select(*named("c"), "tile", F.pmod(F.xxhash64("tile"), F.lit(groups)).cast("int").alias("group"))
    lists = left.join(right, "group").mapInArrow(
        _search(k), "query_key bigint, query_id bigint, list bigint, vec_id bigint, vec_key bigint, score bigint")
    lists = lists.withColumn("list", F.pmod(F.xxhash64("list"), F.lit(max(1, n_tiles))))
    order = [F.desc("score"), F.asc("vec_id"), F.asc("vec_key")]
    left_over = n_tiles
    while left_over > FAN:  # tree merge: at most FAN lists of k meet in one place
        left_over = -(-left_over // FAN)
        lists = (lists.withColumn("list", F.pmod("list", F.lit(left_over)))
                 .withColumn("rank", F.row_number().over(Window.partitionBy("query_key", "list").orderBy(*order))).filter(F.col("rank") <= k).drop("rank"))
    last = lists.withColumn("rank", F.row_number().over(Window.partitionBy("query_key").orderBy(*order))).filter(F.col("rank") <= k)
    return last.select("query_id", "rank", F.nullif("vec_id", F.lit(NULL_ID)).alias("vec_id"), "score")
