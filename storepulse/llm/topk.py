"""Exact top-k by inner product: tiles of query blocks and shards, merged as a tree."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_LONG = 2**63 - 1


def _quantised(vectors: pa.Array, scale: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows by dimension: positions, and floor(scale * x) of each component as doubles.

    Vectors that are null or hold a null or non-finite component are left out."""
    sizes: dict[int, list[int]] = {}
    rows = {}
    for i, v in enumerate(vectors.to_pylist()):
        if v is None or any(x is None for x in v):
            continue
        row = np.asarray(v, dtype=np.float64)
        if np.isfinite(row).all():
            with np.errstate(over="ignore"):
                row = np.floor(row * scale)
            if np.isfinite(row).all():
                rows[i] = row
                sizes.setdefault(len(row), []).append(i)
    return {d: (np.asarray(p), np.stack([rows[i] for i in p]) if d else np.zeros((len(p), 0)))
            for d, p in sizes.items()}


def products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Integer inner products, exact: by floating point while sums stay below 2**53,
    else by Python integers, held within 64 bits."""
    bound = (np.abs(queries).max(initial=0) * np.abs(shard).max(initial=0)) * max(1, queries.shape[1])
    if bound < 2**53:
        return (queries @ shard.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    found = exact(queries) @ exact(shard).T
    return np.clip(found, -_LONG - 1, _LONG).astype(np.int64)


def _tile(queries: pa.Table, shard: pa.Table, k: int, scale: float) -> pd.DataFrame:
    """The k best of one shard for each query of one block."""
    found = []
    have = _quantised(shard["embedding"].combine_chunks(), scale)
    ids = np.asarray(shard["vec_id"])
    q_ids = np.asarray(queries["vec_id"])
    s_times, q_times = (np.minimum(np.asarray(t["times"]), k) for t in (shard, queries))
    for dim, (at, wanted) in _quantised(queries["embedding"].combine_chunks(), scale).items():
        if dim not in have:
            continue
        rows, matrix = have[dim]
        names = ids[rows]
        order = np.argsort(names, kind="stable")  # equal scores: smaller id first
        names, matrix, times = names[order], matrix[order], s_times[rows][order]
        scores = products(wanted, matrix)
        own = q_ids[at]
        own_from, own_to = np.searchsorted(names, own, "left"), np.searchsorted(names, own, "right")
        for i in range(len(at)):
            line = scores[i]
            others = np.delete(np.arange(len(line)), np.s_[own_from[i]:own_to[i]]) if own_to[i] > own_from[i] else None
            line = line if others is None else line[others]
            if len(line) > k:
                least = np.partition(line, len(line) - k)[len(line) - k]
                picked = np.flatnonzero(line > least)
                ties = np.flatnonzero(line == least)[:k]
                picked = np.sort(np.concatenate([picked, ties]))
            else:
                picked = np.arange(len(line))
            picked = picked[np.argsort(-line[picked], kind="stable")][:k]
            rows = picked if others is None else others[picked]
            found.append(pd.DataFrame({"query_id": own[i], "vec_id": names[rows], "score": scores[i][rows],
                                       "times": np.minimum(q_times[at[i]] * times[rows], k)}))
    return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0,
          shard_rows: int = 8192, block_rows: int = 1024, fan: int = 32) -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id`, `score`: the k rows of `vectors` with the highest
    integer inner product for each row of `queries`, ties to the smaller vec_id.

    Both frames have vec_id and embedding; other columns are ignored. Components become
    floor(scale * x). Vectors that are null or hold a null or non-finite component, and
    rows without an id, take no part; vectors of different length are never compared.
    A query's own id is no candidate. Rows that repeat an id are candidates of their own, so
    an id may appear several times; queries that repeat an id share one list, in which
    each of them meets every candidate. Fewer than k candidates give fewer rows, none gives none.

    Vectors are dealt by id over shards of about `shard_rows`, queries over blocks of
    about `block_rows`. Each block meets each shard once, in a tile of bounded size that
    keeps k rows per query; the lists are merged within `fan` shards, then across.
    """
    def whole(frame):
        """Usable rows; equal rows are one row with their number, so none fills a shard."""
        usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return (frame.filter("vec_id IS NOT NULL").filter(usable)
                .groupBy(F.col("vec_id").cast("long").alias("vec_id"),
                         F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
                .agg(F.count("*").alias("times")))

    n_shards = max(1, -(-vectors.count() // shard_rows))
    n_blocks = max(1, -(-queries.count() // block_rows))
    shards = whole(vectors).withColumn("shard", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(n_shards)).cast("int"))
    shards = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    blocks = whole(queries).withColumn(
        "block", F.pmod(F.xxhash64("vec_id", "embedding", F.lit(7)), F.lit(n_blocks)).cast("int"))
    blocks = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))

    def tile(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found = _tile(left, right, k, scale) if left.num_rows and right.num_rows else None
        if found is None or found.empty:
            return pa.table({n: pa.array([], t) for n, t in
                             (("shard", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()),
                              ("times", pa.int64()))})
        return pa.table({"shard": pa.array(np.full(len(found), key[1].as_py()), pa.int32()),
                         **{c: pa.array(found[c].to_numpy(), pa.int64()) for c in ("query_id", "vec_id", "score", "times")}})

    lists = blocks.groupBy("block", "shard").cogroup(shards.groupBy("block", "shard")).applyInArrow(
        tile, "shard int, query_id long, vec_id long, score long, times long")
    lists = lists.withColumn("times", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("times")

    def best(frame, *keys):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))
        return frame.withColumn("rank", place).filter(F.col("rank") <= k)

    near = best(lists.withColumn("branch", F.floor(F.col("shard") / fan)), "query_id", "branch")
    return best(near.drop("rank"), "query_id").select("query_id", "rank", "vec_id", "score")
