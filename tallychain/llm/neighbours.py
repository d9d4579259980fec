"""Nearest neighbours by inner product: a block matrix join over int8 tiles with error bounds."""

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallychain.session import written

#: Rows of a candidate block and of a query block; a tile is one of each.
CANDIDATES, QUERIES = 2048, 512
#: Candidate blocks of a group, about one megabyte each, that a join holds at once.
GROUP_BLOCKS = 64
#: A task that has seen more queries hands over the heaps it holds and begins anew.
HEAPS = 20_000
_PACKED = "part long, dim int, ids binary, vectors binary"
_FOUND = "query_id long, vec_id long, score double"


def usable(vectors, vector="embedding", row_id="vec_id"):
    """(vec_id, v array<double>) of the vectors that take part: with an id, neither null, empty nor zero, all components finite.

    Of rows that repeat an id the largest vector, compared from its first component on, stays.
    """
    v = F.col(vector)
    fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(row_id).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & fine).groupBy(
        "vec_id"
    ).agg(F.max("v").alias("v"))


def _packed(rows, block):
    """(block, dim, ids, vectors) rows with at most ``block`` vectors each; ids and vectors are packed binary, dims never mix."""

    def row(ids, vecs, dim):
        vecs = np.array(np.stack(vecs), "<f8")
        return pd.DataFrame({"block": [min(ids)], "dim": [int(dim)], "ids": [np.array(ids, "<i8").tobytes()], "vectors": [vecs.tobytes()]})

    def pack(batches):
        held = {}
        for pdf in batches:
            for dim, group in pdf.groupby("dim"):
                ids, vecs = held.setdefault(dim, ([], []))
                ids.extend(group["vec_id"])
                vecs.extend(group["v"])
                while len(ids) >= block:
                    yield row(ids[:block], vecs[:block], dim)
                    del ids[:block], vecs[:block]
        for dim, (ids, vecs) in held.items():
            if ids:
                yield row(ids, vecs, dim)

    return rows.select("vec_id", "v", F.size("v").alias("dim")).mapInPandas(pack, "block long, dim int, ids binary, vectors binary")


def quantised(v):
    """int8 rows as floats, their scales, and the length of what rounding leaves of each row."""
    scale = np.abs(v).max(axis=1) / 127
    scale[scale == 0] = 1
    q = np.rint(v / scale[:, None])
    return q.astype(np.float32), scale, np.linalg.norm(v - q * scale[:, None], axis=1)


def exact_products(a, b):
    """Inner products of equal rows of a and b, summed from the first component on in double precision."""
    return np.add.accumulate(a * b, axis=1)[:, -1] if len(a) else np.zeros(0)


def tile(query_ids, queries, ids, vectors, k):
    """The k best candidates of each query of a tile, with exact scores: (query row, id, score).

    q.c = (s q')(t c') + rest, where |rest| <= |q - sq'| |tc'| + |q| |c - tc'|.  A candidate whose
    upper bound is below the k-th best lower bound of the tile cannot be among the k best.
    """
    qi, qs, qe = quantised(queries)
    ci, cs, ce = quantised(vectors)
    near = (qi @ ci.T).astype(np.float64) * qs[:, None] * cs[None, :]  # sums of int8 products are exact in float up to dimension 1040
    chat = np.linalg.norm(ci.astype(np.float64) * cs[:, None], axis=1)
    qn = np.linalg.norm(queries, axis=1)
    error = (qe[:, None] * chat[None, :] + qn[:, None] * ce[None, :]) * (1 + 1e-9) + 1e-12 * qn[:, None] * (chat + ce)[None, :]
    if queries.shape[1] > 1000:
        error += np.abs(near) * 1e-4 + 1e-4 * qn[:, None] * chat[None, :]
    own = query_ids[:, None] == ids[None, :]
    low = np.where(own, -np.inf, near - error)
    if low.shape[1] > k:
        bound = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
    else:
        bound = np.full(len(low), -np.inf)
    rows, cols = np.nonzero((near + error >= bound[:, None]) & ~own)
    parts = [exact_products(queries[rows[i:i + 16384]], vectors[cols[i:i + 16384]]) for i in range(0, len(rows), 16384)]
    score, found = np.concatenate([*parts, np.zeros(0)]), ids[cols]
    order = np.lexsort((found, -score, rows))
    rows, found, score = rows[order], found[order], score[order]
    best = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[best], found[best], score[best]


def nearest(queries, candidates, k=20):
    """(query_id, rank, vec_id, score): each query's k candidates of largest inner product, nearest first, ties to the smaller vec_id.

    Both tables are (vec_id, v) as :func:`usable` gives them, each id once.  A query's own id is no
    candidate of its; vectors of another dimension are none either.  Without candidates a query has
    no rows.

    Both sides are packed into blocks.  Candidate blocks are dealt to groups, every query block
    goes to every group, and each pair of blocks is one tile, which compares int8 products with
    their error bounds before it computes exact ones.  A task keeps a heap of k for each query;
    what the heaps hold is ranked at the end.
    """
    spark = candidates.sparkSession
    right, _ = written(_packed(candidates, CANDIDATES), "ann-candidates")
    left, _ = written(_packed(queries, QUERIES), "ann-queries")
    blocks = right.count()
    groups = max(1, min(blocks, int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-blocks // GROUP_BLOCKS))
    right = right.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)))
    left = left.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    # By the size of its files Spark would take the query blocks for few and broadcast their copies for all groups through the driver.
    tiles = left.select("group", "dim", F.col("ids").alias("query_ids"), F.col("vectors").alias("queries")).join(
        right.select("group", "dim", "ids", "vectors").hint("merge"), ["group", "dim"]
    )

    def merge(batches):
        heaps = {}

        def held():
            out = [(query, -one, score) for query, heap in heaps.items() for score, one in heap]
            heaps.clear()
            return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

        for pdf in batches:
            for row in pdf.itertuples(index=False):
                query_ids, ids = np.frombuffer(row.query_ids, "<i8"), np.frombuffer(row.ids, "<i8")
                q, c = np.frombuffer(row.queries, "<f8").reshape(-1, row.dim), np.frombuffer(row.vectors, "<f8").reshape(-1, row.dim)
                rows, found, score = tile(query_ids, q, ids, c, k)
                for query, one, value in zip(query_ids[rows].tolist(), found.tolist(), score.tolist()):
                    heap = heaps.setdefault(query, [])
                    if len(heap) < k:
                        heapq.heappush(heap, (value, -one))
                    elif (value, -one) > heap[0]:
                        heapq.heapreplace(heap, (value, -one))
                if len(heaps) > HEAPS:
                    yield held()
        yield held()

    found = tiles.mapInPandas(merge, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
