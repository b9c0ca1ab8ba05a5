"""Exact top-k by inner product with block-at-a-time pruning.

Vectors are laid out in blocks of consecutive documents. A block carries a
forward index (its ids and components) and, for each dimension, the largest and
smallest component in it. For a query the summed term maxima of a block bound
every score in it. Blocks are scored in the order of their bounds until the
bound falls below the query's kth score, which drops no result and no tie.

Blocks come from a range partition by leading dimension, then id: vectors that
point the same way share a block, which makes the bounds tight. The queries are
cut into chunks in the same way. Every chunk meets the blocks of every partition
in a task of its own, so that neither side is ever held whole, and the lists of
the partitions are merged by rank.

Vectors that are null or hold null or non-finite components, and rows with a
null id, take no part. Every row is an item of its own, also where ids repeat: a
query leaves out only its own row. Vectors of different lengths are padded
with zeros. Equal scores go to the smaller id. Scores are 64-bit integers. An
empty table, or one without queries, gives no rows. Further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.common import written

BLOCK = 512
GROUP = 16
CHUNK = 1024
EXACT = float(1 << 53)


def quantized(df: DataFrame, id_col: str, vector_col: str, scale: int = 64) -> DataFrame:
    """(vec_id, v): integer vectors floor(scale * x) of the rows that take part."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & v.isNotNull()).where(finite)
    ints = F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), ints.alias("v"))


def blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Forward indexes of up to `size` consecutive rows of each partition: block, n, dim, ids, numbers, rows (all binary)."""

    def run(batches):
        from pyspark import TaskContext

        part, made, ids, numbers, rows = TaskContext.get().partitionId(), 0, [], [], []

        def packed(ids, numbers, rows):
            dim = max(len(r) for r in rows)
            matrix = np.zeros((len(rows), dim), dtype=np.int64)
            for k, r in enumerate(rows):
                matrix[k, : len(r)] = r
            raw = [[np.array(x, np.int64).tobytes()] for x in (ids, numbers)]
            values = [[(part << 32) + made], [len(rows)], [dim], *raw, [matrix.tobytes()]]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(values, kinds)], names=["block", "n", "dim", "ids", "numbers", "rows"]
            )

        for batch in batches:
            for i, number, r in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "number", "v"))):
                ids.append(i)
                numbers.append(number)
                rows.append(r)
                if len(ids) == size:
                    yield packed(ids, numbers, rows)
                    made, ids, numbers, rows = made + 1, [], [], []
        if ids:
            yield packed(ids, numbers, rows)

    return vectors.mapInArrow(run, "block long, n int, dim int, ids binary, numbers binary, rows binary")


def unpacked(block: dict, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, row numbers, components) of a block."""
    rows = np.frombuffer(block["rows"], np.int64).reshape(block["n"], block["dim"])
    ids, numbers = (np.frombuffer(block[c], np.int64) for c in ("ids", "numbers"))
    return ids, numbers, np.pad(rows, ((0, 0), (0, dim - block["dim"])))


def best(queries: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k highest scores of each query among (query, id, score) triples, ties to the smaller id."""
    order = np.lexsort((ids, -scores, queries))
    queries, ids, scores = queries[order], ids[order], scores[order]
    starts = np.flatnonzero(np.diff(queries, prepend=-1))
    rank = np.arange(len(queries)) - np.repeat(starts, np.diff(np.append(starts, len(queries))))
    return queries[rank < k], ids[rank < k], scores[rank < k]


def search_blocks(query_numbers: np.ndarray, query_rows: np.ndarray, parts: list, k: int) -> tuple:
    """(place of the query, id, score) of each query's k best among the blocks `parts` of (ids, numbers, rows)."""
    count = len(query_numbers)
    largest = np.stack([rows.max(axis=0) for _, _, rows in parts])
    smallest = np.stack([rows.min(axis=0) for _, _, rows in parts])
    top = max(int(np.abs(largest).max(initial=0)), int(np.abs(smallest).max(initial=0)))
    widest = float(top) * float(np.abs(query_rows).max(initial=0)) * max(1, query_rows.shape[1])
    kind = np.float64 if widest < EXACT else np.int64  # float products of integers below 2^53 are exact
    q = query_rows.astype(kind)
    bounds = np.maximum(q, 0) @ largest.astype(kind).T + np.minimum(q, 0) @ smallest.astype(kind).T
    order = np.argsort(-bounds, axis=1, kind="stable")
    kth = np.full(count, -np.inf) if kind is np.float64 else np.full(count, np.iinfo(np.int64).min)
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind))
    for turn in range(len(parts)):
        block_of = order[:, turn]
        open_ = bounds[np.arange(count), block_of] >= kth
        if not open_.any():
            break
        found = [held]
        for b in np.unique(block_of[open_]):
            ids, numbers, rows = parts[b]
            who = np.flatnonzero(open_ & (block_of == b))
            scores = q[who] @ rows.astype(kind).T
            own = query_numbers[who][:, None] == numbers[None, :]
            keep = ~own & (scores >= kth[who][:, None])
            if scores.shape[1] > k + 1:
                # one column more than k, as the query's own row may be among the highest
                keep &= scores >= np.partition(scores, -(k + 1), axis=1)[:, -(k + 1)][:, None]
            at, col = np.nonzero(keep)
            found.append((who[at], ids[col], scores[at, col]))
        held = best(*[np.concatenate(x) for x in zip(*found)], k)
        filled = np.bincount(held[0], minlength=count) >= k
        ends = np.searchsorted(held[0], np.flatnonzero(filled), side="right") - 1
        kth[filled] = held[2][ends]
    return held


def top_k(
    df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other vectors of every vector for which `is_query` holds.

    `is_query` is a condition on the column vec_id.
    """
    numbered = quantized(df, id_col, vector_col, scale).withColumn("number", F.monotonically_increasing_id())
    vectors = written(numbered, "vectors")
    total = vectors.count()
    parts = max(1, -(-total // (BLOCK * GROUP)))
    size = F.transform("v", lambda x: F.abs(x))
    lead = F.array_position(size, F.array_max(size)) * F.signum(
        F.coalesce(F.try_element_at("v", F.array_position(size, F.array_max(size)).cast("int")), F.lit(0))
    )
    placed = vectors.withColumn("lead", F.coalesce(lead, F.lit(0.0)))
    ranged = placed.repartitionByRange(parts, "lead", "vec_id").sortWithinPartitions("lead", "vec_id")
    index = written(blocks(ranged.select("vec_id", "number", "v"), BLOCK), "blocks")
    asked = vectors.where(is_query)
    chunks = max(1, -(-asked.count() // CHUNK))
    ordered = asked.repartitionByRange(chunks, "vec_id").sortWithinPartitions("vec_id")
    query_chunks = written(blocks(ordered, CHUNK), "queries")
    part = F.shiftright("block", 32).cast("int")
    groups, chunks = (1 + (df_.agg(F.max(part)).first()[0] or 0) for df_ in (index, query_chunks))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index.select(part.alias("g"), every(chunks).alias("c"), "n", "dim", "ids", "numbers", "rows")
    right = query_chunks.select(every(groups).alias("g"), part.alias("c"), "n", "dim", "ids", "numbers", "rows")

    def search(own: pa.Table, asking: pa.Table) -> pa.Table:
        kinds = [pa.int64()] * 4
        names = ["number", "query_id", "vec_id", "score"]
        block_rows, query_rows = own.to_pylist(), asking.to_pylist()
        if not block_rows or not query_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in kinds], names=names)
        dim = max(b["dim"] for b in block_rows + query_rows)
        parts = [unpacked(b, dim) for b in block_rows]
        qs = [unpacked(b, dim) for b in query_rows]
        ids, numbers, rows = (np.concatenate(x) for x in zip(*qs))
        who, found, score = search_blocks(numbers, rows, parts, k)
        values = [numbers[who], ids[who], found, score.astype(np.int64)]
        return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], names=names)

    lists = left.groupBy("g", "c").cogroup(right.groupBy("g", "c")).applyInArrow(
        search, "number long, query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    ranked = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
