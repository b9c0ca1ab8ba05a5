"""Hard-negative mining with exact Four-Russians scores.

Candidates. Rows are packed into blocks as bit planes: byte (b, g) of a row holds
bit b of its components 8g to 8g+7, in two's complement.

Anchors. For each group of eight dimensions a table holds the sum of every subset
of an anchor's components, 256 entries, each built from a smaller one. A score is
then a lookup per plane and group: the looked-up sums of a plane are added, planes
are shifted and added from the highest, which counts negatively.

Passes. Anchors go out in chunks of at most `CHUNK` rows, a bounded broadcast;
the candidates are neither shuffled nor copied. A first pass over a chunk scores
rows of the anchors' own labels and gives each anchor's positives; a second one
scores all rows and gives, for each positive, the best rows of other labels
within its window. Every task keeps its best rows and hands on no others. Before
each pass one block in sixteen is scored, and only rows as good as the result of
these are handed on, so that their number does not follow the number of tasks.

Rows with a null id, label or vector, or a null or non-finite component take no
part. Shorter vectors count as filled up with zeros. Every row is an item of its
own, also where ids repeat; equal scores go to the smaller id. Scores are 64-bit
integers. Anchors without positives or with empty windows give no rows; negative
positive scores have empty windows. Empty tables give no rows. Columns other than
id, vector and label are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from aerolith.llm.common import written
from aerolith.session import fresh_path

BLOCK = 1024
CHUNK = 1024
TILE = 128
WAITING = 1 << 18
SAMPLED = 16
PACKED = "block long, n int, dim int, planes int, ids binary, labels binary, anchors binary, bits binary"


def items(df: DataFrame, is_anchor: Column, label: Column, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, label, anchor, v): rows that take part, with integer vectors floor(scale * x)."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & label.isNotNull() & v.isNotNull()).where(finite)
    return rows.select(
        F.col(id_col).cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v"),
    )


def bit_planes(rows: np.ndarray) -> np.ndarray:
    """Bytes (plane, group, row) of integer vectors whose dimensions are a multiple of eight."""
    top = max(int(rows.max(initial=0)), -int(rows.min(initial=0)) - 1, 0)
    count = top.bit_length() + 1
    bits = np.stack([(rows >> b) & 1 for b in range(count)]).astype(np.uint8)
    return np.packbits(bits.reshape(count, len(rows), -1, 8), axis=3, bitorder="little")[..., 0].transpose(0, 2, 1)


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Table (group, subset, anchor) of the sums of each subset of eight components."""
    n, dim = anchors.shape
    groups = anchors.reshape(n, dim // 8, 8).transpose(1, 2, 0)
    table = np.zeros((dim // 8, 256, n), dtype=anchors.dtype)
    for d in range(8):
        table[:, 1 << d : 2 << d] = table[:, : 1 << d] + groups[:, d : d + 1]
    return table


def scores(planes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Exact inner products (row, anchor) by lookups, shifts and additions."""
    count, groups, n = planes.shape
    total = np.zeros((n, table.shape[2]), dtype=table.dtype)
    for b in range(count - 1, -1, -1):
        total <<= 1
        for g in range(min(groups, len(table))):
            part = table[g].take(planes[b, g], axis=0)
            if b == count - 1:
                total -= part
            else:
                total += part
    return total


def packed(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """Blocks of up to `size` rows (1024 at most) of each partition as bit planes."""

    arrow = to_arrow_schema(StructType.fromDDL(PACKED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                vectors = part.column("v").to_pylist()
                dim = max(8, -(-max(map(len, vectors)) // 8) * 8)
                matrix = np.zeros((len(vectors), dim), dtype=np.int64)
                for k, v in enumerate(vectors):
                    matrix[k, : len(v)] = v
                planes = bit_planes(matrix)
                ids, labels, anchors = (np.array(part.column(c).to_pylist()) for c in ("vec_id", "label", "anchor"))
                yield pa.RecordBatch.from_pylist([{
                    "block": base + made, "n": len(vectors), "dim": dim, "planes": len(planes),
                    "ids": ids.astype(np.int64).tobytes(), "labels": labels.astype(np.int64).tobytes(),
                    "anchors": anchors.astype(np.uint8).tobytes(), "bits": planes.tobytes(),
                }], arrow)
                made += 1

    return rows.mapInArrow(run, PACKED)


class Rows:
    """An unpacked block: numbers, ids, labels and bit planes of its rows."""

    def __init__(self, block: dict):
        n, dim = block["n"], block["dim"]
        self.numbers = (block["block"] << 10) + np.arange(n)
        self.ids = np.frombuffer(block["ids"], np.int64)
        self.labels = np.frombuffer(block["labels"], np.int64)
        self.anchors = np.frombuffer(block["anchors"], np.uint8).astype(bool)
        self.planes = np.frombuffer(block["bits"], np.uint8).reshape(block["planes"], dim // 8, n)

    def vectors(self) -> np.ndarray:
        """The integer vectors again."""
        bits = np.unpackbits(self.planes[..., None], axis=3, bitorder="little").astype(np.int64)
        weights = 1 << np.arange(len(bits), dtype=np.int64)
        weights[-1] *= -1
        return np.einsum("p,pgnd->ngd", weights, bits).reshape(len(self.ids), -1)


def anchor_rows(index: DataFrame) -> DataFrame:
    """(number, vec_id, label, v) of the anchors in the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                rows = Rows(block)
                at = np.flatnonzero(rows.anchors)
                values = [rows.numbers[at], rows.ids[at], rows.labels[at], list(rows.vectors()[at])]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(values, kinds)], names=["number", "vec_id", "label", "v"]
                )

    return index.mapInArrow(run, "number long, vec_id long, label long, v array<long>")


class Chunk:
    """Anchors in order of their labels, with the windows that rows have to meet."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: (r["label"], r["number"]))
        dim = max(8, -(-max(len(r["v"]) for r in rows) // 8) * 8)
        self.vectors = np.zeros((len(rows), dim), dtype=np.int64)
        for k, r in enumerate(rows):
            self.vectors[k, : len(r["v"])] = r["v"]
        self.numbers = np.array([r["number"] for r in rows], dtype=np.int64)
        self.ids = np.array([r["vec_id"] for r in rows], dtype=np.int64)
        self.labels = np.array([r["label"] for r in rows], dtype=np.int64)
        # rows of any block in 32 bits: the sum of an anchor's sizes bounds a score for components below 2^12
        self.small = int(np.abs(self.vectors).sum(axis=1).max(initial=0)) < 1 << 18

    def table(self, planes: int) -> np.ndarray:
        kind = np.int32 if self.small and planes <= 13 else np.int64
        return subset_sums(self.vectors.astype(kind))


class Best:
    """The k best (score, id) of each list, where lists are numbered and floors only rise."""

    def __init__(self, floors: np.ndarray, k: int):
        self.floors, self.k = floors.copy(), k
        self.held = [np.zeros(0, np.int64) for _ in range(4)]  # list, score, id, number
        self.waiting: list[tuple] = []
        self.n_waiting = 0

    def add(self, lists: np.ndarray, found: np.ndarray, ids: np.ndarray, numbers: np.ndarray) -> None:
        if len(lists):
            self.waiting.append((lists, found, ids, numbers))
            self.n_waiting += len(lists)
            if self.n_waiting > WAITING:
                self.settle()

    def settle(self) -> None:
        """Cut every list to its k best and raise the floors of full lists."""
        if not self.waiting:
            return
        lists, found, ids, numbers = (np.concatenate(x) for x in zip(self.held, *self.waiting))
        self.waiting, self.n_waiting = [], 0
        order = np.lexsort((numbers, ids, -found, lists))
        lists, found = lists[order], found[order]
        starts = np.flatnonzero(np.diff(lists, prepend=-1))
        rank = np.arange(len(lists)) - np.repeat(starts, np.diff(np.append(starts, len(lists))))
        keep = rank < self.k
        self.held = [lists[keep], found[keep], ids[order][keep], numbers[order][keep]]
        full = rank == self.k - 1
        self.floors[lists[full]] = np.maximum(self.floors[lists[full]], found[full])

    def batch(self) -> pa.RecordBatch:
        self.settle()
        return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()) for h in self.held], names=["list", "score", "id", "row"])


def positives_in(chunk: Chunk, blocks: Iterator[Rows], floors: np.ndarray, k: int) -> Best:
    """The best rows of the anchors' own labels; lists are anchors."""
    best, tables = Best(floors, k), {}
    spans = {int(x): slice(*np.searchsorted(chunk.labels, [x, x + 1])) for x in np.unique(chunk.labels)}
    for rows in blocks:
        count = len(rows.planes)
        if count not in tables:
            tables[count] = chunk.table(count)
        for label in np.unique(rows.labels).tolist():
            span = spans.get(label)
            if span is None:
                continue
            own = np.flatnonzero(rows.labels == label)
            part = tables[count][:, :, span]
            for at in range(0, len(own), TILE):
                these = own[at : at + TILE]
                got = scores(rows.planes[:, :, these], part)
                keep = (got >= best.floors[span]) & (rows.numbers[these][:, None] != chunk.numbers[span])
                r, a = np.nonzero(keep)
                best.add(a + span.start, got[r, a].astype(np.int64), rows.ids[these][r], rows.numbers[these][r])
        best.settle()
    return best


def negatives_in(
    chunk: Chunk, blocks: Iterator[Rows], floors: np.ndarray, tops: np.ndarray, turns: int, k: int
) -> Best:
    """The best rows of other labels from each floor to each top; list a * turns + t is window t of anchor a."""
    best, tables = Best(floors, k), {}
    for rows in blocks:
        count = len(rows.planes)
        if count not in tables:
            tables[count] = chunk.table(count)
        for at in range(0, len(rows.ids), TILE):
            these = slice(at, at + TILE)
            got = scores(rows.planes[:, :, these], tables[count])
            other = rows.labels[these][:, None] != chunk.labels
            for t in range(turns):
                keep = other & (got >= best.floors[t::turns]) & (got <= tops[t::turns])
                r, a = np.nonzero(keep)
                best.add(a * turns + t, got[r, a].astype(np.int64), rows.ids[these][r], rows.numbers[these][r])
        best.settle()
    return best


def lists_of(index: DataFrame, search, k: int) -> DataFrame:
    """The k best (list, score, id, row) over all blocks, by `search` in each task, with their rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = (Rows(b) for batch in batches for at in range(batch.num_rows) for b in batch.slice(at, 1).to_pylist())
        yield search(blocks).batch()

    found = index.mapInArrow(run, "list long, score long, id long, row long")
    order = Window.partitionBy("list").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def raised(floors: np.ndarray, sample: list, k: int) -> np.ndarray:
    """Floors raised to the kth score that the sampled blocks already give."""
    floors = floors.copy()
    for r in sample:
        if r["rank"] == k:
            floors[r["list"]] = max(floors[r["list"]], r["score"])
    return floors


def mine_chunk(spark: SparkSession, index: DataFrame, chunk: Chunk, n_positives: int, n_negatives: int, least: int) -> DataFrame:
    """Hard negatives of one chunk of anchors."""
    context, lowest = spark.sparkContext, np.iinfo(np.int64).min
    sample = index.where(F.pmod(F.xxhash64("block"), F.lit(SAMPLED)) == 0)
    sent = context.broadcast(chunk)
    floors = np.full(len(chunk.ids), lowest)
    first = lists_of(sample, lambda blocks: positives_in(sent.value, blocks, floors, n_positives), n_positives)
    known = raised(floors, first.collect(), n_positives)
    found = lists_of(index, lambda blocks: positives_in(sent.value, blocks, known, n_positives), n_positives).collect()

    turns = n_positives
    tops = np.full(len(chunk.ids) * turns, lowest)
    bottoms = np.full(len(tops), np.iinfo(np.int64).max)
    positive: list = [None] * len(tops)
    for r in found:
        at = r["list"] * turns + r["rank"] - 1
        tops[at], bottoms[at] = r["score"], -(-least * r["score"] // 100)
        positive[at] = (r["id"], r["score"])
    second = lists_of(sample, lambda blocks: negatives_in(sent.value, blocks, bottoms, tops, turns, n_negatives), n_negatives)
    raised_to = raised(bottoms, second.collect(), n_negatives)
    mined = lists_of(index, lambda blocks: negatives_in(sent.value, blocks, raised_to, tops, turns, n_negatives), n_negatives)
    asked = spark.createDataFrame(
        [(at, int(chunk.ids[at // turns]), *map(int, positive[at])) for at in range(len(tops)) if positive[at]],
        "list long, anchor_id long, positive_id long, positive_score long",
    )
    return mined.join(F.broadcast(asked), "list").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(
    df: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    n_positives: int = 5, n_negatives: int = 5, least: int = 80, scale: int = 256, chunk_rows: int = CHUNK,
) -> DataFrame:
    """For each anchor and each of its best rows of the same label, the best rows of other labels
    with least % of the positive's score or more, and no more than all of it.

    `is_anchor` and `label` are expressions on the columns of df.
    """
    spark = df.sparkSession
    index = written(packed(items(df, is_anchor, label, id_col, vector_col, scale)), "planes")
    anchors = anchor_rows(index)
    total = written(anchors.drop("v"), "anchors").count()
    if total == 0:
        return spark.createDataFrame([], RESULT)
    parts = -(-total // chunk_rows)
    dealt = anchors.repartitionByRange(parts, "number").withColumn("part", F.spark_partition_id())
    dealt = written(dealt, "chunks")
    path = fresh_path(spark, "negatives")
    for part in range(parts):
        rows = dealt.where(F.col("part") == part)
        held = rows.toLocalIterator()
        while batch := [r for r, _ in zip(held, range(chunk_rows))]:
            mined = mine_chunk(spark, index, Chunk(batch), n_positives, n_negatives, least)
            mined.coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path)
