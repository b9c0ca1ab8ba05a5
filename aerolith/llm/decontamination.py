"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Words are runs of ASCII letters and digits and of anything beyond ASCII, A-Z as
a-z; shingles are sets of five words (a shorter item is one shingle of its
length). An item is contained in a document if at least 0.8 of its shingles
occur there.

Items are partitioned by the power of two of their number of shingles. For each
partition a document is cut into overlapping windows of at most four times that
size, so that an item that is inside always fills a good part of some window,
however long the document is. An item and a document become candidates when one
of 64 MinHash values of the item equals that of a window. An occurrence fills a
quarter of a window at worst, so the chance to miss it is about 0.75^64 = 1e-8.
Candidates are verified by counting the item's shingles, as words, in the
document.

Items are cut into portions of bounded size; documents are read once for each
portion, so that what is sent to the executors stays bounded.

Null and empty texts contain nothing; an item without words is contained
nowhere. A document or item that is repeated is reported for each row of it.
Empty tables give no rows. Further columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import slices, texts_of

SIZE = 5
HASHES = 64
PORTION = 2_000_000
RANDOM = np.random.default_rng(11)
FACTORS = RANDOM.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACES = RANDOM.integers(1, 1 << 63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(PLAIN).split()


def shingles(words: list[bytes], size: int) -> set[bytes]:
    return {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


class WordHashes(dict):
    """Hash of each word, kept for the next time."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_hashes(values: np.ndarray) -> np.ndarray:
    """Hashes of the runs of SIZE words, from the hashes of the words."""
    n = len(values) - SIZE + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = values[:n] * PLACES[0]
    for k in range(1, SIZE):
        total = total + values[k : k + n] * PLACES[k]
    total = (total ^ (total >> np.uint64(29))) * FACTORS[0]
    return total ^ (total >> np.uint64(32))


def prepared(items: list[tuple[int, object, str]]) -> dict:
    """What a task needs to know of items (row number, id, text): shingles, and MinHash values by size class."""
    own, classes, short = {}, {}, {}
    table = WordHashes()
    for row, ident, text in items:
        words = words_of(text or "")
        if not words:
            continue
        size = min(SIZE, len(words))
        own[row] = (ident, size, shingles(words, size))
        if size < SIZE:
            short.setdefault(b" ".join(words), []).append(row)
            continue
        hashes = np.unique(shingle_hashes(np.array([table[w] for w in words], dtype=np.uint64)))
        signature = (hashes[None, :] * FACTORS[:, None]).min(axis=1)
        classes.setdefault(int(math.log2(len(hashes))), []).append((row, signature))
    found = {}
    for level, members in classes.items():
        rows = np.array([r for r, _ in members])
        values = np.stack([s for _, s in members], axis=1)
        order = np.argsort(values, axis=1, kind="stable")
        found[level] = (rows, np.take_along_axis(values, order, axis=1), order)
    return {"items": own, "classes": found, "short": short}


def windows_min(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.minimum.reduceat(values, starts) if len(starts) else values[:0]


def layout(lengths: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the blocks of `stride` in runs of the given lengths, and the number of blocks of each run."""
    counts = -(-lengths // stride)
    first = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(lengths)), counts)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[owner] + inner * stride, counts


def candidates(hashes: np.ndarray, lengths: np.ndarray, classes: dict) -> set[tuple[int, int]]:
    """(document number, item row) that share a MinHash value, for documents one after the other in `hashes`."""
    if not classes or not len(hashes):
        return set()
    levels = range(min(classes), max(classes) + 1)
    shapes, runs, stride = [], lengths, 2 << min(classes)
    for _ in levels:
        starts, counts = layout(runs, stride)
        # window i is block i and the next block of the same run
        owner = np.repeat(np.arange(len(counts)), counts)
        follows = np.append(owner[1:] == owner[:-1], False) if len(owner) else np.zeros(0, bool)
        shapes.append((starts, owner, follows))
        runs, stride = counts, 2
    found: set[tuple[int, int]] = set()
    for k in range(HASHES):
        values = hashes * FACTORS[k]
        for level, (starts, owner, follows) in zip(levels, shapes):
            values = windows_min(values, starts)
            if level not in classes:
                continue
            rows, wanted, order = classes[level]
            paired = values.copy()
            paired[:-1] = np.where(follows[:-1], np.minimum(values[:-1], values[1:]), values[:-1])
            low = np.searchsorted(wanted[k], paired, side="left")
            hit = np.flatnonzero(wanted[k][np.minimum(low, len(rows) - 1)] == paired)
            if len(hit):
                high = np.searchsorted(wanted[k], paired[hit], side="right")
                for at, lo, hi in zip(hit.tolist(), low[hit].tolist(), high.tolist()):
                    for column in range(lo, hi):
                        found.add((int(owner[at]), int(rows[order[k][column]])))
    return found


def search(texts: list[str], known: dict, least: float, table: WordHashes) -> list[tuple[int, int, int, int]]:
    """(text number, item row, item's shingles, shared shingles) for each item that a text contains."""
    if len(table) > 1_000_000:
        table.clear()
    words = [words_of(t) for t in texts]
    hashed = [shingle_hashes(np.fromiter(map(table.__getitem__, w), np.uint64, len(w))) for w in words]
    full = [k for k, h in enumerate(hashed) if len(h)]
    lengths = np.array([len(hashed[k]) for k in full], dtype=np.int64)
    flat = np.concatenate([hashed[k] for k in full]) if full else np.zeros(0, np.uint64)
    pairs = {(full[d], row) for d, row in candidates(flat, lengths, known["classes"])}
    for size in {known["items"][rows[0]][1] for rows in known["short"].values()}:
        wanted = {s: rows for s, rows in known["short"].items() if s.count(b" ") == size - 1}
        for k, w in enumerate(words):
            for s in shingles(w, size) & wanted.keys():
                pairs.update((k, row) for row in wanted[s])
    out, sets = [], {}
    for k, row in sorted(pairs):
        _, size, own = known["items"][row]
        if (k, size) not in sets:
            sets = {(k, size): shingles(words[k], size)}
        shared = len(own & sets[(k, size)])
        if shared >= least * len(own):
            out.append((k, row, len(own), shared))
    return out


def portions(benchmark: DataFrame, id_col: str, text_col: str, limit: int = PORTION) -> list[dict]:
    """The items in portions of at most `limit` words or so, each fetched by itself and prepared for the tasks."""
    items = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / 5 / limit))
    made = []
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == part).collect()
        made.append(prepared([(k, r["item_id"], r["text"]) for k, r in enumerate(rows)]))
    return made


def contained_items(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least: float = 0.8,
) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared): every benchmark item that a document contains."""
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in docs.select("doc_id").schema.fields}
    item_kind = benchmark.schema[item_col].dataType.simpleString()
    schema = f"doc_id {kinds['doc_id']}, item_id {item_kind}, n_shingles long, n_shared long"
    result = None
    for known in portions(benchmark, item_col, item_text_col):
        shared = df.sparkSession.sparkContext.broadcast(known)

        def run(batches, shared=shared):
            table = WordHashes()
            for batch in batches:
                for part in slices(batch, "text"):
                    found = search(texts_of(part, "text"), shared.value, least, table)
                    if found:
                        at, rows, sizes, common = zip(*found)
                        items = pa.array([shared.value["items"][r][0] for r in rows])
                        yield pa.RecordBatch.from_arrays(
                            [part.column("doc_id").take(pa.array(at)), items, pa.array(sizes), pa.array(common)],
                            names=["doc_id", "item_id", "n_shingles", "n_shared"],
                        )

        part = docs.mapInArrow(run, schema)
        result = part if result is None else result.unionByName(part)
    return result


def clean(
    df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_text_col: str = "text", least: float = 0.8
) -> DataFrame:
    """Rows of df that contain no benchmark item, in one narrow pass for each portion."""
    for known in portions(benchmark.withColumn("_item", F.lit(0)), "_item", item_text_col):
        shared = df.sparkSession.sparkContext.broadcast(known)

        def run(batches, shared=shared):
            table = WordHashes()
            for batch in batches:
                for part in slices(batch, text_col):
                    hit = {f[0] for f in search(texts_of(part, text_col), shared.value, least, table)}
                    yield part.filter(pa.array([k not in hit for k in range(part.num_rows)]))

        df = df.mapInArrow(run, df.schema)
    return df
