"""Near copies by wide SimHash candidates and exact shingle similarity.

Two texts are near copies if their sets of five-word shingles (of the whole word
sequence, if it is shorter) have a Jaccard similarity of 0.8 or more. Groups are
what such links join.

Nodes are distinct word sequences. Candidates are pairs of nodes whose SimHash
fingerprints over five-word shingles differ in at most `RADIUS` bits and agree in
two of eight bands of eight bits; they are compared bit-sliced, block by block. At
a similarity of 0.94 this finds a pair with a chance of 0.96, at 0.9 of 0.88 (computed
for independent bits); unrelated pairs come that near about once in 20 million.

Sketches. A node carries the parities of its shingle hashes dealt to a number of
places, some two to four per shingle; those of up to `PLACES` go into the blocks. Differing parities of two nodes are never more
than their differing shingles, so pairs above what 0.8 allows go without loss, and
whole shingle sets are read for the few others only.

Rounds. A first pass names each node's smallest smaller neighbour and marks the nodes
that have others; big blocks are compared within their parts only. What the exact
check confirms is joined to components. In the rounds after it, marked nodes name
neighbours of other components that their sketches allow, `width` in a block, and go on behind
those in the next round, with a greater width, until no node has any left. So a group
of copies never becomes all its pairs, yet every pair of candidates has been compared
or lies in one component at the end. The largest component of a big block is compared
with the block's other members, not with itself.

Rows are told apart by id and a hash of their text, so that no text is written to
the working tables. Null texts count as empty; texts without words are one node.
Of rows that agree in id and text one at most stays. An empty table gives no rows.
Columns of the table are kept as they are; working columns take names that it does
not use. The table is read three times and must give the same rows each time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.common import add_columns, unused_names, written
from aerolith.llm.simhash import BLOCK, LANES, block_numbers, components, near, signed, sliced
from aerolith.operators.joins import broadcast_if_small

WORDS = 5
LEAST = 0.8
RADIUS = 11
BANDS = 8
WIDTH = 4
WIDER = 64
PLACES = 1024
SEED = 42


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """Hashes of a text's shingles in their order, repeats included."""
    import xxhash

    parts = text.encode("utf-8").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    runs = max(1, len(parts) - words + 1)
    return np.array([xxhash.xxh64_intdigest(b" ".join(parts[k : k + words]), SEED) for k in range(runs)], np.uint64)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    return np.unique(shingle_hashes(text, words))


def majority(hashes: np.ndarray) -> int:
    """The SimHash of shingle hashes: a bit is 1 if it is set in over half of them."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        rows = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def sketch(distinct: np.ndarray) -> np.ndarray:
    """Parity of the number of hashes at each place; a power of two of places, twice as many as hashes at least."""
    places = max(64, 1 << (2 * len(distinct) - 1).bit_length()) if len(distinct) else 64
    counts = np.bincount((distinct & np.uint64(places - 1)).astype(np.int64), minlength=places)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little")


def least_difference(a: np.ndarray, b: np.ndarray) -> int:
    """A lower bound of the number of hashes that only one of two sets holds, from their sketches."""
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def allowed(n_a: int, n_b: int, difference: int, least: float) -> bool:
    """Whether sets of these sizes with at least that difference can have a Jaccard similarity of `least`."""
    return max(difference, abs(n_a - n_b)) * (1 + least) <= (n_a + n_b) * (1 - least) + 1e-6


def sequence_hash(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(b" ".join(text.encode("utf-8").lower().split()), SEED)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets; 1 for two empty ones."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    whole = len(a) + len(b) - common
    return common / whole if whole else 1.0


def hits(ident, side, fps, asks, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(a, b) in portions: rows b of its block within radius of asking row a, all rows of one a in one portion.

    Rows are sorted by block. In a block with both sides only pairs across are compared.
    """
    starts = np.flatnonzero(np.diff(ident, prepend=ident[:1] - 1))
    sizes = np.diff(np.append(starts, len(fps)))
    has_two = (np.add.reduceat(side, starts) > 0) & (np.add.reduceat(1 - side, starts) > 0)
    offset = np.arange(len(fps)) - np.repeat(starts, sizes)
    words_each = -(-sizes // 64)
    first_word = np.cumsum(words_each) - words_each
    planes, valid = sliced(fps, np.repeat(first_word, sizes) + offset // 64, offset % 64, int(words_each.sum()))
    group_of = np.repeat(np.arange(len(sizes)), sizes)
    asking = np.flatnonzero((sizes[group_of] > 1) & asks)
    at = 0
    lanes_to = np.cumsum(words_each[group_of[asking]])
    while at < len(asking):
        done = lanes_to[at - 1] if at else 0
        cut = max(at + 1, int(np.searchsorted(lanes_to, done + LANES, side="right")))
        part, at = asking[at:cut], cut
        n = words_each[group_of[part]]
        who = np.repeat(part, n)
        word = np.repeat(first_word[group_of[part]], n) + np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
        lanes, found = near(planes, valid, word, fps[who], radius)
        bits = np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, bit = np.nonzero(bits)
        a = who[lanes[row]]
        g = group_of[a]
        b = starts[g] + (word[lanes[row]] - first_word[g]) * 64 + bit
        good = ~(has_two[g] & (side[a] == side[b]))
        yield a[good], b[good]


def ordered(a: np.ndarray, b: np.ndarray, names: np.ndarray) -> tuple:
    """a and b by a, then the name of b; the rank of each row among those of its a, and their number."""
    order = np.lexsort((names[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.diff(a, prepend=-1))
    count = np.diff(np.append(first, len(a)))
    return a, b, np.arange(len(a)) - np.repeat(first, count), np.repeat(count, count)


def nearest(ident, cut, fps, names, radius: int) -> pa.RecordBatch:
    """(h, v, more): members with a neighbour in their block, the smallest smaller one, and whether there may be others.

    Of a block that is a part of a cut one all members are named, as their neighbours may be elsewhere.
    """
    involved, more = cut > 0, cut > 0
    least, has = names.copy(), np.zeros(len(names), bool)
    for a, b in hits(ident, np.zeros_like(cut), fps, np.ones(len(names), bool), radius):
        good = names[b] < names[a]
        a, b, rank, count = ordered(a[good], b[good], names)
        involved[a] = involved[b] = True
        more[a] |= count > 1
        least[a[rank == 0]] = names[b[rank == 0]]
        has[a] = True
    made = [pa.array(names[involved]), pa.array(least[involved], mask=~has[involved]), pa.array(more[involved])]
    return pa.RecordBatch.from_arrays(made, names=["h", "v", "more"])


def folded(nodes: DataFrame) -> DataFrame:
    """nodes with sketches of at most `PLACES` places, which bound differences too."""

    def fold(sketch_: bytes) -> bytes:
        made = np.frombuffer(sketch_, np.uint8)
        while len(made) > PLACES // 8:
            made = made[: len(made) // 2] ^ made[len(made) // 2 :]
        return made.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("sketch")
            yield batch.set_column(at, "sketch", pa.array(map(fold, batch.column("sketch").to_pylist()), pa.binary()))

    return nodes.mapInArrow(run, nodes.schema)


def fitting(a: np.ndarray, b: np.ndarray, n: np.ndarray, sketches: np.ndarray, least: float) -> np.ndarray:
    """Whether sizes and folded sketches of rows a and b allow a similarity of `least`, as `allowed` tells for one pair."""
    used, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a_at, b_at = at[: len(a)], at[len(a) :]
    size = np.array([len(s) for s in sketches[used]], np.int64)
    bits = np.zeros((len(used), PLACES // 8), np.uint8)
    for row, held in zip(bits, sketches[used]):
        row[: len(held)] = np.frombuffer(held, np.uint8)
    common = np.minimum(size[a_at], size[b_at])
    differ = np.abs(n[a] - n[b])
    width = PLACES // 8
    while width >= 8:
        some = np.flatnonzero(common == width)
        for part in np.array_split(some, len(some) // LANES + 1):
            count = np.bitwise_count(bits[a_at[part], :width] ^ bits[b_at[part], :width]).sum(axis=1, dtype=np.int64)
            differ[part] = np.maximum(differ[part], count)
        wide = size >= width
        bits[wide, : width // 2] ^= bits[wide, width // 2 : width]
        width //= 2
    return differ * (1 + least) <= (n[a] + n[b]) * (1 - least) + 1e-6


def neighbours(ident, side, fps, names, labels, start, n, sketches, radius: int, least: float, width: int) -> pa.RecordBatch:
    """(u, v, last): each member's `width` smallest neighbours v in its block, from `start` up to its own name.

    They have other labels, and their sketches allow a similarity of `least`. If there are others, `last` is the last one named.
    """
    made = [(names[:0], names[:0], names[:0], np.zeros(0, bool))]
    for a, b in hits(ident, side, fps, start < names, radius):
        good = (names[b] < names[a]) & (names[b] >= start[a]) & (labels[a] != labels[b])
        a, b = a[good], b[good]
        good = fitting(a, b, n, sketches, least) if len(a) else good[:0]
        a, b, rank, count = ordered(a[good], b[good], names)
        ends = np.flatnonzero(rank == np.minimum(count, width) - 1)
        named = rank < width
        last = np.repeat(names[b[ends]], np.minimum(count, width)[ends])
        made.append((names[a[named]], names[b[named]], last, (count <= width)[named]))
    u, v, last, all_named = (np.concatenate(x) for x in zip(*made))
    columns = [pa.array(u), pa.array(v), pa.array(last, mask=all_named)]
    return pa.RecordBatch.from_arrays(columns, names=["u", "v", "last"])


def keyed(nodes: DataFrame) -> DataFrame:
    """nodes with a row for each of the blocks that their fingerprints lie in."""
    size = 64 // BANDS
    band = lambda i: F.shiftrightunsigned("fp", i * size).bitwiseAND(F.lit((1 << size) - 1))
    keys = [
        (F.lit(k << 2 * size) + F.shiftleft(band(i), size) + band(j)).cast("long")
        for k, (i, j) in enumerate(combinations(range(BANDS), 2))
    ]
    return nodes.select("*", F.explode(F.array(*keys)).alias("key"))


def by_block(spread: DataFrame, fields: list[str], make: Callable[..., pa.RecordBatch], schema: str) -> DataFrame:
    """make(ident, *fields) over rows (key, i, j, *fields), whole blocks at a time."""
    names = ["key", "i", "j", *fields]
    dealt = spread.select(names).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in names])
            if sum(len(h[0]) for h in held) < 1 << 16:
                continue
            columns = [np.concatenate(c) for c in zip(*held)]
            ident = block_numbers(*columns[:3])
            end = int(np.searchsorted(ident, ident[-1]))  # the last block may go on
            if end:
                yield make(ident[:end], *[c[:end] for c in columns[3:]])
            held = [[c[end:] for c in columns]]
        if held and sum(len(h[0]) for h in held):
            columns = [np.concatenate(c) for c in zip(*held)]
            yield make(block_numbers(*columns[:3]), *columns[3:])

    return dealt.mapInArrow(run, schema)


def nearest_pairs(nodes: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """(h, v, more) of the nodes (h, fp) that may have neighbours: the smallest smaller one, and whether there may be others."""
    placed = keyed(nodes.select("h", "fp"))
    sizes = placed.groupBy("key").count().where(F.col("count") > block)
    cuts = written(sizes.select("key", F.ceil(F.col("count") / block).cast("int").alias("cuts")), "cuts")
    whole = F.coalesce("cuts", F.lit(1))
    own = F.pmod(F.xxhash64("h", "key"), whole).cast("int").alias("i")
    parts = placed.join(cuts, "key", "left").select(
        "key", own, F.lit(0).alias("j"), (whole > 1).cast("int").alias("cut"), "fp", "h"
    )

    def make(ident, cut, fps, names) -> pa.RecordBatch:
        return nearest(ident, cut, fps.view(np.uint64), names, radius)

    found = by_block(parts, ["cut", "fp", "h"], make, "h long, v long, more boolean")
    ends = found.groupBy("h").agg(F.min("v").alias("v"), F.max("v").alias("other"), F.max("more").alias("more"))
    return ends.select("h", "v", (F.col("more") | F.coalesce(F.col("v") != F.col("other"), F.lit(False))).alias("more"))


def named_pairs(nodes: DataFrame, radius: int, width: int, block: int = BLOCK, least: float = LEAST) -> DataFrame:
    """(u, v, last) with start <= v < u: candidate pairs of nodes (h, fp, label, start, n, sketch) of different labels.

    They are all that u has up to `last`, or all that it has if that is null.
    """
    placed = keyed(folded(nodes.select("h", "fp", "label", "start", "n", "sketch")))
    big = written(placed.groupBy("key").count().where(F.col("count") > block).select("key"), "big")
    counts = placed.join(big, "key").groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    most = counts.groupBy("key").agg(F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("n"))
    parts_of = lambda n: F.ceil(n / block).cast("int")
    cuts = most.select(
        "key", F.col("most.label").alias("major"), parts_of(F.col("most.n")).alias("majors"),
        parts_of(F.col("n") - F.col("most.n")).alias("minors"),
    )
    in_major = F.col("label") == F.col("major")
    hashed = lambda n: F.pmod(F.xxhash64("h", "key"), n).cast("int")
    own = F.when(in_major, F.col("minors") + hashed(F.col("majors"))).when(F.col("minors") > 0, hashed(F.col("minors")))
    others = F.when(F.col("minors") > 0, F.sequence(F.lit(0), F.col("minors") - 1)).otherwise(F.array().cast("array<int>"))
    all_ = F.sequence(F.lit(0), F.col("minors") + F.col("majors") - 1)
    met = F.when(F.col("major").isNull(), F.array(F.lit(0))).when(in_major, others).otherwise(all_)
    parts = placed.join(written(cuts, "cuts"), "key", "left").withColumn("own", F.coalesce(own, F.lit(0)))
    blocks = parts.select("*", F.explode(met).alias("other")).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "fp", "h", "label", "start", "n", "sketch",
    )

    def make(ident, side, fps, *of_rows) -> pa.RecordBatch:
        return neighbours(ident, side.astype(np.int64), fps.view(np.uint64), *of_rows, radius, least, width)

    found = by_block(blocks, ["side", "fp", "h", "label", "start", "n", "sketch"], make, "u long, v long, last long")
    pairs = found.groupBy("u", "v").agg(F.min("last").alias("last"))
    pairs = pairs.withColumn("last", F.min("last").over(Window.partitionBy("u")))
    return pairs.where(F.col("last").isNull() | (F.col("v") <= F.col("last")))


def shingle_sets(rows: DataFrame) -> DataFrame:
    """(h, shingles): the sorted shingle hashes of rows (h, text), in binary."""

    def make():
        return lambda texts: [[shingles(t).tobytes() for t in texts]]

    return add_columns(rows, "text", [("shingles", "binary")], make).select("h", "shingles")


def sifted(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Those of pairs (u, v) whose sketches allow a similarity of `least`."""
    left = nodes.select(F.col("h").alias("u"), F.col("n").alias("n_a"), F.col("sketch").alias("a"))
    right = nodes.select(F.col("h").alias("v"), F.col("n").alias("n_b"), F.col("sketch").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(*[batch.column(c) for c in ("n_a", "n_b", "a", "b")])
            fits = [
                allowed(m.as_py(), n.as_py(), least_difference(np.frombuffer(a.as_buffer(), np.uint8), np.frombuffer(b.as_buffer(), np.uint8)), least)
                for m, n, a, b in sides
            ]
            yield batch.select(["u", "v"]).filter(pa.array(fits, pa.bool_()))

    joined = pairs.select("u", "v").join(left, "u").join(right, "v").select("u", "v", "n_a", "n_b", "a", "b")
    return joined.mapInArrow(run, "u long, v long")


def verified(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, least: float) -> DataFrame:
    """Those of pairs (u, v) whose shingle sets have a similarity of `least` or more; texts are in rows (id, th, text)."""
    wanted = nodes.join(pairs.select(F.explode(F.array("u", "v")).alias("h")).distinct(), "h", "left_semi")
    wanted = written(wanted.select("h", F.col("id").alias("_id"), F.col("th").alias("_th")), "wanted")
    of_node = (F.col("th") == F.col("_th")) & F.col("id").eqNullSafe(F.col("_id"))
    sets = written(shingle_sets(rows.join(broadcast_if_small(wanted), of_node).select("h", "text")), "sets")
    if sets.count() > wanted.count():  # rows that agree in id and text
        sets = written(sets.dropDuplicates(["h"]), "sets")
    left = sets.select(F.col("h").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("h").alias("v"), F.col("shingles").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = [
                similarity(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)) >= least
                for a, b in zip(batch.column("a"), batch.column("b"))
            ]
            yield batch.select(["u", "v"]).filter(pa.array(same, pa.bool_()))

    joined = pairs.select("u", "v").join(left, "u").join(right, "v").select("u", "v", "a", "b")
    return written(joined.mapInArrow(run, "u long, v long"), "verified")


def linked(nodes: DataFrame, rows: DataFrame, radius: int = RADIUS, least: float = LEAST, width: int = WIDTH) -> DataFrame:
    """(u, v) with v < u: verified links of nodes (h, fp, n, sketch, id, th) that join all that links of candidates join."""
    named = written(nearest_pairs(nodes, radius), "named")
    near_by = written(nodes.join(named, "h", "left_semi"), "candidates")  # a small part, its size is known from here on
    pairs = named.where("v is not null").select(F.col("h").alias("u"), "v")
    waiting = named.where("more").select("h", F.lit(-1 << 63).alias("start"))
    links = None
    while True:
        likely = written(sifted(pairs, near_by, least), "likely")
        same = verified(likely, near_by, rows, least) if links is None or likely.limit(1).count() else likely
        links = same if links is None else links.unionByName(same)
        if waiting.limit(1).count() == 0:
            return links
        labels = components(links).select(F.col("node").alias("h"), F.col("root").alias("label"))
        asked = near_by.select("h", "fp", "n", "sketch").join(labels, "h", "left").join(waiting, "h", "left")
        asked = asked.select("h", "fp", "n", "sketch", *[F.coalesce(c, "h").alias(c) for c in ("label", "start")])
        pairs = written(named_pairs(written(asked, "asked"), radius, width, least=least), "pairs")
        waiting = pairs.where("last is not null").groupBy(F.col("u").alias("h")).agg((F.max("last") + 1).alias("start"))
        width *= WIDER


def features(texts: list[str]) -> list:
    """Word sequence hash, fingerprint, number of distinct shingles and sketch of each text."""
    h, fp, n, sketches = [], [], [], []
    for text in texts:
        hashes = shingle_hashes(text)
        distinct = np.unique(hashes)
        h.append(sequence_hash(text))
        fp.append(majority(hashes))
        n.append(len(distinct))
        sketches.append(sketch(distinct).tobytes())
    return [signed(h), signed(fp), n, sketches]


def keep_one(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, least: float = LEAST
) -> DataFrame:
    """df with one row of each group of near copies: that with the smallest id (null ids come last)."""
    hashed = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    own = df.select(F.col(id_col).alias("id"), hashed.alias("th"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    fields = [("h", "long"), ("fp", "long"), ("n", "long"), ("sketch", "binary")]
    marked = written(add_columns(own, "text", fields, lambda: features).drop("text"), "marked")
    one = F.min(F.struct("th", F.col("id").isNull().alias("last"), "id", "fp", "n", "sketch")).alias("one")
    nodes = marked.groupBy("h").agg(one).select("h", "one.th", "one.id", "one.fp", "one.n", "one.sketch")
    nodes = written(nodes, "nodes")
    roots = components(linked(nodes, own, radius, least))
    placed = marked.join(roots, marked["h"] == roots["node"], "left").select(
        F.coalesce("root", "h").alias("root"), F.struct(F.col("id").isNull().alias("last"), "id", "th").alias("place")
    )
    counts = written(placed.groupBy("root", "place").agg(F.count(F.lit(1)).alias("n")), "placed")
    heads = counts.groupBy("root").agg(F.min(F.struct("place", "n")).alias("head"))
    row_id, row_th, th = unused_names(df, "row_id", "row_th", "th")
    key = [F.col("place.id").alias(row_id), F.col("place.th").alias(row_th)]
    gone = written(counts.join(heads, "root").where(F.col("place") != F.col("head.place")).select(*key), "gone")
    twice = heads.where("head.n > 1").select(F.col("head.place").alias("place")).select(*key)
    twice = written(twice, "twice")
    same_row = (F.col(th) == F.col(row_th)) & F.col(id_col).eqNullSafe(F.col(row_id))
    rows = df.withColumn(th, hashed)
    kept = rows.join(broadcast_if_small(gone), same_row, "left_anti")
    if twice.limit(1).count():  # heads that agree in id and text
        single = kept.join(broadcast_if_small(twice), same_row, "left_anti")
        several = rows.join(broadcast_if_small(twice), same_row, "left_semi").dropDuplicates([id_col, th])
        kept = single.unionByName(several)
    return kept.select(*df.columns)
