"""SimHash near-duplicates: fingerprints, bit-sliced comparison, components.

Fingerprints. A-Z become lower case, words are runs of anything but ASCII white
space, shingles are runs of four words with repeats. A bit is 1 if it is set in
over half of the shingles' 64-bit hashes. A text with fewer words is one
shingle; one without words has fingerprint zero, linked like any other.

Candidates. 64 bits are cut into six bands. Two fingerprints that differ in at
most four bits agree in two bands at least, so every linked pair of different
fingerprints meets in the bucket of one of the 15 pairs of bands: nothing is
missed. Equal fingerprints are one node from the start. Buckets above a size are
cut into parts by hash, and each pair of parts is a block of its own.

Comparison. A block stores its fingerprints as vertical bit planes, 64 members
to a word. A fingerprint is compared with a whole word at a time: carry-save
adders add planes of differing bits into bitwise counters, and words in which
all members exceed the radius are abandoned. A block hands on a spanning star of
each of its components, never all pairs.

Components. Large-star and small-star steps turn the stars into one star per
component, each step written to the shared folder.

Null and empty texts have fingerprint zero. Repeated rows are rows of their own
with equal fingerprints. A row with a null id gets the smallest id of its
component, null if there is none. An empty table gives no rows. Further columns
are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import add_columns, unused_names, written

SEED = 42
WORDS = 4
BANDS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
BLOCK = 2048
LANES = 1 << 15


def fingerprint(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of one text."""
    import xxhash

    parts = text.encode("utf-8").lower().split()
    if not parts:
        return 0
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(b" ".join(parts), seed)
    whole = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = [0, *ends[: len(parts) - words].tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(whole[a:b], seed) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())], dtype="<u8"
    )
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def fingerprints(df: DataFrame, text_col: str = "text", out: str = "fp") -> DataFrame:
    """df with the fingerprint of each text as a signed 64-bit number."""
    return add_columns(df, text_col, [(out, "long")], lambda: lambda texts: [signed([fingerprint(t) for t in texts])])


def exceeds(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Bit set where the number held in bitwise counters is above radius."""
    above = np.zeros_like(counters[0])
    equal = ~above
    for place in range(len(counters) - 1, -1, -1):
        if radius >> place & 1:
            equal = equal & counters[place]
        else:
            above |= equal & counters[place]
            equal = equal & ~counters[place]
    return above


def near(planes: np.ndarray, valid: np.ndarray, words: np.ndarray, queries: np.ndarray, radius: int) -> tuple:
    """Lanes that keep a hit and their hits: bit t set where member t of a word is within radius of the lane's query.

    planes: 64 rows of words; a lane compares queries[i] with word words[i].
    """
    lanes = np.arange(len(words))
    places = max(1, radius.bit_length())
    counters = [np.zeros(len(lanes), np.uint64) for _ in range(places)]
    over = ~valid[words]
    one = np.uint64(1)
    for plane in range(0, 64, 2):
        w = words[lanes]
        q = queries[lanes]
        a = planes[plane][w] ^ (np.uint64(0) - (q >> np.uint64(plane) & one))
        b = planes[plane + 1][w] ^ (np.uint64(0) - (q >> np.uint64(plane + 1) & one))
        # carry-save: the lowest counter and two planes make a sum and a carry
        mixed = counters[0] ^ a
        carry = (counters[0] & a) | (mixed & b)
        counters[0] = mixed ^ b
        for place in range(1, places):
            counters[place], carry = counters[place] ^ carry, counters[place] & carry
        over |= carry
        if plane % 8 == 6:
            over |= exceeds(counters, radius)
            alive = over != ~np.uint64(0)
            if not alive.any():
                return lanes[:0], over[:0]
            if alive.sum() < 0.7 * len(lanes):
                lanes, over = lanes[alive], over[alive]
                counters = [c[alive] for c in counters]
    over |= exceeds(counters, radius)
    alive = over != ~np.uint64(0)
    return lanes[alive], ~over[alive]


def sliced(fps: np.ndarray, word_of: np.ndarray, bit_of: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit planes of fingerprints placed at (word, bit), and the mask of places in use."""
    planes = np.zeros((64, n_words), np.uint64)
    valid = np.zeros(n_words, np.uint64)
    at = np.left_shift(np.uint64(1), bit_of.astype(np.uint64))
    np.bitwise_or.at(valid, word_of, at)
    for plane in range(64):
        on = (fps >> np.uint64(plane) & np.uint64(1)).astype(bool)
        np.bitwise_or.at(planes[plane], word_of[on], at[on])
    return planes, valid


def stars(block_of: np.ndarray, side: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, root): a spanning star for each component of each block.

    Rows are sorted by block. In a block with both sides only pairs across are
    compared; otherwise all pairs.
    """
    starts = np.flatnonzero(np.diff(block_of, prepend=block_of[:1] - 1))
    sizes = np.diff(np.append(starts, len(fps)))
    has_two = np.add.reduceat(side, starts) > 0
    offset = np.arange(len(fps)) - np.repeat(starts, sizes)
    words_each = -(-sizes // 64)
    first_word = np.cumsum(words_each) - words_each
    word_of = np.repeat(first_word, sizes) + offset // 64
    planes, valid = sliced(fps, word_of, offset % 64, int(words_each.sum()))
    lone = np.repeat(sizes, sizes) < 2
    members = np.flatnonzero(~lone & ~(np.repeat(has_two, sizes) & (side == 0)))
    lanes_each = np.repeat(words_each, sizes)[members]
    left, right = [], []
    group_of = np.repeat(np.arange(len(sizes)), sizes)
    cuts = np.searchsorted(np.cumsum(lanes_each), np.arange(LANES, lanes_each.sum() + LANES, LANES))
    at = 0
    for cut in [*cuts.tolist()[:-1], len(members)]:
        part = members[at : max(cut, at + 1)]
        at = max(cut, at + 1)
        if not len(part):
            continue
        n = words_each[group_of[part]]
        who = np.repeat(part, n)
        word = np.repeat(first_word[group_of[part]], n) + np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
        lanes, hits = near(planes, valid, word, fps[who], radius)
        for lane_at in range(0, len(lanes), 4096):
            some, bits = lanes[lane_at : lane_at + 4096], hits[lane_at : lane_at + 4096]
            found = np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, bit = np.nonzero(found)
            w = word[some[row]]
            a = who[some[row]]
            g = group_of[a]
            b = starts[g] + (w - first_word[g]) * 64 + bit
            good = (a != b) & ~(has_two[g] & (side[a] == side[b]))
            left.append(np.minimum(a, b)[good])
            right.append(np.maximum(a, b)[good])
            if sum(map(len, left)) > 1 << 21:
                a, b = forest(np.concatenate(left), np.concatenate(right), len(fps))
                left, right = [a], [b]
    if not left:
        return fps[:0], fps[:0]
    root, member = forest(np.concatenate(left), np.concatenate(right), len(fps))
    return fps[member], fps[root]


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(root, member) of the components that links a-b form among n rows; the root is the smallest row."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    member = np.flatnonzero(label != np.arange(n))
    return label[member], member


def links(nodes: DataFrame, radius: int = 4, block: int = BLOCK) -> DataFrame:
    """(u, v) with v < u: enough links between the distinct fingerprints `fp` to join what lies within radius."""
    if radius > 4:
        raise ValueError("six bands find pairs that differ in at most four bits")
    fp = F.col("fp")
    band = lambda i: F.shiftrightunsigned(fp, BANDS[i][0]).bitwiseAND(F.lit((1 << BANDS[i][1]) - 1))
    keys = [
        (F.lit(k) * F.lit(1 << 22) + F.shiftleft(band(i), BANDS[j][1]) + band(j)).cast("long")
        for k, (i, j) in enumerate(combinations(range(len(BANDS)), 2))
    ]
    keyed = nodes.select("fp", F.explode(F.array(*keys)).alias("key"))
    large = keyed.groupBy("key").count().where(F.col("count") > block)
    cuts = large.select("key", F.ceil(F.col("count") / block).cast("int").alias("cuts"))
    parts = keyed.join(cuts, "key", "left").select(
        "key",
        "fp",
        F.coalesce("cuts", F.lit(1)).alias("cuts"),
        F.pmod(F.xxhash64("fp", "key"), F.coalesce("cuts", F.lit(1))).cast("int").alias("own"),
    )
    other = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("other")
    blocks = parts.select("key", "fp", "own", other).select(
        "key",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "fp",
    )
    spread = blocks.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches):
        held, last = [], None
        for batch in batches:
            held.append([batch.column(c).to_numpy() for c in ("key", "i", "j", "side", "fp")])
            if sum(len(h[0]) for h in held) < 1 << 16:
                continue
            columns = [np.concatenate(c) for c in zip(*held)]
            ident = block_numbers(*columns[:3])
            end = int(np.searchsorted(ident, ident[-1]))  # the last block may go on
            if end:
                yield found(ident[:end], *[c[:end] for c in columns[3:]])
            held = [[c[end:] for c in columns]]
        if held:
            columns = [np.concatenate(c) for c in zip(*held)]
            if len(columns[0]):
                yield found(block_numbers(*columns[:3]), *columns[3:])

    def found(ident, side, fps):
        member, root = stars(ident, side.astype(np.int64), fps.view(np.uint64), radius)
        a, b = member.view(np.int64), root.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["u", "v"])

    return spread.mapInArrow(run, "u long, v long").distinct()


def block_numbers(key: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """A running number of the blocks of rows sorted by (key, i, j)."""
    new = (np.diff(key, prepend=key[:1]) != 0) | (np.diff(i, prepend=i[:1]) != 0) | (np.diff(j, prepend=j[:1]) != 0)
    return np.cumsum(new)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of edges (u, v) with v < u but the roots."""
    state = written(edges, "links")
    mark = None
    while True:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        state = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = state.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if mark == tuple(now) or now["n"] == 0:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(now)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4) -> DataFrame:
    """(doc_id, fp, root, component_id): fingerprint and component of every row."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marked = written(fingerprints(rows, "text").select("doc_id", "fp"), "fingerprints")
    nodes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes.select("fp"), radius))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    placed = written(placed, "components")
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.select("fp", "root").join(smallest, "root")
    return marked.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def digest(found: DataFrame) -> DataFrame:
    """The report columns: doc_id, fingerprint as 16 hex digits, component_id."""
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4) -> DataFrame:
    """One row of each component: that with the smallest id (null ids come last, repeated ids keep one row)."""
    own_id, own_fp, own_root, n, fp = unused_names(df, "id", "fp", "root", "n", "fp_of_row")
    found = near_duplicates(df, id_col, text_col, radius)
    head = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    heads = found.where(head).groupBy(F.col("root").alias(own_root), F.col("doc_id").alias(own_id))
    # usually one row each; a repeated id leaves several, of which one is kept below
    heads = written(heads.agg(F.min("fp").alias(own_fp), F.count(F.lit(1)).alias(n)), "heads")
    rows = fingerprints(df, text_col, fp).join(
        heads, (F.col(id_col).eqNullSafe(F.col(own_id))) & (F.col(fp) == F.col(own_fp)), "inner"
    )
    single = rows.where(F.col(n) == 1).select(*df.columns)
    several = rows.where(F.col(n) > 1).dropDuplicates([own_root]).select(*df.columns)
    return single.unionByName(several)
