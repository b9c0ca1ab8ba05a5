"""Language-model scores: a unigram base and prediction by partial matching over bytes.

Training counts cover every training text: words, and byte n-grams of the full
order, which hold the counts of all shorter ones. Both are counted in tasks,
added up by shuffle and written to the shared folder.

The byte model is a trie of contexts. A context of length k predicts a byte it
has seen by its count, or escapes to the context of length k - 1, with the
number of distinct bytes seen as escape weight; bytes that a longer context
could have predicted are excluded in shorter ones. Below the empty context all
256 values are equally likely. Texts are lower-cased in ASCII and end with a
symbol of their own, which is scored as well.

The trie holds every n-gram of the training texts and is never gathered. What a
gram needs of it are the contexts that end in the same two bytes, and the orders
0 and 1, which have at most 2^16 nodes and are sent to the tasks. So grams are
scored in tasks, dealt by those two bytes. The scores of grams that make up at
least SHARE of all positions, at most 1 / SHARE of them, are sent to the tasks as
a cache; the other grams of a document, each distinct one scored once, are looked
up by a join. Likewise words: those that make up at least WORD_SHARE of the tokens
are sent, all others are joined. No score depends on either share.

`adaptive_cost` codes a text with a trie that starts empty and learns as it goes.

Null counts as empty: one token, the end. Null ids are scored and not learned
from. Repeated rows are counted and scored each for itself. Without training
texts N and V are 0. An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import slices, texts_of, written

ORDER = 4
BEGIN, END = 0xFE, 0xFF  # bytes that no UTF-8 text has
SHARE = 1 / (1 << 20)
SHORT = 2  # orders 0 and 1 are sent to the tasks
WORD_SHARE = 1 / (1 << 18)
HELD = 250_000
STEP = 2 << 20
CACHE = 1 << 20


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").lower().split()


def grams(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all runs of order + 1 bytes that end in a text or its end symbol, and how many each text has."""
    pad, end = bytes([BEGIN]) * order, bytes([END])
    raw = [t.encode("utf-8").lower() for t in texts]
    flat = np.frombuffer(b"".join([pad + b + end for b in raw]), np.uint8).astype(np.int64)
    lengths = np.array([len(b) + 1 for b in raw], np.int64)
    code = flat.copy()
    for k in range(1, order + 1):
        code[k:] |= flat[:-k] << (8 * k)
    starts = np.cumsum(lengths + order) - lengths
    keep = np.ones(len(flat), bool)
    for k in range(order):
        keep[starts - 1 - k] = False
    return code[keep], lengths


def counts(df: DataFrame, text_col: str = "text", order: int = ORDER) -> DataFrame:
    """(word, gram, n): counts of the words (gram null) and of the byte n-grams (word null) of all texts."""

    def run(batches):
        words: Counter = Counter()
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged(parts):
            codes, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            order_ = np.argsort(codes, kind="stable")
            codes, n = codes[order_], n[order_]
            starts = np.flatnonzero(np.diff(codes, prepend=-1))
            return codes[starts], np.add.reduceat(n, starts)

        def rows(word, gram, n):
            size = len(n)
            word = pa.array(word, pa.binary()) if word is not None else pa.nulls(size, pa.binary())
            gram = pa.array(gram, pa.int64()) if gram is not None else pa.nulls(size, pa.int64())
            return pa.RecordBatch.from_arrays([word, gram, pa.array(n, pa.int64())], names=["word", "gram", "n"])

        def out_words():
            listed = list(words.items())
            words.clear()
            for at in range(0, len(listed), 50_000):
                some = listed[at : at + 50_000]
                yield rows([w for w, _ in some], None, [n for _, n in some])

        def out_grams():
            codes, n = merged(held)
            held.clear()
            for at in range(0, len(codes), 100_000):
                yield rows(None, codes[at : at + 100_000], n[at : at + 100_000])

        for batch in batches:
            for part in slices(batch, text_col, STEP):
                texts = texts_of(part, text_col)
                for t in texts:
                    words.update(words_of(t))
                    if len(words) > HELD:
                        yield from out_words()
                codes, _ = grams(texts, order)
                if len(codes):
                    held.append(np.unique(codes, return_counts=True))
                if sum(len(h[0]) for h in held) > 4 * HELD:
                    held = [merged(held)]
                    if len(held[0][0]) > 2 * HELD:
                        yield from out_grams()
        yield from out_words()
        if held:
            yield from out_grams()

    made = df.select(text_col).mapInArrow(run, "word binary, gram long, n long")
    return made.groupBy("word", "gram").agg(F.sum("n").alias("n"))


def trie(levels: list[tuple[np.ndarray, np.ndarray]]) -> list[dict]:
    """Tables of each order from its kept grams (sorted codes, counts), shortest first."""
    tables = []
    for k, (codes, n) in enumerate(levels):
        context = codes >> 8
        starts = np.flatnonzero(np.diff(context, prepend=-1))
        kept = np.add.reduceat(n, starts) if len(starts) else n
        children = np.diff(np.append(starts, len(codes)))
        ctx = context[starts]
        dropped = np.zeros(len(ctx), np.int64)
        excluded = np.zeros(len(ctx), np.int64)
        if k and len(ctx):
            lower, lower_n = levels[k - 1]
            at = np.minimum(np.searchsorted(lower, ctx), len(lower) - 1)
            dropped = np.where(lower[at] == ctx, np.maximum(0, lower_n[at] - kept), 0)
            suffix = codes & ((1 << 8 * k) - 1)
            excluded = np.add.reduceat(lower_n[np.searchsorted(lower, suffix)], starts)
        tables.append(
            {"codes": codes, "n": n, "ctx": ctx, "kept": kept, "children": children, "dropped": dropped, "excluded": excluded}
        )
    return tables


def log10_probability(tables: list[dict], codes: np.ndarray) -> np.ndarray:
    """log10 of the probability of the last byte of each gram after the bytes before it."""
    out = np.zeros(len(codes))
    excluded_n, excluded_d = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
    open_ = np.arange(len(codes))
    for k in range(len(tables) - 1, -1, -1):
        t = tables[k]
        if not len(t["ctx"]) or not len(open_):
            continue
        gram = codes[open_] & ((1 << 8 * (k + 1)) - 1)
        at = np.minimum(np.searchsorted(t["ctx"], gram >> 8), len(t["ctx"]) - 1)
        there = t["ctx"][at] == gram >> 8
        here, at, gram = open_[there], at[there], gram[there]
        fresh = t["children"][at] - excluded_d[here]
        total = t["kept"][at] - excluded_n[here] + fresh + t["dropped"][at]
        place = np.minimum(np.searchsorted(t["codes"], gram), len(t["codes"]) - 1)
        seen = t["codes"][place] == gram
        out[here[seen]] += np.log10(t["n"][place[seen]] / total[seen])
        missed = here[~seen]
        escape, whole = (fresh + t["dropped"][at])[~seen], total[~seen]
        out[missed] += np.log10(np.where(whole > 0, escape / np.maximum(whole, 1), 1.0))
        excluded_n[missed], excluded_d[missed] = t["excluded"][at[~seen]], t["children"][at[~seen]]
        left = np.ones(len(codes), bool)
        left[here[seen]] = False
        open_ = open_[left[open_]]
    out[open_] -= np.log10(np.maximum(1, 256 - excluded_d[open_]))
    return out


class GramScores:
    """Scores of the cached grams, nan for others, with a direct-mapped table of the grams met last."""

    def __init__(self, codes: np.ndarray, scores: np.ndarray):
        self.codes, self.scores = codes, scores
        self.keys = np.full(CACHE, -1, np.int64)
        self.values = np.zeros(CACHE)

    def cached(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.full(len(codes), np.nan)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.scores[at], np.nan)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        slot = (codes * np.int64(0x9E3779B97F4A7C15 - (1 << 64))).view(np.uint64) >> np.uint64(44)
        out = self.values[slot]
        missed = np.flatnonzero(self.keys[slot] != codes)
        if len(missed):
            fresh, back = np.unique(codes[missed], return_inverse=True)
            out[missed] = self.cached(fresh)[back]
            self.keys[slot[missed]] = codes[missed]
            self.values[slot[missed]] = out[missed]
        return out


def level(codes: np.ndarray, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes and counts of order k from grams of a higher order."""
    codes = codes & ((1 << 8 * (k + 1)) - 1)
    order_ = np.argsort(codes, kind="stable")
    codes, n = codes[order_], n[order_]
    starts = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[starts], np.add.reduceat(n, starts) if len(starts) else n


def gram_scores(counted: DataFrame, asked: DataFrame, short: list, order: int) -> DataFrame:
    """(gram, score) for each row of `asked`, under the trie of all grams `counted` (gram, n).

    Grams meet by the last two bytes of their context; `short` are the levels below, of all grams.
    """
    shared = counted.sparkSession.sparkContext.broadcast(short)
    both = counted.select("gram", "n").unionByName(asked.select("gram", F.lit(0).cast("long").alias("n")))
    key = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * SHORT) - 1))
    spread = both.withColumn("key", key).repartition("key").sortWithinPartitions("key")

    def found(gram, n):
        known = n > 0
        wanted = gram[~known]
        scores = np.zeros(0)
        if len(wanted):
            levels = shared.value + [level(gram[known], n[known], k) for k in range(len(short), order + 1)]
            scores = log10_probability(trie(levels), wanted)
        return pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array(scores, pa.float64())], names=["gram", "score"])

    def run(batches):
        held = []
        for batch in batches:
            held.append([batch.column(c).to_numpy() for c in ("key", "gram", "n")])
            if sum(len(h[0]) for h in held) < 1 << 17:
                continue
            columns = [np.concatenate(c) for c in zip(*held)]
            end = int(np.searchsorted(columns[0], columns[0][-1]))  # the last contexts may go on
            if end:
                yield found(*[c[:end] for c in columns[1:]])
            held = [[c[end:] for c in columns]]
        if held:
            yield found(*[np.concatenate(c) for c in list(zip(*held))[1:]])

    return spread.mapInArrow(run, "gram long, score double")


def lacking(codes: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> pa.Array:
    """For each text a list of (gram, times) of its grams at the places `at`."""
    text_of, code = np.searchsorted(np.cumsum(lengths), at, side="right"), codes[at]
    order_ = np.lexsort((code, text_of))
    text_of, code = text_of[order_], code[order_]
    starts = np.flatnonzero((np.diff(text_of, prepend=-1) != 0) | (np.diff(code, prepend=-1) != 0))
    times = np.diff(np.append(starts, len(code)))
    offsets = np.searchsorted(text_of[starts], np.arange(len(lengths) + 1)).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(code[starts], pa.int64()), pa.array(times, pa.int64())], ["gram", "times"])
    return pa.ListArray.from_arrays(pa.array(offsets), pairs)


def fit(df: DataFrame, text_col: str = "text", order: int = ORDER, share: float = SHARE, word_share: float = WORD_SHARE):
    """Counts of all texts of df: the model, with the table of all grams as `grams`, and the table (word, n) of all words."""
    table = written(counts(df, text_col, order), "counts")
    words = table.where("word is not null").select("word", "n")
    sums = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    texts = df.count()
    total = (sums["n"] or 0) + texts
    distinct = sums["v"] + (1 if texts else 0)
    frequent = words.where(F.col("n") >= F.lit(word_share * total)).collect()
    grams_ = table.where("gram is not null").select("gram", "n")
    positions = grams_.agg(F.sum("n")).first()[0] or 0
    short = []
    for k in range(min(SHORT, order + 1)):
        low = F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))
        made = grams_.groupBy(low.alias("gram")).agg(F.sum("n").alias("n")).toArrow()
        short.append(level(*(made.column(c).to_numpy().astype(np.int64) for c in ("gram", "n")), k))
    cache = gram_scores(grams_, grams_.where(F.col("n") >= F.lit(share * positions)), short, order).toArrow()
    codes, scores = cache.column("gram").to_numpy(), cache.column("score").to_numpy()
    by_code = np.argsort(codes)
    model = {
        "order": order,
        "trie": trie(short),
        "short": short,
        "cache": (codes[by_code], scores[by_code]),
        "grams": grams_,
        "words": {bytes(r["word"]): r["n"] for r in frequent},
        "end": texts,
        "total": total,
        "distinct": distinct,
    }
    return model, words


def score(df: DataFrame, model: dict, words: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for every row."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sent = {k: model[k] for k in ("order", "words", "end", "cache")}
    shared = df.sparkSession.sparkContext.broadcast(sent)
    kind = rows.schema["doc_id"].dataType.simpleString()
    size = model["total"] + model["distinct"] + 1

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        m = shared.value
        own, end = m["words"], m["end"]
        logs = {w: math.log10((n + 1) / size) for w, n in own.items()}
        end_log = math.log10((end + 1) / size)
        of_gram = GramScores(*m["cache"])
        names = ["rid", "doc_id", "n_tokens", "n_known", "base_score", "score", "rare", "rest"]
        rare_kind = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))
        for batch in batches:
            for part in slices(batch, "text", STEP):
                texts = texts_of(part, "text")
                codes, lengths = grams(texts, m["order"])
                byte_scores = of_gram(codes)
                left = np.flatnonzero(np.isnan(byte_scores))
                byte_scores[left] = 0.0
                byte_sums = np.add.reduceat(byte_scores, np.cumsum(lengths) - lengths)
                tokens, known, base, rare = [], [], [], []
                for t in texts:
                    met = Counter(words_of(t))
                    seen = [(w, n) for w, n in met.items() if w in logs]
                    rare.append([{"word": w, "times": n} for w, n in met.items() if w not in logs])
                    tokens.append(met.total() + 1)
                    known.append(sum([n for _, n in seen]) + (end > 0))
                    base.append(math.fsum([n * logs[w] for w, n in seen]) + end_log)
                values = [
                    pa.array(range(number, number + len(texts)), pa.int64()),
                    part.column("doc_id"),
                    *[pa.array(v, pa.int64()) for v in (tokens, known)],
                    *[pa.array(v, pa.float64()) for v in (base, byte_sums)],
                    pa.array(rare, rare_kind),
                    lacking(codes, lengths, left),
                ]
                number += len(texts)
                yield pa.RecordBatch.from_arrays(values, names=names)

    scored = rows.mapInArrow(
        run,
        f"rid long, doc_id {kind}, n_tokens long, n_known long, base_score double, score double, "
        "rare array<struct<word:binary,times:long>>, rest array<struct<gram:long,times:long>>",
    )
    scored = written(scored, "scores")
    rare = scored.select("rid", F.explode("rare").alias("r")).select("rid", "r.word", "r.times")
    of_words = rare.join(words, "word", "left").select(
        "rid",
        (F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(size)))).alias("more"),
        F.when(F.col("n") > 0, F.col("times")).otherwise(0).alias("more_known"),
        F.lit(0.0).alias("more_bytes"),
    )
    rest = scored.select("rid", F.explode("rest").alias("r")).select("rid", "r.gram", "r.times")
    scores = gram_scores(model["grams"], rest.select("gram").distinct(), model["short"], model["order"])
    of_grams = rest.join(scores, "gram").select(
        "rid",
        F.lit(0.0).alias("more"),
        F.lit(0).cast("long").alias("more_known"),
        (F.col("times") * F.col("score")).alias("more_bytes"),
    )
    sums = of_words.unionByName(of_grams).groupBy("rid")
    rest = sums.agg(*[F.sum(c).alias(c) for c in ("more", "more_known", "more_bytes")])
    return scored.join(rest, "rid", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model["total"]).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_bytes", F.lit(0.0))).alias("score"),
    )


def adaptive_cost(text: str, order: int = ORDER) -> float:
    """log10 probability of a text under a trie that is empty at first and counts each byte after coding it."""
    seen: dict[bytes, Counter] = {}
    history = bytes([BEGIN]) * order
    total = 0.0
    for symbol in [*text.encode("utf-8").lower(), END]:
        excluded: set[int] = set()
        for k in range(order, -1, -1):
            found = seen.get(history[len(history) - k :])
            if found is None:
                continue
            open_ = {s: n for s, n in found.items() if s not in excluded}
            if not open_:
                continue
            whole = sum(open_.values()) + len(open_)
            if symbol in open_:
                total += math.log10(open_[symbol] / whole)
                break
            total += math.log10(len(open_) / whole)
            excluded |= found.keys()
        else:
            total -= math.log10(max(1, 256 - len(excluded)))
        for k in range(order + 1):
            seen.setdefault(history[len(history) - k :], Counter())[symbol] += 1
        history = (history + bytes([symbol]))[-order:]
    return total
