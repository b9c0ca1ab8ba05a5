"""Language identification with a byte convolutional network, trained here.

Texts are lower-cased in ASCII, encoded as UTF-8 and cut into windows of fixed
length that cover all of them; the last is padded with zero bytes. Filters of
several widths slide over a window, the largest response of each filter is kept
and a softmax layer gives the probabilities of the window. A document gets the
mean over its windows, weighted by their bytes.

A text that is null or has no letter is `und` with score 0, and so is every text
when there is nothing to learn from. Equal probabilities go to the label that
sorts first. Rows with a null language or id are predicted but not learned from.
Repeated rows are predicted each for itself; an empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations


import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.common import add_columns, written

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
SALT = 17


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded windows (rows of bytes), the text each belongs to, and its number of real bytes."""
    raw = [t.encode("utf-8", "replace").lower() for t in texts]
    counts = np.array([-(-len(b) // WINDOW) for b in raw], dtype=np.int64)
    flat = np.frombuffer(b"".join(b.ljust(int(c) * WINDOW, b"\0") for b, c in zip(raw, counts)), dtype=np.uint8)
    owner = np.repeat(np.arange(len(raw)), counts)
    ordinal = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    lengths = np.array([len(b) for b in raw], dtype=np.int64)
    return flat.reshape(-1, WINDOW), owner, np.minimum(lengths[owner] - ordinal * WINDOW, WINDOW)


def pooled(model: dict, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Largest response of each filter in each window, and where it was."""
    best, where = [], []
    for width in WIDTHS:
        table = model[f"w{width}"]
        span = x.shape[1] - width + 1
        out = table[0][x[:, :span]]
        for k in range(1, width):
            out = out + table[k][x[:, k : k + span]]
        at = out.argmax(axis=1)
        where.append(at)
        best.append(np.take_along_axis(out, at[:, None, :], axis=1)[:, 0, :] + model[f"b{width}"])
    return np.concatenate(best, axis=1), where


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, labels: list[str], epochs: int = 6, step: int = 64, seed: int = 3) -> dict:
    """Fit filters and softmax layer by Adam on windows x and label numbers y; classes weigh the same."""
    rng = np.random.default_rng(seed)
    n = len(labels)
    model = {f"w{w}": rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    model |= {f"b{w}": np.zeros(FILTERS, np.float32) for w in WIDTHS}
    model |= {
        "dense": rng.normal(0, 0.1, (FILTERS * len(WIDTHS), n)).astype(np.float32),
        "bias": np.zeros(n, np.float32),
    }
    weight = len(y) / (n * np.maximum(np.bincount(y, minlength=n), 1))
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), step):
            rows = order[at : at + step]
            xb, yb = x[rows], y[rows]
            raw, where = pooled(model, xb)
            hidden = np.maximum(raw, 0)
            p = softmax(hidden @ model["dense"] + model["bias"])
            p[np.arange(len(yb)), yb] -= 1
            p *= (weight[yb] / len(yb))[:, None].astype(np.float32)
            grads = {"dense": hidden.T @ p, "bias": p.sum(axis=0)}
            back = (p @ model["dense"].T) * (raw > 0)
            for i, width in enumerate(WIDTHS):
                part = back[:, i * FILTERS : (i + 1) * FILTERS]
                g = np.zeros_like(model[f"w{width}"])
                for k in range(width):
                    byte = np.take_along_axis(xb, where[i] + k, axis=1)
                    np.add.at(g[k], (byte, np.broadcast_to(np.arange(FILTERS), byte.shape)), part)
                grads[f"w{width}"] = g
                grads[f"b{width}"] = part.sum(axis=0)
            t += 1
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                model[k] -= 0.01 * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return model | {"labels": list(labels)}


def compiled(model: dict) -> dict:
    """Tables of the responses to byte pairs, so that a filter of width 2k needs k look-ups."""
    pairs = {}
    for width in WIDTHS:
        w = model[f"w{width}"]
        pairs[width] = [
            (w[k][:, None, :] + w[k + 1][None, :, :]).reshape(-1, FILTERS) if k + 1 < width else w[k]
            for k in range(0, width, 2)
        ]
    return model | {"pairs": pairs}


def probabilities(model: dict, x: np.ndarray, chunk: int = 512) -> np.ndarray:
    """Class probabilities of windows."""
    out = []
    for at in range(0, len(x), chunk):
        part = x[at : at + chunk]
        pair = part[:, :-1].astype(np.int32) * 256 + part[:, 1:]
        best = []
        for width in WIDTHS:
            span = WINDOW - width + 1
            total = None
            for k, rows in zip(range(0, width, 2), model["pairs"][width]):
                index = pair[:, k : k + span] if k + 1 < width else part[:, k : k + span]
                got = np.take(rows, index, axis=0)
                total = got if total is None else np.add(total, got, out=total)
            best.append(total.max(axis=1) + model[f"b{width}"])
        hidden = np.maximum(np.concatenate(best, axis=1), 0)
        out.append(softmax(hidden @ model["dense"] + model["bias"]))
    return np.concatenate(out) if out else np.zeros((0, len(model["labels"])), np.float32)


def predict(model: dict | None, texts: list[str]) -> tuple[list[str], list[float]]:
    """Label and probability of each text."""
    if model is None:
        return ["und"] * len(texts), [0.0] * len(texts)
    x, owner, weight = windows(texts)
    sums = np.zeros((len(texts), len(model["labels"])))
    p = probabilities(model, x) * weight[:, None]
    if len(owner):
        begins = np.flatnonzero(np.diff(owner, prepend=-1))
        sums[owner[begins]] = np.add.reduceat(p, begins, axis=0)
    total = np.bincount(owner, weights=weight, minlength=len(texts))
    labels, scores = [], []
    for k, text in enumerate(texts):
        if has_letter(text) and total[k]:
            best = int(sums[k].argmax())
            labels.append(model["labels"][best])
            scores.append(float(min(1.0, max(0.0, sums[k, best] / total[k]))))
        else:
            labels.append("und")
            scores.append(0.0)
    return labels, scores


def fit(
    df: DataFrame,
    learn: Column,
    text_col: str = "text",
    lang_col: str = "lang",
    docs_per_language: int = 700,
    windows_per_doc: int = 2,
    max_docs: int = 180_000,
) -> dict | None:
    """Train on a bounded sample: `docs_per_language` distinct texts of every language, or all if there are fewer,
    `windows_per_doc` windows spread over each. Where languages are so many that this passes `max_docs` texts,
    each gives as many fewer, one at least. `learn` says which rows may be used. The texts are those of the
    smallest hashes, the same ones in every run."""
    rows = df.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )
    rows = rows.withColumn("h", F.xxhash64(F.lit(SALT), "text"))
    hashes = written(rows.select("lang", "h").distinct(), "hashes")
    sizes = hashes.groupBy("lang").agg(F.count(F.lit(1)).alias("texts"))
    sizes = sizes.orderBy("lang").collect()  # one row per language
    if not sizes:
        return None
    docs_per_language = max(1, min(docs_per_language, max_docs // len(sizes)))
    # more than are wanted, but not all, are ranked; of some 2n + 100 hashes by chance there are never fewer than n
    steps = 1 << 40
    shares = [(r["lang"], int(min(1.0, (2 * docs_per_language + 100) / r["texts"]) * steps)) for r in sizes]
    share = F.create_map(*[F.lit(v) for pair in shares for v in pair])
    place = F.pmod("h", F.lit(steps))
    some = hashes.where(place < F.coalesce(F.try_element_at(share, "lang"), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(place, "h"))
    picked = some.withColumn("rank", rank).where(F.col("rank") <= docs_per_language).select("lang", "h")
    sample = rows.join(F.broadcast(picked), ["lang", "h"])

    def make():
        def compute(texts):
            out = []
            for text in texts:
                x = windows([text])[0] if has_letter(text) else np.zeros((0, WINDOW), np.uint8)
                take = np.unique(np.linspace(0, len(x) - 1, windows_per_doc).astype(int)) if len(x) else []
                out.append([x[i].tobytes() for i in take])
            return [out]

        return compute

    cut = add_columns(sample, "text", [("cuts", "array<binary>")], make).select("lang", "h", "cuts")
    got = cut.dropDuplicates(["lang", "h"]).select("lang", F.explode("cuts").alias("cut"))
    pairs = sorted((r["lang"], bytes(r["cut"])) for r in got.collect())
    labels = sorted({lang for lang, _ in pairs})
    if not labels:
        return None
    x = np.frombuffer(b"".join(cut for _, cut in pairs), dtype=np.uint8).reshape(-1, WINDOW)
    y = np.array([labels.index(lang) for lang, _ in pairs])
    return compiled(train(x, y, labels))


def identify(df: DataFrame, model: dict | None, text_col: str = "text") -> DataFrame:
    """df with lang_pred and score."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    return add_columns(
        df, text_col, [("lang_pred", "string"), ("score", "double")], lambda: lambda texts: predict(shared.value, texts)
    )
