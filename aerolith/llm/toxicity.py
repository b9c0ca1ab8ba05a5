"""Toxicity by a support vector machine on a gapped subsequence kernel with Nyström landmarks.

A text is a bag of units: its lower-cased words, and runs of single letters
taken together ("i d i o t" is one unit). The kernel of two units counts subsequences of
three characters that span at most five, weighing each gap by a decay, and is
normalised; marks at both ends count as characters. So a unit with an inserted
or replaced character still shares most of its subsequences with the plain form.

Landmarks are units of the training texts. With K the kernel matrix of the
landmarks, K^(-1/2) k(unit) are the coordinates in which a linear machine is
trained. Labels belong to texts, so the machine learns from one witness of each
toxic text, its highest unit, chosen anew in each round, and from the units that
occur in toxic texts beyond chance, against the units of clean texts, the
highest of which are added in each round. A text scores by its
highest unit, turned into a probability by a logistic curve fitted on sampled
texts that the machine was not trained on.

Because the kernel is a product of explicit features, the trained machine is one
number per subsequence, and texts of any length are scored whole.

Null and empty texts have no unit and get the lowest score of the curve. Without
labels of both kinds every text gets the share of toxic ones, 0 if there are no
labels. Labels of a repeated id count as toxic if one is; labels without a value
and rows without an id are not learned from. Repeated rows are scored each for
itself; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
import string

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import add_columns

DECAY = 0.6
OFFSETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
FEATURES = 64**3
EDGE = 63
PIECE, OVERLAP = 32, 8
KEPT = 200_000
FLOOR = -3.0
TRIM = string.punctuation + "«»„“”’…"
WEIGHTS = np.array([DECAY ** (b - 2) for _, b in OFFSETS])
CODES = np.array(
    [97 <= c <= 122 and c - 96 or 48 <= c <= 57 and c - 21 or 37 + c % 26 for c in range(0x500)], dtype=np.uint8
)


def units_of(text: str) -> set[str]:
    """Words without marks around them, those with marks inside also without these, runs of single letters
    as one unit; long units in overlapping pieces."""
    words = [w.strip(TRIM) for w in text.lower().split()]
    units = set(words)
    units.discard("")
    single = [w for w in units if len(w) == 1]
    if len(single) > 1:
        run: list[str] = []
        for w in [*words, "end"]:
            if len(w) == 1 and w.isalpha():
                run.append(w)
            else:
                if len(run) > 2:
                    units.add("".join(run))
                run = []
    units.update(["".join(filter(str.isalnum, u)) for u in units if not u.isalnum()])
    units.discard("")
    long = [u for u in units if len(u) > PIECE]
    for u in long:
        units.discard(u)
        units.update(u[at : at + PIECE] for at in range(0, len(u) - OVERLAP, PIECE - OVERLAP))
    return units


def subsequences(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit number, feature, weight): the normalised kernel features of units, equal ones added up."""
    width = max(len(u) for u in units) + 2
    points = np.frombuffer("".join(u.ljust(width - 2, "\0") for u in units).encode("utf-32-le"), np.uint32)
    points = points.reshape(len(units), width - 2)
    sizes = np.array([len(u) for u in units])
    grid = np.zeros((len(units), width + 4), np.int64)
    grid[:, 1 : width - 1] = CODES[points % 0x500]
    grid[np.arange(width + 4)[None, :] > sizes[:, None]] = 0
    grid[:, 0] = EDGE
    grid[np.arange(len(units)), sizes + 1] = EDGE
    rows, features, weights = [], [], []
    first = grid[:, :width]
    for (b, c), weight in zip(OFFSETS, WEIGHTS):
        second, third = grid[:, b : b + width], grid[:, c : c + width]
        row, at = np.nonzero(third)
        rows.append(row)
        features.append(first[row, at] * 4096 + second[row, at] * 64 + third[row, at])
        weights.append(np.full(len(row), weight))
    row, weight = np.concatenate(rows), np.concatenate(weights)
    code = row * FEATURES + np.concatenate(features)
    order = np.argsort(code, kind="stable")
    code, weight = code[order], weight[order]
    starts = np.flatnonzero(np.diff(code, prepend=-1))
    weight = np.add.reduceat(weight, starts) if len(starts) else weight
    row, feature = code[starts] // FEATURES, code[starts] % FEATURES
    norm = np.sqrt(np.bincount(row, weights=weight * weight, minlength=len(units)))
    return row, feature, weight / norm[row]


def kernel_to(units: list[str], landmarks: tuple, chunk: int = 500) -> np.ndarray:
    """Kernel of units with landmarks given as (row of each feature, matrix of features by landmarks)."""
    place, matrix = landmarks
    out = np.zeros((len(units), matrix.shape[1]))
    for at in range(0, len(units), chunk):
        row, feature, weight = subsequences(units[at : at + chunk])
        known = place[feature] > 0
        row, part = row[known], matrix[place[feature[known]]] * weight[known][:, None]
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        if len(starts):
            out[at + row[starts]] = np.add.reduceat(part, starts, axis=0)
    return out


def landmark_features(landmarks: list[str]) -> tuple:
    row, feature, weight = subsequences(landmarks)
    distinct, column = np.unique(feature, return_inverse=True)
    place = np.zeros(FEATURES, np.int64)
    place[distinct] = np.arange(1, len(distinct) + 1)
    matrix = np.zeros((len(distinct) + 1, len(landmarks)))
    matrix[column + 1, row] = weight
    return place, matrix


def hinge_fit(z: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-4, steps: int = 30) -> tuple:
    """Linear machine (w, b) for the squared hinge loss: Newton steps on the rows inside the margin, halved as needed."""
    a = np.concatenate([z, np.ones((len(z), 1))], axis=1)
    ridge = penalty * np.eye(a.shape[1])
    ridge[-1, -1] = 1e-9

    def loss(theta):
        return theta @ ridge @ theta + weight @ np.maximum(0, 1 - y * (a @ theta)) ** 2

    theta = np.zeros(a.shape[1])
    now = loss(theta)
    for _ in range(steps):
        inside = y * (a @ theta) < 1
        part = a[inside] * weight[inside][:, None]
        step = np.linalg.solve(ridge + part.T @ a[inside], part.T @ y[inside]) - theta
        size = 1.0
        while size > 1e-3 and loss(theta + size * step) > now:
            size /= 2
        after = loss(theta + size * step)
        if now - after < 1e-9:
            break
        theta, now = theta + size * step, after
    return theta[:-1], float(theta[-1])


def logistic_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and offset of a weighted logistic curve by Newton steps with a small penalty."""
    theta = np.array([1.0, 0.0])
    a = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ theta, -30, 30)))
        g = a.T @ (weight * (p - y)) + 1e-3 * theta * np.array([1, 0])
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2)
        theta = theta - np.clip(np.linalg.solve(h, g), -2, 2)
    return float(max(theta[0], 0.0)), float(theta[1])


def association(a: int, b: int, n: int, m: int) -> float:
    """Log-likelihood ratio of a unit in a of n toxic and b of m clean texts against one common rate."""

    def fits(k, total, rate):
        return (k * math.log(rate) if k else 0) + ((total - k) * math.log(1 - rate) if total > k else 0)

    return fits(a, n, a / n) + fits(b, m, b / max(1, m)) - fits(a, n, (a + b) / (n + m)) - fits(b, m, (a + b) / (n + m))


def train(
    toxic: list[list[str]], clean: list[list[str]], rate: float, landmarks: int = 160, rounds: int = 3, seed: int = 13
) -> dict:
    """Machine and curve from the units of toxic and clean texts; `rate` is the share of toxic texts among all."""
    rng = np.random.default_rng(seed)
    fit = [[t for k, t in enumerate(texts) if k % 4] or texts for texts in (toxic, clean)]
    held = [[t for k, t in enumerate(texts) if k % 4 == 0] for texts in (toxic, clean)]
    in_toxic: dict[str, int] = {}
    in_clean: dict[str, int] = {}
    for texts, counts in zip(fit, (in_toxic, in_clean)):
        for text in texts:
            for u in text:
                counts[u] = counts.get(u, 0) + 1
    odds = {
        u: math.log((n + 0.5) / (len(fit[0]) + 1)) - math.log((in_clean.get(u, 0) + 0.5) / (len(fit[1]) + 1))
        for u, n in in_toxic.items()
    }
    # a unit is telling if its share of toxic texts could not come about by chance among so many units
    least = math.log(len(in_toxic) + len(in_clean) + 1) + 2
    evidence = {u: association(n, in_clean.get(u, 0), len(fit[0]), len(fit[1])) for u, n in in_toxic.items()}
    ranked = sorted((u for u in odds if odds[u] > 0), key=lambda u: (-evidence[u], u))
    telling = ranked[: landmarks // 2]
    usual = sorted(in_clean, key=lambda u: (-in_clean[u], u))[: landmarks // 4]
    pool = sorted(set(in_clean) - set(usual) - set(telling))
    others = [pool[k] for k in rng.choice(len(pool), min(len(pool), landmarks // 4), replace=False)] if pool else []
    chosen = sorted({*telling, *usual, *others})
    features = landmark_features(chosen)
    k_ll = kernel_to(chosen, features)
    values, vectors = np.linalg.eigh(k_ll + 1e-6 * np.eye(len(chosen)))
    whiten = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    units = sorted({*in_toxic, *in_clean})
    number = {u: k for k, u in enumerate(units)}
    bags = [np.array([number[u] for u in text], dtype=np.int64) for text in fit[0]]
    plain = np.array([number[u] for u in in_clean], dtype=np.int64)
    often = np.zeros(len(units))
    often[plain] = np.sqrt([in_clean[u] for u in in_clean])
    first = [number[u] for u in ranked if evidence[u] > least and odds[u] > 1] or [number[u] for u in ranked[:1]]
    times = np.zeros(len(units))
    times[first] = [in_toxic[units[k]] for k in first]
    witness = times.copy()
    hard = rng.choice(plain, min(len(plain), 4000), replace=False)
    model = {}
    for _ in range(rounds):
        positive = np.flatnonzero(witness)
        negative = np.setdiff1d(hard, positive)
        x = kernel_to([units[k] for k in np.concatenate([positive, negative])], features) @ whiten
        y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
        up, down = np.sqrt(witness[positive]), often[negative]
        share = np.concatenate([0.5 * up / up.sum(), 0.5 * down / max(1e-9, down.sum())])
        w, b = hinge_fit(x, y, share)
        place, matrix = features
        model = {"weights": (matrix @ (whiten @ w))[place].astype(np.float32), "bias": b}
        score = unit_scores(model, units)
        highest = plain[np.argsort(-score[plain], kind="stable")[:3000]]
        hard = np.unique(np.concatenate([hard, highest]))
        witness = times.copy()
        for bag in bags:
            top = bag[score[bag].argmax()]
            if score[top] > 0 and odds[units[top]] > 1:
                witness[top] += 1
    texts = (held[0] + held[1]) or (fit[0] + fit[1])
    labels = np.array([1.0] * len(held[0]) + [0.0] * len(held[1])) if held[0] + held[1] else np.zeros(0)
    known: dict[str, float] = {}
    tops = np.array([highest_unit(model, known, set(t)) for t in texts])
    n1, n0 = max(1, len(held[0])), max(1, len(held[1]))
    weight = np.where(labels == 1, rate / n1, (1 - rate) / n0) * len(texts)
    slope, offset = logistic_fit(tops, labels, weight)
    return model | {"slope": slope, "offset": offset}


def unit_scores(model: dict, units: list[str], chunk: int = 1_000) -> np.ndarray:
    """Decision value of each unit."""
    out = np.full(len(units), model["bias"])
    for at in range(0, len(units), chunk):
        row, feature, weight = subsequences(units[at : at + chunk])
        part = np.bincount(row, weights=model["weights"][feature] * weight, minlength=len(units[at : at + chunk]))
        out[at : at + chunk] += part
    return out


def highest_unit(model: dict, known: dict[str, float], units: set[str]) -> float:
    learn(model, known, [u for u in units if u not in known])
    return max([known[u] for u in units], default=FLOOR)


def learn(model: dict, known: dict[str, float], new: list[str]) -> None:
    if new:
        known.update(zip(new, unit_scores(model, new).tolist()))


def probability(model: dict, top: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, model["slope"] * top + model["offset"]))))


def scorer(model: dict):
    """A function from texts to scores."""
    if "prior" in model:
        return lambda texts: [model["prior"]] * len(texts)
    known: dict[str, float] = {}

    def score(texts: list[str]) -> list[float]:
        bags = [units_of(t) for t in texts]
        if len(known) > KEPT:
            known.clear()
        learn(model, known, [u for u in set().union(*bags) if u not in known])
        return [probability(model, max([known[u] for u in bag], default=FLOOR)) for bag in bags]

    return score


def fit(
    df: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "toxic",
    per_class: int = 1200,
    max_chars: int = 20_000,
) -> dict:
    """Train on at most `per_class` labelled texts of each class, those of up to `max_chars` characters.

    An id with several texts gives the least of them in byte order.

    `learn_from` is a condition on the column doc_id that says which labels may be used.
    """
    rows = labels.select(F.col(label_id).alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
    rows = rows.where(learn_from & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return {"prior": float(counts.get(1, 0) > 0)}
    rate = counts[1] / total
    order = F.xxhash64(F.lit(29), "doc_id")
    picked = None
    for label in (0, 1):
        part = rows.where(F.col("toxic") == label).orderBy(order, "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    texts = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.where(F.length("text") <= max_chars)
    labelled = texts.join(F.broadcast(picked), "doc_id")
    sample = labelled.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))  # one text per id: 2 * per_class rows at most
    bags = add_columns(sample, "text", [("units", "array<string>")], lambda: lambda ts: [[sorted(units_of(t)) for t in ts]])
    found = sorted((r["toxic"], r["doc_id"], r["units"]) for r in bags.select("toxic", "doc_id", "units").collect())
    toxic, clean = [[u for t, _, u in found if t == label and u] for label in (1, 0)]
    if not toxic or not clean:
        return {"prior": rate}
    return train(toxic, clean, rate)


def score_texts(df: DataFrame, model: dict, text_col: str = "text", out: str = "score") -> DataFrame:
    """df with the toxicity score of each text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        score = scorer(shared.value)
        return lambda texts: [score(texts)]

    return add_columns(df, text_col, [(out, "double")], make)
