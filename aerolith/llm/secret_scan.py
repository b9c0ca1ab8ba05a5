"""Secret scans: fixed patterns, and character Markov models for strings no pattern names.

Base spans come from three patterns. Two first-order character models, one of
random strings and one of ordinary identifiers, are trained from labelled
samples; every token of 20 or more characters is reported as `markov` when its
log-likelihood ratio per character is above a threshold that one in a hundred
ordinary and all but one in a hundred random training strings pass at most and at
least. Such a span never replaces or overlaps a base span.

A null or empty text has no spans. Repeated rows are scanned each for itself.
An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import add_columns, hash_sample

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ASSIGN_WORD = re.compile(r"(?ai)pass(?:word|wd)|secret|token|api_?key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
IDENTIFIER = re.compile(r"[A-Za-z0-9_-]{4,64}")
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
RANDOM_ALPHABETS = (ALPHABET[:62], "0123456789abcdef", ALPHABET[:64])

CODE = np.full(128, len(ALPHABET), dtype=np.int64)
for _i, _c in enumerate(ALPHABET):
    CODE[ord(_c)] = _i
STATES = len(ALPHABET) + 1


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three patterns, by start, then kind as listed."""
    found = []
    if ASSIGN_WORD.search(text):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    found.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return found


def codes(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character codes of ASCII strings one after the other, and where each begins."""
    raw = np.frombuffer("".join(strings).encode("ascii", "replace"), dtype=np.uint8)
    lengths = np.array([len(s) for s in strings], dtype=np.int64)
    return CODE[np.minimum(raw, 127)], np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(strings) else lengths


def chain(strings: list[str]) -> np.ndarray:
    """Log transition probabilities of a first-order model, add-half smoothed; state 0 row of starts is last."""
    counts = np.full((STATES + 1, STATES), 0.5)
    if strings:
        code, starts = codes(strings)
        before = np.empty_like(code)
        before[1:] = code[:-1]
        before[starts] = STATES
        np.add.at(counts, (before, code), 1.0)
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def random_strings(n: int, seed: int = 5) -> list[str]:
    """Random strings over three alphabets, the same in every run."""
    rng = np.random.default_rng(seed)
    made = []
    for i in range(n):
        letters = RANDOM_ALPHABETS[i % len(RANDOM_ALPHABETS)]
        made.append("".join(letters[k] for k in rng.integers(0, len(letters), int(rng.integers(20, 48)))))
    return made


def compounds(words: list[str], n: int, seed: int = 7) -> list[str]:
    """Ordinary identifiers put together from words: camel case, snake case, dashes, paths, some with a number."""
    rng = np.random.default_rng(seed)
    words = [w for w in words if w.isalpha() and len(w) <= 16]
    made = []
    for i in range(n if words else 0):
        parts = [words[k] for k in rng.integers(0, len(words), int(rng.integers(2, 6)))]
        if i % 4 == 0:
            parts = [parts[0].lower(), *[p.capitalize() for p in parts[1:]]]
        tail = str(int(rng.integers(0, 10_000))) if i % 3 == 0 else ""
        made.append(("", "_", "-", "/")[i % 4].join(parts) + tail)
    return made


def train(samples: list[tuple[str, bool]], missed: float = 0.01) -> dict:
    """Both models and the threshold from (string, is it random) samples.

    Strings sampled as ordinary hold secrets that no pattern names: those that a first model takes for
    random are left out of the second. The threshold is passed by all but a share `missed` of the random
    training strings of 20 or more characters, and by no more than that share of the ordinary ones left.
    """
    random = [s for s, is_random in samples if is_random]
    plain = [s for s, is_random in samples if not is_random]
    long_random = [s for s in random if len(s) >= 20]
    ratio, passed = chain(random) - chain(plain), 0.0
    if long_random:
        passed = max(float(np.quantile(ratios(long_random, ratio), missed)), 0.0)
        long_plain = [s for s in plain if len(s) >= 20]
        outliers = {s for s, r in zip(long_plain, ratios(long_plain, ratio)) if r > passed}
        plain = [s for s in plain if s not in outliers]
        ratio = chain(random) - chain(plain)
        passed = float(np.quantile(ratios(long_random, ratio), missed))
    long_plain = [s for s in plain if len(s) >= 20]
    reached = float(np.quantile(ratios(long_plain, ratio), 1 - missed)) if long_plain else 0.0
    return {"ratio": ratio, "threshold": max(passed, reached, 0.0)}


def ratios(strings: list[str], ratio: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio per character of each string."""
    if not strings:
        return np.zeros(0)
    code, starts = codes(strings)
    before = np.empty_like(code)
    before[1:] = code[:-1]
    before[starts] = STATES
    return np.add.reduceat(ratio[before, code], starts) / np.array([len(s) for s in strings])


def mixed(token: str) -> bool:
    """A digit and a letter occur."""
    return any(c.isdigit() for c in token) and any(c.isalpha() for c in token)


def scan(texts: list[str], model: dict) -> list[tuple[list, list]]:
    """Base spans and Markov spans of each text."""
    base = [base_spans(t) for t in texts]
    proposed = []
    for k, text in enumerate(texts):
        for m in TOKEN.finditer(text):
            if not any(s < m.end() and m.start() < e for s, e, _ in base[k]):
                proposed.append((k, m.start(), m.end(), m[0]))
    added: list[list] = [[] for _ in texts]
    for (k, start, end, _), score in zip(proposed, ratios([p[3] for p in proposed], model["ratio"])):
        if score > model["threshold"]:
            added[k].append((start, end, "markov"))
    return list(zip(base, added))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def runs() -> list[str]:
    """Rules and padding: one character over and over."""
    return [c * n for c in ALPHABET for n in (20, 40)]


def identifier_samples(df: DataFrame, text_col: str = "text", docs: int = 2000, limit: int = 20000) -> list:
    """Labelled samples: identifiers of about `docs` documents, compounds of them and runs (not random), values
    matched by a base pattern there and seeded strings (random). `limit` bounds them; they are the same in every run."""
    texts = df.select(F.col(text_col).alias("text"))
    sampled = hash_sample(texts, F.col("text"), docs, texts.count())

    def make():
        def compute(batch):
            out = []
            for text in batch:
                words = {(w, 0) for w in IDENTIFIER.findall(text) if not mixed(w)}
                for start, end, kind in base_spans(text):
                    value = ASSIGN.match(text, start)[2] if kind == "assign" else text[start:end]
                    if mixed(value):
                        words.add((value, 1))
                out.append(sorted(f"{label}{word}" for word, label in words))
            return [out]

        return compute

    tagged = add_columns(sampled, "text", [("tagged", "array<string>")], make).select(F.explode("tagged").alias("t"))
    distinct = tagged.groupBy("t").count().orderBy(F.xxhash64("t"), "t").limit(limit)
    rows = sorted(r["t"] for r in distinct.collect())
    samples = [(t[1:], t[0] == "1") for t in rows]
    ordinary = compounds([s for s, random in samples if not random], limit // 4) + runs()
    return samples + [(s, False) for s in ordinary] + [(s, True) for s in random_strings(limit // 10)]


def find_secrets(df: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """df with secret_spans: array of (kind, start, end, text), ends exclusive, base and added spans by start."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        def compute(texts):
            out = []
            for text, (base, added) in zip(texts, scan(texts, shared.value)):
                spans = sorted(base + added, key=lambda s: (s[0], (*KINDS, "markov").index(s[2])))
                out.append([{"kind": k, "start": s, "end": e, "value": text[s:e]} for s, e, k in spans])
            return [out]

        return compute

    kind = "array<struct<kind:string,start:int,end:int,value:string>>"
    return add_columns(df, text_col, [("secret_spans", kind)], make)


def digest(df: DataFrame) -> DataFrame:
    """The report columns, derived from secret_spans."""
    spans = F.col("secret_spans")
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter(spans, lambda s: s["kind"] != "markov")
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return df.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(F.array_join(F.transform(base, line), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(spans, line), ",").alias("spans"),
        count("markov"),
    )
