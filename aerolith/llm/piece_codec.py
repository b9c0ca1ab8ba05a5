"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding is the merge procedure itself: the characters of a text are symbols,
an agenda holds every adjacent pair whose union is a piece, ordered by score and
then by position, and the best pair is merged until none is left. Symbols that
are no piece become their bytes.

No piece holds a space mark after another character, a line end or a
punctuation mark after a letter (which pieces do is read from the vocabulary),
so such places are never merged over and a text falls into chunks. Distinct
chunks are encoded once and kept in a bounded table.

The ids are those of the agenda. In every Arrow batch the chunks met for the first
time are encoded by the sentencepiece library as well, and so is one whole text in
sixty-four. `n_differing` counts a text's chunks that differ, and one more if the
whole text does. A codec and its table serve all tasks of a worker process.

Null counts as empty: begin and end ids only. Repeated rows are encoded each for
itself. Texts have no length limit. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import string
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from aerolith.llm.common import add_columns, kept_in_worker

MARK = "▁"
KEPT = 250_000
LOOKED_AT = 64
SHORT = 24
NEVER = 1 << 40


class Codec:
    """A merge vocabulary with identity normalisation, a leading space mark and byte pieces."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(size)]
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        scores = sorted({sp.get_score(i) for i in self.ids.values()}, reverse=True)
        order = {s: k for k, s in enumerate(scores)}
        self.order = {p: order[sp.get_score(i)] for p, i in self.ids.items()}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        self.begin, self.end = (np.array([i], dtype="<u4").tobytes() for i in (self.bos, self.eos))
        self.chunk = self.boundaries()
        self.known: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}
        self.wrong: set[str] = set()

    def boundaries(self) -> re.Pattern:
        """The chunk pattern that this vocabulary allows, over texts with plain spaces."""
        pairs = {(a, b) for p in self.ids for a, b in zip(p, p[1:])}
        after_letter = {b for a, b in pairs if a.isalpha()}
        if any(b == MARK and a != MARK for a, b in pairs):
            return re.compile(r"(?s).+")
        line = any("\n" in pair for pair in pairs)
        marks = [c for c in string.punctuation if c not in after_letter] + ([] if line else ["\n"])
        stop = re.escape("".join(marks) + " ")
        if line:
            return re.compile(rf" *[^\W\d_]+(?=[{stop}]|\Z)| +[^ ]*|[^ ]+")
        return re.compile(rf" *[^\W\d_]+(?=[{stop}]|\Z)| +[^ \n]*|\n|[^ \n]+")

    def merge(self, chunk: str) -> list[int]:
        """Ids of a chunk with space marks, by the agenda of adjacent pairs."""
        symbols = self.merged_short(list(chunk)) if len(chunk) <= SHORT else self.merged_long(list(chunk))
        ids = []
        for s in symbols:
            found = self.ids.get(s)
            if found is not None:
                ids.append(found)
            else:
                ids.extend([self.byte_ids[b] for b in s.encode("utf-8")])
        return ids

    def merged_short(self, symbols: list[str]) -> list[str]:
        """The agenda as a list with one entry for each adjacent pair; the first of the best is merged."""
        rank = self.order.get
        agenda = [rank(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            i = agenda.index(best)
            symbols[i] += symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = rank(symbols[i] + symbols[i + 1], NEVER)
            if i:
                agenda[i - 1] = rank(symbols[i - 1] + symbols[i], NEVER)
        return symbols

    def merged_long(self, symbols: list[str]) -> list[str]:
        """The agenda as a heap; entries whose symbols have changed meanwhile are passed over."""
        n = len(symbols)
        order = self.order
        before = list(range(-1, n - 1))
        after = [*range(1, n), -1]
        agenda = []
        for i in range(n - 1):
            union = symbols[i] + symbols[i + 1]
            if union in order:
                agenda.append((order[union], i, i + 1, union))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, union = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != len(union):
                continue
            symbols[left], symbols[right] = union, ""
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            for i, j in ((before[left], left), (left, after[left])):
                if i >= 0 and j >= 0:
                    union = symbols[i] + symbols[j]
                    if union in order:
                        heapq.heappush(agenda, (order[union], i, j, union))
        return [s for s in symbols if s]

    def unmerge(self, ids: list[int]) -> str:
        """Text of ids, space marks as spaces; runs of bytes that are not UTF-8 become U+FFFD each."""
        out, held = [], bytearray()
        for i in [*ids, -1]:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(as_text(bytes(held)))
                held.clear()
            if i >= 0 and i not in (self.bos, self.eos):
                out.append(self.pieces[i].replace(MARK, " "))
        return "".join(out)

    def learn(self, chunks: list[str]) -> None:
        """Encode chunks met for the first time and check them against the library in one call."""
        marked = [c.replace(" ", MARK) for c in chunks]
        own = [self.merge(c) for c in marked]
        # the library puts a mark before a text: a chunk that has none is given a line end to follow
        given = [c[1:] if c[0] == " " else "\n" + c for c in chunks]
        lone = self.library.encode("\n")
        checked = self.library.encode(given, num_threads=1)
        for chunk, mine, theirs in zip(chunks, own, checked):
            if chunk == " ":
                theirs = lone[:1]
            elif chunk[0] != " ":
                theirs = theirs[len(lone) :]
            if mine != theirs:
                self.wrong.add(chunk)
            self.known[chunk] = (packed(mine), self.unmerge(mine))

    def encode_batch(self, texts: list[str]) -> Iterator[tuple[bytes, str, int]]:
        """(ids as little-endian 32-bit integers, decoded text, number of differences) of each text."""
        split = [self.chunk.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        if len(self.known) > KEPT:  # what is not met again before the next change is forgotten
            self.known, self.older = {}, self.known
        new = []
        for c in set().union(*split).difference(self.known):
            if c in self.older:
                self.known[c] = self.older[c]
            else:
                new.append(c)
        for at in range(0, len(new), 20_000):
            self.learn(new[at : at + 20_000])
        look = self.known.__getitem__
        for text, chunks in zip(texts, split):
            found = list(map(look, chunks))
            raw = b"".join([self.begin, *[f[0] for f in found], self.end])
            differing = sum(c in self.wrong for c in chunks) if self.wrong else 0
            if text and zlib.crc32(raw) % LOOKED_AT == 0:
                differing += raw != packed([self.bos, *self.library.encode(text), self.eos])
            yield raw, "".join([f[1] for f in found])[1:], differing


def packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def as_text(raw: bytes) -> str:
    """Bytes as text; every byte that belongs to no character becomes U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        lead = raw[at]
        size = 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0
        try:
            out.append(raw[at : at + size].decode("utf-8") if size else "�")
            at += size or 1
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


def encoded(df: DataFrame, path: str, text_col: str = "text", with_text: bool = False) -> DataFrame:
    """df with ids (array), n_tokens, n_differing and, if asked for, the decoded text."""
    fields = [("ids", "array<int>"), ("n_tokens", "long"), ("n_differing", "long")]

    make_codec = shared_codec(df, path)

    def make():
        codec = make_codec()

        def compute(texts):
            made = list(codec.encode_batch(texts))
            counts = [len(raw) // 4 for raw, _, _ in made]
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join([raw for raw, _, _ in made]), "<i4"))
            columns = [ids, counts, [wrong for _, _, wrong in made], [text for _, text, _ in made]]
            return columns[: 4 if with_text else 3]

        return compute

    return add_columns(df, text_col, fields + [("decoded", "string")] * with_text, make)


def shared_codec(df: DataFrame, path: str) -> Callable[[], Codec]:
    """A function that gives the worker process's codec; the vocabulary file (a fixed one) is sent from the driver."""
    with open(path, "rb") as file:
        sent = df.sparkSession.sparkContext.broadcast(file.read())
    return lambda: kept_in_worker(("pieces", path), lambda: Codec(sent.value))


def digests(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """df with n_tokens, ids_sha256, decoded_sha256 and n_differing, without keeping ids or texts."""
    fields = [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string"), ("n_differing", "long")]

    make_codec = shared_codec(df, path)

    def make():
        codec = make_codec()

        def compute(texts):
            counts, ids, decoded, differing = [], [], [], []
            for raw, text, wrong in codec.encode_batch(texts):
                counts.append(len(raw) // 4)
                ids.append(hashlib.sha256(raw).hexdigest())
                decoded.append(hashlib.sha256(text.encode("utf-8")).hexdigest())
                differing.append(wrong)
            return [counts, ids, decoded, differing]

        return compute

    return add_columns(df, text_col, fields, make)
