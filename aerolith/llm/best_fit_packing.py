"""Best-fit packing of tokenized documents into sequences, with a bounded number of open bins.

A document's ids, closed by an end id, form one piece; only a longer document is
cut, into pieces of the sequence length, the last one shorter.

Pieces are dealt to packing tasks by a hash, about `SHARE` tokens each, so that
the number of tasks follows the corpus, and pass through a task in the order of
that hash. A task keeps up to `OPEN` bins. Bit f of a bitset tells whether a bin
with f free places is open: the lowest bit at or above a piece's length is the
best fit. If none fits, a bin is opened; if that makes too many, the fullest one
is closed. Sequence numbers hold the task's number above 32 bits.

Tokens of the vocabulary never span white space. Long texts are therefore encoded
in portions, and words met before are looked up. The end id is 0.

Null counts as empty; an empty text is the end id alone. Repeated rows and rows
without id are packed each for itself. Texts have no length limit. An empty table
gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import re
import string
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.llm.common import kept_in_worker, slices, texts_of, written

LENGTH = 2048
OPEN = 1024
SHARE = 1 << 24
PORTION = 1 << 16
GROUP = 1 << 21
SEAM = re.compile(r"[ \n\t](?=[A-Za-z0-9])")
STOPS = string.punctuation.replace("'", "")
SIMPLER = np.arange(256, dtype=np.uint8)  # as the vocabulary's own first steps do, on the bytes of ASCII
SIMPLER[list(b"\n\t\r")] = ord(" ")
SIMPLER[list(string.ascii_uppercase.encode())] = list(string.ascii_lowercase.encode())
IS_WORD, IS_STOP = (np.isin(np.arange(256), list(x.encode())) for x in (string.ascii_lowercase + string.digits, STOPS))
LETTERS = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")  # each such word is a word to the library
KEPT = 400_000
SHORT = 48


def portions(text: str, size: int = PORTION) -> list[str]:
    """The text in pieces of at least `size` characters, cut after white space only."""
    out, at = [], 0
    while len(text) - at > size:
        seam = SEAM.search(text, at + size)
        if not seam:
            break
        out.append(text[at : seam.end()])
        at = seam.end()
    return [*out, text[at:]]


def simplified(text: str) -> bytes:
    """The text in UTF-8 with lower-case ASCII, spaces for other ASCII white space, and a space before marks that follow a word.

    Marks after a letter or digit are words of their own to the library, so the space changes no id.
    """
    raw = SIMPLER[np.frombuffer(text.encode("utf-8"), np.uint8)]
    marks = np.flatnonzero(IS_WORD[raw[:-1]] & IS_STOP[raw[1:]]) + 1
    return np.insert(raw, marks, ord(" ")).tobytes()


class Encoder:
    """Ids of texts by a tokenizers definition whose tokens never span white space.

    Words between ASCII white space are encoded by the library once and kept in a bounded table.
    A group of portions is split into words and put together again as Arrow columns, so that only
    its distinct words pass through Python.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, the end id included, as little-endian 32-bit integers."""
        whole: list[list] = [[] for _ in texts]
        group, size = [], 0
        for k, text in enumerate(texts):
            for part in portions(text):
                group.append((k, part))
                size += len(part)
                if size > GROUP:
                    self.encode_group(group, whole)
                    group, size = [], 0
        self.encode_group(group, whole)
        return [b"".join([*parts, bytes(4)]) for parts in whole]

    def encode_group(self, group: list[tuple[int, str]], whole: list[list]) -> None:
        """Encode portions and add their ids to those of their texts."""
        plain = pa.array([simplified(part) for _, part in group], pa.large_string())
        split = pc.split_pattern(plain, pattern=" ")
        coded = split.values.dictionary_encode()
        listed = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
        words = pc.binary_join(listed, pa.scalar(" ", pa.large_string()))[0].as_py().split(" ")  # no word holds a space
        missing = [w for w in words if w not in self.known]
        if len(self.known) > KEPT:  # what is not met again before the next change is forgotten
            self.known, self.older = {"": b""}, self.known
            missing = words
        rare = self.learn(missing)
        known = self.known
        ids_of = [rare[w] if w in rare else known[w] for w in words] if rare else [known[w] for w in words]
        made = pa.array(ids_of, pa.large_binary())
        _, ends, ids = made.take(coded.indices).buffers()
        cuts = np.frombuffer(ends, np.int64)[split.offsets.to_numpy()].tolist()
        held = memoryview(ids) if ids else b""
        for (k, _), at, to in zip(group, cuts, cuts[1:]):
            whole[k].append(held[at:to])

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Add words to the table; the ids of very long ones are returned instead."""
        known, older, stems, rare, plain, others = self.known, self.older, {}, {}, [], set()
        for word in words:
            if word in older:
                known[word] = older[word]
            elif len(word) <= SHORT and LETTERS.fullmatch(word):
                plain.append(word)
            else:
                stem = word.rstrip(STOPS)
                if stem and stem != word and (LETTERS.fullmatch(stem[-1]) or stem[-1] in string.digits):
                    stems[word] = stem, word[len(stem) :]  # marks after a letter or digit are words of their own
                    others.update(stems[word])
                else:
                    others.add(word)
        for word in others.difference(known, plain, stems):
            if word in older:
                known[word] = older[word]
            elif len(word) <= SHORT and LETTERS.fullmatch(word):
                plain.append(word)
            else:
                (known if len(word) <= SHORT else rare)[word] = self.one(word)
        self.learn_letters(plain)
        for word, pair in stems.items():
            ids = b"".join(known[part] if part in known else rare[part] for part in pair)
            (known if len(word) <= SHORT else rare)[word] = ids
        return rare

    def learn_letters(self, words: list[str]) -> None:
        """Encode words of letters in one call; the library numbers the words that its tokens belong to."""
        for at in range(0, len(words), 128):
            some = words[at : at + 128]
            made = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids, number = np.array(made.ids, dtype="<u4"), np.array(made.word_ids)
            cuts = np.searchsorted(number, np.arange(len(some) + 1))
            if cuts[0] or cuts[-1] != len(ids) or not np.diff(cuts).all():
                self.known.update((w, self.one(w)) for w in some)
                continue
            raw, ends = ids.tobytes(), (4 * cuts).tolist()
            self.known.update(zip(some, [raw[a:b] for a, b in zip(ends, ends[1:])]))

    def one(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()


def cut_documents(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_ids: bool = False
) -> DataFrame:
    """(doc_id, row, piece, start, length, ids_crc32[, ids]) of every document; `row` numbers the documents."""
    with open(path, encoding="utf-8") as file:
        definition = file.read()  # a fixed file, a few megabytes
    shared = df.sparkSession.sparkContext.broadcast(definition)
    plain = df.select(df[id_col].alias("doc_id"), df[text_col].cast("string").alias("text"))
    schema = T.StructType([T.StructField("doc_id", plain.schema["doc_id"].dataType)])
    extra = ", ids array<int>" if with_ids else ""
    for field in T.StructType.fromDDL(f"row long, piece int, start long, length long, ids_crc32 long{extra}").fields:
        schema = schema.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        arrow = to_arrow_schema(schema)
        encoder = kept_in_worker(("packing", path), lambda: Encoder(shared.value))
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch, "text"):
                rows: list[list] = [[] for _ in arrow]
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(texts_of(part, "text"))):
                    ids = np.frombuffer(ids, "<u4")
                    for piece, start in enumerate(range(0, len(ids), length)):
                        held = ids[start : start + length]
                        values = [doc_id, row, piece, start, len(held), zlib.crc32(held.tobytes())]
                        for column, value in zip(rows, values + [held.astype(np.int32)] * with_ids):
                            column.append(value)
                    row += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, arrow)], schema=arrow)

    return plain.mapInArrow(run, schema)


class Bins:
    """At most `most` open bins of a size, found by their free places."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.bits, self.count, self.made = 0, 0, 0
        self.by_free: dict[int, list[int]] = defaultdict(list)

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of the fullest open bin that takes a piece of this length, or of a new one."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            bin_ = self.take(free)
        else:
            free, bin_ = self.size, self.made
            self.made += 1
        if free > length:
            if self.count == self.most:
                self.take((self.bits & -self.bits).bit_length() - 1)
            self.by_free[free - length].append(bin_)
            self.bits |= 1 << (free - length)
            self.count += 1
        return bin_, self.size - free

    def take(self, free: int) -> int:
        """Remove the newest bin with this many free places."""
        held = self.by_free[free]
        bin_ = held.pop()
        self.count -= 1
        if not held:
            self.bits &= ~(1 << free)
        return bin_


def packed(pieces: DataFrame, size: int = LENGTH, most: int = OPEN, share: int = SHARE) -> DataFrame:
    """`pieces` (from cut_documents, written) with sequence_id and offset; no piece is longer than `size`."""
    total = pieces.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
    tasks = max(1, -(-total // share))
    deal = F.xxhash64(F.lit(7), "row", "piece")
    dealt = pieces.withColumn("_deal", deal).repartition(tasks, "_deal").sortWithinPartitions("_deal", "row", "piece")
    schema = T.StructType(list(pieces.schema.fields)).add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bins, base = Bins(size, most), TaskContext.get().partitionId() << 32
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            sequences = pa.array([base + s for s, _ in placed], pa.int64())
            offsets = pa.array([o for _, o in placed], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sequences, offsets], names=schema.names)

    return dealt.drop("_deal").mapInArrow(run, schema)


def pack(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    most: int = OPEN, share: int = SHARE, with_ids: bool = False,
) -> DataFrame:
    """Every piece of every document with its place: doc_id, row, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = written(cut_documents(df, path, id_col, text_col, length, with_ids), "pieces")
    return packed(pieces, length, most, share)


def sequences(pack: DataFrame) -> DataFrame:
    """(sequence_id, ids): whole sequences of a result with ids; a sequence has a bounded number of pieces."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pack.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
