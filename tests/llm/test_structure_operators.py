"""Conversation repair, hard negatives and packing against plain versions and edge rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from aerolith.llm import best_fit_packing, conversation_repair, hard_negatives
from aerolith.llm.queries import OP12_SQL, op11_conversation_repair, op12_hard_negatives

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
SPACE = " \t\n\x0b\x0c\r"
EMPTY_HASH = hashlib.sha256(b"").hexdigest()
TALK = "conv_id long, turn long, role string, text string, conv_ID_2 string"


def plain_damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv_id, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def plain_faults(rows):
    seen, faults = set(), []
    for _, _, role, text in rows:
        kept = text.rstrip(SPACE)
        fault = "blank" if not kept else "duplicate" if (role, text) in seen else ""
        faults.append(fault or ("" if kept[-1] in ".!?" else "truncated"))
        seen.add((role, text))
    return faults


def plain_repair(rows, faults):
    """Cheapest, then least (cost, audit, lines), by dynamic programming from the end over (rows left, roles said)."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}
    best = {}
    for at in range(len(rows), -1, -1):
        here = {}
        for said in follow:
            options = [(0, "", [])] if at == len(rows) and said in ("", "a") else []
            if at < len(rows):
                _, _, role, text = rows[at]
                options.append(step(2, "D", [], best[at + 1, said]))
                if faults[at] not in ("blank", "duplicate"):
                    extra = 5 * (faults[at] == "truncated")
                    for to in follow[said]:
                        if role[:1] == to:
                            options.append(step(extra, "K", [f"{role}:{text}"], best[at + 1, to]))
                        if to in full:
                            options.append(step(1 + extra, "R", [f"{full[to]}:{text}"], best[at + 1, to]))
            here[said] = min(options, default=None)
        for _ in range(4):
            for said in follow:
                for to in follow[said]:
                    if to in full and here.get(to):
                        one = step(5, "I", [f"{full[to]}:"], here[to])
                        here[said] = min(filter(None, (here[said], one)), key=lambda o: o[:2])
        best.update({(at, said): x for said, x in here.items()})
    return best[0, ""]


def step(cost, letter, lines, rest):
    return cost + rest[0], letter + rest[1], lines + rest[2]


def plain_reports(rows):
    damaged = defaultdict(list)
    for row in plain_damage(rows):
        damaged[row[0]].append(row)
    out = {}
    for conv_id in {r[0] for r in rows}:
        own = sorted(damaged[conv_id], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        faults = plain_faults(own)
        count = Counter(faults)
        turns = {r[1] for r in own if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:])]
        cost, audit, lines = plain_repair(own, faults)
        out[conv_id] = (
            gaps, count["blank"], count["duplicate"], count["truncated"], sum(p not in ("su", "ua", "au") for p in pairs),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def as_reports(df):
    found = df.collect()
    assert len({r["conv_id"] for r in found}) == len(found)
    return {r["conv_id"]: tuple(r[1:]) for r in found}


def random_talk(seed, n):
    rng = random.Random(seed)
    texts = [None, "", " \n", "Yes.", "No", "Why?", "A long one indeed. " * 3, "ç日本.", "end\x0b."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, ""]
    return [
        (rng.choice([None, 1, 2, 3, 5, 8, 13]), rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts))
        for _ in range(n)
    ]


def test_conversation_query_equals_plain_repair(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    found = op11_conversation_repair(spark, SF)
    assert found.columns == ["conv_id", *conversation_repair.REPORT_NAMES, "repaired_sha256"]
    assert as_reports(found) == plain_reports(rows)


@pytest.mark.parametrize("limits", [{}, {"long_rows": 6}, {"long_rows": 0, "long_bytes": 0}])
def test_conversation_repair_both_ways(spark, limits):
    rows = random_talk(3, 120) + random_talk(4, 1) * 30
    df = spark.createDataFrame([(*r, "x") for r in rows], TALK).repartition(5)
    damaged = conversation_repair.damaged(df)
    assert as_reports(conversation_repair.reports(damaged, **limits)) == plain_reports(rows)
    lines = conversation_repair.repaired_rows(damaged, **limits).orderBy("conv_id", "step").collect()
    said = defaultdict(list)
    for r in lines:
        said[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    for conv_id, report in plain_reports(rows).items():
        assert hashlib.sha256("\n".join(said[conv_id]).encode()).hexdigest() == report[-1]


def test_conversation_edges(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    kept = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 > 4)
    rows = [(gone, 0, "user", "Hi."), (kept, 0, "assistant", "word " * 200_000 + ".")]
    found = as_reports(conversation_repair.reports(
        conversation_repair.damaged(spark.createDataFrame([(*r, None) for r in rows], TALK))
    ))
    assert found[gone] == (0, 0, 0, 0, 0, 0, "", EMPTY_HASH)
    assert found[kept] == (0, 0, 0, 0, 0, 2, "D", EMPTY_HASH)
    assert conversation_repair.reports(conversation_repair.damaged(spark.createDataFrame([], TALK))).count() == 0


def test_auction_prices_are_exact_costs():
    rng = random.Random(5)
    solver = conversation_repair.Solver()
    for _ in range(400):
        codes = bytes(rng.choice([0, 4, 8, 4, 8, 12, 3, 5, 6, 7, 9, 11, 15]) for _ in range(rng.randint(0, 40)))
        kinds = {0: "system", 1: "user", 2: "assistant", 3: "tool"}
        faults = ["", "blank", "duplicate", "truncated"]
        rows = [(0, k, kinds[c // 4], str(k)) for k, c in enumerate(codes)]
        assert solver.solve(codes) == plain_repair(rows, [faults[c % 4] for c in codes])[:2]
    block = conversation_repair.Block(codes[:8], (0, None, None, 0), True)
    for node, arcs in enumerate(block.arcs):
        assert all(block.prices[node] <= cost + block.prices[to] for _, cost, to in arcs)


VECTORS = "vec_id long, label int, embedding array<float>, V string, score string"


def run_sql(spark, df, sql):
    df = df.select("vec_id", "label", "embedding")
    con = duckdb.connect()
    con.register("embeddings", df.toArrow())
    return sorted(tuple(r) for r in con.sql(sql).fetchall())


def mined(df, **options):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 100 == 0, moved, **options).collect())


def test_lookups_give_inner_products():
    rng = np.random.default_rng(0)
    for low, high in ((-256, 257), (-1, 1), (0, 5), (0, 1), (-1000, 2**31), (-3, -2)):
        rows, anchors = rng.integers(low, high, (70, 24)), rng.integers(low, high, (9, 24))
        found = hard_negatives.scores(hard_negatives.bit_planes(rows), hard_negatives.subset_sums(anchors))
        assert (found == rows @ anchors.T).all()


def test_hard_negatives_equal_sql(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    expected = run_sql(spark, df, OP12_SQL)
    assert expected == sorted(tuple(r) for r in op12_hard_negatives(spark, SF).collect())
    assert mined(df.repartition(7), chunk_rows=2) == expected


def test_hard_negatives_edges(spark):
    rng = random.Random(2)
    rows = []
    for k in range(400):
        v = [rng.choice([0.0, 0.5, 0.25, -0.5, 1.0]) for _ in range(11)]
        rows.append((rng.choice([None, k, k % 50 * 100, 100]), rng.choice([None, 0, 1, 2, 9]), v, "x", "y"))
    rows += [(100, 1, None, "", ""), (200, 1, [], "", ""), (300, 1, [1.0, None], "", ""), (400, 2, [float("nan")], "", "")]
    rows += [(500, 2, [float("inf")], "", ""), (600, 2, [0.5] * 11, "", "")] * 5
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    padded = df.withColumn("embedding", F.when(F.size("embedding") == 0, F.array_repeat(F.lit(0.0), 11)).otherwise(F.col("embedding")))
    assert mined(df, chunk_rows=80) == run_sql(spark, padded, OP12_SQL) != []
    assert mined(df.where("false")) == []
    assert mined(df.where("vec_id % 100 <> 0")) == []


def check_packing(rows, texts, length):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["row"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert len(by_doc) == len(texts)
    expected = Counter()
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        cut = [ids[k : k + length] for k in range(0, len(ids), length)]
        expected[(doc_id, tuple((len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for c in cut))] += 1
    found = Counter()
    for pieces in by_doc.values():
        pieces.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        assert [r["start"] for r in pieces] == [k * length for k in range(len(pieces))]
        found[(pieces[0]["doc_id"], tuple((r["length"], r["ids_crc32"]) for r in pieces))] += 1
    assert found == expected
    for parts in by_sequence.values():
        parts.sort()
        ends = np.cumsum([n for _, n in parts])
        assert [o for o, _ in parts] == [0, *ends[:-1]] and ends[-1] <= length
    return len(by_sequence)


def test_packing_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = best_fit_packing.pack(docs.repartition(3), WORDS).collect()
    used = check_packing(rows, [tuple(r) for r in docs.collect()], 2048)
    assert used <= 1.1 * sum(r["length"] for r in rows) / 2048 + 1


def test_packing_encoder_passes_few_words_through_the_library():
    from tokenizers import Tokenizer

    with open(WORDS, encoding="utf-8") as file:
        definition = file.read()
    library = Tokenizer.from_str(definition)
    rng = random.Random(11)
    letters = "aAbBzZ \n\t\r'.,!-_09\u00df\u00c0\u00dc\u00e9\u0307\u0130\u0131\u03a3\u3000\x0b\x1c\u672c\u212bK#<|"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += ["\u0130,", "", " ", "x" * 90 + "." * 60 + " x", "One, two. (three) 'four's: " * 9]
    encoder = best_fit_packing.Encoder(definition)
    for some in (texts, texts[::-1]):
        made = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(some)]
        assert made == [[*library.encode(t, add_special_tokens=False).ids, 0] for t in some]
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(500)]
    seen = best_fit_packing.Encoder(definition)
    seen.encode([" ".join(w + mark for w in words) for mark in ("", ",", ".", ");", "!")])
    assert len(seen.known) <= 510  # marks make no new words of known ones


def test_packing_edges(spark):
    texts = [None, "", " \n\t", "a", "a", "Don't STOP... now!?", "é é  x y ÀÉÎ İ ΑΣ <|endoftext|>", "x" * 5000, "lorem ipsum, dolor\r\n" * 4000]
    rows = [(None if k == 3 else k, t, "s", 1) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, length int")
    for options in ({}, {"length": 5, "most": 2, "share": 4000}):
        made = best_fit_packing.pack(df, WORDS, with_ids=True, **options)
        found = made.collect()
        check_packing(found, [r[:2] for r in rows], options.get("length", 2048))
    assert sum(len(r["ids"]) for r in best_fit_packing.sequences(made).collect()) == sum(r["length"] for r in found)
    assert best_fit_packing.pack(df.where("false"), WORDS).count() == 0


def test_best_fit_takes_the_fullest_and_closes_the_fullest():
    rng = random.Random(1)
    for most in (1, 3, 50):
        bins, open_, made = best_fit_packing.Bins(16, most), {}, 0
        for _ in range(2000):
            n = rng.randint(1, 16)
            found, offset = bins.place(n)
            fitting = [f for f in open_.values() if f >= n]
            if fitting:
                assert open_[found] == min(fitting) and offset == 16 - open_[found]
            else:
                assert (found, offset) == (made, 0)
                made += 1
            left = open_.pop(found, 16) - n
            if left:
                if len(open_) == most:
                    fullest = min(open_.values())
                    gone = [b for b, f in open_.items() if f == fullest and b not in held(bins)]
                    assert len(gone) == 1
                    open_.pop(gone[0])
                open_[found] = left
            assert len(open_) <= most and set(open_) == held(bins)


def held(bins):
    return {b for lists in bins.by_free.values() for b in lists}
