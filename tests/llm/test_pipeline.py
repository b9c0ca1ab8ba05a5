"""The pipeline stage by stage against plain versions, and the registry."""

import random

import numpy as np

import corpus_pipeline
from aerolith.llm import decontamination, near_copies, pii
from aerolith.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_decide_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(spark, docs, SF).cache()
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert after.keys() <= before.keys() and len(after) > 0.7 * len(before)
        if name == "simhash":
            sets = {i: near_copies.shingles(t or "") for i, t in before.items()}
            pairs = [(a, b) for a in sets for b in sets if a < b and near_copies.similarity(sets[a], sets[b]) >= 0.8]
            missed = [(a, b) for a, b in pairs if a in after and b in after]
            assert len(missed) <= 0.2 * len(pairs)
            linked = {i for pair in pairs for i in pair}
            assert before.keys() - after.keys() <= linked
        if name == "decontaminate":
            bench = spark.read.parquet(f"{SF}/benchmark.parquet")
            assert decontamination.contained_items(docs, bench).count() == 0
        if name == "pii":
            assert after.keys() == before.keys()
            assert pii.find_pii(docs).where("size(pii_spans) > 0").count() == 0
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())


def test_pipeline_runs_through(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 100 and out.where("not round_trip").count() == 0


def test_all_operators_and_no_unknown_sql():
    numbers = {int(n[2:].split("_")[0]) for n in QUERIES}
    assert numbers == set(range(1, 14)) and ORACLES.keys() <= QUERIES.keys()


def test_near_copies_are_found_and_clean_documents_stay(spark):
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(3000)]
    rows, planted = [], []
    for i in range(300):
        parts = rng.choices(words, k=rng.randint(80, 400))
        rows.append((i, " ".join(parts)))
        for k in range(1, 5):
            copy = list(parts)
            for at in rng.sample(range(len(parts)), k):
                copy[at] = rng.choice(words)
            rows.append((1000 * k + i, " ".join(copy)))
            a, b = (near_copies.shingles(" ".join(x)) for x in (parts, copy))
            if near_copies.similarity(a, b) >= 0.8:
                planted.append(1000 * k + i)
    often = " ".join(rng.choices(words, k=90))
    rows += [(9000 + k, f"{often} and {k}") for k in range(400)]  # a group of near copies
    rows += [(None, None), (9990, ""), (9991, " \n"), (9992, "short text"), (9992, "Short  text"), (None, "no id")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, _row int, _ID string")
    kept = near_copies.keep_one(df)
    assert kept.columns == df.columns
    left = [r["doc_id"] for r in kept.collect()]
    assert set(range(300)) <= set(left) and len(planted) > 900
    assert sum(i in left for i in planted) <= 0.1 * len(planted)
    assert sum(i is not None and 9000 <= i < 9990 for i in left) == 1
    assert left.count(9990) == 1 and left.count(9991) == 0 and left.count(9992) == 1 and left.count(None) == 1
    assert near_copies.keep_one(df.where("false")).count() == 0


def test_narrow_naming_still_checks_all_pairs(spark):
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(base[:k] + [f"other{k}{j}" for j in range(9)] + base[k + 9 :])) for k in range(0, 50, 3)]
    rows += [(100 + k, t + " end") for k, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: near_copies.shingles(t) for i, t in rows}
    assert all((near_copies.similarity(sets[a], sets[b]) >= 0.8) == (b == 100 + a) for a in sets for b in sets if a < b)
    kept = {r["doc_id"] for r in near_copies.keep_one(df, radius=40).collect()}
    assert kept == {i for i in sets if i < 100}


def test_sketches_never_reject_a_near_copy():
    rng = np.random.default_rng(3)
    for size in (0, 1, 2, 5, 60, 400, 5000):
        for share in (0.0, 0.02, 0.1, 0.12, 0.5):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            b = np.unique(np.concatenate([a[int(share * len(a)) :], rng.integers(0, 1 << 63, int(share * size), dtype=np.uint64)]))
            bound = near_copies.least_difference(near_copies.sketch(a), near_copies.sketch(b))
            assert bound <= len(np.setxor1d(a, b))
            if near_copies.similarity(a, b) >= 0.8:
                assert near_copies.allowed(len(a), len(b), bound, 0.8)
            elif share == 0.5 and size >= 60:
                assert not near_copies.allowed(len(a), len(b), bound, 0.8)
    small, large = np.arange(3, dtype=np.uint64), np.arange(900, dtype=np.uint64)
    assert near_copies.least_difference(near_copies.sketch(small), near_copies.sketch(large)) <= 897


def test_repeated_rows_leave_one(spark):
    text = "one text of a good many words that stands here more than once"
    rows = [(1, text)] * 5 + [(2, text.upper())] * 3 + [(None, "lone row")] * 4 + [(3, "")] * 2 + [(3, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    kept = [(r["doc_id"], r["text"] or "") for r in near_copies.keep_one(df).collect()]
    assert sorted(kept, key=str) == sorted([(1, text), (None, "lone row"), (3, "")], key=str)


def test_a_link_beyond_the_named_ones_joins_its_group(spark):
    base = [f"w{k}" for k in range(400)]
    leaves = [" ".join(base[:k] + [f"new{k}{j}" for j in range(26)] + base[k + 26 :]) for k in range(0, 370, 30)]
    signed = lambda text: int(np.uint64(near_copies.sequence_hash(text)).astype(np.int64))
    salted = (" ".join([f"salt{k}", *base]) for k in range(2000))
    centre = next(t for t in salted if signed(t) > max(map(signed, leaves)))  # it names the leaves, they do not name it
    bands = lambda text: np.array([near_copies.majority(near_copies.shingle_hashes(text))], np.uint64).view(np.uint8)
    leaves = [t for t in leaves if (bands(t) == bands(centre)).sum() >= 2]  # candidates
    assert len(leaves) > near_copies.WIDTH + 3
    rows = [(k, t) for k, t in enumerate([*leaves, centre])]
    sets = [near_copies.shingles(t) for _, t in rows]
    linked = {(a, b) for a in range(len(sets)) for b in range(a) if near_copies.similarity(sets[a], sets[b]) >= 0.8}
    assert linked == {(len(leaves), b) for b in range(len(leaves))}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r["doc_id"] for r in near_copies.keep_one(df, radius=40).collect()] == [0]


def test_cut_blocks_meet_all_their_candidates(spark):
    rng = np.random.default_rng(5)
    seeds = rng.integers(-(1 << 62), 1 << 62, 12)
    flips = rng.integers(0, 64, (600, 5))
    fps = [int(seeds[k % 12]) ^ sum({1 << int(b) for b in flips[k] if b < 63}) for k in range(600)]
    names = sorted(int(x) for x in rng.choice(1 << 40, 600, replace=False))
    bands = [[f >> 8 * i & 255 for i in range(8)] for f in fps]
    near = lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 11 and sum(x == y for x, y in zip(bands[a], bands[b])) >= 2
    pairs = {(names[a], names[b]) for a in range(600) for b in range(a) if near(a, b)}
    nodes = spark.createDataFrame(list(zip(names, fps)), "h long, fp long")
    first = {r["h"]: r for r in near_copies.nearest_pairs(nodes, 11, block=16).collect()}
    assert {x for pair in pairs for x in pair} <= first.keys()
    for u in names:
        mine = {b for a, b in pairs if a == u}
        found = {first[u]["v"]} - {None} if u in first else set()
        assert found <= mine and (mine == found or first[u]["more"])
    label = {x: names[k % 12] if k % 5 else x for k, x in enumerate(names)}
    hashes = [rng.integers(0, 1 << 62, n, dtype=np.uint64) for n in (2, 40, 40, 90, 900)]
    held = {x: (len(hashes[k % 5]), near_copies.sketch(hashes[k % 5]).tobytes()) for k, x in enumerate(names)}
    fields = "h long, fp long, label long, start long, n long, sketch binary"
    asked = spark.createDataFrame([(x, f, label[x], -(1 << 63), *held[x]) for x, f in zip(names, fps)], fields)
    bound = lambda a, b: near_copies.least_difference(*[np.frombuffer(held[x][1], np.uint8) for x in (a, b)])
    across = {(a, b) for a, b in pairs if label[a] != label[b] and near_copies.allowed(held[a][0], held[b][0], bound(a, b), 0.8)}
    assert 100 < len(across) < 0.9 * len({(a, b) for a, b in pairs if label[a] != label[b]})
    found, width = set(), 2
    while True:
        made = near_copies.named_pairs(asked, 11, width, block=16).collect()
        assert not found & {(r["u"], r["v"]) for r in made}
        found |= {(r["u"], r["v"]) for r in made}
        start = {r["u"]: r["last"] + 1 for r in made if r["last"] is not None}
        if not start:
            break
        rows = [(x, f, label[x], start.get(x, x), *held[x]) for x, f in zip(names, fps)]
        asked, width = spark.createDataFrame(rows, fields), 16
    assert found == across
