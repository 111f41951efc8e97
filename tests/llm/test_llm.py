"""The operators for training data against brute force and on odd input."""

import glob
import math
import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from arenaflow.llm import leakage, matching, mixing, nearest, quality, queries, runs

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ZONE = "row_id long, match_id long, t double, zone string, red_blocks int, blue_blocks int, rid string, chunk string, fn string"


def greedy(rows, tol, gap=5.0):
    """rows: (key, t, id, a, b) -> {(key, first id): n}"""
    got, cur = {}, None
    for key, t, rid, a, b in sorted(set(rows), key=lambda r: (str(r[0]), r[1], r[2])):
        if cur and cur[0] == key and t - cur[1] <= gap and abs(a - cur[2]) <= tol and abs(b - cur[3]) <= tol:
            cur[1] = t
        else:
            cur = [key, t, a, b, rid]
        got[(key, cur[4])] = got.get((key, cur[4]), 0) + 1
    return got


@pytest.mark.parametrize("tol,chunks,fan", [(1, 1, 256), (1, 7, 256), (2, 25, 4), (0, 9, 2), (30, 12, 3)])
def test_runs_in_chunks(spark, monkeypatch, tol, chunks, fan):
    monkeypatch.setattr(runs, "FAN_IN", fan)
    rng = random.Random(tol)
    rows, level = [], 0
    for k in range(900):  # one hot key holds most rows
        level = max(0, level + rng.choice((-1, 0, 0, 0, 1)))
        rows.append((k, 1, k * 0.9 + 20 * (k // 300), "a", level, rng.choice((0, 0, 0, 1, 2)), "", "", ""))
    rows += [(2000 + k, 2, float(k % 50), "b", k % 3, 0, "", "", "") for k in range(90)]
    rows += [(3000 + k, None, float(k), None, 1, 1, "", "", "") for k in range(5)]
    rows += rows[5:60]  # redelivered
    rows += [(4000, 1, None, "a", 1, 1, "", "", ""), (4001, 1, 3.0, "a", None, 1, "", "", "")]
    got = runs.collapse_runs(spark.createDataFrame(rows, ZONE), ["match_id", "zone"], "t", "row_id", ["red_blocks", "blue_blocks"], tolerance=tol, n_chunks=chunks).collect()
    want = greedy([((r[1], r[3]), r[2], r[0], r[4], r[5]) for r in rows if r[2] is not None and r[4] is not None], tol)
    assert {((r["match_id"], r["zone"]), r["first_row_id"]): r["n_readings"] for r in got} == want
    assert all(r["duration"] >= 0 for r in got)


def test_runs_empty(spark):
    assert runs.collapse_runs(spark.createDataFrame([], ZONE), ["match_id", "zone"], "t", "row_id", ["red_blocks"]).count() == 0


@pytest.mark.parametrize("batch,bucket", [(10_000, 10.0), (3, 2.0), (1, 1.6)])
def test_nearest(spark, batch, bucket):
    rng = random.Random(batch)
    left = [(k, k % 2, round(rng.uniform(-3, 30), 2), 0) for k in range(150)]
    right = [(k, k % 2, round(rng.uniform(-3, 30), 2), 0) for k in range(400)]
    left += left[:9] + [(900, None, 1.0, 0), (901, 1, None, 0), (902, 1, float("nan"), 0)]
    right += right[:30] + [(900, None, 1.0, 0), (901, 1, None, 0)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        kind = "id long, match_id long, t double, side int"
        a, b = spark.createDataFrame(left, kind).withColumnRenamed("id", "l"), spark.createDataFrame(right, kind).withColumnRenamed("id", "r")
        got = sorted((x["l"], x["r"]) for x in nearest.nearest_by_time(a, b, "match_id", "t", "l", "r", bucket_s=bucket).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    want = []
    for rid, m, t, _ in sorted(set(x for x in left if x[1] is not None and x[2] is not None and not math.isnan(x[2]))):
        near = [(round(abs(t - q[2]), 9), q[2], q[0]) for q in set(right) if q[1] == m and q[2] is not None and abs(t - q[2]) <= 0.4 + 1e-9]
        if near:
            want.append((rid, min(near)[2]))
    assert got == want


def test_dense_buckets_are_cut(spark):
    """One entity holds nearly all rows within a few seconds; narrow buckets give the same pairs."""
    rng = random.Random(6)
    a = spark.createDataFrame([(k, "hot", round(rng.uniform(-3, 9), 3)) for k in range(300)] + [(k, "other", k * 0.5) for k in range(300, 320)], "l long, who string, t double")
    b = spark.createDataFrame([(k, "hot", round(rng.uniform(-3, 9), 3)) for k in range(700)] + [(k, "other", k * 0.5 + 0.1) for k in range(300, 320)], "r long, who string, t double")
    pairs = [sorted(map(tuple, nearest.nearest_by_time(a, b, "who", "t", "l", "r", dense_rows=n).collect())) for n in (10**6, 50)]
    assert pairs[0] == pairs[1] and len(pairs[0]) > 300


def test_nearest_empty(spark):
    df = spark.createDataFrame([(1, 1, 1.0)], "l long, match_id long, t double")
    other = df.withColumnRenamed("l", "r")
    for a, b in ((df.limit(0), other), (df, other.limit(0))):
        assert nearest.nearest_by_time(a, b, "match_id", "t", "l", "r").count() == 0


def test_hamming_pairs_are_exact(spark):
    rng = random.Random(3)
    base = [[rng.getrandbits(63), rng.getrandbits(63)] for _ in range(30)]
    near = [[w ^ (1 << rng.randrange(63)) if rng.random() < 0.8 else w for w in b] for b in base]
    kind = "id long, v array<bigint>, g string"
    a = [(k, v, "x" if k % 3 else "y") for k, v in enumerate(base)]
    b = [(k, v, "x" if k % 3 else "y") for k, v in enumerate(near)]
    got = {tuple(r) for r in matching.hamming_pairs(spark.createDataFrame(a, kind), spark.createDataFrame(b, kind), ["g"], 2, 2).collect()}
    want = {(i, j) for i, v, g in a for j, w, h in b if g == h and sum((x ^ y).bit_count() for x, y in zip(v, w)) <= 2}
    assert got == want and len(want) >= 25


TEAM = "struct<team: struct<name: string>>"
OFFICIAL = f"id long, sku string, division string, round int, instance int, matchnum int, alliances array<struct<color: string, score: int, teams: array<{TEAM}>>>, fetched_at timestamp_ntz"
MATCH = "id long, event_id long, video_id string, name string, re_match_id long, red1 string, red2 string, blue1 string, blue2 string, red_score int, blue_score int, ocr_red_score int, ocr_blue_score int, loaded_at timestamp_ntz, score double, sku string"


def league(spark):
    import datetime as dt

    day = dt.datetime(2026, 1, 1)
    rng = random.Random(4)
    team = lambda: f"{rng.randrange(20000, 70000)}{rng.choice('ABCDEFGH')}"
    side = lambda c, s, ts: (c, s, [((t,),) for t in ts])
    off, mat = [], []
    for k in range(60):
        r, b = [team(), team()], [team(), team()]
        for leg in (1, 2):
            rs, bs = rng.randrange(10, 99), rng.randrange(10, 99)
            oid = 100 * k + leg
            off.append((oid, f"S{k // 20}", "D", 6, k + 1, leg, [side("blue", bs, b), side("red", rs, r)], day))
            if leg == 1 or k % 2:
                broken = r[0][:2] + "9" + r[0][3:] if k % 4 == 0 else r[0]
                mat.append((oid, 7 + k // 20 if k % 5 else None, "v", f"R16 {k + 1}-{leg}" if k % 7 else None, None, r[1], broken, b[0].lower(), b[1] if k % 6 else None, None, None, rs, bs if k % 9 else None, day, 1.0, "?"))
    mat += [mat[0], (9999, None, None, None, None, None, None, None, None, None, None, None, None, day, None, None)]
    t = [(7 + k, f"S{k}", day) for k in range(3)]
    return spark.createDataFrame(mat, MATCH), spark.createDataFrame(off, OFFICIAL), spark.createDataFrame(t, "id long, sku string, loaded_at timestamp_ntz")


def test_matches_find_their_records(spark):
    m, o, t = league(spark)
    got = matching.match_official(m, o, t).collect()
    right = [r for r in got if r["match_id"] == r["official_id"]]
    assert len(right) >= 0.97 * 90 and len(got) - len(right) <= 2
    assert all(0 <= r["confidence"] <= 1 for r in got) and min(r["confidence"] for r in right) > 0.5


def test_matches_with_empty_tables(spark):
    m, o, t = league(spark)
    assert matching.match_official(m, o.limit(0), t.limit(0)).count() == 0
    assert matching.match_official(m.limit(0), o, t).count() == 0


def test_candidates_hold_every_pair_with_enough_agreeing_fields(spark):
    """Damage in both alliances, and a tournament that is right, null or wrong: the pairs that brute force scores well are candidates."""
    rng = random.Random(11)
    fields = "id long, sku string, name string, r1 string, r2 string, b1 string, b2 string, rs int, bs int, known boolean"
    right, left = [], []
    for k in range(90):
        rec = [f"Q{k % 30 + 1}", *[f"{rng.randrange(20000, 70000)}{rng.choice('ABCDEFGH')}" for _ in range(4)], rng.randrange(10, 99), rng.randrange(10, 99)]
        right.append((k, f"S{k % 3}", *rec, True))
        seen = list(rec)
        one, two = rng.choice((1, 2)), rng.choice((3, 4))
        for at in (one, two) if k % 5 else (1, 2, 3, 4):  # every fifth has all four teams misread
            seen[at] = None if k % 5 and rng.random() < 0.5 else seen[at][:1] + "X" + seen[at][2:4] + "Y" + seen[at][5:]
        if k % 5 and k % 2:
            seen[0] = None
        left.append((k, (f"S{k % 3}", None, f"S{(k + 1) % 3}")[k // 3 % 3], *seen, True))
    left, right = [matching._profiles(spark.createDataFrame(x, fields)) for x in (left, right)]
    every = left.select(F.col("id").alias("lid")).crossJoin(right.select(F.col("id").alias("rid")))
    good = {(r["lid"], r["rid"]) for r in matching.field_scores(every, left, right).where("score >= 0.6").collect()}
    got = {tuple(r) for r in matching.candidates(left, right).collect()}
    assert len(good) > 60 and good <= got
    assert {(k, k) for k in range(90)} <= got


def test_colours_mixed_up(spark):
    """Every fourth match holds its sides the other way round from its record."""
    m, o, t = league(spark)
    flip = F.col("id") % 4 == 1
    swapped = m.select(*[c for c in m.columns if "red" not in c and "blue" not in c], *[F.when(flip, F.col(b)).otherwise(F.col(a)).alias(a) for x, y in (("red", "blue"), ("blue", "red")) for a, b in [(p.format(x), p.format(y)) for p in ("{}1", "{}2", "{}_score", "ocr_{}_score")]])
    got = matching.match_official(swapped, o, t).collect()
    right = [r for r in got if r["match_id"] == r["official_id"]]
    assert len(right) >= 0.95 * 90 and all(r["swapped"] == (r["match_id"] % 4 == 1) for r in right)


def test_copies_are_compared_once(spark):
    """A third of all matches are one record under many ids: each gets its result, from one comparison."""
    m, o, t = league(spark)
    one = m.where("id = 101").limit(1)
    many = m.unionByName(spark.range(20_000, 20_400).crossJoin(one.drop("id")).select(m.columns))
    records, members = matching.distinct_records(matching.match_profiles(many, t), ["known", "re_match_id"])
    assert members.count() == 491 and records.count() <= 91 and records.agg(F.sum("n")).first()[0] == 491
    got = {r["match_id"]: (r["official_id"], round(r["score"], 9)) for r in matching.match_official(many, o, t).collect()}
    assert {got[k] for k in range(20_000, 20_400)} == {got[101]} and got[101][0] == 101


def test_confidence_without_bare_records():
    """Where every record has some candidate, the low scores tell how many have no partner."""
    rng = np.random.default_rng(0)
    wrong = np.histogram(rng.beta(8, 12, 1000), 50, (0, 1))[0].astype(float)
    best = np.histogram(np.r_[rng.beta(30, 2, 600), rng.beta(8, 12, 500)], 50, (0, 1))[0].astype(float)
    c = matching.fit_confidence(wrong, best, 1000, 1100)
    assert (np.diff(c) >= 0).all() and c[25] < 0.3 and c[47] > 0.95


def test_confidence_is_calibrated():
    rng = np.random.default_rng(0)
    wrong = np.histogram(rng.beta(8, 8, 400), 50, (0, 1))[0].astype(float)
    best = np.histogram(np.r_[rng.beta(30, 2, 900), rng.beta(8, 8, 80)], 50, (0, 1))[0].astype(float)
    c = matching.fit_confidence(wrong, best, 1000, 1100)
    assert (np.diff(c) >= 0).all() and c[20] < 0.3 and c[47] > 0.95


@pytest.mark.parametrize("every", [3, 4])
def test_leak_with_dense_errors_is_found(spark, every):
    item = [f"word{k}" for k in range(60)]
    leak = [w if k % every else f"other{k}" for k, w in enumerate(item, 1)]
    docs = spark.createDataFrame([(1, " ".join(["before"] * 5 + leak + ["after"] * 5)), (2, "nothing of it " * 20)], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in leakage.leaked_items(docs, items).collect()] == [(1, 7)]


@pytest.mark.parametrize("every", [2, 3, 5])
@pytest.mark.parametrize("kind", ["altered", "added", "dropped", "mixed"])
def test_leak_with_errors_of_any_kind(spark, every, kind):
    rng = random.Random(every)
    item = [f"word{k}" for k in range(60)]
    leak = []
    for k, w in enumerate(item, 1):
        how = rng.choice(("altered", "added", "dropped")) if kind == "mixed" else kind
        leak += [w] if k % every else [f"other{k}"] if how == "altered" else [w, f"other{k}"] if how == "added" else []
    want = leakage.aligned_stretches(item, leak, 12)
    docs = spark.createDataFrame([(1, " ".join(["before"] * 5 + leak + ["after"] * 5))], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = leakage.leaked_items(docs, items).collect()
    assert len(got) == 1 and abs(got[0]["share"] - sum(e[0] for e in want) / 60) < 1e-9 and got[0]["share"] >= 0.49


def stretches_by_trying_all(item, doc, least):
    """The most words in stretches, by recursion over every choice."""
    import functools

    @functools.lru_cache(None)
    def best(i, j, n):  # the stretch now has n words and ended at item word i, document word j
        top = 0 if n >= least else -(10**6)
        for di, dj in leakage.MOVES:
            if i + di < len(item) and j + dj < len(doc) and item[i + di] == doc[j + dj]:
                top = max(top, 1 + best(i + di, j + dj, min(n + 1, least)))
        if n >= least:
            top = max(top, fresh(i + 1, j + 1))
        return top

    @functools.lru_cache(None)
    def fresh(i, j):
        top = 0
        for a in range(i, len(item)):
            for b in range(j, len(doc)):
                if item[a] == doc[b]:
                    top = max(top, 1 + best(a, b, 1))
        return top

    return fresh(0, 0)


def test_alignment_takes_the_best_stretches():
    rng = random.Random(8)
    for _ in range(120):
        item, doc = [[rng.choice("abc") for _ in range(rng.randrange(4, 11))] for _ in range(2)]
        chain = leakage.aligned_stretches(item, doc, 3)
        assert sum(e[0] for e in chain) == stretches_by_trying_all(tuple(item), tuple(doc), 3)
        assert all(a[2] <= b[1] and a[4] <= b[3] for a, b in zip(chain, chain[1:])) and all(e[0] >= 3 for e in chain)


@pytest.mark.parametrize("shard", [90, 400, 100_000])
def test_leaks_equal_brute_force(spark, monkeypatch, shard):
    """Few words, so that chance stretches abound: candidates lose none of what the alignment of every document with every item finds."""
    monkeypatch.setattr(leakage, "HITS_AT_ONCE", 500)
    monkeypatch.setattr(leakage, "ITEMS_PER_BLOCK", 10 if shard == 400 else 5_000)
    rng = random.Random(shard)
    few = [a + b for a in "bdfg" for b in "aeiou"]
    items = {k: [rng.choice(few) for _ in range(rng.randrange(12, 40))] for k in range(25)}
    docs = {k: [rng.choice(few) for _ in range(rng.randrange(5, 200))] for k in range(60)}
    for k in range(0, 60, 2):
        it = items[k % 25]
        a = rng.randrange(0, max(len(it) - 16, 1))
        part = [w for w in it[a : a + rng.randrange(14, 30)] if rng.random() < 0.9]
        docs[k][3:3] = part
    got = {(r["doc_id"], r["item_id"]): r["share"] for r in leakage.leaked_items(
        spark.createDataFrame([(k, " ".join(w)) for k, w in docs.items()], "doc_id long, text string"),
        spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string"), shard_words=shard,
    ).collect()}
    want = {(d, i): sum(e[0] for e in leakage.aligned_stretches(v, w, 12)) / len(v) for d, w in docs.items() for i, v in items.items()}
    want = {k: s for k, s in want.items() if s >= 1 / 3 - 1e-9}
    assert len(want) > 15 and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_places_of_words_in_the_text():
    for text in ("Déjà-VU, l’école ﬁn­!", "Plain text, isn't it?", "ＦＵＬＬ ｗｉｄｔｈ ´acute Ǆ İstanbul ß", " \t\n", ""):
        assert [leakage.words_of(text[a:b]) for a, b in leakage.word_places(text)] == [[w] for w in leakage.words_of(text)]


def test_confidence_has_no_switch_by_size():
    best = np.zeros(50)
    best[[12, 15, 30, 45]] = 5, 10, 20, 40
    wrong = np.zeros(50)
    wrong[[12, 15]] = 20, 40
    curves = [matching.fit_confidence(wrong, best, n, 90) for n in (98, 99, 100, 101)]
    assert max(np.abs(a - b).max() for a, b in zip(curves, curves[1:])) < 0.02


def test_fm_index_finds_all():
    rng = np.random.default_rng(0)
    s = rng.integers(1, 5, 800)
    fm = leakage.FMIndex(s, 5)
    for p in rng.integers(1, 5, (60, 3)):
        lo, hi = fm.search(p[None])
        assert sorted(fm.locate(np.arange(lo[0], hi[0])).tolist()) == [i for i in range(798) if (s[i : i + 3] == p).all()]
    assert (leakage.suffix_array(np.array([2, 1, 2, 1, 0])) == [4, 3, 1, 2, 0]).all()


WORDS = [a + b for a in "ba de fi go hu ka le mi no pu".split() for b in "ra se ti vo lu ne".split()]


def test_leaks(spark):
    rng = random.Random(5)
    text = lambda n: [rng.choice(WORDS) for _ in range(n)]
    items = {k: text(60) for k in range(6)}
    docs = {k: text(150) for k in range(12)}
    noisy = items[0][:30].copy()
    noisy[8], noisy[19] = "xx", "yy"
    docs[0][40:40] = noisy
    docs[1][10:10] = items[1][5:17] + text(20) + items[1][30:42]  # two stretches in order: 24 of 60 words
    docs[2][10:10] = items[2][30:42] + text(20) + items[2][5:17]  # out of order
    docs[3][10:10] = items[3][:11] + text(9) + items[3][20:31]  # too short
    docs[4][0:0] = [w.upper() + "," for w in items[4]]
    rows = [(k, " ".join(v)) for k, v in docs.items()] + [(4, " ".join(docs[4])), (50, None), (51, ""), (52, " \n"), (None, " ".join(items[5])), (53, "a " * 60_000 + " ".join(items[5]))]
    d = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, spans string")
    it = spark.createDataFrame([(k, " ".join(v)) for k, v in items.items()] + [(90, None), (91, "short one")], "item_id long, text string")
    found = leakage.leaked_items(d, it, shard_words=700)
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(0, 0), (1, 1), (4, 4), (53, 5)]
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in leakage.removal_spans(found).collect()}
    assert len(spans[1]) == 2 and spans[4] == [(0, 60)]
    assert leakage.leaked_items(d.limit(0), it).count() == 0 and leakage.leaked_items(d, it.limit(0)).count() == 0


def test_words_of_any_form():
    assert leakage.words_of("Déjà-VU, l’école ﬁn­!") == leakage.words_of("déjà vu; l'ecole fin") == ["deja", "vu", "lecole", "fin"]


def test_cube_keeps_totals():
    rng = random.Random(1)
    size = [float(rng.randrange(5, 400)) for _ in range(500)]
    prob = [0.37] * 500
    p = mixing.landing(mixing.flight(prob, size, rng), size)
    assert set(p) <= {0.0, 1.0}
    assert abs(sum(p) - 185) <= 2 and abs(sum(a * b for a, b in zip(p, size)) - 0.37 * sum(size)) <= 400
    means = np.mean([mixing.landing(mixing.flight([0.3] * 20, size[:20], random.Random(k)), size[:20]) for k in range(400)], axis=0)
    assert np.abs(means - 0.3).max() < 0.12


def test_mixture_shares(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 60)
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(5, 60))), rng.choice(["Web ", "web", "news", "small"]) if k % 40 else "small", 1) for k in range(1200)]
    rows += [(5000, None, "web", 1), (5001, "", "web", 1), (5002, "text", None, 1), (None, "text", "web", 1), rows[0]]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, p int")
    t = spark.createDataFrame([("web", 0.5, 1), ("news", 0.2, 2), ("SMALL", 0.25, 3), ("none", 0.05, 2), (None, 0.1, 1)], "source string, target_share double, max_repeat int")
    used, report = mixing.mixture(d, t)
    most = {"web": 1, "news": 2, "small": 3}
    u = used.toPandas()
    assert u.doc_id.is_unique and all(c <= most[s] for s, c in zip(u.source, u.copies))
    r = report.toPandas().set_index("source")
    for s in most:
        assert abs(r.mixed_tokens[s] - r.target_tokens[s]) < 150
    assert r.mixed_tokens["none"] == 0 and r.shortfall_tokens["none"] == r.target_tokens["none"] and abs(r.actual_share.sum() - 1) < 1e-9
    short = mixing.mixture(d, t, total_tokens=10**6)[1].toPandas().set_index("source")
    assert (short.shortfall_tokens > 0).all() and short.mixed_tokens["small"] == 3 * short.available_tokens["small"]
    for a, b in ((d.limit(0), t), (d, t.limit(0))):
        used, report = mixing.mixture(a, b)
        assert used.count() == 0 and report.agg(F.sum("mixed_tokens")).first()[0] in (None, 0)


def test_many_target_sources(spark, monkeypatch):
    """As many targets as do not fit a broadcast, one of which bounds the total."""
    from arenaflow.llm import mixing as module

    monkeypatch.setattr(module, "fits_broadcast", lambda df: False)
    d = spark.range(3000).selectExpr("id AS doc_id", "repeat('some words of a text ', int(1 + id % 5)) AS text", "concat('s', id % 300) AS source")
    t = spark.range(310).selectExpr("concat('S', id) AS source", "1 / 310 AS target_share", "int(if(id = 0, 1, 3)) AS max_repeat")
    used, report = mixing.mixture(d, t)
    r = report.toPandas().set_index("source")
    assert len(r) == 310 and (r.available_docs > 0).sum() == 300 and r.limits_total.sum() >= 1 and r.limits_total["s0"]
    there = r[r.available_docs > 0]
    assert (abs(there.mixed_tokens - there.target_tokens) <= 30).all() and used.where("copies > 3").count() == 0


PROSE = ["The committee met in the old hall and nobody knew what the report would say about the bridge.", "When the music stopped, she asked whether the window was open and he said that it was not.", "After a while they went home, because there was nothing else to do on that day."]


def test_prose_and_junk(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice(PROSE) for _ in range(rng.randrange(1, 9))), "x") for k in range(300)]
    rows += [(1000, "- apples\n- pears, 3\n- plums\n- nuts\n- figs", "x"), (1001, "a\tb\tc\n1\t2\t3\n4\t5\t6\n7\t8\t9", "x"), (1002, "xkcd qwrt zzpf mnbv lkjh " * 4, "x"), (1003, "@#$ %^& *() 88|| <<>> ~~ ^^ " * 4, "x"), (1004, "\n".join(PROSE).upper(), "x")]
    rows += [(2000, None, "x"), (2001, "", "x"), (2002, " \n\t", "x"), (2003, PROSE[0] * 5000, "x"), (2004, "7", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    q = quality.text_quality(df).toPandas().set_index("doc_id")
    assert q.is_prose[q.index < 300].all() and q.is_prose[1004] and q.is_prose[2003]
    assert not q.is_prose[[1000, 1001, 1002, 1003]].any()
    assert not set(q.index) & {2000, 2001, 2002} and 2004 in q.index
    parts = q[[f"{s}_part" for s in quality.STATS]].sum(axis=1)
    assert np.allclose(parts, q.distance2)
    assert quality.text_quality(df.limit(0)).count() == 0


def stats_of(spark, x, length=100, language="en"):
    cols = ["n_chars", "n_words", "n_lines", *quality.STATS]
    rows = [(k, language, 5 * length, length, 9, *map(float, r)) for k, r in enumerate(x)]
    return spark.createDataFrame(rows, "doc_id long, language string, " + ", ".join(f"{c} {'long' if c[:2] == 'n_' else 'double'}" for c in cols))


def test_correlation_decides(spark, monkeypatch):
    """A document whose two statistics are usual each but not together is found by the covariance, and lost without it."""
    rng = np.random.default_rng(3)
    x = rng.normal(0, 0.01, (1500, len(quality.STATS)))
    z = rng.normal(size=1500)
    x[:, 0], x[:, 1] = 0.4 + 0.1 * z + rng.normal(0, 0.01, 1500), 5 + z + rng.normal(0, 0.1, 1500)
    x[0, :2] = 0.4 + 0.22, 5 - 2.2
    stats = stats_of(spark, x)
    far = lambda: {r["doc_id"] for r in quality.with_distance(stats, quality.prose_models(stats)).where(f"distance2 > {quality.LIMIT}").collect()}
    assert 0 in far() and len(far()) < 8
    monkeypatch.setattr(quality, "correlation", lambda cov: np.eye(len(cov)))
    assert 0 not in far()


def test_noise_of_short_texts_is_estimated():
    """Statistics that are means over the length: the split finds the shared variance and that of one unit."""
    rng = np.random.default_rng(4)
    length = rng.integers(5, 300, (40_000, len(quality.STATS))).astype(float)
    x = rng.normal(0, 0.1, length.shape) + rng.normal(0, 1, length.shape) / np.sqrt(length)
    mean, shared, noise = quality._Sums.model(quality._Sums.of(x, length), np.zeros(len(quality.STATS)))
    assert np.abs(mean).max() < 0.01 and np.abs(np.diag(shared) - 0.01).max() < 0.002 and np.abs(noise - 1).max() < 0.1


def test_a_further_language_is_judged_by_its_own_documents(spark):
    rng = random.Random(9)
    base = "il comitato si riunisce nella vecchia sala mentre nessuno sapeva cosa direbbe la relazione sul ponte della citta".split()
    text = lambda n: " ".join(rng.choice(base) for _ in range(n)) + "."
    rows = [(k, "it-IT", " ".join(text(14) for _ in range(rng.randrange(2, 8)))) for k in range(150)]
    rows += [(1000 + k, rng.choice(("en", "eng", "DE", "und", None)), " ".join(rng.choice(PROSE) for _ in range(rng.randrange(2, 8)))) for k in range(300)]
    rows += [(5000, "it", "- uno\n- due\n- tre 3\n- quattro\n- cinque")]
    q = quality.text_quality(spark.createDataFrame(rows, "doc_id long, lang string, text string")).toPandas().set_index("doc_id")
    assert set(q.language[q.index < 150]) == {"it"} and set(q.language[(q.index >= 1000) & (q.index < 5000)]) == {"en"}
    assert q.is_prose[q.index < 5000].mean() > 0.99 and not q.is_prose[5000]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = queries.QUERIES[name](spark, SF)
    q = con.execute(queries.SQL[name])
    columns = [c[0] for c in q.description]
    want = sorted(tuple(r[columns.index(c)] for c in df.columns) for r in q.fetchall())
    assert sorted(tuple(r) for r in df.collect()) == want
