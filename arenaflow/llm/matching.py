"""Problem 5: match records of two sources that share no key, by partial and noisy attributes.

Every attribute's q-grams are set as bits of a fixed-width vector. Close pairs
come from multi-index Hamming hashing: vectors within r bits agree exactly on
at least one of r + 1 disjoint sets of bit positions, so an equi-join on each
set finds all of them and counting the bits of the exclusive or keeps just
them. Whole records and alliances are searched so, within a tournament with a
wider radius than among those without one; equal fields, vectors at distance 0,
are joined by key: one of them within a tournament, two of them anywhere.
Candidates get Dice scores per field, either way round of the colours, a
weighted mean of the fields present, and from that a confidence fitted on the
records that are already matched. Exact copies are compared once.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.orphans import latest_versions
from ..runtime import materialize, union_all

#: Weights of the fields in the mean score.
WEIGHTS = {"red": 3.0, "blue": 3.0, "name": 4.0, "red_score": 3.0, "blue_score": 3.0, "tournament": 1.0}

# Letters that text recognition confuses with digits, and round names.
CONFUSED = ("OQDILSBZ", "00011582")
LONG_ROUNDS = (("QUALIFICATION", "Q"), ("QUALS", "Q"), ("QUAL", "Q"), ("PRACTICE", "P"), ("QUARTERFINAL", "QF"), ("SEMIFINAL", "SF"), ("FINAL", "F"))


def canon_team(c: Column) -> Column:
    """Upper case without white space, confusable letters as digits but for the last letter of a full number; blank becomes null."""
    u = F.upper(F.regexp_replace(c, r"\s+", ""))
    full = F.length(u) >= 6
    body = F.when(full, F.substring(u, 1, 5)).otherwise(u)
    out = F.concat(F.translate(body, *CONFUSED), F.when(full, u.substr(F.lit(6), F.lit(99))).otherwise(F.lit("")))
    return F.when(u != "", out)


def canon_name(c: Column) -> Column:
    """Match name as round code and digits: upper case, letters and digits only, long round names shortened, confusable letters after the code as digits; blank becomes null."""
    u = F.regexp_replace(F.upper(c), "[^A-Z0-9]", "")
    for long, short in LONG_ROUNDS:
        u = F.regexp_replace(u, f"^{long}", short)
    code = F.regexp_extract(u, "^(QF|SF|Q|R|P|F)", 1)
    rest = F.translate(u.substr(F.length(code) + 1, F.lit(99)), *CONFUSED)
    return F.when(u != "", F.concat(code, rest))


def official_name(round_: Column, instance: Column, matchnum: Column) -> Column:
    """Canonical name of an official record; rounds are coded 1 P, 2 Q, 3 QF, 4 SF, 5 F, 6 R16."""
    code = F.element_at(F.create_map(*[F.lit(x) for kv in {1: "P", 2: "Q", 3: "QF", 4: "SF", 5: "F", 6: "R16"}.items() for x in kv]), round_)
    num = F.coalesce(matchnum, F.lit(0)).cast("string")
    return F.when(round_.isin(1, 2), F.concat(code, num)).otherwise(F.concat(code, F.coalesce(instance, F.lit(1)).cast("string"), num))


def grams(c: Column, tag: str | Column = "", q: int = 2) -> Column:
    """The q-grams of a string with its ends marked; null gives none."""
    s = F.concat(F.lit("^" * (q - 1)), c, F.lit("$" * (q - 1)))
    tag = F.lit(tag) if isinstance(tag, str) else tag
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - (q - 1), F.lit(1))), lambda i: F.concat(tag, s.substr(i, F.lit(q))))
    )


def bit_vector(items: Column, words: int) -> Column:
    """The set of strings as an array of `words` longs, one bit each by hash."""
    at = F.transform(items, lambda x: F.pmod(F.xxhash64(x), F.lit(64 * words)).cast("int"))
    one = F.lit(1).cast("long")

    def word(w: int) -> Column:
        mine = F.filter(at, lambda b: F.shiftright(b, 6) == w)
        return F.aggregate(mine, F.lit(0).cast("long"), lambda acc, b: acc.bitwiseOR(F.call_function("shiftleft", one, b.bitwiseAND(F.lit(63)))))

    return F.array(*[word(w) for w in range(words)])


def bits(v: Column, words: int) -> Column:
    return sum((F.bit_count(v[w]) for w in range(words)), F.lit(0))


def shared_bits(a: Column, b: Column, words: int) -> Column:
    return sum((F.bit_count(a[w].bitwiseAND(b[w])) for w in range(words)), F.lit(0))


def hamming_pairs(left: DataFrame, right: DataFrame, block: list[str], words: int, radius: int) -> DataFrame:
    """(lid, rid) of all pairs of equal block whose vectors v differ in at most `radius` bits. Both sides: id, v and the block columns, none null."""

    def tables(df: DataFrame, name: str) -> DataFrame:
        keys = []
        for part in range(radius + 1):
            masks = [sum(1 << b for b in range(64) if (64 * w + b) % (radius + 1) == part) for w in range(words)]
            masks = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
            keys.append(F.struct(F.lit(part).alias("part"), F.xxhash64(F.lit(part), *[F.col("v")[w].bitwiseAND(F.lit(m).cast("long")) for w, m in enumerate(masks)]).alias("key")))
        return df.withColumn("k", F.explode(F.array(*keys))).select(F.col("id").alias(name), F.col("v").alias(f"{name}_v"), *block, "k.part", "k.key")

    pairs = tables(left, "lid").join(tables(right, "rid"), [*block, "part", "key"])
    apart = sum((F.bit_count(F.col("lid_v")[w].bitwiseXOR(F.col("rid_v")[w])) for w in range(words)), F.lit(0))
    return pairs.where(apart <= radius).select("lid", "rid").distinct()


#: What tells one record from another; records equal in all of it are copies.
FIELDS = ["sku", "name", "r1", "r2", "b1", "b2", "rs", "bs"]


def _profiles(df: DataFrame) -> DataFrame:
    """Adds the vectors of the fields: df has id and FIELDS, teams and name canonical. Sides are told apart by the fields only, so that records with their colours mixed up lie close to each other."""
    red, blue = F.concat(grams(F.col("r1")), grams(F.col("r2"))), F.concat(grams(F.col("b1")), grams(F.col("b2")))
    whole = F.concat(red, blue, grams(F.col("name"), "n"))
    return df.withColumns({"red_v": bit_vector(red, 2), "blue_v": bit_vector(blue, 2), "all_v": bit_vector(whole, 4), "name_v": bit_vector(grams(F.col("name")), 1)})


def match_profiles(matches: DataFrame, tournaments: DataFrame) -> DataFrame:
    """One row per match id, with its tournament's sku where event_id leads to one. Of rows with one id the last loaded counts."""
    cols = ["event_id", "name", "re_match_id", "red1", "red2", "blue1", "blue2", "red_score", "blue_score", "ocr_red_score", "ocr_blue_score"]
    one = latest_versions(matches.where("id IS NOT NULL"), "id", cols)
    sku = latest_versions(tournaments.where("id IS NOT NULL"), "id", ["sku"]).select(F.col("id").alias("event_id"), F.col("sku").alias("t_sku"), F.lit(True).alias("known"))
    one = one.join(sku, "event_id", "left")
    return (
        one.select(
            "id", "re_match_id", F.when(F.trim("t_sku") != "", F.trim("t_sku")).alias("sku"), F.coalesce("known", F.lit(False)).alias("known"), canon_name(F.col("name")).alias("name"),
            *[canon_team(F.col(c)).alias(a) for c, a in (("red1", "r1"), ("red2", "r2"), ("blue1", "b1"), ("blue2", "b2"))],
            F.coalesce("red_score", "ocr_red_score").alias("rs"), F.coalesce("blue_score", "ocr_blue_score").alias("bs"),
        )
    )


def official_profiles(official: DataFrame) -> DataFrame:
    """One row per official id, of the latest fetch; an alliance's first two teams count, whatever the order of colours."""
    one = latest_versions(official.where("id IS NOT NULL"), "id", ["sku", "round", "instance", "matchnum", "alliances"], "fetched_at")

    def side(colour: str) -> Column:
        return F.filter(F.col("alliances"), lambda a: F.lower(a["color"]) == colour)

    def team(colour: str, i: int) -> Column:
        return canon_team(F.get(F.get(side(colour), F.lit(0))["teams"], F.lit(i))["team"]["name"])

    return (
        one.select(
            "id", F.when(F.trim("sku") != "", F.trim("sku")).alias("sku"), official_name(F.col("round"), F.col("instance"), F.col("matchnum")).alias("name"),
            team("red", 0).alias("r1"), team("red", 1).alias("r2"), team("blue", 0).alias("b1"), team("blue", 1).alias("b2"),
            F.get(side("red"), F.lit(0))["score"].alias("rs"), F.get(side("blue"), F.lit(0))["score"].alias("bs"),
        )
    )


def distinct_records(df: DataFrame, also: list[str]) -> tuple[DataFrame, DataFrame]:
    """(records, members): of rows equal in FIELDS and `also` one record with the least id and their number n; (id, copy, `also`) of every row, copy being the key of its record."""
    cols = [*FIELDS, *also]
    keyed = materialize(df.withColumn("copy", F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)), "keyed")
    records = keyed.groupBy("copy").agg(F.min("id").alias("id"), F.count("*").alias("n"), *[F.first(c).alias(c) for c in cols])
    return records, keyed.select("id", "copy", *also)


def agreement_keys(df: DataFrame, name: str) -> DataFrame:
    """(name, key, weak): a record's agreements that prove a pair worth scoring, whichever side holds which colour.

    Within a tournament one undamaged field is enough: a team, the name or both
    scores; whatever the tournament, two teams, or both scores and a team or the
    name. Where a side has no tournament also (weak) a team and the name; across two
    known tournaments these agree by chance too often. What is null gives no key.
    """
    teams = [F.col(c) for c in ("r1", "r2", "b1", "b2")]
    low, high = F.least("rs", "bs"), F.greatest("rs", "bs")  # of two numbers
    both = F.col("rs").isNotNull() & F.col("bs").isNotNull()

    def key(kind: str, *parts: Column, weak: bool = False) -> Column:
        there = F.lit(True)
        for p in parts:
            there = there & p.isNotNull()
        return F.when(there, F.struct(F.xxhash64(F.lit(kind), *parts).alias("key"), F.lit(weak).alias("weak")))

    def scored(k: Column) -> Column:
        return F.when(both, k)

    name_, sku = F.col("name"), F.col("sku")
    keys = [scored(key("name, scores", name_, low, high)), key("tournament, name", sku, name_), scored(key("tournament, scores", sku, low, high))]
    for i, team in enumerate(teams):
        keys += [key("team, name", team, name_, weak=True), scored(key("team, scores", team, low, high)), key("tournament, team", sku, team)]
        for mate in teams[i + 1 :]:
            keys.append(F.when(team.isNotNull() & mate.isNotNull(), key("teams", F.least(team, mate), F.greatest(team, mate))))
    return df.select(F.col("id").alias(name), "sku", F.inline(F.array_distinct(F.array_compact(F.array(*keys)))))


def candidates(left: DataFrame, right: DataFrame, wide: int = 12, near: int = 4, loose: int = 6) -> DataFrame:
    """(lid, rid): whole records within `wide` bits in one tournament, and within `loose` bits where neither has one; alliances within `near` bits in one tournament; and pairs with an agreement key. No record meets all others of its tournament."""

    def wholes(df: DataFrame) -> DataFrame:
        return df.where("coalesce(name, r1, r2, b1, b2) IS NOT NULL").select("id", F.col("all_v").alias("v"), F.coalesce(F.col("sku"), F.lit("")).alias("sku"))

    def alliances(df: DataFrame) -> DataFrame:
        return union_all([df.where(f"sku IS NOT NULL AND {c} IS NOT NULL").select("id", F.col(f"{side}_v").alias("v"), "sku") for side, c in (("red", "coalesce(r1, r2)"), ("blue", "coalesce(b1, b2)"))])

    a, b = agreement_keys(left, "lid"), agreement_keys(right, "rid").withColumnRenamed("sku", "r_sku")
    strong = a.where("NOT weak").join(b.where("NOT weak").drop("weak"), "key").select("lid", "rid")
    weak = [a.where(f"weak AND sku {x}").join(b.where(f"weak {y}").drop("weak"), "key").select("lid", "rid") for x, y in (("IS NULL", ""), ("IS NOT NULL", "AND r_sku IS NULL"))]
    here, nowhere = ([wholes(df).where(f"sku {op} ''") for df in (left, right)] for op in ("<>", "="))
    return union_all([strong, *weak, hamming_pairs(*here, ["sku"], 4, wide), hamming_pairs(*nowhere, ["sku"], 4, loose), hamming_pairs(alliances(left), alliances(right), ["sku"], 2, near)]).distinct()


def field_scores(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """pairs with a score in 0..1 per field of WEIGHTS (null where a side lacks it), their weighted mean as score, and swapped: whether they agree better with the colours of one side mixed up."""
    cols = [*FIELDS, "red_v", "blue_v", "name_v"]
    both = (
        pairs.join(left.select(F.col("id").alias("lid"), F.col("known"), *[F.col(c).alias(f"l_{c}") for c in cols]), "lid")
        .join(right.select(F.col("id").alias("rid"), *[F.col(c).alias(f"r_{c}") for c in cols]), "rid")
    )

    def dice(v: str, w: str, words: int, teams: tuple[tuple[str, str], ...] = ()) -> Column:
        """Dice of two bit vectors; where a side lacks a team, the share of the smaller vector."""
        a, b = F.col(f"l_{v}"), F.col(f"r_{w}")
        n, m, both_ = bits(a, words), bits(b, words), shared_bits(a, b, words)
        lacking = F.lit(False)
        for t, u in teams:
            lacking = lacking | F.col(f"l_{t}").isNull() | F.col(f"r_{u}").isNull()
        return F.when((n > 0) & (m > 0), F.when(lacking, both_ / F.least(n, m)).otherwise(2.0 * both_ / (n + m)))

    def near_score(c: str, d: str) -> Column:
        """1 for equal scores, 0.4 for scores one digit apart."""
        a, b = F.col(f"l_{c}"), F.col(f"r_{d}")
        return F.when(a.isNotNull() & b.isNotNull(), F.when(a == b, 1.0).when(F.levenshtein(a.cast("string"), b.cast("string")) <= 1, 0.4).otherwise(0.0))

    tournament = F.when(F.col("l_sku").isNotNull() & F.col("r_sku").isNotNull(), (F.col("l_sku") == F.col("r_sku")).cast("double")).when(
        F.col("known") & (F.col("l_sku").isNull() != F.col("r_sku").isNull()), 0.0
    )
    sides = (("red", "r1", "r2", "rs"), ("blue", "b1", "b2", "bs"))
    plain = {"name": F.when(F.col("l_name") == F.col("r_name"), 1.0).otherwise(0.8 * dice("name_v", "name_v", 1) ** 2), "tournament": tournament}
    for tag, order in (("s_", (0, 1)), ("x_", (1, 0))):
        for (c, *mine, score), k in zip(sides, order):
            d, *theirs, other = sides[k]
            plain[f"{tag}{c}"] = dice(f"{c}_v", f"{d}_v", 2, tuple(zip(mine, theirs)))
            plain[f"{tag}{c}_score"] = near_score(score, other)
    both = both.withColumns(plain)
    total = sum(WEIGHTS.values())

    def mean(tag: str) -> Column:
        field = {f: F.col(f if f in plain else tag + f) for f in WEIGHTS}
        there = sum((F.when(c.isNotNull(), WEIGHTS[f]).otherwise(0.0) for f, c in field.items()), F.lit(0.0))
        agreed = sum((F.coalesce(c, F.lit(0.0)) * WEIGHTS[f] for f, c in field.items()), F.lit(0.0))
        # Of what is missing nothing is known; it counts as half agreed with a small weight, so that one agreeing field is no proof.
        return (agreed + 0.5 * 0.2 * (total - there)) / (there + 0.2 * (total - there))

    both = both.withColumns({"s_all": mean("s_"), "x_all": mean("x_")}).withColumn("swapped", F.col("x_all") > F.col("s_all"))
    picked = [F.col(f).alias(f) if f in plain else F.when(F.col("swapped"), F.col(f"x_{f}")).otherwise(F.col(f"s_{f}")).alias(f) for f in WEIGHTS]
    return both.select("lid", "rid", *picked, F.greatest("s_all", "x_all").alias("score"), "swapped")


def fit_confidence(wrong: np.ndarray, best: np.ndarray, n_known: int, n_open: int, least: int = 100) -> np.ndarray:
    """Confidence per score bin. wrong: counts per bin of the best wrong candidate of the n_known records whose partner is known; best: of the best candidate of the n_open others.

    A record without a partner shows its best wrong candidate, or none. Wrong
    candidates are spread as among the known records, so at any score the share
    of open records without a better candidate, over that of known records,
    bounds the share that have no partner from above. The least such bound, over
    scores that at least 5 % of the known records stay below, tells how many wrong
    ones each bin holds. The share of right ones per bin, made monotone by pooling
    adjacent bins, is the confidence, averaged with a fixed curve that weighs as
    much as `least` known records, so that it fades with their number.
    """
    x = (np.arange(len(best)) + 0.5) / len(best)
    prior = 1 / (1 + np.exp(-40 * (x - 0.68)))
    if not n_known or not best.sum():
        return prior
    below_known = (n_known - wrong.sum() + np.r_[0, np.cumsum(wrong)]) / n_known
    below_open = (n_open - best.sum() + np.r_[0, np.cumsum(best)]) / max(n_open, 1)
    enough = below_known >= 0.05
    lone = min(1.0, (below_open[enough] / below_known[enough]).min())
    false = lone * n_open * (wrong + 0.02) / n_known
    # Pool adjacent violators, from the lowest score on.
    blocks: list[list[float]] = []
    for n, f in zip(best, false):
        blocks.append([max(n - f, 0.0), max(n, f), 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] > blocks[-1][0] * blocks[-2][1]:
            g, n_, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + g, blocks[-1][1] + n_, blocks[-1][2] + k]
    fitted = np.concatenate([np.full(k, g / n_ if n_ else 0.0) for g, n_, k in blocks])
    return (n_known * fitted + least * prior) / (n_known + least)


def match_official(matches: DataFrame, official: DataFrame, tournaments: DataFrame, bins: int = 50) -> DataFrame:
    """(match_id, official_id, confidence, score, the fields' scores and swapped): of every match with null re_match_id its best candidate.

    Matches without a candidate do not come out. Of equal scores the lower
    official id wins. Null, blank or damaged fields lower what is known of a
    pair; a pair is scored if it agrees in what `candidates` lists, either way
    round of the colours. Records equal in all fields are compared once and
    their result goes to each of them. Null ids do not count; rows repeated with
    one id count once, the last loaded; empty tables give an empty result; other
    columns are ignored, whatever their names.
    """
    left, members = distinct_records(match_profiles(matches, tournaments), ["known", "re_match_id"])
    right, partners = distinct_records(official_profiles(official), [])
    left, right = materialize(_profiles(left), "left"), materialize(_profiles(right), "right")
    partner = partners.join(right.select("copy", F.col("id").alias("partner")), "copy").select(F.col("id").alias("re_match_id"), "partner")
    whose = left.select(F.col("id").alias("lid"), "n", "re_match_id").join(partner, "re_match_id", "left")
    scored = materialize(field_scores(candidates(left, right), left, right).join(whose, "lid"), "scored")
    top = F.max(F.struct("score", (-F.col("rid")).alias("neg"), *WEIGHTS, "swapped")).alias("top")
    best = scored.where("re_match_id IS NULL").groupBy("lid").agg(top, F.first("n").alias("n"))
    wrong = scored.where("re_match_id IS NOT NULL AND rid <> coalesce(partner, re_match_id)").groupBy("lid").agg(F.max("score").alias("score"), F.first("n").alias("n"))

    def histogram(df: DataFrame, c: str) -> np.ndarray:
        got = np.zeros(bins)
        for b, k in df.groupBy(F.least(F.floor(F.col(c) * bins), F.lit(bins - 1)).cast("int").alias("b")).agg(F.sum("n")).collect():
            got[b] = k
        return got

    n_known, n_open = left.agg(F.coalesce(F.sum(F.when(F.col("re_match_id").isNotNull(), F.col("n"))), F.lit(0)), F.coalesce(F.sum(F.when(F.col("re_match_id").isNull(), F.col("n"))), F.lit(0))).first()
    curve = fit_confidence(histogram(wrong, "score"), histogram(best, "top.score"), n_known, n_open)
    at = F.least(F.floor(F.col("top.score") * bins), F.lit(bins - 1)).cast("int")
    found = best.join(left.select(F.col("id").alias("lid"), "copy"), "lid").join(members.where("re_match_id IS NULL").select(F.col("id").alias("match_id"), "copy"), "copy")
    return found.select(
        "match_id", (-F.col("top.neg")).alias("official_id"), F.element_at(F.array(*[F.lit(float(c)) for c in curve]), at + 1).alias("confidence"),
        F.col("top.score").alias("score"), *[F.col(f"top.{f}").alias(f"{f}_sim") for f in WEIGHTS], F.col("top.swapped").alias("swapped"),
    )
