"""Overlay text, match names and notes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Confusions of timer digits, formats of teams and scores, match labels in order of trial (prefix, words, whether a leg may follow).
TIMER_CONFUSED = ("oOlISB", "001158")
TEAM = r"^\d{1,5}[A-Z]$"
SCORE = r"^\d{1,3}$"
LABELS = (
    ("Q", r"\b(?:QUALIFICATION|QUAL|Q)\s*#?\s*(\d+)\b", False),
    ("R16", r"\b(?:ROUND\s*OF\s*16|R16)\s*#?\s*(\d+)(?:\s*-\s*(\d+))?", True),
    ("QF", r"\b(?:QUARTERFINAL|QF)\s*#?\s*(\d+)(?:\s*-\s*(\d+))?", True),
    ("SF", r"\b(?:SEMIFINAL|SF)\s*#?\s*(\d+)(?:\s*-\s*(\d+))?", True),
    ("F", r"\b(?:FINAL|F)\s*#?\s*(\d+)(?:\s*-\s*(\d+))?", True),
    ("P", r"\bPRACTICE\s*#?\s*(\d+)", False),
)
ROUNDS = {1: "P", 2: "Q", 3: "QF", 4: "SF", 5: "F", 6: "R16"}


def timer(c: Column) -> Column:
    """Seconds of a countdown text such as 1:45, with confused letters read as digits; null unless 0..120."""
    t = F.translate(F.trim(c), *TIMER_CONFUSED)
    form = r"^([0-2])[:;.]([0-5]\d)$"
    s = F.regexp_extract(t, form, 1).try_cast("int") * 60 + F.regexp_extract(t, form, 2).try_cast("int")
    return F.when(t.rlike(form) & (s <= 120), s)


def match_label(c: Column) -> Column:
    """Short match name of a label, e.g. Q12 or SF1-2; null for previews of the next match and other texts."""
    found = []
    for prefix, form, legs in LABELS:
        rx = "(?i)" + form
        name = F.concat(F.lit(prefix), F.regexp_extract(c, rx, 1))
        if legs:
            leg = F.regexp_extract(c, rx, 2)
            name = F.when(leg != "", F.concat(name, F.lit("-"), leg)).otherwise(name)
        found.append(F.when(c.rlike(rx), name))
    return F.when(~c.rlike(r"(?i)UP\s*NEXT"), F.coalesce(*found))


def is_team(c: Column) -> Column:
    return F.trim(c).rlike(TEAM)


def score(c: Column) -> Column:
    return F.when(F.trim(c).rlike(SCORE), F.trim(c).try_cast("int"))


def phase(c: Column) -> Column:
    return F.when(c.rlike("(?i)AUTON"), "auton").when(c.rlike("(?i)DRIVER"), "driver")


def canon(c: Column) -> Column:
    """Upper case without white space; null becomes empty."""
    return F.upper(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", ""))


def official_label(round_: Column, instance: Column, matchnum: Column) -> Column:
    """Short name of an official record: the number for practice and qualification, instance-number for elimination, only the instance if the number is 0 or null."""
    code = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in ROUNDS.items() for x in kv]), round_), F.lit("?"))
    inst, num = F.coalesce(instance, F.lit(1)), F.coalesce(matchnum, F.lit(0))
    return F.when(code.isin("P", "Q"), F.concat(code, num.cast("string"))).when(num == 0, F.concat(code, inst.cast("string"))).otherwise(F.concat(code, inst.cast("string"), F.lit("-"), num.cast("string")))


def source_ref(video_id: Column, start_ts: Column, source_id: Column, notes: Column) -> tuple[Column, Column]:
    """Embeddable id and start of a match's stream: of a clip that of its source, as its notes tell; cut at the first underscore and dot."""
    form = r"src=(\S+)@(\d+)"
    clip = source_id.isNotNull() & (source_id != "")
    noted = clip & F.coalesce(notes, F.lit("")).rlike(form)
    vid = F.when(noted, F.regexp_extract(notes, form, 1)).when(clip, source_id).otherwise(F.coalesce(video_id, F.lit("")))
    ts = F.when(noted, F.regexp_extract(notes, form, 2).try_cast("double")).otherwise(start_ts)
    return F.split_part(F.split_part(vid, F.lit("_"), F.lit(1)), F.lit("."), F.lit(1)), ts


def clip_notes(notes: Column, video_id: Column, start_ts: Column) -> Column:
    return F.concat(F.coalesce(notes, F.lit("")), F.lit(" | src="), video_id, F.lit("@"), F.bround(start_ts, 0).cast("long").cast("string"))


def image_parts(name: Column) -> tuple[Column, Column]:
    """Match id and time of an image named m<id>_t<seconds>.jpg."""
    form = r"m(\d+)_t([\d.]+)\.jpg"
    return F.regexp_extract(name, form, 1).try_cast("long"), F.regexp_extract(name, form, 2).try_cast("double")


def query_param(url: Column, key: str) -> Column:
    v = F.regexp_extract(url, f"[?&]{key}=([^&]+)", 1)
    return F.when(v != "", v)


def clock(t: Column) -> Column:
    s = F.floor(t)
    return F.concat(F.floor(s / 60).cast("string"), F.lit(":"), F.lpad((s % 60).cast("string"), 2, "0"))


def period(t: Column, auton_s: float = 15) -> Column:
    return F.when(t <= auton_s, "AUTON").otherwise("DRIVER")


def file_slug(c: Column) -> Column:
    return F.replace(c, F.lit("/"), F.lit("_"))


def section_suffix(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit(":"), F.lit("")), F.lit("-"), F.lit("_"))
