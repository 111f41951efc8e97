"""Problem 3: references to records that are missing, deleted or arrive later.

References are first aggregated per key and period, which combines before it
shuffles. The few keys that hold a large share of all references are checked
against their targets by broadcast, the others by a shuffle join, and the counts
of both are united. Rows are asked for again only where single references are
wanted, and then only those of keys found wanting: by broadcast where the keys
are few enough, else the heavy ones by broadcast and the others by shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import fits_broadcast, materialize, stripped, union_all

#: At most so many keys can be heavy: each holds more than 1 / HEAVY_KEYS of the references.
HEAVY_KEYS = 5_000


def references(df: DataFrame, ref_field: str, row_key: str, ref: str, loaded_at: str = "loaded_at") -> DataFrame:
    """(ref_field, row_key, key, loaded_at) of the rows whose trimmed reference is neither null nor blank."""
    return df.select(
        F.lit(ref_field).alias("ref_field"), F.col(row_key).cast("string").alias("row_key"), stripped(F.col(ref).cast("string")).alias("key"), F.col(loaded_at).alias("loaded_at")
    ).where("key IS NOT NULL")


def latest_versions(df: DataFrame, id_: str, columns: list[str], loaded_at: str = "loaded_at") -> DataFrame:
    """Per id the columns of the row with the greatest loaded_at (null the least); equal ones are told apart by the columns."""
    best = F.max(F.struct(F.col(loaded_at), *[F.col(c) for c in columns if c != loaded_at])).alias("best")
    return df.groupBy(id_).agg(best).select(id_, *[F.col(f"best.{c}").alias(c) for c in dict.fromkeys([*columns, loaded_at])])


def targets(df: DataFrame, ref_fields: list[str], id_: str = "id", loaded_at: str = "loaded_at", deleted_at: str = "deleted_at") -> DataFrame:
    """(ref_field, key, first_at, gone): per target id its earliest arrival and whether its latest version is deleted."""
    per_id = (
        df.select(stripped(F.col(id_).cast("string")).alias("key"), F.col(loaded_at).alias("at"), F.col(deleted_at).isNotNull().alias("gone"))
        .where("key IS NOT NULL").groupBy("key").agg(F.min("at").alias("first_at"), F.max(F.struct("at", "gone"))["gone"].alias("gone"))
    )
    return per_id.withColumn("ref_field", F.explode(F.array(*[F.lit(f) for f in ref_fields])))


def _checked(refs: DataFrame, targets_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(checked, heavy): references per field, key and period with the count n, the first and last loaded_at, and the targets' first_at, gone and known; the keys that count as heavy."""
    by = ["ref_field", "key"]
    period = F.date_format("loaded_at", "yyyy-MM").alias("period")
    groups = materialize(refs.groupBy(*by, period).agg(F.count("*").alias("n"), F.min("loaded_at").alias("first_ref"), F.max("loaded_at").alias("last_ref")), "groups")
    total = groups.agg(F.sum("n")).first()[0] or 0
    heavy = groups.groupBy(*by).agg(F.sum("n").alias("all")).where(F.col("all") > max(10_000, total // HEAVY_KEYS)).select(*by)
    known = targets_.withColumn("known", F.lit(True))
    # heavy is bounded by its definition, and so are its targets: one a key.
    few = groups.join(F.broadcast(heavy), by).join(F.broadcast(known.join(F.broadcast(heavy), by, "left_semi")), by, "left")
    many = groups.join(F.broadcast(heavy), by, "left_anti").join(known, by, "left")
    return few.unionByName(many), heavy


#: Whether all references of a group are missing or deleted, or its first one is late.
STATE = "CASE WHEN known IS NULL THEN 'missing' WHEN gone THEN 'deleted' WHEN first_at > first_ref THEN 'late' END"


def orphans(refs: DataFrame, targets_: DataFrame) -> DataFrame:
    """(ref_field, row_key, state, loaded_at), one per orphan reference; state is missing, deleted or late.

    missing: no target has the key; else deleted: its latest version is marked
    deleted; else late: it first arrived after the referring row. A null
    loaded_at of either side is never late. Repeated referring rows come out
    once; an empty reference table gives an empty result, an empty target table
    makes all references missing.
    """
    by = ["ref_field", "key"]
    checked, heavy = _checked(refs, targets_)
    wanting = materialize(checked.withColumn("state", F.expr(STATE)).where("state IS NOT NULL").select(*by, "state", "first_at").distinct(), "wanting")
    if fits_broadcast(wanting):
        found = refs.join(F.broadcast(wanting), by)
    else:
        # Rows of heavy keys, wanting or not, stay out of the shuffle.
        found = refs.join(F.broadcast(wanting.join(F.broadcast(heavy), by, "left_semi")), by).unionByName(
            refs.join(F.broadcast(heavy), by, "left_anti").join(wanting.join(F.broadcast(heavy), by, "left_anti"), by)
        )
    found = found.where((F.col("state") != "late") | (F.col("loaded_at") < F.col("first_at")))
    return found.select("ref_field", "row_key", "state", "loaded_at").distinct()


def orphan_report(refs: DataFrame, targets_: DataFrame) -> DataFrame:
    """(ref_field, period, state, n_refs, n_keys): orphan references and their distinct keys per field, period and state, from the counts per key and period; every referring row counts, repeated ones too.

    Rows are read again only for keys whose target arrived in the middle of a
    period. Empty tables and null loaded_at as in `orphans`; a null loaded_at has
    a null period.
    """
    by = ["ref_field", "key"]
    checked = _checked(refs, targets_)[0].withColumn("state", F.expr(STATE)).where("state IS NOT NULL")
    split = (F.col("state") == "late") & (F.col("last_ref") >= F.col("first_at"))
    whole = checked.where(~split).select(*by, "period", "state", "n")
    cut = checked.where(split).select(*by, "period", "first_at")
    rows = refs.withColumn("period", F.date_format("loaded_at", "yyyy-MM")).join(cut, [*by, "period"]).where("loaded_at < first_at")
    part = rows.groupBy(*by, "period").agg(F.count("*").alias("n")).withColumn("state", F.lit("late"))
    return whole.unionByName(part).groupBy("ref_field", "period", "state").agg(F.sum("n").alias("n_refs"), F.count("*").alias("n_keys"))


def league_references(matches: DataFrame, videos: DataFrame, tournaments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(references, targets) of matches.video_id, videos.source_id and matches.event_id."""
    refs = union_all(
        [
            references(matches, "matches.video_id", "id", "video_id"),
            references(latest_versions(videos, "id", ["source_id"]), "videos.source_id", "id", "source_id"),
            references(matches, "matches.event_id", "id", "event_id"),
        ]
    )
    known = targets(videos, ["matches.video_id", "videos.source_id"]).unionByName(targets(tournaments, ["matches.event_id"]))
    return materialize(refs, "refs"), known


def league_orphans(matches: DataFrame, videos: DataFrame, tournaments: DataFrame) -> DataFrame:
    """The orphans of matches.video_id, videos.source_id and matches.event_id, with their month as period."""
    return orphans(*league_references(matches, videos, tournaments)).withColumn("period", F.date_format("loaded_at", "yyyy-MM"))


def orphan_counts(found: DataFrame) -> DataFrame:
    """Orphans per field, state and period."""
    return found.groupBy("ref_field", "state", "period").agg(F.count("*").alias("n_refs"), F.countDistinct("row_key").alias("n_rows"))
