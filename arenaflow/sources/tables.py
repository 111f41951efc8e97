"""The store's tables: schemas, readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns and types per table.
SCHEMAS = {
    "events": "id bigint, sku string, name string, season string, start_date string",
    "videos": "id string, event_id bigint, source_id string, division string, path string, title string, duration_s double, fps double, width int, height int",
    "matches": "id bigint, event_id bigint, video_id string, name string, re_match_id bigint, red1 string, red2 string, blue1 string, blue2 string, video_start_ts double, video_auton_end_ts double, video_end_ts double, red_score int, blue_score int, ocr_red_score int, ocr_blue_score int, breakdown string, quality double, notes string",
    "score_timeline": "match_id bigint, t double, red_score int, blue_score int",
    "calibrations": "video_id string, from_ts double, homography string, reproj_err_in double",
    "robot_tracks": "match_id bigint, t double, slot string, team string, x_in double, y_in double, conf double",
    "zone_states": "match_id bigint, t double, zone string, red_blocks int, blue_blocks int",
    "team_robots": "event_id bigint, team string, archetype string, archetype_conf double",
}
#: Tables of an export.
EXPORTED = ("events", "matches", "score_timeline", "robot_tracks", "zone_states", "team_robots")
OFFICIAL = (
    "id bigint, round int, instance int, matchnum int, alliances array<struct<color: string, score: int, teams: array<struct<team: struct<name: string>>>>>"
)


def conform(df: DataFrame, name: str) -> DataFrame:
    """df with exactly the table's columns and types; a missing column is null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(SCHEMAS[name])])


def open_store(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """All tables under path as views; tables that are not there are empty."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    out = {}
    for name, schema in SCHEMAS.items():
        p = fs_path(f"{path}/{name}.parquet")
        there = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
        out[name] = conform(spark.read.parquet(f"{path}/{name}.parquet"), name) if there else spark.createDataFrame([], schema)
        out[name].createOrReplaceTempView(name)
    return out


def export_tables(tables: dict[str, DataFrame], out: str) -> list[str]:
    """Writes the tables of an export as parquet, empty ones not; returns the names written."""
    written = []
    for name in EXPORTED:
        if name in tables and not tables[name].isEmpty():
            tables[name].write.mode("overwrite").parquet(f"{out}/{name}.parquet")
            written.append(name)
    return written


def write_documents(docs: DataFrame, out: str) -> None:
    """One text file of JSON per match, under match_id=<id>/."""
    docs.select("match_id", F.col("body").alias("value")).repartition("match_id").write.mode("overwrite").partitionBy("match_id").text(out)


def pack_documents(docs: DataFrame, out: str, files: int) -> None:
    """The same documents (match_id, body) in few files, in ranges of match_id, so that a reader of one match skips all files but one."""
    docs.select("match_id", "body").repartitionByRange(files, "match_id").sortWithinPartitions("match_id").write.mode("overwrite").parquet(out)


def read_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """(video, title) of <video>.info.json files."""
    d = spark.read.option("multiLine", True).schema("title string, channel string, uploader string").json(path)
    return d.select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.info\.json$", 1).alias("video"), "title", F.coalesce(F.nullif("channel", F.lit("")), "uploader").alias("channel"))


def read_official(spark: SparkSession, path: str) -> DataFrame:
    """Official records landed as JSON pages: {"data": [...]} a file."""
    page = T.StructType([T.StructField("data", T.ArrayType(T.StructType.fromDDL(OFFICIAL)))])
    return spark.read.option("multiLine", True).schema(page).json(path).select(F.inline("data"))


#: Fields of the other endpoints' records, landed as JSON pages like the official ones.
ENDPOINTS = {
    "events": "id bigint, sku string, name string, season struct<id: bigint, name: string>, start string",
    "divisions": "id bigint, name string, order int",
    "teams": "id bigint, number string, team_name string, organization string",
    "seasons": "id bigint, name string, start string, end string",
}


def read_pages(spark: SparkSession, path: str, endpoint: str) -> DataFrame:
    """Records of an endpoint from files of pages {"data": [...]}; those of divisions also from an event's own record {"divisions": [...]}."""
    record = T.ArrayType(T.StructType.fromDDL(ENDPOINTS[endpoint]))
    page = T.StructType([T.StructField("data", record), T.StructField("divisions", record)])
    got = spark.read.option("multiLine", True).schema(page).json(path)
    inner = F.coalesce("data", "divisions") if endpoint == "divisions" else F.col("data")
    return got.select(F.inline(inner))


def search_events(events: DataFrame, sku: str | None = None, name: str | None = None, season: str | None = None) -> DataFrame:
    """Events by exact sku or season and by a part of the name in any case."""
    for col, v in (("sku", sku), ("season", season)):
        if v is not None:
            events = events.where(F.col(col) == v)
    return events if name is None else events.where(F.lower("name").contains(name.lower()))


def label_lines(boxes: DataFrame) -> DataFrame:
    """image and its label text, a line `class cx cy w h` per box in order of pos."""
    line = F.format_string("%d %.6f %.6f %.6f %.6f", "cls", "cx", "cy", "bw", "bh")
    return boxes.groupBy("image").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", line.alias("l")))), lambda x: x["l"]), "\n").alias("label"))


def parse_labels(labels: DataFrame) -> DataFrame:
    """The boxes of label texts; lines without exactly five parts do not count."""
    p = labels.select("image", F.posexplode(F.split("label", "\n")).alias("pos", "line")).withColumn("p", F.split(F.trim("line"), r"\s+")).where(F.size("p") == 5)
    return p.select("image", "pos", F.col("p")[0].try_cast("int").alias("cls"), *[F.col("p")[i].try_cast("double").alias(n) for i, n in enumerate(("cx", "cy", "bw", "bh"), 1)])


def label_tasks(boxes: DataFrame, classes: tuple[str, ...]) -> DataFrame:
    """(image, task): labelling tasks with the boxes as predictions in percent."""
    names = F.array(*[F.lit(c) for c in classes])
    value = F.struct(
        ((F.col("cx") - F.col("bw") / 2) * 100).alias("x"), ((F.col("cy") - F.col("bh") / 2) * 100).alias("y"), (F.col("bw") * 100).alias("width"), (F.col("bh") * 100).alias("height"), F.array(F.element_at(names, F.col("cls") + 1)).alias("rectanglelabels")
    )
    result = F.transform(F.array_sort(F.collect_list(F.struct("pos", F.to_json(value).alias("v")))), lambda x: F.from_json(x["v"], "x double, y double, width double, height double, rectanglelabels array<string>"))
    return boxes.groupBy("image").agg(result.alias("result")).select("image", F.to_json(F.struct(F.struct("image").alias("data"), F.array(F.struct("result")).alias("predictions"))).alias("task"))


def finished_annotations(completions: DataFrame, tasks: DataFrame) -> DataFrame:
    """(image, class, x, y, width, height) of completions (task_id, was_cancelled, result JSON) that were not cancelled."""
    kind = "array<struct<value: struct<x: double, y: double, width: double, height: double, rectanglelabels: array<string>>>>"
    j = completions.where("was_cancelled = 0").join(tasks.select(F.col("id").alias("task_id"), F.get_json_object("data", "$.image").alias("image")), "task_id")
    return j.select("image", F.explode(F.from_json("result", kind)).alias("r")).select("image", F.col("r.value.rectanglelabels")[0].alias("class"), "r.value.x", "r.value.y", "r.value.width", "r.value.height")


def sampled_times(matches: DataFrame, n_total: int, seed: int = 7, val_share: float = 0.15) -> DataFrame:
    """(match_id, k, ts, split): n_total frames spread evenly over the finished matches, uniform within each and drawn by hash, so that a rerun gives the same."""
    done = matches.where("video_end_ts IS NOT NULL AND video_start_ts IS NOT NULL").select(F.col("id").alias("match_id"), "video_start_ts", "video_end_ts")
    per = max(1, n_total // max(1, done.count()))
    e = done.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(per - 1))))
    u = lambda salt: F.pmod(F.xxhash64("match_id", "k", F.lit(salt)), F.lit(1_000_000)) / 1e6
    return e.select("match_id", "k", (F.col("video_start_ts") + u(seed) * (F.col("video_end_ts") - F.col("video_start_ts"))).alias("ts"), F.when(u(seed + 1) < val_share, "val").otherwise("train").alias("split"))


def pending_images(images: DataFrame, annotated: DataFrame) -> DataFrame:
    """Images without an annotation."""
    return images.join(annotated.select("image").distinct(), "image", "left_anti")


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, size) of the files under path; their contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("size"))


# Colours of the label classes.
LABEL_COLOURS = {"robot_red": "#e53935", "robot_blue": "#1e88e5", "block_red": "#ffb3b3", "block_blue": "#b3d1ff"}


def label_config(classes: tuple[str, ...]) -> str:
    """The labelling tool's description of an image with rectangles of the classes."""
    lines = ['<View>', '  <Image name="image" value="$image" zoom="true"/>', '  <RectangleLabels name="label" toName="image">']
    lines += [f'    <Label value="{c}" background="{LABEL_COLOURS.get(c, "#aaaaaa")}"/>' for c in classes]
    return "\n".join([*lines, "  </RectangleLabels>", "</View>", ""])


def dataset_yaml(root: str, classes: tuple[str, ...]) -> str:
    """The training set's description: its root, both splits and the numbered classes."""
    return "\n".join([f"path: {root}", "train: images/train", "val: images/val", "names:", *[f"  {i}: {c}" for i, c in enumerate(classes)], ""])
