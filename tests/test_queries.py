"""Every query with SQL against DuckDB at the smallest scale, and the shape of the others."""

import datetime
import decimal
import glob
import math
import os
import random

import duckdb
import pytest

from arenaflow.operators import insights
from arenaflow.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def plain(v):
    if v is None or isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return None if math.isnan(v) else float(f"{float(v) + 0.0:.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def table(rows, columns):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_against_sql(spark, db, name):
    df = catalogue.QUERIES[name](spark, SF)
    q = db.execute(catalogue.SQL[name])
    columns = [c[0] for c in q.description]
    assert sorted(columns) == sorted(df.columns)
    assert table(df.collect(), df.columns) == table(q.fetchall(), columns)


def test_spans_of_the_state_machine(spark):
    s = catalogue.QUERIES["segment_matches"](spark, SF)
    assert s.count() and s.where("start_ts >= end_ts OR start_ts > auton_end_ts").count() == 0


def test_slots_hold_one_reading_a_frame(spark):
    t = catalogue.QUERIES["slot_tracks"](spark, SF)
    assert t.groupBy("match_id", "slot", "t").count().where("count > 1").count() == 0


def test_throttle_over_all_slots(spark, tmp_path):
    rng = random.Random(3)
    rows = [(m, round(rng.uniform(-1, 30), 1), slot) for m in (1, 2) for slot in ("red1", "red2", "blue1", "blue2")[m - 1 :] for _ in range(60)]
    spark.createDataFrame(rows + [(None, 1.0, "red1"), (1, None, "red1")], "match_id long, t double, slot string").write.parquet(f"{tmp_path}/robot_tracks.parquet")
    want = set()
    for m in (1, 2):
        last = None
        for t in sorted({r[1] for r in rows if r[0] == m and r[1] >= 0}):
            if last is None or t >= last + 1.0:
                want.add((m, last := t))
    assert {tuple(r) for r in catalogue.QUERIES["throttle_frames"](spark, str(tmp_path)).select("match_id", "t").collect()} == want


def test_label_round_trip_over_whole_matches(spark, tmp_path):
    rows = [(m * 1000 + k, m, k / 5, "red1", "1A", float(k % 140), 70.0, 1.0) for m in (1, 2) for k in range(600)]
    spark.createDataFrame(rows, "row_id long, match_id long, t double, slot string, team string, x_in double, y_in double, conf double").write.parquet(f"{tmp_path}/robot_tracks.parquet")
    got = {r["image_id"]: (r["n_boxes"], r["cx_sum"]) for r in catalogue.QUERIES["label_round_trip_whole"](spark, str(tmp_path)).collect()}
    assert got == {m: (600, round(sum(k % 140 for k in range(600)) / 200, 4)) for m in (1, 2)}


def test_archetypes_of_every_vector(spark, tmp_path):
    rng = random.Random(5)
    # The third label has no vec_id that 5 divides; every seventh vector has no label.
    rows = [(k * 5 + label, [float(label == i) + rng.gauss(0, 0.05) for i in range(3)], label if k % 7 else None) for k in range(40) for label in range(3)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r["vec_id"]: r["archetype"] for r in catalogue.QUERIES["archetypes"](spark, str(tmp_path)).collect()}
    assert got == {v: f"kind{v % 5}" for v, _, _ in rows}


def test_too_many_archetypes(spark):
    teams = spark.range(1001).selectExpr("id", "array(cast(id AS double), 1.0D) AS vector")
    with pytest.raises(ValueError):
        insights.archetypes(teams, teams.selectExpr("id", "concat('k', id) AS archetype"), ["id"])


def test_sql_only_for_queries():
    assert set(catalogue.SQL) <= set(catalogue.QUERIES) and catalogue.FLAGSHIP in catalogue.QUERIES
