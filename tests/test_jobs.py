"""Whole jobs on small inputs."""

import random

import pytest
from pyspark.sql import functions as F

from statloom.operators import series
from statloom.plans import maintenance, mushrooms
from statloom.sources import readers, writers


def test_mushrooms(spark, tmp_path):
    rng = random.Random(1)
    lines = []
    for i in range(400):
        bad = i % 2
        cells = ["p" if bad else "e"]
        for name in mushrooms.NAMES[1:]:
            codes = list(mushrooms.LEVELS[name])
            # odor decides, the rest is noise
            cells.append(("f" if bad else "n") if name == "odor" else rng.choice(codes))
        lines.append(",".join(cells))
    path = tmp_path / "m.data"
    path.write_text("\n".join(lines) + "\n")
    df = readers.read_headerless(spark, str(path), mushrooms.NAMES).withColumn("id", F.monotonically_increasing_id())
    named = mushrooms.readable(df)
    assert {r[0] for r in named.select("odor").distinct().collect()} == {"foul", "none"}
    assert named.where("stalk_root = 'missing'").count() == df.where("stalk_root = '?'").count()
    job = mushrooms.classification_job(df, "id")
    screening = {r["feature"]: r for r in job["screening"].collect()}
    assert not screening["veil_type"]["relevant"] and screening["odor"]["chi_squared"] == pytest.approx(400)
    assert job["importance"].first()["feature"] == "odor"
    test = job["test"].collect()
    assert sum(r["n"] for r in test) == 120
    assert all(r["actual"] == r["predicted"] for r in test)


def test_csv_with_null_token(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,NULL\n2,3.5\n")
    (tmp_path / "b.csv").write_text("id,v\n3,NULL\n")
    df = readers.load_staging(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], "id long, v double", "NULL", ["v"])
    assert sorted((r["id"], r["v"]) for r in df.collect()) == [(1, 0.0), (2, 3.5), (3, 0.0)]
    assert df.select("source_file").distinct().count() == 2


def test_skipped_notes_line(spark, tmp_path):
    (tmp_path / "n.csv").write_text("# notes\nid,v\n1,a\n")
    assert readers.read_csv(spark, str(tmp_path / "n.csv"), "id long, v string", skip_prefix="#").count() == 1


def test_upsert_and_truncate(spark, tmp_path):
    base = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    new = spark.createDataFrame([(2, "b"), (3, None)], "k int, v string")
    got = sorted((r["k"], r["v"] or "") for r in writers.upsert(base, new, ["k"]).collect())
    assert got == [(1, "a"), (2, "b"), (3, "")]
    path = str(tmp_path / "t")
    writers.write_table(base, path)
    writers.truncate_table(spark, path)
    assert spark.read.parquet(path).count() == 0 and spark.read.parquet(path).columns == ["k", "v"]


def test_truth_moves_the_last_cycle(spark):
    df = spark.createDataFrame([(i, c, float(c)) for i in (2, 3) for c in range(1, 21)], "id int, cycle int, s1 double")
    truth = spark.createDataFrame([(2, 10), (3, 100)], "id int, rul int")
    got = {(r["id"], r["cycle"]): (r["rul"], r["label1"], r["label2"]) for r in series.label_remaining_life(df, truth).collect()}
    assert got[2, 20] == (10, 1, 2) and got[2, 15] == (15, 1, 2) and got[2, 14] == (16, 1, 1) and got[3, 20] == (100, 0, 0)


def test_constant_columns_are_dropped_everywhere(spark):
    df = spark.createDataFrame([(i, c, float(c), 5.0) for i in (1, 2) for c in range(1, 8)], "id int, cycle int, s1 double, s2 double")
    train = maintenance.train_features(df, ["s1", "s2"])
    test = maintenance.test_features(df, ["s1", "s2"])
    a, b, model = maintenance.normalised(train, test, ["s1", "s2", "a1", "sd2"])
    assert set(model.dropped) == {"s2", "sd2"} and "s2" not in a.columns and "s2" not in b.columns
    assert b.count() == 2 and {r["s1"] for r in b.collect()} == {1.0}
