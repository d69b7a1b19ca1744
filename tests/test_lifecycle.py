import os
import subprocess
import sys
from pathlib import Path

import pyspark
import pytest
from pyspark.sql import functions as F

from quillstone.functions import payloads, titles
from quillstone.operators import ingest, lifecycle, persons
from quillstone.schemas import DOCUMENT
from quillstone.sources import bronze, connectors, jdbc, sqlite, workspace
from quillstone.sources.build import Build


def doc(i, name, kind="person", source="lib"):
    return ("entity", i, None, source, "2026-01-01", None, name, kind, None, None, "{}", [])


def test_rebuild_replays_oldest_first_and_carries_decisions(spark, tmp_path):
    bucket, target = bronze.Bucket(spark, f"{tmp_path}/raw"), Build(spark, f"{tmp_path}/silver")
    made = lambda *rows: spark.createDataFrame(list(rows), DOCUMENT)
    bucket.write_documents("lib", made(doc("1", "Ann"), doc("2", "Bo")), "r1")
    bucket.write_documents("lib", made(doc("1", "Anne")), "r2")
    bucket.write_documents("other", made(doc("9", "Bo", source="other")), "r1")
    lifecycle.rebuilt(spark, bucket, target, ["lib", "other"])
    entities = {r.label: r.id for r in target.table("entities").collect()}
    assert set(entities) == {"Anne", "Bo"} and target.table("records").count() == 3
    decisions = spark.createDataFrame([(entities["Anne"], entities["Bo"], "rejected"), (entities["Anne"], "gone", "accepted"), (entities["Anne"], entities["Bo"], "auto_linked")], "duplicate string, canonical string, status string")
    lifecycle.rebuilt(spark, bucket, target, ["lib", "other"], decisions)
    assert [r.status for r in target.table("decisions").collect()] == ["rejected"]
    before = target.manifest()
    with pytest.raises(ValueError):  # nothing to replay: the tables stay
        lifecycle.rebuilt(spark, bucket, target, ["none"])
    assert target.manifest() == before


def test_derived_passes_have_a_place(spark):
    with pytest.raises(ValueError):
        lifecycle.derived({}, {"odd": lambda t: t})


def test_runs_end_completed_or_failed():
    good = lifecycle.run(lambda: {"seen": 3}, "r", "lib")
    assert good["status"] == "completed" and good["seen"] == 3 and good["error"] is None
    bad = lifecycle.run(lambda: 1 / 0, "r", "lib")
    assert bad["status"] == "failed" and "division" in bad["error"]


def test_null_hashes_are_hashes(spark):
    row = lambda *x: spark.createDataFrame([x], "id int, name string, hash string, first_run string, last_run string")
    new = lambda *x: spark.createDataFrame([x], "id int, name string, hash string, run_id string")
    got = lambda o, n: ingest.upsert(row(1, "a", o, "r1", "r1"), new(1, "b", n, "r2"), ["id"], ["name"]).first()
    assert [(got(o, n).change, got(o, n)["name"]) for o, n in ((None, "x"), ("x", None), (None, None), ("x", "x"))] == [("changed", "b"), ("changed", "b"), ("same", "a"), ("same", "a")]


def test_premieres_go_to_the_earliest_and_finest(spark):
    works = spark.createDataFrame([(1, None, None, None), (2, "1824", "home", "s0"), (3, "1800", "home", "s0"), (4, None, None, None)], "work int, premiere_date string, premiere_place string, premiere_source string")
    raw = lambda date, place=None: '{"premiere": {"date": "%s"%s}}' % (date, f', "place": "{place}"' if place else "")
    rows = [(1, 1, "s", raw("1900-05", "A")), (1, 2, "s", raw("1899", "B")), (1, 3, "s", raw("1899", "C")), (2, 4, "t", raw("1824-05-07")), (3, 5, "t", raw("1801")), (4, 6, "t", raw("spring")), (4, 7, "t", "{broken")]
    got = lifecycle.premieres(works, spark.createDataFrame(rows, "work int, id int, source string, raw string")).collect()
    assert {tuple(r) for r in got} == {(1, "1899", "B", "s"), (2, "1824-05-07", None, "t"), (3, "1800", "home", "s0"), (4, None, None, None)}
    one = spark.range(1).select(payloads.supersedes(F.lit("1824-05"), F.lit("1824")), payloads.supersedes(F.lit("1824"), F.lit("1824-05")), payloads.supersedes(F.lit("1"), F.lit(None).cast("string")))
    assert tuple(one.first()) == (True, False, True)


def test_sources_keep_their_ids(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("old",), ("b",)], "source string")
    known = spark.createDataFrame([(4, "old")], "id long, name string")
    assert {tuple(r) for r in lifecycle.sources_of(rows, known).collect()} == {(4, "old"), (5, "a"), (6, "b")}
    assert {tuple(r) for r in lifecycle.sources_of(rows.limit(0), known).collect()} == {(4, "old")}


def test_person_records(spark):
    entities = spark.createDataFrame([(1, "Ann", "ann|Q5"), (2, "Bo", "bo")], "id int, label string, dedup_key string")
    rows = [(1, "born_on", "1900-01", "a"), (1, "born_on", "c. 1901", "b"), (1, "died_on", "?", "a"), (1, "also_known_as", "An", "a"), (1, "musicbrainz_id", " m ", "a"), (1, "born_on", None, "c")]
    got = {r.id: r for r in persons.person_records(entities, spark.createDataFrame(rows, "subject int, predicate string, value string, source string")).collect()}
    assert (got[1].birth, got[1].birth_years, got[1].death, got[1].musicbrainz, got[1].qid, got[1].sources) == (1900, [1900, 1901], None, ["m"], "Q5", ["a", "b", "c"])
    assert got[2].aliases == [] and got[2].sources == [] and got[2].birth is None


def test_carried_works_without_a_composer(spark):
    decisions = spark.createDataFrame([("s", "1", None, "Nocturne!"), ("s", "2", "c", "Nocturne"), ("s", "9", "c", "gone")], "source string, external_id string, composer string, title string")
    mentions = spark.createDataFrame([("s", "1"), ("s", "2")], "source string, external_id string")
    works = spark.createDataFrame([(7, None, "nocturne"), (5, None, "Nocturne")], "work int, composer string, title string")
    got = {r.external_id: (r.work, r.created) for r in lifecycle.carried_works(decisions, mentions, works).collect()}
    assert got["1"] == ("5", False) and got["2"][1] and set(got) == {"1", "2"}


def test_tables_go_through_a_database(spark, tmp_path):
    url = f"jdbc:derby:memory:{tmp_path.name}"
    rows = spark.createDataFrame([(i, f"n{i}") for i in range(50)] + [(None, "x")], "K long, NAME string")
    jdbc.write_table(rows, f"{url};create=true", "T")
    assert jdbc.read_table(spark, url, "T", "K", 4).rdd.getNumPartitions() == 4
    assert {tuple(r) for r in jdbc.read_table(spark, url, "T", "K", 4).collect()} == {tuple(r) for r in rows.collect()}
    jdbc.write_table(rows.limit(0), url, "E")
    assert jdbc.read_table(spark, url, "E", "K").count() == 0


def test_databases_below_a_folder_hold_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sqlite, "DATABASE_BYTES", 1)
    monkeypatch.setattr(sqlite, "INSERT_ROWS", 7)
    held = [(i - 20, None if i == 3 else f"n{i}\0é", i % 5, bytes([i])) for i in range(50)] + [(None, "x", None, None)] * 2
    rows = spark.createDataFrame(held, 'k long, `a "name"` string, v int, b binary')
    sqlite.write_table(rows, f"file://{tmp_path}", "t", "k")
    assert spark.read.parquet(f"{tmp_path}/t").count() > 4
    for low, high in ((None, None), (None, 3), (3, None), (-5, 11), (40, 50)):
        want = [r for r in held if (low is None if r[0] is None else (low is None or r[0] >= low) and (high is None or r[0] < high))]
        got = sqlite.read_table(spark, f"file://{tmp_path}", "t", rows.schema, "k", low, high).collect()
        assert sorted(repr((*r[:3], r[3] and bytes(r[3]))) for r in got) == sorted(map(repr, want))
    sqlite.write_table(rows.limit(0), f"file://{tmp_path}", "e", "k")
    assert sqlite.read_table(spark, f"file://{tmp_path}", "e", rows.schema, "k").count() == 0
    with pytest.raises(ValueError):
        sqlite.write_table(rows.withColumn("d", F.lit(1.0)), f"file://{tmp_path}", "d", "k")


CLUSTER = """
import sys
from pyspark.sql import SparkSession, functions as F
import __spark_entry__
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.checkpoint.dir", f"file://{sys.argv[1]}/shared").config("spark.ui.enabled", "false").getOrCreate()
k = F.col("id")
spark.range(0, 3000, 1, 8).select(k.alias("p_partkey"), F.concat(F.lit("n"), k % 7).alias("p_name"), (k % 50).cast("int").alias("p_size")).write.parquet(f"{sys.argv[1]}/part.parquet")
rows = __spark_entry__.queries()["src09_table_scan"](spark, sys.argv[1]).collect()
assert sorted(map(tuple, rows)) == [(i, f"n{i % 7}", i % 50) for i in range(3000)]
print("whole")
"""


def test_tables_go_through_databases_on_a_cluster(tmp_path):
    """Executors are JVMs of their own: what one of them holds in memory no other can read."""
    home = tmp_path / "home"  # executors work below Spark's home
    home.mkdir()
    for p in Path(pyspark.__file__).parent.iterdir():
        (home / p.name).symlink_to(p)
    done = subprocess.run([sys.executable, "-c", CLUSTER, str(tmp_path)], cwd=Path(__file__).parents[1], env=os.environ | {"SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13", "PYSPARK_PYTHON": sys.executable, "SPARK_LOCAL_IP": "127.0.0.1"}, capture_output=True, text=True, timeout=300)
    assert done.stdout.split()[-1:] == ["whole"], done.stderr[-3000:]


def test_workspace_is_new_each_time(spark):
    assert workspace.shared_folder(spark, "a") != workspace.shared_folder(spark, "a")


def test_item_codes_and_counterparts(spark):
    one = lambda code, item, short: spark.range(1).select(titles.item_code(F.lit(code), F.lit(item).cast("string"), F.lit(short).cast("string"), F.lit("mozart"))).first()[0]
    assert one("550", None, "KV") == ["kv:550"] and one("K. 550", "Q162478", None) == ["kv:550"] and one("deest", "Q9", None) == []
    assert one("960602-001", "Q9", None) == ["wd:Q9:960602 001"] and one("550", None, None) == []
    nodes = spark.createDataFrame([("a", "Waltz "), ("b", "waltz"), ("c", "Waltz music"), ("d", "polka")], "qid string, label string")
    differs = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", "c"), ("a", "d"), ("a", "z")], "qid string, other string")
    assert {tuple(r) for r in connectors.counterparts(nodes, differs).collect()} == {("a", "b"), ("a", "c")}
