from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quillstone.operators import ingest
from quillstone.schemas import DOCUMENT
from quillstone.sources import bronze
from quillstone.sources.build import Build
from quillstone.streaming import ingest as stream


def doc(i, name, kind="person", url=None, claims=None, raw="{}"):
    return ("entity", i, url, "lib", "2026-01-01", None, name, kind, None, None, raw, claims or [])


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), DOCUMENT)


@pytest.mark.parametrize("bad", ["", ".", "..", "a/b", "a\\b", "a\x00", "\n"])
def test_segments_are_validated(bad):
    with pytest.raises(ValueError):
        bronze.segment(bad, "source")


def test_snapshots_round_trip_and_later_run_wins(spark, tmp_path):
    bucket = bronze.Bucket(spark, str(tmp_path))
    first = bucket.write_documents("lib", docs(spark, doc("1", "Ann"), doc("2", "Bob")), "2026-01-01-a")
    second = bucket.write_documents("lib", docs(spark, doc("1", "Anne")), "2026-01-02-b")
    broken = tmp_path / "lib" / "2026-01-03-c" / "records"
    broken.mkdir(parents=True)
    (broken / "part.json").write_text('{"_type": "entity", "id": "3", "name": "Cy", "source_name": "lib"}\n\n{"_type": "ent')
    assert bucket.loadable("lib") == [first, second, "2026-01-03-c"]
    assert {r.status for r in bucket.runs().collect()} == {"completed", "unknown"}
    assert {(r.id, r["name"]) for r in bucket.latest("lib", bucket.loadable("lib")).collect()} == {("1", "Anne"), ("2", "Bob"), ("3", "Cy")}
    assert bucket.read("lib", []).count() == 0
    assert bucket.runs().filter("run_id = '2026-01-01-a'").first().record_count == 2


def test_failed_snapshot_is_marked(spark, tmp_path):
    bucket = bronze.Bucket(spark, str(tmp_path))
    bad = docs(spark, doc("1", "Ann")).withColumn("name", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception):
        bucket.write_documents("lib", bad, "r1")
    assert bucket.runs().first().status == "failed"
    assert bucket.loadable("lib") == [] and bucket.loadable("lib", replay=True) == ["r1"]


def test_due(spark):
    rows = [("static", None), ("weekly", None), ("weekly", datetime(2026, 1, 1)), ("weekly", datetime(2026, 1, 9)), ("odd", datetime(2020, 1, 1))]
    frame = spark.createDataFrame(rows, "cadence string, at timestamp")
    due = bronze.is_due(F.col("cadence"), F.col("at"), F.lit(datetime(2026, 1, 10)))
    assert [r[0] for r in frame.select(due).collect()] == [False, True, True, False, False]


def test_build_swaps_only_what_ended_well(spark, tmp_path):
    build = Build(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        build.table("t")
    build.run(lambda: {"t": spark.range(3)})
    with pytest.raises(ValueError):
        build.run(lambda: {"t": spark.range(0)}, refuse_empty="t")
    assert build.table("t").count() == 3
    build.run(lambda: {"t": build.table("t").union(spark.range(2))})
    assert build.table("t").count() == 5


def test_upsert_keeps_identity_and_claims_are_append_only(spark):
    url = "https://www.wikidata.org/wiki/Q1"
    claims = [("born_in", "place", "Bonn", None, "Q586"), ("born_on", None, None, "1770", None)]
    one = docs(spark, doc("1", "Beethoven, Ludwig van", url=url, claims=claims)).withColumn("run_id", F.lit("r1"))
    two = docs(spark, doc("1", "L. van Beethoven", url=url, claims=claims[:1] + [("born_on", None, None, "1771", None)]), doc("2", "X")).withColumn("run_id", F.lit("r2"))
    old = ingest.records_of(one).withColumns({"first_run": F.col("run_id"), "last_run": F.col("run_id")}).drop("run_id")
    got = {r.external_id: r for r in ingest.upsert(old, ingest.records_of(two), ["source", "external_id"], ["name", "url", "raw"]).collect()}
    assert got["1"].change == "changed" and got["1"]["name"] == "L. van Beethoven"
    assert got["1"].dedup_key == "ludwig van beethoven|Q1" and (got["1"].first_run, got["1"].last_run) == ("r1", "r2")
    assert got["2"].change == "new"
    once = ingest.append_claims(ingest.claims_of(one).limit(0), ingest.claims_of(one))
    both = ingest.append_claims(once, ingest.claims_of(two)).filter("subject = '%s'" % got["1"].entity_id)
    assert ingest.append_claims(both, ingest.claims_of(one)).count() == both.count()
    assert sorted(r.value for r in once.filter("predicate = 'born_on'").collect()) == ["1770"]


def test_streaming_upsert_equals_batch(spark, tmp_path):
    bucket, target = bronze.Bucket(spark, f"{tmp_path}/raw"), Build(spark, f"{tmp_path}/silver")
    run = lambda: stream.upsert_records(stream.documents(spark, bucket.root, "lib"), target, f"{tmp_path}/state").awaitTermination()
    bucket.write_documents("lib", docs(spark, doc("1", "Ann"), doc("2", "Bob")), "r1")
    run()
    bucket.write_documents("lib", docs(spark, doc("1", "Anne")), "r2")
    run()
    run()
    got = {r.external_id: (r["name"], r.first_run, r.last_run) for r in target.table("records").collect()}
    assert got == {"1": ("Anne", "r1", "r2"), "2": ("Bob", "r1", "r1")}


def test_unconfirmed(spark):
    records = spark.createDataFrame([("a", "r1"), ("a", "r2"), ("b", "r1")], "source string, last_run string")
    runs = spark.createDataFrame([("a", "r1", "completed"), ("a", "r2", "failed"), ("b", "r1", "completed")], "source string, run_id string, status string")
    assert {tuple(r) for r in ingest.unconfirmed(records, runs).collect()} == {("a", 2, 1), ("b", 1, 0)}
