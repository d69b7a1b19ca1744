"""Vertices, edges, blueprints and the sinks."""

import hashlib
import json
from dataclasses import dataclass

import pytest
from pyspark.sql import functions as F

from quillstone.operators import export
from quillstone.sources import exports

CLAIM = "subject long, predicate string, object long, value string, source string"


def world(spark):
    entities = spark.createDataFrame(
        [(1, "person", "Ann", "Q1"), (2, "person", "Bob", None), (3, "place", "Graz", None), (4, "event", "E", None), (5, "person", "Cy", None)],
        "id long, kind string, label string, qid string",
    )
    claims = spark.createDataFrame(
        [
            (1, "born_on", None, "1900-01-02", "a"), (1, "born_on", None, "1900-01-02", "b"), (1, "born_on", None, "1899", "c"), (1, "died_on", None, "+1950", "a"),
            (1, "performs_as", None, "Piano", "a"), (1, "performs_as", None, "piano", "b"), (1, "sitelink_count", None, "12", "a"),
            (2, "sitelink_count", None, "x", "a"), (1, "born_in", 3, None, "b"), (1, "born_in", 3, None, "a"), (1, "composed", 4, None, "a"),
        ],
        CLAIM,
    )
    records = spark.createDataFrame([(1, "b", "http://b"), (1, "a", None)], "id long, source string, url string")
    return entities, claims, records


def test_vertices(spark):
    entities, claims, records = world(spark)
    got = {r.id: (r.label, json.loads(r.properties)) for r in export.entity_vertices(entities, claims, records).collect()}
    assert set(got) == {"1", "2", "3", "5"} and got["2"] == ("Person", {"label": "Bob"})
    assert got["1"][1] == {
        "label": "Ann", "wikidata_id": "Q1", "sources": ["a", "b"], "url": "http://b", "born_on": "1900-01-02", "died_on": "+1950", "sitelink_count": 12,
        "performs_as": got["1"][1]["performs_as"],
    } and len(got["1"][1]["performs_as"]) == 1
    works = spark.createDataFrame([(7, "T", None), (8, None, "1")], "id long, title string, opus string")
    ids = spark.createDataFrame([(7, "wikidata", "Q9"), (7, "bwv", "2"), (7, "bwv", "2")], "id long, scheme string, value string")
    got = {r.id: json.loads(r.properties) for r in export.work_vertices(works, ids).collect()}
    assert got == {"7": {"title": "T", "wikidata_id": "Q9", "identifiers": ["bwv 2", "wikidata Q9"]}, "8": {"opus": "1"}}


def test_edges_and_what_is_skipped(spark):
    entities, claims, _ = world(spark)
    edges, skipped = export.claim_relationships(claims, entities)
    assert [(r.type, r.start, r.end, r["from"], r.to, json.loads(r.properties)) for r in edges.collect()] == [("BORN_IN", "Person", "Place", "1", "3", {"sources": ["a", "b"]})]
    assert [tuple(r) for r in skipped.collect()] == [("claim composed", 1)]
    works = spark.createDataFrame([(7, 1), (8, 4), (9, 99), (10, None)], "id long, composer long")
    edges, skipped = export.composed_edges(works, entities)
    assert edges.count() == 1 and {tuple(r) for r in skipped.collect()} == {("orphan works", 2), ("composer of kind event", 1)}
    rows = spark.createDataFrame([(1, 7), (1, 7), (1, None), (2, 7)], "event long, work long")
    edges, skipped = export.programmed_edges(rows, "Concert")
    assert {(r["from"], json.loads(r.properties)["times"]) for r in edges.collect()} == {("1", 2), ("2", 1)} and skipped.first().n == 1
    credits = spark.createDataFrame([(1, 1, "soloist", None), (1, 4, "x", "y")], "event long, entity long, role string, discipline string")
    edges, skipped = export.performed_edges(credits, entities, "Concert")
    assert json.loads(edges.first().properties) == {"role": "soloist"} and skipped.first().reason == "performer of kind event"


def test_blueprint_and_sinks(spark, tmp_path):
    entities, claims, records = world(spark)
    credits = spark.createDataFrame([(2, "conductor", False), (2, "soloist", True), (5, "soloist", False)], "entity long, role string, recording boolean")
    edges = spark.createDataFrame([(2, 1, 3), (5, 1, 9), (2, 2, 1)], "performer long, composer long, weight long")
    elements, links = export.blueprint(entities, credits, edges, claims, records, export.Slice(performers=1, min_weight=2))
    path = f"{tmp_path}/map.json"
    for _ in range(2):
        assert exports.write_blueprint(elements, links, path) == (4, 3)
    found = json.loads(open(path, encoding="utf-8").read())
    by_id = {e["id"]: e for e in found["elements"]}
    assert by_id["1"]["description"] == "Composer · 1900–1950" and by_id["2"]["description"] == "Conductor, soloist · 1 concerts, 1 recordings"
    assert by_id["2"]["tags"] == ["conductor", "soloist"] and "tags" not in by_id["3"] and by_id["4"]["type"] == "Event"
    assert {(c["from"], c["to"], c["type"]) for c in found["connections"]} == {("2", "1", "performed"), ("1", "3", "born in"), ("1", "4", "composed")}
    vertices, other = export.entity_vertices(entities, claims, records), export.claim_relationships(claims, entities)[0]
    with pytest.raises(FileNotFoundError):
        exports.read_graph(spark, f"{tmp_path}/graph")
    for _ in range(2):
        exports.write_graph(vertices, other, f"{tmp_path}/graph")
    v, e = exports.read_graph(spark, f"{tmp_path}/graph")
    assert v.count() == 4 and e.filter("type = 'BORN_IN'").count() == 1


@dataclass(frozen=True)
class Cut:
    a: int = 1
    b: float = 0.5


def test_settings_labelled_rows_and_split(spark, tmp_path):
    assert exports.load_settings(spark, f"{tmp_path}/none.json", Cut()) == Cut()
    exports.save_settings(spark, f"{tmp_path}/cut.json", Cut(7))
    assert exports.load_settings(spark, f"{tmp_path}/cut.json", Cut(b=0.1)) == Cut(7, 0.5)
    rows = spark.createDataFrame([("x", "y", 1), ("y", "x", 0), (None, "z", 1)], "a string, b string, label int")
    exports.write_labelled(rows, f"{tmp_path}/pairs")
    assert sorted(map(str, exports.read_labelled(spark, f"{tmp_path}/pairs", rows.schema).collect())) == sorted(map(str, rows.collect()))
    got = rows.select(exports.is_held_out(F.col("a"), F.col("b")).alias("t")).collect()
    want = int(hashlib.blake2b(b"173:x|y", digest_size=4).hexdigest(), 16) < 2**31
    assert [r.t for r in got][:2] == [want, want]
