import json

import pytest
from pyspark.sql import functions as F

from quillstone.functions import instruments, text
from quillstone.sources import connectors as C


def bodies(spark, *found):
    return spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in found], "body string")


def value(spark, given, column):
    return spark.createDataFrame([(given,)], "t string").select(column(F.col("t")).alias("v")).first().v


def test_bindings_fold_by_item(spark):
    v = lambda x: {"type": "literal", "value": x}
    q = lambda n: v(f"http://www.wikidata.org/entity/Q{n}")
    rows = [
        {"item": q(1), "itemLabel": v("Ann"), "birth": v("+1770-12-17T00:00:00Z"), "birthPrecision": v("11"), "genre": q(5)},
        {"item": q(1), "itemLabel": v("Ann"), "birth": v("+1770-01-01T00:00:00Z"), "birthPrecision": v("9"), "genre": q(4)},
        {"item": v("bad"), "itemLabel": v("x")},
    ]
    got = C.fold_items(C.bindings(bodies(spark, {"results": {"bindings": rows}}, "{broken")), "item", ["genre"], ["birth"], "itemLabel").collect()
    assert [(r.qid, r.label, list(r.genre), r.birth) for r in got] == [("Q1", "Ann", ["Q4", "Q5"], "1770")]


@pytest.mark.parametrize(("given", "want"), [("Point(7.1 50.7)", "50.7,7.1"), ("POINT (-0.1 51)", "51,-0.1"), ("x", None)])
def test_points(spark, given, want):
    assert value(spark, given, C.lat_lon) == want


def test_dumps(spark):
    dump = {"composers": [{"complete_name": "A", "birth": "1770-01-01", "death": "1827-03-26", "epoch": "E", "works": [{"title": "T", "subtitle": "", "genre": "g"}]}, {"complete_name": "B", "works": []}]}
    assert [tuple(r) for r in C.nested_dump(bodies(spark, dump)).orderBy("composer").collect()] == [("A", "1770", "1827-03-26", "E", "T", "g"), ("B", None, None, None, None, None)]
    listed = {"0": {"id": "Category:Bach, J.", "type": "1", "permlink": "u"}, "metadata": {"start": 0}}
    assert [tuple(r) for r in C.people_list(bodies(spark, listed)).collect()] == [("Bach, J.", "u")]
    assert tuple(value(spark, "Ann (1770–1827)", C.life_years)) == (1770, 1827) and tuple(value(spark, "b. 1955", C.life_years)) == (1955, None)


def test_programmes(spark):
    works = [{"workTitle": "W1", "composerName": "X", "conductorName": "K", "soloists": [{"soloistName": "S", "soloistInstrument": "Piano"}]}, {"workTitle": None}]
    program = {"programs": [{"programID": "7", "season": "1900-01", "concerts": [{"Date": "1900-02-03T05:00:00Z", "Venue": "V"}, {"Date": "1900-02-04T05:00:00Z"}], "works": works}]}
    rows = C.programmes(bodies(spark, program))
    assert {(r.date, r.title, r.conductor) for r in rows.collect()} == {("1900-02-03", "W1", "K"), ("1900-02-04", "W1", "K")}
    assert {(r.role, r.name, r.programs) for r in C.registry(rows).collect()} == {("conductor", "K", 1), ("soloist", "S", 1)}


def test_credit_texts(spark):
    assert [tuple(x) for x in value(spark, "Ann Lee (violin, alto), Bo", C.named_parts)] == [("Ann Lee", "violin, alto"), ("Bo", None)]
    assert [tuple(x) for x in value(spark, "Ann Lee, Piano; Bo (conductor); Cy", C.credit_line)] == [("Ann Lee", "piano"), ("Bo", "conductor"), ("Cy", None)]
    row = spark.createDataFrame([(["A", "", "B"], ["t1", "t2", "t3"])], "c array<string>, t array<string>")
    assert [tuple(x) for x in row.select(C.aligned(F.col("c"), F.col("t"))).first()[0]] == [("A", "t1"), ("A", "t2"), ("B", "t3")]


def test_html(spark):
    page = '<table><tr><th>Key: </th><td>C&amp;D</td></tr><tr><td>1</td><td><b>2</b></td></tr></table><dl><dt>Key</dt><dd>no</dd><dt>Dur</dt><dd>5</dd></dl><b>Year:</b> 1900<script type="application/ld+json">{"name": "N"}</script><a href="/w/1">x</a><a href="/w/1#y">x</a><a href="/p">x</a>'
    assert value(spark, page, C.labelled_pairs) == {"Key": "C&D", "Dur": "5", "Year": "1900"}
    assert value(spark, page, C.table_rows) == [["Key:", "C&D"], ["1", "2"]]
    assert value(spark, page, lambda t: F.variant_get(C.json_ld(t), "$.name", "string")) == "N"
    assert value(spark, page, lambda t: C.links(t, "^/w/")) == ["/w/1"]
    assert value(spark, "none", lambda t: C.json_ld(t).isNull())


def test_release_works(spark):
    tracks = [{"work": "W", "composer": "X", "title": "W: I", "credits": [{"name": "A", "role": "piano"}]}, {"work": None, "composer": "X", "title": "W: II", "credits": [{"name": "A", "role": "piano"}, {"name": "B", "role": None}]}]
    (row,) = C.release_works(bodies(spark, {"id": "p1", "tracks": tracks})).collect()
    assert (row.record_key, row.title, row.tracks, [a.name for a in row.artists]) == ("p1", "W", 2, ["A", "B"])


@pytest.mark.parametrize(
    ("given", "want"),
    [("Violin and piano", ["violin", "piano"]), ("string quartet", ["string quartet"]), ("violin and kazoo", []), ("violin, piano", []), ("Piano", ["piano"])],
)
def test_instrumentation(spark, given, want):
    assert value(spark, given, instruments.instrumentation) == want


def test_shorthand(spark):
    got = value(spark, "3.2.2.3 – 4.3.3.1 – timp – str", instruments.shorthand)
    assert got == {"flute": 3, "oboe": 2, "clarinet": 2, "bassoon": 3, "horn": 4, "trumpet": 3, "trombone": 3, "tuba": 1, "timpani": 1, "strings": 1}
    assert value(spark, "3.2.2.3 – 4.3.3.1", instruments.shorthand) is None and value(spark, "timp – str", instruments.shorthand) is None


@pytest.mark.parametrize(
    ("function", "given", "want"),
    [(text.roman_value, "XLIV", 44), (text.roman_value, "IIII", None), (text.roman_value, "C", 100), (text.recording_code, "T-123.456.789-0", "T1234567890"),
     (text.recording_code, "x", None), (text.minutes, "1 h 5 min", 65), (text.minutes, "20-25 minutes", 20), (text.minutes, "soon", None),
     (text.ensemble_type, "Vienna Chamber Choir", "choir"), (text.ensemble_type, "Ann Lee", None), (text.participant_key, "Sir Dr. Simon Rattle", "simon rattle"),
     (text.participant_key, "Sirius", "sirius"), (text.title_key, "Straße—Éléphant!", "straße elephant"), (text.dedup_key, "Dvořák, Antonín", "antonin dvorak"),
     (text.long_date, "7 May 1824", "1824-05-07"), (text.long_date, "May 1824", "1824-05"), (text.long_date, "7 Foo 1824", None), (text.first_year, "in 1824-05", 1824),
     (text.id_of_url, "https://www.wikidata.org/wiki/Q42", "Q42"), (text.id_of_url, "https://x.org/Q42", None), (text.tokens, "J.S. Bách", ["j", "s", "bach"])],
)
def test_scalars(spark, function, given, want):
    assert value(spark, given, function) == want
