"""Anchors of ensembles, places and genres, and what becomes of pairs of people."""

from pyspark.sql import functions as F

from quillstone.operators import anchoring, decisions


def test_ensemble_keys(spark):
    names = ["The Vienna Philharmonic", "Vienna Philharmonic Orchestra", "Vienna Philharmoniker", "Le", "Orchestre de Lyon", "", None]
    rows = spark.createDataFrame(list(enumerate(names)), "i int, n string").select("i", anchoring.ensemble_key(F.col("n")).alias("k"))
    got = {r.i: r.k for r in rows.collect()}
    assert got == {0: "vienna philharmonic", 1: "vienna philharmonic", 2: "vienna philharmonic", 3: "le", 4: "orchestra de lyon", 5: "", 6: None}
    rows = spark.createDataFrame([("Members of the Wiener Philharmoniker",), ("Mitglieder des Ensembles",), ("Members",)], "n string")
    assert [r[0] for r in rows.select(anchoring.whole_of(F.col("n"))).collect()] == ["wiener philharmoniker", "ensembles", None]


def test_anchors_city_tie_break_and_report(spark):
    rows = [
        (1, "Vienna Philharmonic", "Q1"), (2, "City Orchestra", "Q2"), (3, "City Orchestra", "Q3"), (4, "The Vienna Philharmonic", None),
        (5, "City Orchester", None), (6, "Orchestra of Lyon", None), (7, "Members of the Vienna Philharmonic", None), (8, "Nobody", None),
        (9, "Wiener Philharmoniker", None),
    ]
    ensembles = spark.createDataFrame(rows, "id long, label string, qid string")
    aliases = spark.createDataFrame([(1, "Wiener Philharmoniker"), (2, "Orchestra of Lyon"), (3, "Orchestra of Lyon"), (8, "x")], "id long, value string")
    cities = spark.createDataFrame([(2, "Lyon"), (3, "Graz")], "id long, city string")
    got = {r.id: (r.canonical, r.outcome) for r in anchoring.anchored(ensembles, aliases, cities).collect()}
    assert got == {
        4: (1, "anchored"), 5: (None, "ambiguous"), 6: (2, "anchored"), 7: (None, "member_of"), 8: (None, "unanchored"), 9: (1, "anchored"),
    }
    persons = spark.createDataFrame([(20, "Vienna Philharmonic", None), (21, "Nobody", "Q9")], "id long, label string, qid string")
    credited = spark.createDataFrame([(8,), (8,)], "id long")
    report = anchoring.anchor_report(ensembles, persons, aliases, cities, credited).first().asDict()
    assert report == {
        "anchors": 3, "anchored": 3, "ambiguous": 1, "unanchored": 1, "unanchored_credited": 1, "members_of": 1,
        "persons_like_anchors": 1, "ensembles_like_persons": 1,
    }


def test_places_and_genres(spark):
    rows = [(1, "Wien", "Q1"), (2, "Linz", "Q2"), (3, "Linz", "Q3"), (4, "wien", None), (5, "Linz", None), (6, "Steyr", None)]
    places = spark.createDataFrame(rows, "id long, label string, qid string")
    assert {r.id: r.canonical for r in anchoring.linked_places(places).collect()} == {4: 1, 5: None, 6: None}
    aliases = spark.createDataFrame([(1, "Steyr"), (2, "Wien")], "id long, value string")
    assert {r.id: r.canonical for r in anchoring.linked_genres(places, aliases).collect()} == {4: 1, 5: None, 6: 1}


PEOPLE = "id long, surname string, given array<string>, birth int, death int"


def test_orientation_alias_identity_and_reset(spark):
    people = spark.createDataFrame([(1, "bach", ["j", "s"], None, None), (2, "bach", ["johann"], None, None), (3, "bach", ["jo"], None, None)], PEOPLE)
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a long, b long")
    assert {(r.a, r.b): (r.canonical, r.duplicate) for r in decisions.oriented(pairs, people).collect()} == {(1, 2): (2, 1), (1, 3): (1, 3)}
    side = "struct<surname:string,given:array<string>,normalized:string,aliases:array<string>>"
    rows = [
        (("a", ["x"], "x a", []), ("b", ["y"], "y b", ["x a"])), (("a", ["x", "y"], "x y a", ["y x a"]), ("a", ["y", "x"], "y x a", [])),
        (("a", ["x"], "x a", None), ("b", None, "y b", None)),
    ]
    got = spark.createDataFrame(rows, f"a {side}, b {side}").select(decisions.alias_identity(F.col("a"), F.col("b")))
    assert [r[0] for r in got.collect()] == [True, False, False]
    matches = spark.createDataFrame([(1, 2, "accepted"), (1, 3, "auto_linked"), (1, 4, "rejected")], "canonical long, duplicate long, status string")
    entities = spark.createDataFrame([(2, "person", 1), (3, "person", 1), (4, "person", None), (9, "genre", 8)], "id long, kind string, canonical long")
    kept, out = decisions.reset_links(matches, entities)
    assert {r.duplicate for r in kept.collect()} == {2, 4}
    assert {r.id: r.canonical for r in out.collect()} == {2: 1, 3: None, 4: None, 9: 8}


def numbers_of(spark, held):
    return spark.createDataFrame([(i, "k", str(n)) for i, ns in held.items() for n in ns], "id long, scheme string, value string")


def test_catalogue_links(spark):
    rows = [
        (1, "mozart", ["wolfgang"], 1756, None), (2, "mozart", ["leopold"], 1719, None), (3, "mozart", [], None, None),
        (4, "haydn", ["joseph"], 1732, None), (5, "haydn", ["j"], 1733, None), (6, "bach", ["carl"], None, None), (7, "bach", ["carl"], None, None),
        (8, "strauss", [], None, None), (9, "strauss", ["johann"], None, None), (10, "strauss", ["richard"], None, None),
    ]
    people = spark.createDataFrame(rows, PEOPLE)
    clusters = spark.createDataFrame([(6, 6)], "node long, cluster long")
    held = {1: range(9), 2: range(9, 12), 3: range(11), 4: range(50, 53), 5: range(50, 52), 6: [70], 7: [70], 8: range(80, 84), 9: range(80, 82), 10: range(82, 84)}
    barred = spark.createDataFrame([(7, 6)], "a long, b long")
    got = {tuple(r) for r in decisions.catalogue_links(people, clusters, numbers_of(spark, held), barred).collect()}
    # 3 shares 9 numbers with Wolfgang and 2 with Leopold; Strauss is torn; the Bachs are barred. Leopold's only
    # partner is 3, whose component holds the two Mozarts apart.
    assert got == {(1, 3, 9), (4, 5, 2)}
    matches = spark.createDataFrame(
        [(1, 3, 0.6, "m", "needs_review"), (4, 5, 0.1, "m", "rejected")], "canonical long, duplicate long, score double, method string, status string"
    )
    links = spark.createDataFrame([(3, 1, 9), (4, 5, 2), (9, 8, 1)], "a long, b long, shared long")
    out = {(r.canonical, r.duplicate): (r.score, r.method, r.status) for r in decisions.upgraded(matches, links, people).collect()}
    assert out == {
        (1, 3): (0.995, "shared_catalogue:9", "auto_linked"), (4, 5): (0.1, "m", "rejected"), (9, 8): (0.995, "shared_catalogue:1", "auto_linked"),
    }


def test_ambiguous_links_go_back_to_review(spark):
    rows = [(1, 10, "auto_linked"), (2, 10, "auto_linked"), (1, 11, "auto_linked"), (3, 12, "auto_linked"), (4, 12, "accepted"), (1, 13, "auto_linked"), (2, 13, "auto_linked")]
    matches = spark.createDataFrame(rows, "canonical long, duplicate long, status string")
    ids = spark.createDataFrame([(1, "q", "a"), (2, "q", "b"), (3, "q", "c"), (13, "q", "a")], "id long, authority string, value string")
    none = spark.createDataFrame([], "a long, b long")
    status = lambda c: {(r.canonical, r.duplicate): r.status for r in decisions.demoted(matches, ids, c).collect()}
    got = status(none)
    assert {k for k, v in got.items() if v == "needs_review"} == {(1, 10), (2, 10)} and got[4, 12] == "accepted"
    assert "needs_review" not in status(spark.createDataFrame([(2, 1)], "a long, b long")).values()
