import json
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from quillstone.functions import titles
from quillstone.operators import events, works


def frame(spark, rows):
    made = spark.createDataFrame([(i, "c", i, t, []) for i, t in rows], "id long, composer string, place long, title string, externals array<string>")
    return made.withColumn("f", works.features(F.col("title"), F.lit("mozart"), F.col("externals")))


@pytest.mark.parametrize(
    ("title", "opus", "number", "key", "kind", "ids"),
    [("Symphony No. 5 in C minor, Op. 67", "67", 5, "c minor", "symphony", []), ("Sonate cis-Moll op. 27 Nr. 2", "27", 2, "c sharp minor", None, []),
     ("Symphony in B-flat major, K. 319", None, None, "b flat major", "symphony", ["kv:319"]), ("Messe h-Moll", None, None, "b minor", None, []),
     ("Concerto, WoO 4", None, None, None, "concerto", ["woo:4"]), ("Partita BWV 1004", None, None, None, "partita", []), ("", None, None, None, None, [])],
)
def test_title_features(spark, title, opus, number, key, kind, ids):
    t = F.col("t")
    row = spark.createDataFrame([(title,)], "t string").select(
        titles.opus(t), titles.number_in_opus(t), titles.musical_key(t), titles.work_type(t), titles.catalogue_ids(t, F.lit("mozart"))
    )
    assert tuple(row.first()) == (opus, number, key, kind, ids)


def test_pruned_matching_equals_full_scan(spark):
    pick = random.Random(366)
    words = "symphony sonata in the of night moon river dance song for two four piano violin".split()
    title = lambda: " ".join(pick.choice(words) for _ in range(pick.randint(2, 6))) + pick.choice(["", " No. 1", " No. 2", " Op. 5", " Op. 6 No. 1", " K. 12", " in C major"])
    stock, asked = [title() for _ in range(120)], [title() for _ in range(80)]
    have = frame(spark, list(enumerate(stock))).select(F.col("id").alias("work"), F.col("id").alias("ordinal"), "composer", "f")
    want = frame(spark, list(enumerate(asked)))
    got = {r.id: (r.status, r.candidate) for r in works.best_matches(want, have).collect()}
    fs, gs = ([r.f.asDict() for r in x.orderBy(k).collect()] for x, k in ((want, "id"), (have, "work")))
    for i, f in enumerate(fs):
        best, at = 0.0, None
        for k, g in enumerate(gs):
            s = works._py_identifier(f, g)
            s = works._py_title(f, g, SequenceMatcher(None, f["core"], g["core"]).ratio()) if s is None else s
            if s > best:
                best, at = s, k
        status = "auto_matched" if best >= 0.9 else "needs_review" if best >= 0.6 else "created"
        assert got[i] == (status, at if best >= 0.6 else None)


def test_created_works_become_candidates(spark):
    rows = [(1, "Symphony No. 40 in G minor, K. 550"), (2, "Symphony No. 40, KV 550"), (3, "Symphony No. 41, K. 551"), (4, "Requiem"), (5, "Requiem"), (6, "Requiem (arr. piano)")]
    got = {r.id: (r.status, r.work) for r in works.resolve_in_order(frame(spark, rows)).collect()}
    assert got[2] == ("auto_matched", got[1][1]) and got[3][0] == "created" and got[5] == ("auto_matched", got[4][1])
    assert got[6][0] == "created"
    again = {r.id: (r.status, r.work) for r in works.resolve_in_order(frame(spark, rows[::-1]).repartition(3)).collect()}
    assert again == got


def test_links_between_works(spark):
    rows = [("a", "op", 3, 8), ("b", "op", 4, 6), ("c", "op", 5, 5), ("d", "op", 8, 8), ("e", "op", 9, 9)]
    got = works.enclosing_sets(spark.createDataFrame(rows, "work string, scheme string, low int, high int")).collect()
    assert {tuple(r) for r in got} == {("c", "b"), ("d", "a")}
    ids = spark.createDataFrame([("x", "1", "mo"), ("x", "2", "mo"), ("x", "3", "ha"), ("y", "1", "ha"), ("y", "2", "mo")], "scheme string, value string, composer string")
    assert {tuple(r) for r in works.scheme_owners(ids).collect()} == {("x", "mo")}


def mentions(spark, rows):
    return spark.createDataFrame([(i, s, json.dumps(p) if p is not None else "{broken") for i, s, p in rows], "id long, source string, raw string")


def test_concerts(spark):
    rows = [
        (1, "berlinphil", {"concert_id": "c1", "date": "1999-05-01", "venue": "Hall", "conductors": ["A"], "soloists": [{"name": "S", "discipline": None}]}),
        (2, "berlinphil", {"concert_id": "c1", "date": "1999-05-02", "conductors": ["A", "B"], "soloists": [{"name": "S", "discipline": "violin"}], "ensembles": ["E"]}),
        (3, "concertgebouw_archive", {"date": "03-04-1950", "city": None, "conductor": "K"}),
        (4, "nyphil", {"programID": "7"}), (5, "rco", None), (6, "x", {"_source": "llm", "concert_key": "k"}),
    ]
    heads, credits, played = events.concerts(mentions(spark, rows))
    assert {(r.source, r.key, r.date, r.venue) for r in heads.collect()} == {("berlinphil", "c1", "1999-05-01", "Hall"), ("concertgebouw_archive", "1950-04-03|", "1950-04-03", None), ("x", "k", None, None)}
    assert {(r.role, r.name, r.discipline) for r in credits.collect()} == {("conductor", "A", None), ("conductor", "B", None), ("soloist", "S", "violin"), ("ensemble", "E", None), ("conductor", "K", None)}
    assert played.count() == 4
    maps = [spark.createDataFrame(x, "name string, entity long") for x in ([("E", 9), ("A", 8)], [("A", 1), ("E", 2)], [("S", 5)])]
    got = {(r.role, r.name): r.entity for r in events.linked_credits(credits, *maps).collect()}
    assert got["ensemble", "E"] == 9 and got["conductor", "A"] == 1 and got["soloist", "S"] == 5 and got["conductor", "B"] is None


def test_recordings(spark):
    release = lambda key, title, number, people, **more: {"_kind": "recording", "record_key": key, "title": title, "catalogue_number": number, "artists": [{"name": n, "role": r} for n, r in people], **more}
    rows = [
        (1, "d", release("p1", "Nocturnes", "A 1", [("Sir Ann", "Soloist"), ("Bo", "guest")])), (2, "d", release("p2", "NOCTURNES", None, [("Ann", "conductor")], label="L")),
        (3, "d", release("p3", "Nocturnes", "B 2", [("Ann", "conductor")])), (4, "d", release("p4", "", None, [("Ann", None)])), (5, "d", {"_kind": "concert"}),
        (6, "d", release("p1", "Other", None, [("Bo", "conductor")])),
    ]
    releases, people = events.recordings(mentions(spark, rows))
    assert {(r.key, r.name, r.role) for r in people.collect()} >= {("p1", "Sir Ann", "soloist"), ("p1", "Bo", "performer")}
    clusters = events.recording_clusters(releases, people)
    assert {r.key: r.cluster for r in clusters.collect()} == {"p1": "p1", "p2": "p1", "p3": "p3", "p4": "p4"}
    merged = {r.cluster: r for r in events.merged_recordings(releases, clusters).collect()}
    assert merged["p1"].label == "L" and merged["p1"].catalogue_number == "A 1" and list(merged["p1"].mentions) == [1, 2, 6]


def test_a_performers_first_release_links_the_others(spark):
    release = lambda key, number, people: {"_kind": "recording", "record_key": key, "title": "Nocturnes!", "catalogue_number": number, "artists": [{"name": n} for n in people]}
    rows = [(1, "d", release("a", "1", ["Ann"])), (2, "d", release("b", "2", ["Ann"])), (3, "d", release("c", "2", ["Ann"]))]
    rows += [(4, "d", release("d", "3", ["Cy", "Bo"])), (5, "d", release("e", None, ["Bo"])), (6, "d", release("f", "4", ["Bo", "Cy"]))]
    got = {r.key: r.cluster for r in events.recording_clusters(*events.recordings(mentions(spark, rows))).collect()}
    assert got == {"a": "a", "b": "b", "c": "c", "d": "d", "e": "d", "f": "f"}


def test_parts_of_different_parents_differ(spark):
    rows = [(1, "Allegro, excerpt from K. 550"), (2, "Allegro, excerpt from K. 551"), (3, "Allegro, excerpt")]
    f = [r.f.asDict() for r in frame(spark, rows).orderBy("id").collect()]
    assert works._py_identifier(f[0], f[1]) == works.CONFLICT and works._py_identifier(f[0], f[2]) is None
    both = frame(spark, rows[:1]).select(F.col("f").alias("a")).crossJoin(frame(spark, rows[1:]).select("id", F.col("f").alias("b")))
    got = {r.id: r.s for r in both.select("id", works.identifier_score(F.col("a"), F.col("b")).alias("s")).collect()}
    assert got == {2: works.CONFLICT, 3: None}
