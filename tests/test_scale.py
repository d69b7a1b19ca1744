"""What must hold at size, seen on small tables: no broadcast without a bound, no task that holds all pairs of a key."""

import itertools
import random
import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from quillstone.operators import graph, linkage, promote, spread, works
from quillstone.plans import linking, people, textual


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def chains(spark, n):
    k = spark.range(n).select((F.col("id") * 3).alias("k"))
    rows = k.select(F.col("k").alias("a"), (F.col("k") + 1).alias("b"), F.lit(0.9).alias("score"))
    rows = rows.unionByName(k.select((F.col("k") + 1).alias("a"), (F.col("k") + 2).alias("b"), F.lit(0.5).alias("score")))
    return rows, k.select(F.col("k").alias("a"), (F.col("k") + 2).alias("b"))


def test_clusters_broadcast_nothing_and_merge_in_batches(spark, monkeypatch):
    monkeypatch.setattr(linkage, "BATCH", 40, raising=False)
    homes = linkage.cluster(*chains(spark, 60))
    assert "Broadcast" not in plan(homes)
    assert {(r.node, r.cluster) for r in homes.collect()} == {(i, i if i % 3 == 2 else i // 3 * 3) for i in range(180)}
    edges, _ = chains(spark, 60)
    refused = linkage.refused(edges, homes)
    assert "Broadcast" not in plan(refused) and refused.count() == 60


@pytest.fixture(scope="module")
def one_name(spark, tmp_path_factory):
    """Parts of one name, brand and type, and a few others: a key that holds nearly all rows."""
    d = str(tmp_path_factory.mktemp("one_name"))
    k = F.col("id")
    name = F.when(k % 50 == 0, F.concat(F.lit("other n"), k % 3)).when(k == 7, None).otherwise("ann lee")
    rows = spark.range(700).select(k.alias("p_partkey"), name.alias("p_name"), F.lit("b").alias("p_brand"), F.when(k % 2 == 0, "t").otherwise("t").alias("p_type"), (k * 7 % 50 + 1).cast("int").alias("p_size"))
    rows.write.parquet(f"{d}/part.parquet")
    return d


@pytest.mark.parametrize("keys", [["key"], ["key", "more"]])
def test_pairs_within_equal_brute_force(spark, monkeypatch, keys):
    monkeypatch.setattr(spread, "BLOCK", 16)
    monkeypatch.setattr(spread, "TASK_PAIRS", 500)
    pick = random.Random(1)
    rows = [(pick.choice("aaaab") if i % 9 else None, i % 2, i // 2 if i < 20 else i, i * i) for i in range(150)]
    got = spread.pairs_within(spark.createDataFrame(rows, "key string, more int, id long, v long"), keys, "id")
    key = lambda r: r[: len(keys)]
    want = [(x[2], x[3], y[2], y[3]) for x, y in itertools.permutations(rows, 2) if key(x) == key(y) and x[0] and x[2] < y[2]]
    assert sorted(got.select("id_a", "v_a", "id_b", "v_b").collect()) == sorted(want)


@pytest.mark.parametrize(
    "query", [people.lnk07_orientation, people.lnk08_undecided, people.lnk13_upgraded, people.jon13_pairs_within_groups, textual.str06_year_level, linking.lnk38_shared_given_bits, linking.lnk16_labels, linking.lnk05_pair_scores, linking.lnk21_identifier_scores]
)
def test_no_task_makes_most_pairs_of_a_name(spark, monkeypatch, one_name, query):
    monkeypatch.setattr(spread, "BLOCK", 64, raising=False)
    monkeypatch.setattr(spread, "TASK_PAIRS", 10_000, raising=False)
    made = [r["count"] for r in query(spark, one_name).groupBy(F.spark_partition_id()).count().collect()]
    assert len(made) > 4 and max(made) < sum(made) / 2


def test_compiled_code_starts_from_few_pairs(spark, monkeypatch):
    """All pairs that compiled code makes of its input row are in memory at once."""
    monkeypatch.setattr(spread, "BLOCK", 40)
    monkeypatch.setattr(spread, "CHUNK", 7, raising=False)
    rows = [("ab"[i % 2], i, None if i % 5 == 0 else str(i)) for i in range(150)]
    got = spread.pairs_within(spark.createDataFrame(rows, "key string, id long, v string"), ["key"], "id").select("id_a", "v_a", "id_b", "v_b")
    found = [tuple(r) for r in got.collect()]
    assert set(found) == {(x[1], x[2], y[1], y[2]) for x, y in itertools.combinations(rows, 2) if x[0] == y[0]} and len(found) == len(set(found))
    cuts = [line for line in plan(got).split("Initial Plan")[0].splitlines() if "Generate explode(transform" in line]
    assert len(cuts) == 2 and not any("*" in line.split("Generate")[0] for line in cuts)


def test_pair_scores_are_looked_up_by_one_key(spark, one_name):
    got = linking.lnk05_pair_scores(spark, one_name)
    assert not re.search(r"Join \[kind_a#\d+L?, kind_b", plan(got))
    readings = linking._who(spark, one_name)._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in readings  # each label is read once, and kept


def test_bits_do_not_hang_on_which_part_stands_for_a_name(spark, monkeypatch, one_name):
    """Executors read a shuffle's parts in any order, so that each use of a plan may keep another row."""
    nth = F.udf(random.randrange, "int").asNondeterministic()

    def any_of(self, subset):
        rows = self.groupBy(*subset).agg(F.collect_list(F.struct(*self.columns)).alias("l")).withColumn("n", nth(F.size("l")))
        return rows.select(F.inline(F.array(F.get("l", F.col("n")))))

    want = linking._labelled(spark, one_name).count()
    monkeypatch.setattr(type(spark.range(0)), "dropDuplicates", any_of)
    assert linking.lnk38_shared_given_bits(spark, one_name).count() == want


def test_patterns_count_what_pairs_hold(spark, one_name):
    evidence = ["birth_gap", "common_sources", "alias_identity", "same_authority", "label"]
    pairs = linking._labelled(spark, one_name).groupBy(*evidence).agg(F.count("*").alias("n"))
    got = linking._patterns(spark, one_name).select(*evidence, "rows")
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in pairs.collect()}


def test_a_number_of_many_works_meets_ranges_once(spark):
    rows = [(i, "s", 5, 5) for i in range(300)] + [(1000 + i, "s", 5 - i % 3, 9 + i % 2) for i in range(300)]
    got = works.enclosing_sets(spark.createDataFrame(rows, "work long, scheme string, low int, high int"))
    seen = got._jdf.queryExecution().optimizedPlan().toString()
    assert seen.index("Join") < seen.rindex("Aggregate") and seen.count("Aggregate") == 2
    assert {tuple(r) for r in got.collect()} == {(i, 1000) for i in range(300)}


def test_works_meet_by_identifiers_and_kinds(spark, monkeypatch):
    """Equal features by the hundred, every way that identifiers settle a pair, and both kinds of cuts."""
    monkeypatch.setattr(spread, "BLOCK", 16)
    pick = random.Random(24)
    some = lambda *values: pick.choice(values)
    ids = lambda *values: [v for v in values if pick.random() < 0.2]
    made = lambda: (some("ab", "song of night", "song of day", "night", ""), some(None, "song"), some(None, None, "1", "2"), some(None, 1, 2), some(None, "c minor"), ids("k:1", "k:2", "b:1"), ids("e", "g"), some(None, None, None, "arr"), ids("k:1", "k:2"))
    stock = [(i, some("c", "c", "d"), made()) for i in range(150)] * 2
    asked = [(i, some("c", "d", "none", None), made() if i % 9 else None) for i in range(150)] + [(150 + i, "c", stock[0][2]) for i in range(100)]
    schema = f"id long, composer string, f {works.FEATURES}"
    have = spark.createDataFrame([(i + 1000 * (k >= 150), c, f) for k, (i, c, f) in enumerate(stock)], schema).select(F.col("id").alias("work"), (-F.col("id")).alias("ordinal"), "composer", "f")
    want = spark.createDataFrame(asked, schema)
    names = "core kind opus number key ids externals derivation parents".split()
    for cuts, few in ((works.WorkCuts(), 20_000), (works.WorkCuts(auto=0.9, review=0.1), 0)):
        monkeypatch.setattr(works, "BROADCAST_KINDS", few)
        got = {r.id: (r.status, r.work, r.candidate, r.score and round(r.score, 9)) for r in works.best_matches(want, have, cuts).collect()}
        assert len(got) == len(asked)
        for i, c, f in asked:
            best, at = 0.0, None
            for k in reversed(range(len(stock))):  # ordinals fall
                if f is None or stock[k][1] != c:
                    continue
                x, y = dict(zip(names, f)), dict(zip(names, stock[k][2]))
                score = works._py_identifier(x, y)
                score = works._py_title(x, y, SequenceMatcher(None, x["core"], y["core"]).ratio()) if score is None else score
                if score > best:
                    best, at = score, stock[k][0] + 1000 * (k >= 150)
            status = "auto_matched" if best >= cuts.auto else "needs_review" if best >= cuts.review else "created"
            seen = best >= cuts.review
            assert got[i] == (status, at if best >= cuts.auto else None, at if seen else None, round(best, 9) if seen else None)


def test_best_matches_number_names_in_parts_and_make_no_pairs_of_a_composer(spark, one_name):
    got = linking.lnk24_best_matches(spark, one_name)
    assert "Window" not in plan(got) and not re.search(r"Join \[composer#\d+\]", plan(got))
    assert got.count() == 700 and got.filter("status = 'auto_matched' AND id % 50 <> 0").agg(F.min("work"), F.max("work")).first() == (1, 1)


def test_spellings_are_collected_once(spark, tmp_path):
    spark.range(4000).select(F.lit(1).alias("c_nationkey"), F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("c_mktsegment")).write.parquet(f"{tmp_path}/customer.parquet")
    got = textual.agg14_distinct_spellings(spark, str(tmp_path))
    assert "collect_list" not in plan(got) and [tuple(r) for r in got.collect()] == [(1, "A,B")]


def test_nodes_that_are_listed_twice_repeat_no_claim(spark):
    claims = spark.createDataFrame([(1, 2, None), (1, None, "x")], "subject long, object long, value string")
    nodes = spark.createDataFrame([(1,), (2,), (2,)], "node long")
    assert promote.surviving_claims(claims, nodes).count() == 2 and promote.nulled(claims, "object", nodes).count() == 2


def test_carried_evidence_decides_as_joined_evidence_does(spark):
    pairs = spark.createDataFrame([(1, 2, 2, 1), (1, 3, None, None), (2, 3, 2, 3)], "a long, b long, x long, y long")
    old = pairs.filter("x IS NOT NULL").select(F.col("x").alias("a"), F.col("y").alias("b"))
    carried = linkage.undecided(pairs, (F.lit(None), F.lit(None)), (F.col("x"), F.col("y"))).select("a", "b")
    assert carried.collect() == linkage.decided_anew(pairs.select("a", "b"), old).collect() == [(1, 3)]


def test_best_partners_equal_brute_force_and_make_no_pair_rows(spark, monkeypatch):
    monkeypatch.setattr(graph, "NODES", 9, raising=False)
    monkeypatch.setattr(graph, "CHUNK", 4, raising=False)
    pick = random.Random(3)
    held = {n: {k: pick.randrange(1, 5) for k in pick.sample("abcdefgh", pick.choice((2, 3, 8)))} | {"z": 1} for n in range(30)}
    got = graph.weighted_jaccard(spark.createDataFrame([(n, k, w) for n, e in held.items() for k, w in e.items()], "node long, neighbour string, weight long"), 3, 4)
    want = []
    for a, x in held.items():
        rows = []
        for b, y in held.items():
            low = sum(min(w, y.get(k, 0)) for k, w in x.items())
            if a != b and low and len(x) > 3 and len(y) > 3:
                rows.append((-round(low / (sum(x.values()) + sum(y.values()) - low), 6), b))
        want += [(a, b, -s, i + 1) for i, (s, b) in enumerate(sorted(rows)[:3])]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert "FlatMapCoGroups" in plan(got)


def test_pages_break_ties_of_two_relations_by_name(spark):
    edges = [(1, n, [r], 5, 1.0, 5.0) for n in "xy" for r in ("q", "p")]
    for rows in (edges, edges[::-1]):
        page = graph.budgeted_read(spark.createDataFrame(rows, "node long, neighbour string, relations array<string>, weight long, affinity double, raw double"), limit=3)
        assert [(r.neighbour, r.relation) for r in page.orderBy("place").collect()] == [("x", "p"), ("x", "q"), ("y", "p")]
