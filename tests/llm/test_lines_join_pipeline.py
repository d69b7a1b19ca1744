import os
import random
from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers
import pytest

from quillstone.llm import common, linededup, mixing, ngramjoin, packing, quality
from quillstone.operators import fixpoint
from tests.llm import cases


def brute_lines(rows, least):
    """rows in order; the text of each without the lines of runs of `least` words that stood before."""
    seen, out = set(), []
    for _, text in rows:
        lines = text.split("\n")
        gone = set()
        for a in range(len(lines)):
            n = 0
            for b in range(a, len(lines)):
                n += len(cases.words(lines[b]))
                if n >= least:
                    run = tuple(lines[a : b + 1])
                    if run in seen:
                        gone |= set(range(a, b + 1))
                    seen.add(run)
        out.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_line_dedup_equals_brute_force(spark, seed):
    pick = random.Random(seed)
    pool = ["", "x"] + [" ".join(pick.choice(cases.WORDS) for _ in range(pick.randint(1, 9))) for _ in range(5)]
    rows = [(i, "\n".join(pick.choice(pool) for _ in range(pick.randint(1, 14)))) for i in range(25)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r.text for r in sorted(linededup.line_dedup(frame, linededup.LineRules(min_words=12)).collect())]
    assert got == brute_lines(rows, 12)


def test_line_dedup_odd_tables(spark):
    docs = cases.docs(spark)
    got = linededup.line_dedup(docs)
    assert set(got.columns) == set(docs.columns) | {"n_lines", "n_cut"}
    by_id = defaultdict(list)
    for r in got.collect():
        by_id[r.doc_id].append(r)
    assert len(by_id[12]) == 3 and len(by_id[None]) == 2
    assert by_id[2][0].text == "" and by_id[1][0].n_cut == 0 and by_id[5][0].text is None
    assert by_id[4][0].text == cases.prose(120, 2)
    assert linededup.line_dedup(cases.docs(spark, [])).count() == 0


def brute_join(texts, threshold):
    sets = [cases.shingles(t) for t in texts]
    links, root = [0] * len(sets), list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if (not a and not b) or (a | b and len(a & b) >= threshold * len(a | b)):
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return links, [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("block", [512, 7])
def test_join_equals_brute_force(spark, block):
    pick = random.Random(3)
    texts = []
    for k in range(25):
        base = cases.prose(pick.choice([4, 30, 200]), k).split(" ")
        for _ in range(pick.randint(1, 12)):
            text = list(base)
            for _ in range(pick.randint(0, 3)):
                text[pick.randrange(len(text))] = f"w{pick.randrange(10**6)}"
            texts.append(" ".join(text))
    texts += ["", " ", "one", "one", "a b c d e", "a  b\nc d e"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(ngramjoin.jaccard_join(frame, ngramjoin.JoinRules(block=block)).collect())
    links, root = brute_join(texts, 0.8)
    assert [r.n_links for r in got] == links
    assert [r.class_id for r in got] == root
    kept = ngramjoin.one_of_each_class(frame, ngramjoin.JoinRules(block=block, broadcast_rows=0))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root))


@pytest.mark.parametrize("rules", [ngramjoin.JoinRules(block=4, broadcast_rows=0), ngramjoin.JoinRules(block_bytes=4000)])
def test_chains_are_joined_by_blocks_that_share_a_band(spark, rules):
    """Windows of one long text, each alike to its neighbours alone, and a group in which all are alike."""
    whole = cases.prose(900, 5).split()
    texts = [" ".join(whole[at : at + 200]) for at in range(0, 400, 10)]
    base = cases.prose(100, 6).split()
    texts += [" ".join([*base[:k], "other", *base[k:]]) for k in range(10, 30)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(ngramjoin.jaccard_join(frame, rules).collect())
    links, root = brute_join(texts, 0.8)
    assert len(set(root)) == 2 and max(links[:40]) < 6
    assert [r.n_links for r in got] == links and [r.class_id for r in got] == root


TABLES = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.exists(TABLES), reason="needs the driver's tables")
def test_recall_of_every_twentieth_document_against_all(spark):
    frame = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text")
    rows = sorted((r.doc_id, r.text) for r in frame.collect())
    sets = {i: cases.shingles(t) for i, t in rows}
    holders = defaultdict(set)
    for i, s in sets.items():
        for x in s or {None}:
            holders[x].add(i)
    got = {r.doc_id: r for r in ngramjoin.jaccard_join(frame).collect()}
    for i in [i for i in sets if i % 20 == 0]:
        shared = Counter(j for x in sets[i] or {None} for j in holders[x] if j != i)
        near = {j for j, n in shared.items() if not sets[i] or n >= 0.8 * (len(sets[i]) + len(sets[j]) - n)}
        assert got[i].n_links == len(near)
        assert {got[j].class_id for j in near} <= {got[i].class_id}


def test_join_odd_tables(spark):
    docs = cases.docs(spark)
    got = ngramjoin.jaccard_join(docs)
    assert got.count() == docs.count()
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[3].class_id == by_id[2].class_id == 1 and by_id[1].n_links == 2
    assert by_id[5].n_links == by_id[6].n_links == 3  # 5, 6, 7 and a null row are without words
    assert ngramjoin.jaccard_join(cases.docs(spark, [])).count() == 0
    kept = ngramjoin.one_of_each_class(docs)
    assert kept.columns == docs.columns


def test_one_row_of_each_class_stays_whatever_its_id(spark):
    base, near = cases.prose(200, 1), cases.prose(200, 1).replace(" the ", " teh ", 1)
    rows = [(1, base, "a"), (None, base, "a"), (None, near, "b"), (None, near, "b"), (7, near, "a"), (7, cases.prose(90, 2), "a")]
    rows += [(8, cases.prose(90, 3), "c")] * 3 + [(None, cases.prose(90, 4), "c")] * 2 + [(None, cases.prose(90, 5), "c")]
    docs = cases.docs(spark, rows)
    want = sorted([(1, base), (7, rows[5][1]), (8, rows[6][1]), (-1, rows[9][1]), (-1, rows[11][1])])
    for bound in (200_000, 0):
        kept = ngramjoin.one_of_each_class(docs, ngramjoin.JoinRules(broadcast_rows=bound))
        assert kept.columns == docs.columns
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.text) for r in kept.collect()) == want


def test_mix_takes_rows_not_ids(spark):
    rows = [(None, cases.prose(50 + i, i), "ab"[i % 2]) for i in range(40)]
    docs = cases.docs(spark, rows)
    taken = Counter((r.source, r.size, -(-r.taken // r.size)) for r in mixing.mix(docs).collect() if r.taken)
    got = Counter((r.source, len(cases.words(r.text))) for r in mixing.mixed_documents(docs).collect())
    assert got == Counter({(s, n): k for s, n, k in taken})


def test_bands_reach_the_recall():
    bands, rows = ngramjoin.choose_bands(ngramjoin.JoinRules())
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= 160


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_brute_force(spark, seed):
    pick = random.Random(seed)
    edges = [(pick.randrange(60), pick.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)]
    scratch = common.Scratch(spark, "t")
    frame = spark.createDataFrame(edges, "a long, b long")
    got = fixpoint.components(frame, lambda df: scratch.save(df, "edges"), scratch.drop)
    root = {x: x for e in edges for x in e}
    for _ in range(200):
        for u, v in edges:
            root[u] = root[v] = min(root[u], root[v])
    want = {x: r for x, r in root.items() if any(x in e and e[0] != e[1] for e in edges)}
    assert {r.node: r.root for r in got.collect()} == want


def test_pipeline_equals_its_brute_force_twin(spark, tmp_path):
    rows = [(i, cases.prose(60 + 3 * i, i), "abc"[i % 3]) for i in range(40)]
    rows += [(50, rows[3][1], "a"), (51, rows[4][1].replace(" the ", " teh ", 1), "b"), (52, rows[5][1] + "\n" + cases.prose(90, 99), "c")]
    rows += [(60, "buy now " * 50, "a"), (61, "short", "b"), (62, None, "c")]
    frame = spark.createDataFrame(
        [(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long"
    )
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    rules, zstd = quality.QualityRules(), __import__("zstandard").ZstdCompressor(level=3)
    docs = [(i, t, s) for i, t, s in rows if quality.measure(t, rules, zstd)[-1]]
    cut = brute_lines([(i, t) for i, t, _ in docs], 50)
    docs = [(i, t, s) for (i, old, s), t in zip(docs, cut) if t == old or cases.words(t)]
    _, root = brute_join([t for _, t, _ in docs], 0.8)
    docs = [d for k, d in enumerate(docs) if root[k] == k]
    left = spark.createDataFrame(docs, "doc_id long, text string, source string")
    copies = {r.doc_id: -(-r.taken // r.size) for r in mixing.mix(left).collect() if r.taken}
    encoder = packing.byte_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t, _ in docs:
        n = len(encoder.encode(t)) // 4 + 1
        for start in range(0, n, 1024):
            want[i, start, min(1024, n - start)] += copies.get(i, 0)
    assert Counter((r.doc_id, r.start, r.length) for r in got) == +want
