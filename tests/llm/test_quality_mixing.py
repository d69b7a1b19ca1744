import hashlib
import os
from collections import Counter

import duckdb
import pytest
import zstandard
from pyspark.sql import functions as F

from quillstone.llm import mixing, quality, queries
from tests.llm import cases


def brute(text):
    w = cases.words(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = {x for x, n in Counter(windows).items() if n > 1}
    covered = {i + j for i, x in enumerate(windows) if x in often for j in range(5)}
    lines = [x for x in (text or "").split("\n") if cases.words(x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_base_counts_equal_brute_force(spark):
    rows = cases.texts() + [(20, "a b c d e f a b c d e\n# *\n# *\n\n\n" + cases.prose(40, 9), "s")]
    got = quality.quality_rules(cases.docs(spark, rows)).collect()
    want = Counter((i, *brute(t)) for i, t, _ in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert all(not (r.kept and r.base_failed) for r in got)


def test_prose_is_kept_and_noise_is_not(spark):
    import base64
    import random

    noise = " ".join(base64.b85encode(random.Random(1).randbytes(9)).decode() for _ in range(500))
    rows = [(1, cases.prose(300, 8), "a"), (2, noise, "a"), (3, " ".join(["lorem ipsum dolor %d" % i for i in range(300)]), "a")]
    kept = {r.doc_id: r.kept for r in quality.quality_rules(cases.docs(spark, rows)).collect()}
    assert not kept[3]
    whole = quality.keep_quality(cases.docs(spark, rows))
    assert whole.columns == cases.docs(spark, rows).columns
    assert {r.doc_id for r in whole.collect()} == {k for k, v in kept.items() if v}


def test_empty_tables(spark):
    none = cases.docs(spark, [])
    assert quality.quality_rules(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert mixing.mixed_documents(none).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_mix_equals_sql(spark, sf):
    got = queries.op7_mixing(spark, f"/root/testdata/{sf}").toPandas()
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '/root/testdata/{sf}/documents.parquet'")
    want = con.sql(queries.OP7_SQL).df()
    key = ["doc_id"]
    assert got.sort_values(key)[list(want)].reset_index(drop=True).equals(want.sort_values(key).reset_index(drop=True))


def brute_targets(sizes, weights, budget):
    """Reshares the excess again and again until no source is above its limit."""
    total, limit, fixed = budget * sum(sizes), [2 * s for s in sizes], {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left = total - sum(fixed.values())
        share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = [i for i in free if share[i] > limit[i]]
        if not over:
            return [fixed.get(i, share.get(i)) for i in range(len(sizes))]
        fixed |= {i: float(limit[i]) for i in over}


def test_targets_and_taken(spark):
    docs = cases.docs(spark)
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count()
    sources = sorted({r.source for r in got}, key=lambda s: (s is None, s or ""))
    size = {s: sum(r.size for r in got if r.source == s) for s in sources}
    want = brute_targets([size[s] for s in sources], [(5, 2, 1)[i % 3] for i in range(len(sources))], 1.5)
    for s, target in zip(sources, want):
        rows = [r for r in got if r.source == s]
        assert all(r.target == pytest.approx(target) and r.source_size == size[s] for r in rows)
        assert abs(sum(r.taken for r in rows) - target) <= 1
        assert all(0 <= r.taken <= 2 * r.size for r in rows)


@pytest.mark.parametrize("parts", ["1", "7"])
def test_cut_by_running_sums_is_each_sources_share(spark, parts):
    """The words taken, by hand: each source's queue up to its target."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        docs = cases.docs(spark, [(i, cases.prose(3 + i * i % 90, i), "aaabbcdddd"[i % 10]) for i in range(120)] + [(200, "", "z"), (201, None, "y")])
        got = mixing.mix(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for s in {r.source for r in got}:
        rows = sorted((r for r in got if r.source == s), key=lambda r: hashlib.md5(f"mix-1:{r.doc_id}".encode()).hexdigest())
        at = 0
        for r in rows:
            words = round(r.target)
            want = sum(max(0, min(r.size, words - at - k * r.source_size)) for k in (0, 1))
            assert r.taken == want
            at += r.size
    times = [r.finish for r in got if r.finish is not None]
    assert times == sorted(times)


def test_mixed_documents_repeat_whole_rows(spark):
    docs = cases.docs(spark, [(i, cases.prose(50, i), "ab"[i % 2]) for i in range(40)])
    taken = {r.doc_id: -(-r.taken // r.size) for r in mixing.mix(docs).collect()}
    got = Counter(r.doc_id for r in mixing.mixed_documents(docs).collect())
    assert got == Counter({k: v for k, v in taken.items() if v})


@pytest.mark.parametrize("size", [1, 4095, 4096, 6143, 6144, 10239, 10240, 50_000])
def test_ratios_and_verdict_equal_brute_force(size):
    """Chunks of 4,096 bytes, a tail under half of one going with the chunk before, each a frame of its own."""
    text = (cases.prose(size, size) + " " * size)[:size]
    rules, zstd = quality.QualityRules(), zstandard.ZstdCompressor(level=3)
    row = dict(zip(quality.SCHEMA.names[1:], quality.measure(text, rules, zstd)))
    data = text.encode()
    n = max(1, (size + 2048) // 4096)
    chunks = [data[4096 * k : 4096 * (k + 1) if k < n - 1 else size] for k in range(n)]
    ratio = lambda x: len(x) / len(zstandard.ZstdCompressor(level=3).compress(x))
    assert row["n_bytes"] == size and row["ratio"] == ratio(data)
    assert (row["min_chunk_ratio"], row["max_chunk_ratio"]) == (min(map(ratio, chunks)), max(map(ratio, chunks)))
    band = max((b for b in rules.bands if b.from_bytes <= size), key=lambda b: b.from_bytes)
    inside = band.whole_low <= ratio(data) <= band.whole_high
    inside &= all(band.chunk_low <= ratio(x) <= band.chunk_high for x in chunks)
    assert row["kept"] == (inside and not row["base_failed"])


DATA = "/root/testdata"


@pytest.mark.skipif(not os.path.exists(f"{DATA}/sf0.1"), reason="needs the driver's tables")
def test_bands_are_what_the_labelled_documents_give(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    assert quality.fit_bands(docs, labels.filter("quality = 1")) == quality.QualityRules().bands


@pytest.mark.skipif(not os.path.exists(f"{DATA}/sf0.01"), reason="needs the driver's tables")
def test_bands_hold_for_labels_not_seen(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rules = quality.QualityRules(bands=quality.fit_bands(docs, labels.filter("quality = 1 and doc_id % 2 = 0"), least=15))
    unseen = quality.quality_rules(docs, rules).filter("not base_failed").join(labels.filter("doc_id % 2 = 1"), "doc_id")
    kept = {r.quality: r.kept for r in unseen.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert kept[1] >= 0.97 and kept[0] <= 0.75


def test_bands_need_documents(spark):
    with pytest.raises(ValueError):
        quality.fit_bands(cases.docs(spark), spark.createDataFrame([], "doc_id long"))
