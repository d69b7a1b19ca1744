"""Operator 5, n-gram Jaccard join: MinHash banding proposes, full n-gram sets decide."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quillstone.llm.common import Scratch, map_slices
from quillstone.llm.wordhash import mix, shingle_hashes, stream, word_bounds, word_hashes
from quillstone.operators.fixpoint import components
from quillstone.operators.spread import hot_keys, spread_join

_U = np.uint64


@dataclass(frozen=True)
class JoinRules:
    """Pairs of texts whose sets of five-word shingles have a Jaccard index of threshold or more.

    recall: chance that a pair at the threshold is proposed; pairs above it have a better one. max_hashes bounds the
    hashes a text; with it, choose_bands() takes the longest bands that reach the recall.
    block, block_bytes: a task compares two blocks of texts at most, each of that many texts and bytes of shingle
    hashes, one text that alone is longer excepted. bin_rows, bin_bytes: the same for components of fewer texts than a
    block, several of which share a task.
    broadcast_rows: candidates up to this number are broadcast to the texts; more are joined by shuffling both.
    """

    threshold: float = 0.8
    recall: float = 0.999
    max_hashes: int = 160
    block: int = 512
    block_bytes: int = 8 << 20
    bin_rows: int = 2048
    bin_bytes: int = 16 << 20
    broadcast_rows: int = 200_000


def choose_bands(rules: JoinRules) -> tuple[int, int]:
    """(bands, rows). Longer bands propose fewer pairs in vain, but more of them are needed."""
    best = None
    for rows in range(1, rules.max_hashes + 1):
        miss = 1 - rules.threshold**rows
        bands = 1 if miss <= 0 else math.ceil(math.log(1 - rules.recall) / math.log(miss))
        if bands * rows <= rules.max_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("max_hashes is too small for the recall")
    return best


class MinHash:
    """Band hashes of a set of 64-bit hashes. A hash function multiplies by an odd number, modulo 2**64, and adds."""

    BLOCK = 2048

    def __init__(self, bands: int, rows: int) -> None:
        self.bands, self.rows = bands, rows
        self.times = (stream(bands * rows, 31) | _U(1))[:, None]
        self.plus = stream(bands * rows, 32)[:, None]
        self.fold, self.name = stream(rows, 33) | _U(1), stream(bands, 34)

    def __call__(self, values: np.ndarray) -> list[int]:
        if not len(values):
            return []
        with np.errstate(over="ignore"):
            least = None
            for at in range(0, len(values), self.BLOCK):
                part = (values[None, at : at + self.BLOCK] * self.times + self.plus).min(axis=1)
                least = part if least is None else np.minimum(least, part)
            folded = (mix(least).reshape(self.bands, self.rows) * self.fold).sum(axis=1, dtype=_U)
            return mix(folded ^ self.name).view(np.int64).tolist()


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles; a text of one to four words is one shingle."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return np.unique(shingle_hashes(word_hashes(data, *word_bounds(data))))


SIGNED = T.StructType(
    [
        T.StructField("none", T.BooleanType()),
        T.StructField("id", T.LongType()),
        T.StructField("text_key", T.LongType()),
        T.StructField("set_key", T.BinaryType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)


def _keyed(docs: DataFrame, *others: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"),
        F.xxhash64(text).alias("text_key"), text.alias("text"), *others,
    )


def _signed(docs: DataFrame, rules: JoinRules) -> DataFrame:
    bands, rows = choose_bands(rules)

    def make():
        minhash = MinHash(bands, rows)

        def step(part: dict[str, list]) -> dict[str, list]:
            out = {k: part[k] for k in ("none", "id", "text_key")}
            sets = [shingle_set(x) for x in part["text"]]
            out["set_key"] = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets]
            out["n_bytes"] = [x.nbytes for x in sets]
            out["bands"] = [minhash(x) for x in sets]
            return out

        return step

    return map_slices(_keyed(docs), SIGNED, make)


WITH_SET = T.StructType(
    [
        T.StructField("node", T.LongType()),
        T.StructField("root", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("block", T.LongType()),
        T.StructField("shingles", T.BinaryType()),
    ]
)
LINKED = T.StructType(
    [
        T.StructField("node", T.LongType()),
        T.StructField("links", T.LongType()),
        T.StructField("near", T.LongType()),
        T.StructField("final", T.BooleanType()),
    ]
)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections: products of 0/1 rows, over the values that two sets or more hold."""
    n = len(sets)
    values, owner = np.concatenate(sets), np.repeat(np.arange(n), [len(x) for x in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    opens = np.append(True, values[1:] != values[:-1])
    column = np.cumsum(opens) - 1
    often = np.bincount(column) > 1
    kept = often[column]
    owner, column = owner[kept], (np.cumsum(often) - 1)[column[kept]]
    out = np.zeros((n, n), np.float64)
    width = max(256, (1 << 22) // max(n, 1))
    at = 0
    while at < len(column):
        first = column[at]
        to = int(np.searchsorted(column, first + width))
        held = np.zeros((n, min(width, int(column[to - 1] - first) + 1)), np.float32)
        held[owner[at:to], column[at:to] - first] = 1
        out += held @ held.T
        at = to
    return out


def _verify(rows: pa.Table, threshold: float) -> tuple[list, list, list, list]:
    """LINKED's columns for the texts of one task: who is linked, with how many documents, and to whom."""
    at = {}
    for i, node in enumerate(rows.column("node").to_pylist()):
        at.setdefault(node, i)  # rows equal in id and text are one
    rows = rows.take(list(at.values()))
    node, size = (rows.column(k).to_numpy() for k in ("node", "size"))
    root, part, p, q = (rows.column(k).to_pylist() for k in ("root", "block", "p", "q"))
    sets = [np.frombuffer(x, _U) for x in rows.column("shingles").to_pylist()]
    groups: dict[int, list[int]] = {}
    for i, x in enumerate(root):
        groups.setdefault(x, []).append(i)
    out: tuple[list, list, list, list] = ([], [], [], [])
    for members in groups.values():
        shared = shared_counts([sets[i] for i in members])
        n = np.array([len(sets[i]) for i in members], np.float64)
        linked = shared >= threshold * (n[:, None] + n[None, :] - shared) - 1e-9
        np.fill_diagonal(linked, False)
        block = np.array([part[i] for i in members])
        if p[members[0]] != q[members[0]]:
            linked &= block[:, None] != block[None, :]  # pairs within a block belong to the block's own task
        ids = node[members]
        near = ids.copy()
        while True:
            least = np.minimum(near, np.where(linked, near[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max))
            if (least == near).all():
                break
            near = least
        weight = (linked * size[members][None, :]).sum(axis=1)
        for column, values in zip(out, (ids, weight, near)):
            column.extend(values.tolist())
        out[3].extend([p[members[0]] is None] * len(members))
    return out


def _classes(docs: DataFrame, rules: JoinRules) -> tuple[DataFrame, DataFrame, list]:
    """The signed rows, one row a class of equal sets, and the keys of the classes that hold a large part of all rows.

    A class has its least row, and near, the same for all that links connect.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngramjoin")
    signed = scratch.save(_signed(docs, rules), "signed")
    first = F.min(F.struct("none", "id", "text_key")).alias("first")
    classes = signed.groupBy("set_key").agg(first, F.count("*").alias("size"), F.any_value("bands").alias("bands"), F.any_value("n_bytes").alias("n_bytes"))
    classes = classes.withColumn("node", F.monotonically_increasing_id())
    classes = scratch.save(classes, "classes")
    hot = hot_keys(classes, "set_key", "size", signed.count())
    linked = _links(docs, classes, rules, scratch)
    heads = classes.select("node", "set_key", "size", "first").join(linked, "node", "left")
    heads = scratch.save(heads.withColumn("near", F.coalesce("near", "node")), "heads")
    scratch.keep(signed, heads)
    return signed, heads, hot


def jaccard_join(docs: DataFrame, rules: JoinRules = JoinRules()) -> DataFrame:
    """One row a row of docs(doc_id, text): copy_id, class_id and n_links.

    copy_id is the least doc_id with the same set of shingles; class_id the least of all documents that links connect;
    n_links counts the other documents whose sets have a Jaccard index of at least the threshold, copies included.

    1. Texts become sets, and equal sets one class with its band hashes; only classes go on.
    2. Band hashes are shuffled. Each class of a shared band is linked to the band's least class: one row a member,
       however large the band. Components of these links hold every proposed pair.
    3. Classes of a component meet by their full sets, each set shuffled once: many small components in one task. A
       component larger than a block is cut into blocks by the classes' stars, and pairs of blocks meet that share a band
       hash. All pairs that meet are compared, so that no link of two classes with an equal band hash is lost. A task
       returns a row a class: how many documents it is linked to, and the least class it reaches.
    4. Where blocks were needed, the reached classes are edges, and components of those give the classes.

    No pairs are ever rows. Null and empty texts have the empty set and are each other's copies; null ids are never the
    least; rows equal in doc_id and text are linked as copies; an empty table gives an empty one; other columns are
    ignored.
    """
    signed, heads, hot = _classes(docs, rules)
    heads = heads.withColumn("copy_id", F.when(~F.col("first.none"), F.col("first.id")))
    least = heads.groupBy("near").agg(F.min("copy_id").alias("class_id"))
    heads = heads.join(least, "near").select(
        "set_key", "copy_id", "class_id", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    out = spread_join(signed.select("none", "id", "set_key"), heads, "set_key", hot)
    return out.select(F.when(~F.col("none"), F.col("id")).alias("doc_id"), "copy_id", "class_id", "n_links")


def one_of_each_class(docs: DataFrame, rules: JoinRules = JoinRules()) -> DataFrame:
    """docs(doc_id, text, ...) with one row of all those that links connect, by way of others too: the least one.

    Rows are told apart by doc_id and text, so that a row without an id goes as any other, and a text stays whatever its
    id's other texts do. The least row has the lowest doc_id (null last), then the lowest hash of its text; of rows equal
    in both, the least by its other columns stays. Few dropped keys are broadcast, many are joined by shuffling both sides.
    """
    scratch = Scratch(docs.sparkSession, "ngramjoin-kept")
    signed, heads, hot = _classes(docs.select("doc_id", "text"), rules)
    heads = heads.join(heads.groupBy("near").agg(F.min("first").alias("kept")), "near").select("set_key", "kept")
    keys = ["none", "id", "text_key"]
    rows = spread_join(signed.groupBy(*keys, "set_key").agg(F.count("*").alias("n")), heads, "set_key", hot)
    many = F.struct(*keys) == F.col("kept")
    marked = scratch.save(rows.filter(~many | (F.col("n") > 1)).select(*keys, many.alias("many")), "marked")
    small = marked.count() <= rules.broadcast_rows
    # The key's own columns under names that docs does not have; never null.
    row = _keyed(docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row")), "_row").drop("text")
    row = row.join(F.broadcast(marked) if small else marked, keys, "left")
    out = row.filter("many is null").select("_row.*")
    if marked.filter("many").head(1):
        one = row.filter("many").groupBy(*keys).agg(F.min("_row").alias("_row"))
        out = out.unionByName(one.select("_row.*"))
    return out


def _links(docs: DataFrame, classes: DataFrame, rules: JoinRules, scratch: Scratch) -> DataFrame:
    """(node, links, near) of the classes that share a band with another."""

    def save(df: DataFrame) -> DataFrame:
        return scratch.save(df, "edges")

    bands = classes.select("node", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("v")).filter("n > 1")
    shared = scratch.save(shared.select("band", "v", "n"), "shared")
    mates = shared.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    stars = spread_join(bands, shared.select("band", "v"), "band", hot_keys(shared, "band", "n", mates))
    stars = scratch.save(stars.select("node", "band", "v"), "stars")
    edges = stars.select(F.col("node").alias("a"), F.col("v").alias("b"))
    roots = scratch.save(components(edges, save, scratch.drop), "roots")
    wanted = roots.join(classes.select("node", "first", "size", "n_bytes"), "node")
    wanted = scratch.save(wanted.select("node", "root", "size", "n_bytes", "first.*"), "wanted")
    count, volume = wanted.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    parts = F.greatest(F.ceil(F.count("*") / rules.block), F.ceil(F.sum("n_bytes") / rules.block_bytes))
    large = wanted.groupBy("root").agg(parts.cast("long").alias("parts"), F.count("*").alias("n")).filter("parts > 1")
    large = scratch.save(large, "large")
    blocks = pairs = None
    if not large.isEmpty():
        blocks, pairs = _blocks(wanted, large, stars, rules, scratch)
    bins = max(count // rules.bin_rows, volume // rules.bin_bytes) + 1
    found = _compared(docs, wanted, count, bins, blocks, pairs, rules, scratch)
    found = scratch.save(found, "found")
    crossing = found.filter("not final and near <> node").select(F.col("node").alias("a"), F.col("near").alias("b"))
    merged = components(crossing, save, scratch.drop)
    links = found.groupBy("node").agg(F.sum("links").alias("links"), F.min("near").alias("near"))
    return links.join(merged, "node", "left").select("node", "links", F.coalesce("root", "near").alias("near"))


def _blocks(
    wanted: DataFrame, large: DataFrame, stars: DataFrame, rules: JoinRules, scratch: Scratch
) -> tuple[DataFrame, DataFrame]:
    """Blocks of large components: (node, block), and (block, p, q) for every pair of blocks that shares a band hash.

    A class goes with the least class of all its bands, so that classes alike lie in one block or a few. The stars of a
    component that are less than a block are dealt to blocks by hash; a larger star has blocks of its own.
    """
    center = stars.groupBy("node").agg(F.min("v").alias("center"))
    hot = hot_keys(large, "root", "n", wanted.count())
    inside = spread_join(wanted.select("node", "root", "n_bytes"), large.select("root", "parts"), "root", hot)
    inside = scratch.save(inside.join(center, "node"), "inside")
    cuts = F.greatest(F.ceil(F.count("*") / rules.block), F.ceil(F.sum("n_bytes") / rules.block_bytes)).cast("long")
    stars_of = inside.groupBy("center").agg(cuts.alias("cuts"), F.count("*").alias("n"))
    total = inside.count()
    inside = spread_join(inside, stars_of.select("center", "cuts"), "center", hot_keys(stars_of, "center", "n", total))
    own = F.xxhash64("center", F.pmod(F.xxhash64("node"), F.col("cuts")))
    dealt = F.xxhash64("root", F.pmod(F.xxhash64("center"), F.col("parts")), F.lit("dealt"))
    blocks = scratch.save(inside.select("node", F.when(F.col("cuts") > 1, own).otherwise(dealt).alias("block")), "blocks")
    held = scratch.save(stars.select("node", "band").join(blocks, "node").select("band", "block").distinct(), "held")
    meet = held.select("band", F.col("block").alias("p")).join(held.select("band", F.col("block").alias("q")), "band")
    meet = scratch.save(meet.filter("p <= q").select("p", "q").distinct(), "meet")
    both = meet.select(F.col("p").alias("block"), "p", "q").unionByName(meet.filter("p < q").select(F.col("q").alias("block"), "p", "q"))
    return blocks, scratch.save(both, "pairs")


def _compared(
    docs: DataFrame, wanted: DataFrame, count: int, bins: int, blocks: DataFrame | None, pairs: DataFrame | None,
    rules: JoinRules, scratch: Scratch,
) -> DataFrame:
    """LINKED's rows: the classes of each small component, and of each pair of blocks, by their full sets."""
    small = count <= rules.broadcast_rows
    keys = ["none", "id", "text_key"]
    if blocks is None:
        wanted = wanted.withColumn("block", F.lit(None).cast("long"))
    else:
        wanted = wanted.join(blocks, "node", "left")
    names = WITH_SET.names[:-1]
    wanted = wanted.select(*keys, *names)
    texts = _keyed(docs).join(F.broadcast(wanted) if small else wanted, keys)

    def make():
        def step(part: dict[str, list]) -> dict[str, list]:
            return {k: part[k] for k in names} | {"shingles": [shingle_set(x).tobytes() for x in part["text"]]}

        return step

    rows = map_slices(texts.select(*names, "text"), WITH_SET, make)
    none = F.lit(None).cast("long")
    if pairs is None:
        rows = rows.withColumns({"p": none, "q": none})
    elif small:
        rows = rows.join(F.broadcast(pairs), "block", "left")
    else:
        rows = scratch.save(rows, "sets")
        met = rows.join(pairs, "block")
        rows = met.unionByName(rows.filter("block is null").withColumns({"p": none, "q": none}))
    rows = rows.withColumn("g", F.when(F.col("p").isNull(), F.pmod(F.xxhash64("root"), F.lit(bins))).otherwise(-1))
    threshold, arrow = rules.threshold, to_arrow_schema(LINKED)

    def verify(part: pa.Table) -> pa.Table:
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(_verify(part, threshold), arrow)], schema=arrow)

    return rows.groupBy("g", "p", "q").applyInArrow(verify, LINKED)
