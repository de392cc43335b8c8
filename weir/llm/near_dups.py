"""Near duplicates by b-bit MinHash, confirmed on full shingle sets.

A document is its set of distinct ``width``-word shingles (A-Z lower-cased,
words ``[^\\x20\\x09-\\x0D]+``); a text with fewer words is one shingle. Texts
with equal sets form a class, and one member stands for it.

1. Signatures: ``bands * rows`` minima per class. The low bits of each are
   packed, 16 minima to a long; every band of minima hashes to a bucket key.
2. Candidates: classes in one bucket. Whether a pair is worth reading is
   estimated from the packed bits, corrected for chance agreement of ``BITS``
   bits: a pair is dropped only when the estimate lies five standard errors
   under the threshold.
3. Stars: in each bucket every class is compared with ``STARS`` centres, drawn by a
   hash of the class alone, so near copies have the same ones in all the buckets
   that they share. So a bucket of n copies costs n comparisons, not n squared.
4. Rest: classes in buckets that still span components. Bucket-mates form
   clusters; a cluster's consensus C is the set of shingles that over half of
   it holds, and D(a) is the symmetric difference of a and C. Two sets link when
   |a ^ b| <= t (|a| + |b|) with t = (1 - s) / (1 + s), and |a ^ b| is
   |D(a)| + |D(b)| - 2 |D(a) & D(b)|. Let e(a) = |D(a)| - t |a|. Pairs with
   e(a) + e(b) <= 0 are both linked to the class of least e, so they need one
   comparison each. All others link only if they share (e(a) + e(b)) / 2
   differences. Differences are few, and most are held by one class alone and
   left out; shared ones are counted block against block, ``BLOCK`` classes each,
   and give the exact similarity. So thousands of copies of one text, alike or
   not quite, neither make a row per pair nor lose a link.

Links are confirmed on full sets of 64-bit shingle hashes. Components come from
alternating large-star and small-star steps on tables in the scratch folder. A
pair of the required similarity shares no bucket with a probability of
``(1 - s ** rows) ** bands``: 4e-7 for 0.85, 20 bands of 4.

NULL and empty texts have no shingles and are linked with nothing. Repeated
rows link by their text like others. A row without doc_id belongs to its
component, which takes the smallest id that is not NULL; with none it is NULL.
Other columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import map_texts, repeat_rows, written

BITS = 4
BANDS, ROWS = 20, 4
LANES = 64 // BITS
BLOCK = 1024  # classes of a cluster that a task counts against as many others
STARS = 2  # centres per bucket, before the rest is compared
SIGNATURES = "doc_id long, dkey long, n_shingles long, ckey long, packed array<long>, bands array<long>"


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply, twice)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, ASCII white space
    if not words:
        return np.zeros(0, np.uint64)
    if len(known) > 200_000:
        known.clear()
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    span = min(width, len(words))
    total = np.full(len(words) - span + 1, span, np.uint64)
    for i in range(span):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(words) - span + 1 + i])
    return np.unique(total)


def minima(shingles: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the set."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        block = shingles[at : at + 2048]
        least = np.minimum(least, (factors[:, None] * block[None, :] + offsets[:, None]).min(axis=1))
    return least


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    draws = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return draws[:n] | np.uint64(1), draws[n:]


def packed_bits(least: np.ndarray) -> np.ndarray:
    low = mixed(least) & np.uint64((1 << BITS) - 1)
    low = np.concatenate([low, np.zeros(-len(low) % LANES, np.uint64)]).reshape(-1, LANES)
    return (low << (np.arange(LANES, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)


def _signatures(width: int, bands: int, rows: int, batch: pa.RecordBatch) -> dict:
    known, (factors, offsets) = WordHashes(), _functions(bands * rows)
    sizes, keys, packs, buckets = [], [], [], []
    for text in batch.column("text").to_pylist():
        shingles = shingle_set(text, width, known)
        sizes.append(len(shingles))
        if not len(shingles):
            keys.append(0), packs.append(None), buckets.append(None)
            continue
        least = minima(shingles, factors, offsets)
        keys.append(xxhash.xxh3_64_intdigest(shingles.tobytes()))
        packs.append(packed_bits(least).view(np.int64))
        bucket = np.arange(1, bands + 1, dtype=np.uint64)
        for i in range(rows):
            bucket = mixed(bucket * np.uint64(0x9E3779B97F4A7C15) + least.reshape(bands, rows)[:, i])
        buckets.append(bucket.view(np.int64))
    longs = pa.list_(pa.int64())
    return {
        "doc_id": batch.column("doc_id"),
        "dkey": batch.column("dkey"),
        "n_shingles": pa.array(sizes, pa.int64()),
        "ckey": pa.array(np.array(keys, np.uint64).view(np.int64)),
        "packed": pa.array(packs, longs),
        "bands": pa.array(buckets, longs),
    }


def agreement(hashes: int) -> Column:
    """Estimated similarity from ``packed_a`` and ``packed_b``."""
    ones = F.lit(int("1" * LANES, 16))
    differ = F.lit(0)
    for i in range(-(-hashes // LANES)):
        x = F.col("packed_a")[i].bitwiseXOR(F.col("packed_b")[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        differ = differ + F.bit_count(x.bitwiseAND(ones))
    chance = 2.0**-BITS
    return (1 - differ / hashes - chance) / (1 - chance)


def _shingle_rows(width: int, batch: pa.RecordBatch) -> dict:
    known = WordHashes()
    sets = [shingle_set(t, width, known) for t in batch.column("text").to_pylist()]
    keys = np.repeat(batch.column("ckey").to_numpy(), [len(x) for x in sets])
    hashes = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
    return {"ckey": pa.array(keys, pa.int64()), "shingle": pa.array(hashes, pa.int64())}


def _estimated_least(similarity: float, hashes: int) -> float:
    agree = similarity + (1 - similarity) * 2.0**-BITS
    return similarity - 5 * (agree * (1 - agree) / hashes) ** 0.5 / (1 - 2.0**-BITS)


def _confirm(width: int, percent: int, batch: pa.RecordBatch) -> dict:
    known, last, cache = WordHashes(), None, np.zeros(0, np.uint64)
    linked = []
    for a, b in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
        if b != last:  # pairs with one centre follow each other
            last, cache = b, shingle_set(b, width, known)
        one = shingle_set(a, width, known)
        both = len(np.intersect1d(one, cache, assume_unique=True))
        linked.append(100 * both >= percent * (len(one) + len(cache) - both))
    return {"a": batch.column("a"), "b": batch.column("b"), "linked": pa.array(linked, pa.bool_())}


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the least node.

    Alternates large-star and small-star steps until nothing changes.
    """
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    state_of = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    stars = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = state_of(stars)
    while before[0]:
        around = both(stars)
        least = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = around.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("m").alias("b"))
        stars = written(small.filter("a <> b").distinct(), "stars")
        state = state_of(stars)
        if state == before:
            break
        before = state
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = 3, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id of its component) and kept.

    Documents are linked when 100 * intersection >= ``percent`` * union. ``class_id``
    names the class of equal sets; ``kept`` holds when the id is the component's.
    """
    out = _labelled(docs, percent, width, bands, rows)
    alone = F.col("n_shingles") == 0
    smallest = out.filter(~alone).groupBy("root").agg(F.min("doc_id").alias("least"))
    out = out.join(smallest, "root", "left").withColumn("component_id", F.when(alone, F.col("doc_id")).otherwise(F.col("least")))
    return out.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        F.when(~alone, F.col("ckey")).alias("class_id"),
    )


def deduplicate(docs: DataFrame, percent: int = 85, width: int = 3, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id; texts without shingles all stay.

    Ties of repeated ids go to the smaller hash of the text.
    """
    out = _labelled(docs, percent, width, bands, rows)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "dkey")).alias("first")
    winners = out.filter("n_shingles > 0").groupBy("root").agg(first).select(F.col("first.dkey").alias("key"), F.lit(1).alias("times"))
    empty = out.filter("n_shingles = 0").groupBy(F.col("dkey").alias("key")).agg(F.count("*").cast("int").alias("times"))
    return repeat_rows(docs, F.xxhash64("doc_id", "text"), winners.union(empty))


def _labelled(docs: DataFrame, percent: int, width: int, bands: int, rows: int) -> DataFrame:
    """Per row: doc_id, dkey, n_shingles, its class and the root of its component."""
    texts = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("dkey"))
    signed = written(map_texts(texts, partial(_signatures, width, bands, rows), SIGNATURES), "signatures")
    found = signed.filter("n_shingles > 0")
    classes = found.groupBy("ckey").agg(
        F.min_by("dkey", F.struct("doc_id", "dkey")).alias("dkey"), F.first("packed").alias("packed"),
        F.first("bands").alias("bands"), F.first("n_shingles").alias("n"),
    )
    classes = written(classes, "classes")
    entries = classes.select("ckey", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    entries = written(entries.join(shared, "bucket"), "buckets")
    wanted = entries.select("ckey").distinct().join(classes, "ckey").select("ckey", "dkey")
    read = written(texts.join(wanted, "dkey").select("ckey", "text"), "candidate-texts")

    hashes = bands * rows
    bits = classes.select("ckey", "packed")
    likely = _estimated_least(percent / 100, hashes)
    # the same few centres in all buckets that hold them, so that near copies meet few of them
    drawn = [F.min(F.struct(F.xxhash64(F.lit(star), "ckey").alias("h"), "ckey")).alias(f"c{star}") for star in range(STARS)]
    named = F.array_distinct(F.array(*[F.col(f"c{star}.ckey") for star in range(STARS)])).alias("centres")
    # a table of its own, so that a small one is joined without dealing out the entries by bucket
    centres = written(entries.groupBy("bucket").agg(*drawn).select("bucket", named), "centres")
    pairs = entries.join(centres, "bucket").select("ckey", F.explode("centres").alias("centre")).filter("ckey <> centre")
    pairs = pairs.select(F.greatest("ckey", "centre").alias("a"), F.least("ckey", "centre").alias("b")).distinct()
    pairs = pairs.join(bits.toDF("a", "packed_a"), "a").join(bits.toDF("b", "packed_b"), "b")
    pairs = pairs.filter(agreement(hashes) >= likely).select("a", "b")
    pairs = pairs.join(read.toDF("a", "text_a"), "a").join(read.toDF("b", "text_b"), "b")
    compared = written(map_texts(pairs, partial(_confirm, width, percent), "a long, b long, linked boolean"), "compared")
    linked = compared.filter("linked").select("a", "b")
    grown = components(linked)
    here = _with_roots(entries, grown)
    open_buckets = here.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1")
    here = written(here.join(open_buckets.select("bucket"), "bucket"), "open-buckets")
    rest = _rest_links(here, read, classes.select("ckey", "n"), width, percent)
    grown = components(rest.union(linked))

    return _with_roots(signed.select("ckey", "doc_id", "dkey", "n_shingles"), grown)


def _rest_links(here: DataFrame, read: DataFrame, sizes: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) that connect everything that links within the clusters of ``here`` (bucket, ckey, root)."""
    t = (100 - percent) / (100 + percent)
    mates = here.join(here.groupBy("bucket").agg(F.min("ckey").alias("b")), "bucket").select(F.col("ckey").alias("a"), "b")
    members = components(mates.filter("a <> b")).toDF("ckey", "cluster")
    members = members.union(members.select("cluster", "cluster").distinct()).toDF("ckey", "cluster").distinct()
    members = written(members.join(here.select("ckey", "root").distinct(), "ckey").join(sizes, "ckey"), "members")
    counts = written(members.groupBy("cluster").agg(F.count("*").alias("size")), "clusters")
    texts = read.join(members.select("ckey"), "ckey").dropDuplicates(["ckey"])
    held = written(map_texts(texts, partial(_shingle_rows, width), "ckey long, shingle long"), "held")
    held = held.join(members.select("ckey", "cluster"), "ckey")
    often = held.groupBy("cluster", "shingle").agg(F.count("*").alias("f")).join(counts, "cluster")
    often = written(often.withColumn("common", 2 * F.col("f") > F.col("size")), "shingle-counts")
    common = often.filter("common")
    extra = held.join(often.filter("not common"), ["cluster", "shingle"]).select("ckey", "cluster", "shingle", "f", F.lit(True).alias("has"))
    lacking = (
        members.select("ckey", "cluster")
        .join(common.filter("f < size"), "cluster")  # what all of a cluster hold, nobody lacks
        .join(held.select("ckey", "shingle"), ["ckey", "shingle"], "left_anti")
        .select("ckey", "cluster", "shingle", (F.col("size") - F.col("f")).alias("f"), F.lit(False).alias("has"))
    )
    differ = written(extra.union(lacking), "differences")
    excess = members.join(differ.groupBy("ckey").agg(F.count("*").alias("d")), "ckey", "left").na.fill(0, ["d"])
    excess = written(excess.withColumn("e", F.col("d") - t * F.col("n")), "excess")
    least = excess.groupBy("cluster").agg(F.min(F.struct("e", "ckey", "root")).alias("l"))
    excess = excess.join(least, "cluster").join(counts, "cluster")
    # by the bound itself, with a margin for rounding; those within the margin are counted below as well
    near = excess.filter("e + l.e <= -1e-6 and root <> l.root").select("ckey", F.col("l.ckey").alias("b"))
    excess = excess.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    excess = excess.withColumn("block", F.pmod(F.xxhash64("ckey"), "blocks").cast("int")).withColumn("far", F.expr("e + l.e > -1e-6"))
    element = F.xxhash64("shingle", "has").alias("element")
    shared = differ.filter("f > 1").groupBy("ckey").agg(F.collect_list(element).alias("elements"))
    rows = excess.join(shared, "ckey").select("cluster", "block", "blocks", "far", "ckey", "root", "n", "d", "elements")
    rows = written(rows, "blocks")
    numbers = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    one = rows.filter("far").withColumn("other", numbers)
    keys = ["cluster", "block", "other"]
    names = {c: f"their_{c}" for c in ("ckey", "root", "n", "d", "elements")}
    two = rows.select(
        "cluster", F.col("block").alias("other"), numbers.alias("block"), *[F.col(c).alias(a) for c, a in names.items()]
    )
    met = one.groupBy(*keys).cogroup(two.groupBy(*keys)).applyInPandas(partial(_block_links, percent), "ckey long, b long")
    return near.union(met).select(F.greatest("ckey", "b").alias("a"), F.least("ckey", "b").alias("b"))


def _block_links(percent: int, far: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
    """Links of the classes of one block to those of another: one per class and component met."""
    out: list[tuple[int, int]] = []
    if len(far) and len(near):
        elements = np.concatenate(near["their_elements"].to_list())
        holders = np.repeat(np.arange(len(near)), near["their_elements"].map(len))
        order = np.argsort(elements, kind="stable")
        elements, holders = elements[order], holders[order]
        n, d, roots, keys = (near[f"their_{c}"].to_numpy() for c in ("n", "d", "root", "ckey"))
        for row in far.itertuples():
            own = np.asarray(row.elements)
            starts, ends = (np.searchsorted(elements, own, side) for side in ("left", "right"))
            met = [holders[a:b] for a, b in zip(starts, ends) if b > a]
            if not met:
                continue
            overlap = np.bincount(np.concatenate(met), minlength=len(n))
            both = (n + row.n - (d + row.d - 2 * overlap)) // 2
            fits = np.flatnonzero((overlap > 0) & (roots != row.root) & (100 * both >= percent * (n + row.n - both)))
            _, first = np.unique(roots[fits], return_index=True)
            out += [(row.ckey, keys[i]) for i in fits[first]]
    return pd.DataFrame(out, columns=["ckey", "b"], dtype="int64")


def _with_roots(rows: DataFrame, grown: DataFrame | None) -> DataFrame:
    """``rows`` (ckey, ...) with the root of their component."""
    if grown is None:
        return rows.withColumn("root", F.col("ckey")).select("*")
    joined = rows.join(grown, F.col("ckey") == F.col("node"), "left")
    return joined.select(*rows.columns, F.coalesce("root", "ckey").alias("root"))
