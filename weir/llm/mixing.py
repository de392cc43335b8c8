"""Mix sources to target weights by fitting subset sums to word budgets.

Sources, in code-point order with NULL last, weigh 1, 2, 3, repeating. Together
they get as many words as there are; a target stops at three times its source's
size, and what is above goes to the others by weight. A source is taken whole
as often as its target allows; a chosen subset of its documents fills the rest.

The subset is chosen on counts, not on rows. A source's documents are counted
by exact length; per source one task walks the lengths in seeded order, takes
the same share of each, and closes the remaining budget, at most ``window``
words, with a bounded-knapsack dynamic program over subset sums. The result
says how many documents of each length to take; which ones, a seeded hash
decides. Ranks within a length come from counts per hash bin, so a length or a
source with a third of all rows is never gathered in one task.

Size is the number of words (``[^\\x20\\x09-\\x0D]+``); NULL and empty texts have
size 0 and are never taken. Repeated rows count as rows of their own. NULL ids
are hashed like a value of their own. Only doc_id, text and source are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import repeat_rows, row_key, seeded, text_key, word_count, written

SEED = 17
WINDOW = 1 << 15  # words that the dynamic program may close at most
BINS = 256
MOST = 3  # no target and no document is taken more often


def water_fill(sizes: DataFrame) -> DataFrame:
    """(skey, source_size) with ``target``: equal per unit of weight, up to the cap.

    Whoever is capped has cap / weight under the common level; sorted by that
    ratio the capped ones are a prefix, so running sums find the level. The
    table has one row per source.
    """
    ranked = sizes.withColumn("weight", (F.row_number().over(Window.orderBy("skey")) - 1) % 3 + 1)
    ranked = ranked.withColumn("cap", F.col("source_size") * MOST)
    below = Window.orderBy(F.col("cap") / F.col("weight"), "skey").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = ranked.withColumn("rest", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(below), F.lit(0)))
    levels = levels.withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0)))
    levels = levels.withColumn("level", F.col("rest") / F.col("open"))
    fits = F.col("level") * F.col("weight") <= F.col("cap")  # nobody from here on is above
    level = F.max(F.when(fits, F.col("level"))).over(everything)  # the first: levels only fall after it
    return levels.withColumn("first", level).select(
        "skey",
        "source_size",
        F.least(F.col("cap").cast("double"), F.coalesce("first", F.lit(float("inf"))) * F.col("weight")).alias("target"),
    )


def fit_counts(lengths, counts, budget: int, key: str, seed: int = SEED, window: int = WINDOW) -> np.ndarray:
    """How many documents of each length to take so that the words come near ``budget``."""
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    taken = np.zeros_like(counts)
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return taken
    if budget >= total:
        return counts.copy()
    rng = np.random.default_rng([seed, zlib.crc32(key.encode())])
    share, rest = budget / total, budget
    order = rng.permutation(len(lengths))
    draw = rng.random(len(lengths))
    for i in order:  # the same share of each length, rounded at random, down to the window
        n = min(int(counts[i] * share + draw[i]), int(counts[i]), max(rest - window, 0) // int(lengths[i]))
        taken[i] = n
        rest -= n * int(lengths[i])
    for i in order:  # what rounding left above the window
        if rest <= window:
            break
        n = min(int(counts[i] - taken[i]), -(-(rest - window) // int(lengths[i])), rest // int(lengths[i]))
        taken[i] += n
        rest -= n * int(lengths[i])
    taken[order] += _knapsack(lengths[order], (counts - taken)[order], rest)
    return taken


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Counts whose lengths sum to the reachable value nearest to ``budget``.

    Reachable sums are bits of one integer. Bounded counts are split into
    powers of two; each sum remembers the part that reached it first. Lengths
    are used in the order given.
    """
    taken = np.zeros_like(counts)
    if budget <= 0:
        return taken
    top = 2 * budget  # 0 is nearer than what lies beyond
    mask, reach, parts = (1 << (top + 1)) - 1, 1, []
    source = np.full(top + 1, -1, np.int32)
    for i in range(len(lengths)):
        left, chunk = min(int(counts[i]), top // int(lengths[i])), 1
        while left > 0:
            chunk = min(chunk, left)
            step = chunk * int(lengths[i])
            new = (reach << step) & mask & ~reach
            if new:
                bits = np.unpackbits(np.frombuffer(new.to_bytes(top // 8 + 1, "little"), np.uint8), bitorder="little")
                source[np.flatnonzero(bits[: top + 1])] = len(parts)
                parts.append((i, chunk, step))
                reach |= new
            left -= chunk
            chunk *= 2
        if reach >> budget & 1:
            break
    under = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1
    over = reach >> budget
    over = budget + (over & -over).bit_length() - 1 if over else top + 1
    at = over if over - budget < budget - under else under
    while at > 0:
        i, chunk, step = parts[source[at]]
        taken[i] += chunk
        at -= step
    return taken


def mix_sources(docs: DataFrame, seed: int = SEED, window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, size, source_size, target (its source's) and the words taken."""
    return _mixed(docs, F.col("doc_id"), seed, window).drop("key")


def apply_mix(docs: DataFrame, seed: int = SEED, window: int = WINDOW) -> DataFrame:
    """``docs`` with every row as often as the mix takes it."""
    copies = _mixed(docs, row_key(docs), seed, window).groupBy("key").agg(F.sum("copies").alias("times"))
    return repeat_rows(docs, row_key(docs), copies)


def _mixed(docs: DataFrame, key: Column, seed: int, window: int) -> DataFrame:
    rows = written(
        docs.select(
            "doc_id",
            key.alias("key"),
            text_key(F.col("source")).alias("skey"),
            word_count(F.col("text")).alias("size"),
            seeded(seed, F.col("doc_id")).alias("h"),
        ),
        "mix-sizes",
    ).withColumn("bin", F.pmod("h", F.lit(BINS)))
    bins = rows.groupBy("skey", "size", "bin").agg(F.count("*").alias("n"))
    histogram = bins.groupBy("skey", "size").agg(F.sum("n").alias("n"))
    targets = water_fill(histogram.groupBy("skey").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    targets = written(
        targets.withColumn(
            "whole", F.when(F.col("source_size") > 0, F.least(F.lit(MOST), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("long")
        ).withColumn("budget", (F.round("target") - F.col("whole") * F.col("source_size")).cast("long")),
        "mix-targets",
    )

    def fit(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        chosen = fit_counts(group["size"], group["n"], int(group["budget"].iloc[0]), key[0], seed, window)
        return pd.DataFrame({"skey": key[0], "size": group["size"].to_numpy(), "chosen": chosen})

    chosen = (
        histogram.filter("size > 0")
        .join(targets.select("skey", "budget"), "skey")
        .groupBy("skey")
        .applyInPandas(fit, "skey string, size long, chosen long")
    )
    before = F.coalesce(F.sum("n").over(Window.partitionBy("skey", "size").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    quota = (
        bins.join(chosen, ["skey", "size"], "left")
        .withColumn("quota", F.greatest(F.lit(0), F.least("n", F.coalesce("chosen", F.lit(0)) - before)))
        .select("skey", "size", "bin", "n", "quota")
    )
    quota = written(quota, "mix-quota")
    # Most bins are taken whole or not at all; only cut bins need an order.
    joined = rows.join(quota, ["skey", "size", "bin"])
    rank = F.row_number().over(Window.partitionBy("skey", "size", "bin").orderBy("h", "doc_id"))
    cut = joined.filter("quota > 0 and quota < n").withColumn("extra", (rank <= F.col("quota")).cast("long"))
    plain = joined.filter("quota = 0 or quota = n").withColumn("extra", (F.col("quota") > 0).cast("long"))
    picked = plain.unionByName(cut).select("doc_id", "key", "skey", "size", "extra")
    return picked.join(targets, "skey").select(
        "doc_id",
        "key",
        "size",
        "source_size",
        "target",
        (F.col("size") * (F.col("whole") + F.col("extra"))).alias("taken"),
        (F.col("whole") + F.col("extra")).alias("copies"),
    )
