"""Phrases of two and three words that stand out, by best-first branch and bound.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those
into words ``[^\\x20\\x09]+``. All is per language. A phrase with count ``a`` that is
cut into parts with counts ``l`` and ``r`` scores ``floor(1000000 a a / (l r))``; its
lowest cut counts.

Phrases grow from their prefixes. A first pass adds up words and pairs in
``2 ** BUCKETS`` buckets of a hash; only those whose bucket holds ``least`` can be
frequent, so only they are counted one by one (their bitmap, 16 MiB, is
broadcast). The counts of words and word pairs give every
pair a bound, ``floor(1000000 f(pair) / f(first word))``: no phrase that begins with
the pair, nor the pair itself, scores more, as a count is never above those of
its parts. Pairs are expanded in falling order of that bound: one pass over the
corpus counts the phrases of three words that hold an open pair, as their prefix
(growth) or as their end (which decides whether the pair survives). A language is
settled once ``top`` phrases survive at or above the level down to which it is
expanded: what is not expanded scores less, so ties at the last place are all
there. Others go on, four times as deep each round.

The frontier is cut by a histogram of bounds (at most 1,001 rows a language on
the driver). A pass opens at most ``OPEN`` pairs, which are broadcast; more are
taken in several passes. Tasks combine counts before the shuffle, by language and
phrase, so a hot language or phrase is spread. Long texts are counted in stretches
that end at a piece, and a very long piece in halves and across their cut.

NULL texts count as empty, a NULL language as ``und``; a language without words has
no rows. Repeated rows count again. Columns other than lang and text are ignored.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import written
from weir.llm.near_dups import mixed

TO_PIECES = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")
STRETCH = 1 << 22  # bytes of text whose words a task holds at once
HELD = 1 << 20  # distinct phrases that a task holds before it hands them on
BITS = 21  # of a word's number
LISTED = 1 << 18  # words that a task knows before it starts a new list
BUCKETS = 27
OPEN = 1 << 17  # pairs that one pass over the corpus opens
LEVELS = 1000  # steps of the bound
UNIT = 1_000_000
COUNTS = "lang string, w1 string, w2 string, w3 string, n long"


class Hashes(dict):
    """Hashes of words, forgotten when there are many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= LISTED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word) if word != b"\xff" else 0
        return value


class Words(dict):
    """Numbers of words from 1, and their hashes; 0 stands between pieces."""

    def __init__(self, first: list[bytes] = ()):
        super().__init__({b"\xff": 0})  # no byte of UTF-8
        self.names, self.hashes = [b""], array("Q", [0])
        for word in first:
            self[word]
        self.given = len(self.names)

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names)
        self.names.append(word)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        return number


def stretches(texts: list[bytes | None]) -> Iterator[bytes]:
    """The texts, lower-cased and with line ends between pieces, about ``STRETCH`` bytes at a time."""
    held, size = [], 0
    for text in texts:
        text = (text or b"").lower().translate(TO_PIECES)
        start = 0
        while len(text) - start > STRETCH and (end := text.find(b"\n", start + STRETCH)) >= 0:
            yield text[start:end]
            start = end
        held.append(text[start:])
        size += len(text) - start
        if size > STRETCH:
            yield b"\n".join(held)
            held, size = [], 0
    yield b"\n".join(held)


def tokens_of(stretch: bytes) -> list[bytes]:
    return stretch.replace(b"\n", b" \xff ").split()


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(codes):
        return codes, counts
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[first], np.add.reduceat(counts[order], first)


def buckets(lang: str, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word, and of each pair of neighbours."""
    seed = np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))
    step = np.uint64(0x9E3779B97F4A7C15)
    first = mixed(hashes ^ seed)
    second = mixed(first[:-1] * step + hashes[1:])
    shift = np.uint64(64 - BUCKETS)
    return (first >> shift).astype(np.int32), (second >> shift).astype(np.int32)


def frequent_only(lang: str, bitmap: np.ndarray, words: Words, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of all words together, and of the words and pairs whose bucket is in the bitmap."""
    one, two = buckets(lang, np.frombuffer(words.hashes, np.uint64)[ids])
    marked = lambda at: (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
    a, b = ids[:-1], ids[1:]
    pairs = ((a << 2 * BITS) | (b << BITS))[(a > 0) & (b > 0) & marked(two)]
    codes, counts = np.unique(np.concatenate([pairs, ids[(ids > 0) & marked(one)] << 2 * BITS]), return_counts=True)
    return np.r_[0, codes], np.r_[np.count_nonzero(ids), counts]


def triples_with(open_pairs: np.ndarray, words: Words, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the phrases of three words that hold one of ``open_pairs`` (sorted codes)."""
    pairs = (ids[:-1] << BITS) | ids[1:]
    at = np.minimum(np.searchsorted(open_pairs, pairs), len(open_pairs) - 1)
    opened = open_pairs[at] == pairs
    a, b, c = ids[:-2], ids[1:-1], ids[2:]
    kept = (a > 0) & (b > 0) & (c > 0) & (opened[:-1] | opened[1:])
    return np.unique(((a << 2 * BITS) | (b << BITS) | c)[kept], return_counts=True)


class Tally:
    """Counts of phrases in one language, combined within a task."""

    def __init__(self, lang: str, first: list[bytes], count: Callable):
        self.lang, self.first, self.count = lang, first, count
        self.clear()

    def clear(self) -> None:
        self.words, self.parts, self.size = Words(self.first), [], 0

    def add(self, tokens: list[bytes], sign: int = 1) -> Iterator[pa.RecordBatch]:
        ids = np.fromiter(map(self.words.__getitem__, tokens), np.int64, len(tokens))
        if len(self.words.names) >= 1 << BITS:  # numbers no longer fit: count these tokens with a new list of words
            yield from self.rows()
            if len(tokens) >= 1 << BITS - 1:  # a very long piece: in halves, and the phrases across the cut
                half = len(tokens) // 2
                ends = tokens[half - 2 : half], tokens[half : half + 2]
                for some, times in ((tokens[:half], 1), (tokens[half:], 1), (ends[0] + ends[1], 1), (ends[0], -1), (ends[1], -1)):
                    yield from self.add(some, times * sign)
                return
            ids = np.fromiter(map(self.words.__getitem__, tokens), np.int64, len(tokens))
        codes, counts = self.count(self.words, ids if len(ids) > 2 else np.r_[ids, 0, 0])
        self.parts.append((codes, sign * counts))
        self.size += len(codes)
        if self.size > 2 * HELD:
            self.parts = [self.merged()]
            self.size = len(self.parts[0][0])
            if self.size > HELD:
                yield from self.rows()

    def learned(self) -> int:
        return len(self.words.names) - self.words.given

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        codes, counts = (np.concatenate([np.zeros(0, np.int64), *[p[i] for p in self.parts]]) for i in range(2))
        return summed(codes, counts)

    def rows(self) -> Iterator[pa.RecordBatch]:
        codes, counts = self.merged()
        names = pa.array(self.words.names, pa.binary()).cast(pa.string())
        mask = (1 << BITS) - 1
        for at in range(0, len(codes), 1 << 16):
            some = codes[at : at + (1 << 16)]
            places = [(some >> shift) & mask for shift in (2 * BITS, BITS, 0)]
            words = [names.take(pa.array(p, mask=p == 0)) for p in places]
            lang = pa.array([self.lang] * len(some), pa.string())
            yield pa.RecordBatch.from_arrays([lang, *words, pa.array(counts[at : at + (1 << 16)])], [f.split()[0] for f in COUNTS.split(", ")])
        self.clear()


def _texts_by_lang(batch: pa.RecordBatch) -> dict[str, list[bytes]]:
    out = defaultdict(list)
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
        out[lang].append(text)
    return out


def _tallied(counter: Callable[[str], tuple[list[bytes], Callable]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tallies: dict[str, Tally] = {}
    for batch in batches:
        for lang, own in _texts_by_lang(batch).items():
            if lang not in tallies:
                tallies[lang] = Tally(lang, *counter(lang))
            for stretch in stretches(own):
                yield from tallies[lang].add(tokens_of(stretch))
            while sum(t.size for t in tallies.values()) > 2 * HELD:
                yield from max(tallies.values(), key=lambda t: t.size).rows()
            while sum(t.learned() for t in tallies.values()) > LISTED:
                yield from max(tallies.values(), key=Tally.learned).rows()
    for tally in tallies.values():
        yield from tally.rows()


def _counted(rows: DataFrame, counter: Callable, least: int, label: str) -> DataFrame:
    """Counts over all rows of every phrase that ``counter`` finds ``least`` times; sums of all words stay."""
    parts = rows.mapInArrow(lambda batches: _tallied(counter, batches), COUNTS)
    whole = parts.groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n"))
    return written(whole.filter((F.col("n") >= least) | F.col("w1").isNull()), label)


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, parts, size = Hashes(), [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        return summed(*(np.concatenate([p[i] for p in parts]) for i in range(2)))

    for batch in batches:
        for lang, own in _texts_by_lang(batch).items():
            for stretch in stretches(own):
                tokens = tokens_of(stretch)
                hashes = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
                one, two = buckets(lang, hashes)
                both = np.concatenate([one[hashes > 0], two[(hashes[:-1] > 0) & (hashes[1:] > 0)]])
                parts.append(np.unique(both, return_counts=True))
                size += len(parts[-1][0])
                if size > 2 * HELD:
                    parts = [merged()]
                    size = len(parts[0][0])
                    if size > HELD:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, parts[0])), ["bucket", "n"])
                        parts, size = [], 0
    if parts:
        yield pa.RecordBatch.from_arrays(list(map(pa.array, merged())), ["bucket", "n"])


def _bitmap(rows: DataFrame, least: int) -> np.ndarray:
    """A bit for each bucket that holds ``least`` words and pairs; of a fixed size."""
    full = rows.mapInArrow(_bucket_counts, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    bits = full.groupBy((F.col("bucket") / 32).cast("int").alias("at")).agg(F.expr("bit_or(shiftleft(1L, bucket % 32))").alias("bits"))
    found = bits.toArrow()
    out = np.zeros(1 << BUCKETS - 5, "<u4")
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint8)


def _pair_counter(bitmap, lang: str):
    return [], partial(frequent_only, lang, bitmap.value)


def _triple_counter(opened, lang: str):
    words, codes = opened.value.get(lang, ([], None))
    if codes is None:
        return [], lambda words, ids: (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return words, partial(triples_with, codes)


def _packed(pairs: list) -> dict[str, tuple[list[bytes], np.ndarray]]:
    """Per language the words of its open pairs and the sorted codes of these."""
    out = {}
    by_lang = defaultdict(list)
    for r in pairs:
        by_lang[r.lang].append((r.w1.encode(), r.w2.encode()))
    for lang, own in by_lang.items():
        words = Words()
        out[lang] = None, np.sort(np.array([(words[a] << BITS) | words[b] for a, b in own], np.int64))
        out[lang] = words.names[1:], out[lang][1]
    return out


def floor_score(a: str, left: str, right: str) -> Column:
    """Exact ``floor(UNIT * a * a / (left * right))`` of long columns below 10 ** 15."""
    wide = lambda c: f"cast({c} as decimal(15,0))"
    return F.expr(f"(cast({UNIT} as decimal(7,0)) * {wide(a)} * {wide(a)}) div ({wide(left)} * {wide(right)})")


def _scored_pairs(grams: DataFrame) -> DataFrame:
    words = grams.filter("w1 is not null and w2 is null").select("lang", "w1", "n")
    pairs = grams.filter("w2 is not null").select("lang", "w1", "w2", F.col("n").alias("a"))
    found = pairs.join(words.withColumnRenamed("n", "l"), ["lang", "w1"])
    found = found.join(words.toDF("lang", "w2", "r"), ["lang", "w2"])
    found = found.withColumn("score", floor_score("a", "l", "r"))
    return found.withColumn("level", F.floor(floor_score("a", "a", "l") / (UNIT // LEVELS)).cast("int"))


def _scored_triples(triples: DataFrame, grams: DataFrame, pairs: DataFrame) -> DataFrame:
    """Both cuts of each phrase, the lower one kept; the first of equals."""
    words = grams.filter("w1 is not null and w2 is null")
    counts = pairs.select("lang", "w1", "w2", "a")
    found = triples.select("lang", "w1", "w2", "w3", F.col("n").alias("a"))
    found = found.join(words.select("lang", "w1", F.col("n").alias("l1")), ["lang", "w1"])
    found = found.join(words.select("lang", F.col("w1").alias("w3"), F.col("n").alias("r2")), ["lang", "w3"])
    found = found.join(counts.withColumnRenamed("a", "l2"), ["lang", "w1", "w2"])
    found = found.join(counts.toDF("lang", "w2", "w3", "r1"), ["lang", "w2", "w3"])
    found = found.withColumn("s1", floor_score("a", "l1", "r1")).withColumn("s2", floor_score("a", "l2", "r2"))
    low = lambda one, two: F.when(F.col("s2") < F.col("s1"), F.col(two)).otherwise(F.col(one))
    return found.select("lang", "w1", "w2", "w3", "a", low("l1", "l2").alias("l"), low("r1", "r2").alias("r"), F.least("s1", "s2").alias("score"))


def _survivors(pairs: DataFrame, triples: DataFrame, share: int) -> DataFrame:
    """Phrases that no longer phrase with ``share`` percent of their count holds: lang, phrase, a, l, r, score."""
    inside = F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2"))))
    held = triples.select("lang", inside.alias("p"), "a").groupBy("lang", "p.w1", "p.w2").agg(F.max("a").alias("longer"))
    left = pairs.join(held, ["lang", "w1", "w2"], "left").filter(f"longer is null or 100 * longer < {share} * a")
    numbers = ["a", "l", "r", "score"]
    two = left.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), *numbers)
    return two.union(triples.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), *numbers))


def _lowered(shape: dict[str, list[int]], levels: dict[str, int], wanted: int) -> dict[str, int]:
    """How far down each unsettled language goes to open at least ``wanted`` more pairs."""
    out = {}
    for lang, level in levels.items():
        more = 0
        while level and more < wanted:
            level -= 1
            more += shape[lang][level]
        out[lang] = level
    return out


def collocations(docs: DataFrame, top: int = 2000, least: int = 10, share: int = 50, batch: int = OPEN) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Ordered by score, then count, both falling, then phrase by its bytes.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").filter("text is not null")
    bitmap = spark.sparkContext.broadcast(_bitmap(rows, least))
    grams = _counted(rows, partial(_pair_counter, bitmap), least, "grams")
    pairs = written(_scored_pairs(grams), "pairs")
    shape: dict[str, list[int]] = defaultdict(lambda: [0] * (LEVELS + 1))
    for r in pairs.groupBy("lang", "level").count().collect():  # at most LEVELS + 1 a language
        shape[r.lang][r.level] = r["count"]
    settled: dict[str, int] = {}
    levels = dict.fromkeys(shape, LEVELS + 1)
    triples, survivors, wanted = [], None, 4 * top
    while levels:
        lowered = _lowered(shape, levels, wanted)
        spans = spark.createDataFrame([(k, lowered[k], levels[k]) for k in levels], "lang string, low int, high int")
        opened = pairs.join(F.broadcast(spans), "lang").filter("level >= low and level < high")
        passes = max(1, -(-sum(sum(shape[k][lowered[k] : levels[k]]) for k in levels) * 5 // (batch * 4)))
        here = rows.join(F.broadcast(spans.select("lang")), "lang")
        for i in range(passes):
            part = opened.filter(F.pmod(F.xxhash64("lang", "w1", "w2"), F.lit(passes)) == i)
            shared = spark.sparkContext.broadcast(_packed(part.select("lang", "w1", "w2").collect()))
            triples.append(_counted(here, partial(_triple_counter, shared), least, "triples"))
        levels = lowered
        whole = triples[0]
        for more in triples[1:]:
            whole = whole.union(more)  # a phrase met by several passes has the same count in each
        whole = whole.filter("w3 is not null").dropDuplicates(["lang", "w1", "w2", "w3"])
        floors = spark.createDataFrame([*(settled | levels).items()], "lang string, low int")
        found = _survivors(pairs, _scored_triples(whole, grams, pairs), share).join(F.broadcast(floors), "lang")
        survivors = written(found.filter(f"score >= low * {UNIT // LEVELS}").drop("low"), "survivors")
        reached = {r.lang: r["count"] for r in survivors.groupBy("lang").count().collect()}
        done = [k for k, level in levels.items() if not level or reached.get(k, 0) >= top]
        settled |= {k: levels.pop(k) for k in done}
        wanted *= 4
    if survivors is None:  # no pair is frequent enough
        survivors = pairs.select("lang", F.lit("").alias("phrase"), "a", "l", "r", "score")
    return _ranked(survivors, grams, top)


def _ranked(survivors: DataFrame, grams: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = survivors.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    sums = grams.filter("w1 is null").select("lang", "n")
    return best.join(sums, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
