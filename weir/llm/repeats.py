"""Remove repeated passages: a run-compressed index of the corpus and matching statistics.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts earlier: in
a document with a smaller id, or earlier in its own. The index is that of a
run-length compressed Burrows-Wheeler transform, kept at anchors instead of at
every byte:

* Anchors. Among the ``GRAM``-byte strings of each ``LENGTH``-byte string the one
  with the least hash is an anchor, so equal strings have equal anchors. Only
  about 1 byte in 35 starts one.
* Runs. Anchors are sorted by what follows, with what precedes as their symbol,
  as far as a ``LENGTH``-byte string around the anchor can reach. Occurrences equal
  in both are a run; a run stores its first end, the earliest place, as sample.
  Repetitive text has long runs.
* Matching statistics. Occurrences are streamed against the runs. Any but the
  sample of its run matches an earlier place with its whole surroundings. The
  samples of anchors with several runs match in part: they are brought together
  by anchor, at most about ``SHARD`` in a task, and their strings are met in the
  order of places. Only an anchor with more runs than that sends the strings
  that a shard met first on to be compared across shards.

Every step is an aggregate combined in each task, a join whose larger side may be
split, or a sweep over bounded shards, so a passage in a third of all documents is
no hot spot. Keys are two 64-bit hashes, of the anchor and of its surroundings or
the string; within a shard the bytes themselves are compared.

Text is UTF-8 bytes; NULL and empty texts have none and lose none. Documents with
equal ids come in order of a hash of their text; NULL ids come last. Of rows equal
in id and text all but one repeat it whole. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import discard, map_batches, written

LENGTH = 100
GRAM = 32
CHUNK = 1 << 19  # bytes hashed at a time; longer documents are a chunk of their own
LAST = (1 << 63) - 1
SHARD = 4096  # samples of one anchor that a task meets
AROUND = "gram long, doc long, th long, pos long, left int, around binary"
FOUND = "doc long, th long, pos long, upto int, gram long, around long"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place on (those at the end are cut off)."""
    x = _mixed(data.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    step = 1
    while step < GRAM:  # doubling: the hash of 2n bytes from two of n bytes
        factor = np.uint64(0x9E3779B97F4A7C15 + 2 * step)
        x[: len(x) - step] = x[: len(x) - step] * factor + x[step:]
        step *= 2
    return np.maximum(_mixed(x), np.uint64(1))


def _sliding(x: np.ndarray, width: int, best, pad) -> np.ndarray:
    """best() of x[i : i + width] at each i."""
    x = np.concatenate([x, np.full(width, pad, x.dtype)])
    done = 1
    while done < width:
        step = min(done, width - done)
        x[: len(x) - step] = best(x[: len(x) - step], x[step:])
        done += step
    return x[: len(x) - width]


def anchors(data: np.ndarray, ends: np.ndarray, length: int = LENGTH):
    """Anchor places, gram hashes, and the least hash of each string of documents laid end to end.

    ``ends`` holds the end of the document of each byte. A string that would
    leave its document has least hash 0.
    """
    top = np.iinfo(np.uint64).max
    place = np.arange(len(data))
    grams = gram_hashes(data)
    grams[place + GRAM > ends] = top
    width = length - GRAM + 1
    least = _sliding(grams, width, np.minimum, top)
    least[place + length > ends] = 0
    # a gram is an anchor if it is the least of some string that it lies in
    most = _sliding(least[::-1], width, np.maximum, 0)[::-1]
    return np.flatnonzero(most == grams), grams, least


def _chunks(texts: list[bytes]):
    """(first document, bytes of some documents laid end to end, their ends)."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= CHUNK):
            size += len(texts[to])
            to += 1
        yield at, b"".join(texts[at:to]), np.cumsum([len(t) for t in texts[at:to]])
        at = to


def _encoded(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _index(length: int, batch: pa.RecordBatch) -> dict:
    """Anchors of each document with a hash of their surroundings."""
    docs, ths = batch.column("doc").to_numpy(), batch.column("th").to_numpy()
    reach = length - GRAM
    out: list[list[np.ndarray]] = []
    for first, joined, stops in _chunks(_encoded(batch)):
        data = np.frombuffer(joined, np.uint8)
        if len(data) < length:
            continue
        sizes = np.diff(stops, prepend=0)
        places, grams, _ = anchors(data, np.repeat(stops, sizes), length)
        if not len(places):
            continue
        doc = np.searchsorted(stops, places, "right")
        start, stop = stops[doc] - sizes[doc], stops[doc]
        left, right = np.maximum(places - reach, start), np.minimum(places + GRAM + reach, stop)
        view, digest = memoryview(joined), xxhash.xxh3_64_intdigest
        around = [digest(view[a:b], p - a) for a, b, p in zip(left.tolist(), right.tolist(), places.tolist())]
        columns = docs[first + doc], ths[first + doc], places - start, right - places, grams[places].view(np.int64)
        out.append([*columns, np.array(around, np.uint64).view(np.int64)])
    names = ("doc", "th", "pos", "upto", "gram", "around")
    joined = [np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(len(names))]
    return {n: pa.array(c, pa.int32() if n == "upto" else pa.int64()) for n, c in zip(names, joined)}


def _surroundings(length: int, batch: pa.RecordBatch) -> dict:
    """The bytes around given anchors, as far as a string can reach."""
    out: dict[str, list] = {"gram": [], "doc": [], "th": [], "pos": [], "left": [], "around": []}
    reach = length - GRAM
    for doc, th, text, wanted in zip(batch.column("doc").to_pylist(), batch.column("th").to_pylist(), _encoded(batch), batch.column("wanted").to_pylist()):
        for anchor in wanted:
            pos = anchor["pos"]
            start = max(pos - reach, 0)
            for name, value in zip(out, (anchor["gram"], doc, th, pos, pos - start, text[start : pos + GRAM + reach])):
                out[name].append(value)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return {name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds)}


def _sweep(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Meet the strings of each (gram, shard) in the order of places.

    Rows come sorted. Gives the places that repeat an earlier one as (doc, th, a,
    b), and where a gram has several shards the first of each string as well,
    with its hash.
    """
    digest = xxhash.xxh3_64_intdigest
    group, seen = None, {}
    for batch in batches:
        out: list[tuple] = []
        columns = (batch.column(c).to_pylist() for c in ("gram", "shard", "shards", "doc", "th", "pos", "left", "around"))
        for gram, shard, shards, doc, th, pos, left, around in zip(*columns):
            if group != (gram, shard):
                group, seen = (gram, shard), {}
            start = pos - left
            a = b = None
            for i in range(min(left, len(around) - length) + 1):
                string = around[i : i + length]
                here = (doc, th, start + i)
                first = seen.setdefault(string, here)
                if first is not here and first != here:  # in periodic text anchors of a place overlap
                    if b is None or start + i > b:
                        if b is not None:
                            out.append((doc, th, a, b, None, None))
                        a = start + i
                    b = start + i + length
                elif shards > 1 and first is here:
                    out.append((doc, th, start + i, start + i + length, gram, digest(string) - (1 << 63)))
            if b is not None:
                out.append((doc, th, a, b, None, None))
        columns = list(zip(*out)) or [()] * 6
        names = ["doc", "th", "a", "b", "gram", "string"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def removed_bytes(size: int, spans) -> np.ndarray:
    change = np.zeros(size + 1, np.int64)
    for a, b in spans or ():
        change[a] += 1
        change[b] -= 1
    return np.cumsum(change[:-1]) > 0


def _remove(batch: pa.RecordBatch) -> dict:
    out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
    for text, starts, ends in zip(_encoded(batch), batch.column("starts").to_pylist(), batch.column("ends").to_pylist()):
        gone = removed_bytes(len(text), zip(starts or (), ends or ()))
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if starts else text
        out["n_bytes"].append(len(text))
        out["n_removed"].append(int(gone.sum()))
        out["n_spans"].append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
        out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
    return {c: batch.column(c) for c in ("doc_id", "doc", "th")} | {n: pa.array(v) for n, v in out.items()}


def repeated_spans(docs: DataFrame, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """(doc, th, starts, ends): the places of each document that earlier ones, or earlier parts, repeat.

    ``docs`` has (doc, th, text), with (doc, th) unique and the order of documents.
    """
    place = F.struct("doc", "th", "pos")
    found = written(map_batches(docs.select("doc", "th", "text"), partial(_index, length), FOUND), "anchors")
    # as a table of its own, so that the join can split a common anchor
    often = written(found.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"), "common-grams")
    anchored, found = found, written(found.join(often, "gram", "left_semi"), "repeated-anchors")
    discard(anchored)
    runs = written(found.groupBy("gram", "around").agg(F.min(place).alias("sample")), "runs")
    whole = found.join(runs, ["gram", "around"]).filter(place != F.col("sample"))
    reach = length - GRAM
    whole = whole.select("doc", "th", F.greatest(F.col("pos") - reach, F.lit(0)).alias("a"), (F.col("pos") + F.col("upto")).alias("b"))
    whole = written(whole.filter(F.col("b") - F.col("a") >= length), "whole-matches")
    discard(found)

    several = runs.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1")
    several = written(several.withColumn("shards", F.ceil(F.col("n") / shard).cast("int")).drop("n"), "cut-grams")
    cut = runs.join(several, "gram", "left_semi").select("gram", "sample.*")
    cut = cut.groupBy("doc", "th").agg(F.collect_list(F.struct("gram", "pos")).alias("wanted"))
    around = map_batches(docs.select("doc", "th", "text").join(cut, ["doc", "th"]), partial(_surroundings, length), AROUND)
    sharded = around.join(several, "gram").withColumn("shard", F.pmod(F.xxhash64("doc", "th", "pos"), "shards"))
    key = ["gram", "shard"]
    sorted_rows = sharded.repartition(*key).sortWithinPartitions(*key, "doc", "th", "pos")
    met = sorted_rows.mapInArrow(partial(_sweep, length), "doc long, th long, a long, b long, gram long, string long")
    met = written(met, "cut-matches")
    discard(runs)
    place = F.struct("doc", "th", "a")
    firsts = met.filter("gram is not null")
    earliest = firsts.groupBy("gram", "string").agg(F.min(place).alias("sample"))
    across = firsts.join(earliest, ["gram", "string"]).filter(place != F.col("sample"))
    part = met.filter("gram is null").select("doc", "th", "a", "b").union(across.select("doc", "th", "a", "b"))
    spans = whole.union(part).groupBy("doc", "th").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    spans = written(spans.select("doc", "th", F.col("spans.a").alias("starts"), F.col("spans.b").alias("ends")), "repeated-spans")
    discard(whole)
    discard(met)
    return spans


def remove_repeats(docs: DataFrame, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans and kept_sha256."""
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("th"), "text")
    spans = repeated_spans(rows, length, shard)
    schema = "doc_id long, doc long, th long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    out = map_batches(rows.join(spans, ["doc", "th"], "left"), _remove, schema)
    # rows equal in id and text: the first keeps what it has, the others repeat it
    alike = out.groupBy("doc_id", "th", "n_bytes", "n_removed", "n_spans", "kept_sha256").agg(F.count("*").cast("int").alias("n"))
    again = alike.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))).withColumn("whole", (F.col("copy") > 1) & (F.col("n_bytes") >= length))
    pick = lambda new, old: F.when(F.col("whole"), new).otherwise(F.col(old)).alias(old)
    return again.select(
        "doc_id", "n_bytes", pick(F.col("n_bytes"), "n_removed"), pick(F.lit(1).cast("long"), "n_spans"), pick(F.lit(EMPTY_SHA), "kept_sha256")
    )
