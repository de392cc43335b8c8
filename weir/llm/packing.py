"""Pack documents into few token sequences by bulk-synchronous best fit.

A document is its token ids and an end id. Longer ones than the capacity are
cut into full pieces; the last piece may be shorter. Pieces are placed in
rounds, one for each length in falling order, at most ``capacity`` in all. A
round places all pieces of its length at once: a sweep over the gaps in order
of size starts at the successor, the smallest gap that holds the length. Where
pieces want the same gaps, the rank decides: the i-th piece takes the i-th
place. What finds no gap opens new sequences; the gaps are updated, and the
next round begins.

Pieces of one length are alike, so the sweep needs the counts of pieces and
gaps by size alone, which the capacity bounds whatever the input; its outcome
is a list of placements: ranks r0..r1 of a length go to sequences from s on. The pieces themselves stay on the executors. They get their rank
within their length from counts per hash bin, and look up their placement.

NULL and empty texts are documents of one token, the end id. Repeated rows are
documents of their own; a NULL doc_id stays NULL. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import re
import zlib
from array import array
from functools import partial

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weir.llm.common import map_batches, map_texts, seeded, written

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
END_ID = 1
BINS = 64
KNOWN = 200_000  # parts a task remembers at a time
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

# The tokenizer splits at white space and then into letters, single digits and
# runs of others. In a text of these characters only, lower-casing and this
# pattern do the same, and each part can be encoded, and remembered, alone.
PLAIN = re.compile("[\\x09\\x0a\\x0d\\x20-\\x7eÀ-ÖØ-öø-ÿ]*")
PART = re.compile("[a-zß-öø-ÿ]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\\x09\\x0a\\x0d\\x20a-zß-öø-ÿ0-9]+")


class Parts(dict):
    """Token ids of the parts of plain text, as little-endian bytes; remembers what it gave."""

    def __init__(self, model, limit: int = KNOWN):
        super().__init__()
        self.model, self.limit = model, limit
        # bytes as the vocabulary spells them: printable ones as they are, others from 256 on
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in shown]
        self.spelling = {b: 256 + i for i, b in enumerate(rest)}

    def __missing__(self, part: str) -> bytes:
        if len(self) > self.limit:
            self.clear()
        spelled = part if part.isascii() else part.encode().decode("latin-1").translate(self.spelling)
        ids = self[part] = array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
        return ids


class Words:
    """Token ids of texts, as little-endian bytes."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.parts = Parts(self.tokenizer.model)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> bytes:
        if "<|" in text:  # a special token may be spelled out
            return self.whole(text)
        if PLAIN.fullmatch(text):
            return self._plain(text)
        words = filter(None, re.split("[ \\n]+", text))
        return b"".join(self._plain(w) if PLAIN.fullmatch(w) else self.whole(w) for w in words)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, PART.findall(text.lower())))


def _pieces(words: list, path: str, capacity: int, batch: pa.RecordBatch) -> dict:
    if not words:
        words.append(Words(path))
    out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
    end = np.array([END_ID], "<u4").tobytes()
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
        ids = (words[0].ids(text) if text else b"") + end
        for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
            part = ids[at : at + 4 * capacity]
            for name, value in zip(out, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                out[name].append(value)
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    return {name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds)}


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document: (doc_id, piece, start, length, ids_crc32)."""
    path = path or public_tokenizers.path(VOCABULARY)
    return map_texts(docs.select("doc_id", "text"), partial(_pieces, [], path, capacity), PIECES)


def best_fit_rounds(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Placements (length, first rank, count, per sequence, first sequence, offset).

    Rank r of the length goes to sequence ``first + (r - first rank) // per`` at
    ``offset + ((r - first rank) % per) * length``.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # size: runs of alike sequences (first, count)
    sizes: list[int] = []  # the keys of gaps in order
    placed, sequences = [], 0

    def leave(gap: int, first: int, run: int) -> None:
        if gap and run:
            if gap not in gaps:
                bisect.insort(sizes, gap)
            gaps.setdefault(gap, []).append((first, run))

    def fill(length: int, rank: int, have: int, first: int, run: int, gap: int) -> int:
        """Put pieces into sequences alike, as many as they hold or there are."""
        per = gap // length
        used = min(have, run * per)
        placed.append((length, rank, used, per, first, capacity - gap))
        full, part = divmod(used, per)
        leave(gap - per * length, first, full)
        leave(gap - part * length, first + full, int(part > 0))
        leave(gap, first + full + (part > 0), run - full - (part > 0))
        return used

    for length in sorted((l for l, n in counts.items() if n > 0), reverse=True):
        rank, count = 0, counts[length]
        while rank < count and (at := bisect.bisect_left(sizes, length)) < len(sizes):
            size = sizes[at]  # the successor: the smallest gap that holds the length
            first, run = gaps[size].pop()
            if not gaps[size]:
                del gaps[size], sizes[at]
            rank += fill(length, rank, count - rank, first, run, size)
        if rank < count:
            opened = -(-(count - rank) // (capacity // length))
            fill(length, rank, count - rank, sequences, opened, capacity)
            sequences += opened
    return placed


def _place(plan: np.ndarray, batch: pa.RecordBatch) -> dict:
    """Look up the placement of each (length, rank)."""
    length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
    keys = plan[:, 0] << 48 | plan[:, 1]
    _, r0, _, per, first, offset = plan[np.searchsorted(keys, length << 48 | rank, "right") - 1].T
    row, slot = np.divmod(rank - r0, per)
    columns = {name: batch.column(name) for name in ("doc_id", "piece", "start", "length", "ids_crc32")}
    return columns | {"sequence_id": first + row, "offset": offset + slot * length}


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, seed: int = 0) -> DataFrame:
    """Place every piece: its columns, ``sequence_id`` and ``offset``."""
    pieces = written(token_pieces(docs, path, capacity), "pieces")
    pieces = pieces.withColumn("bin", F.pmod(seeded(seed, F.col("doc_id"), F.col("piece")), F.lit(BINS)))
    bins = written(pieces.groupBy("length", "bin").agg(F.count("*").alias("n")), "piece-counts")
    # at most `capacity` rows reach the driver
    counts = {r.length: r.n for r in bins.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    placed = best_fit_rounds(counts, capacity)
    plan = np.array(sorted(placed) or np.zeros((0, 6)), np.int64)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = bins.withColumn("before", before).select("length", "bin", "before")
    within = Window.partitionBy("length", "bin").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(within) - 1)
    ranked = ranked.join(starts, ["length", "bin"]).withColumn("rank", F.col("rank") + F.col("before"))
    return map_batches(ranked, partial(_place, plan), f"{PIECES}, sequence_id long, offset long")
