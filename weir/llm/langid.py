"""Language identification by mixture inference.

Learning counts the hashed character n-grams (1 to ``ORDER``) of labelled texts
per language. Prediction cuts a whole text into segments of ``SEGMENT`` letters
and scores each under every language. Expectation-maximisation then estimates
the document's language proportions from the segments' likelihoods. The set of
languages is chosen by penalised likelihood: it grows from the single best one
as long as another language raises the log-likelihood by more than
``PENALTY * log(segments)``. The prediction is the largest proportion.

The model is fitted on a sample of labelled rows, bounded by ``sample`` texts
per language in expectation and chosen by a hash of id and text; it has
languages * ``BUCKETS`` numbers. Prediction reads every text whole.

NULL texts and texts without a letter are ``und`` with score 0; so is every text
when there is nothing to learn from. Rows without language or doc_id are not
learned from; a NULL doc_id is not held out. Repeated rows are rows of their
own. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import bound_batches, map_texts, seeded

UNDETERMINED = "und"
ORDER = 3
BUCKETS = 1 << 15
SEGMENT = 48
SAMPLE = 1500  # texts per language to learn from
ROUNDS = 12
PENALTY = 2.0
SMOOTHING = 0.5
LEAST = 0.5  # share that the main language of a kept document has at least


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # languages x (orders * buckets): log probability of each n-gram


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters of the texts with one space for each run of others, and each one's text."""
    joined = np.frombuffer("\x00".join(texts).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.cumsum(joined == 0)
    letter = _letters()[np.minimum(joined, 0x30000)]
    chars = np.where(letter, joined, 32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of a run of others
    keep &= joined != 0
    return chars[keep], owner[keep]


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether a code point is a letter; one entry stands for all from 0x30000 on."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(i).isalpha() for i in range(0x30000)] + [True]))
    return _LETTERS[0]


def grams(chars: np.ndarray, owner: np.ndarray):
    """For each order, the bucket of the n-gram that starts at each place, -1 where it leaves its text."""
    value = np.zeros(len(chars), np.uint64)
    for n in range(1, ORDER + 1):
        shifted = np.zeros(len(chars), np.uint64)
        shifted[: len(chars) - n + 1] = chars[n - 1 :]
        value = (value + shifted + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        bucket = (value >> np.uint64(64 - 15)).astype(np.int64)
        inside = np.zeros(len(chars), bool)
        inside[: len(chars) - n + 1] = owner[: len(chars) - n + 1] == owner[n - 1 :]
        yield np.where(inside, bucket + (n - 1) * BUCKETS, -1)


def _count(batch: pa.RecordBatch) -> dict:
    table = batch.to_pandas()
    out = []
    for lang, texts in table.groupby("lang")["text"]:
        counts = np.zeros(ORDER * BUCKETS, np.int64)
        for gram in grams(*code_points(list(texts))):
            counts += np.bincount(gram[gram >= 0], minlength=ORDER * BUCKETS)
        seen = np.flatnonzero(counts)
        out.append(pd.DataFrame({"lang": lang, "bucket": seen, "n": counts[seen]}))
    found = pd.concat(out) if out else pd.DataFrame({"lang": [], "bucket": [], "n": []})
    kinds = (("lang", pa.string()), ("bucket", pa.int64()), ("n", pa.int64()))
    return {name: pa.array(found[name].tolist(), kind) for name, kind in kinds}


def fit(labelled: DataFrame, sample: int = SAMPLE, seed: int = 0) -> Model:
    """Learn from (doc_id, text, lang); the sample's size does not grow with the input."""
    labelled = labelled.select("doc_id", "text", "lang").filter("text is not null and lang is not null")
    sizes = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], np.zeros((0, ORDER * BUCKETS)))
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample / n))])
    draw = F.pmod(seeded(seed, F.col("doc_id"), F.col("text")), F.lit(1 << 20)) / (1 << 20)
    chosen = labelled.filter(draw < share[F.col("lang")])
    counts = map_texts(chosen.select("text", "lang"), _count, "lang string, bucket long, n long")
    # at most languages * ORDER * BUCKETS rows
    total = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sizes)
    table = np.full((len(languages), ORDER, BUCKETS), SMOOTHING)
    index = {lang: i for i, lang in enumerate(languages)}
    rows = total["lang"].map(index).to_numpy(np.int64)
    np.add.at(table.reshape(len(languages), -1), (rows, total["bucket"].to_numpy(np.int64)), total["n"].to_numpy(float))
    logs = np.log(table / table.sum(axis=2, keepdims=True))
    return Model(languages, logs.reshape(len(languages), -1).astype(np.float32))


def segment_scores(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood of each segment under each language, and the segment's text."""
    chars, owner = code_points(texts)
    if not len(chars):
        return np.zeros((0, len(model.languages))), np.zeros(0, np.int64)
    first = np.searchsorted(owner, owner)  # where each place's text begins
    within = (np.arange(len(chars)) - first) // SEGMENT
    starts = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (within[1:] != within[:-1])])
    scores = np.zeros((len(starts), len(model.languages)))
    for gram in grams(chars, owner):
        inside = gram >= 0
        for i, logs in enumerate(model.logs):
            scores[:, i] += np.add.reduceat(np.where(inside, logs[gram], 0), starts)
    # overlapping n-grams of several orders repeat the same evidence
    return scores / ORDER, owner[starts]


def mixtures(scores: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Language proportions of each text: EM on nested language sets, grown while it pays."""
    shares = np.zeros((texts, scores.shape[1]))
    if not len(scores):
        return shares
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    who = owner[starts]
    row = np.repeat(np.arange(len(who)), np.diff(np.r_[starts, len(owner)]))
    n = np.bincount(row)
    peak = scores.max(axis=1)
    odds = np.exp(np.maximum(scores - peak[:, None], -60))
    alone = np.add.reduceat(scores, starts)  # log-likelihood of each language by itself
    allowed = np.zeros(alone.shape, bool)
    allowed[np.arange(len(who)), alone.argmax(axis=1)] = True
    best = alone.max(axis=1)
    result = allowed.astype(float)
    full, _ = _em(odds, peak, starts, row, np.ones_like(allowed))
    active = np.ones(len(who), bool)
    for _ in range(scores.shape[1] - 1):
        candidate = np.where(allowed, -1, full)
        add = candidate.argmax(axis=1)
        active &= candidate[np.arange(len(who)), add] > 1e-3
        if not active.any():
            break
        wider = allowed.copy()
        wider[np.arange(len(who)), add] = True
        share, likelihood = _em(odds, peak, starts, row, wider)
        active &= likelihood > best + PENALTY * np.log(n + 1)
        allowed[active], result[active], best[active] = wider[active], share[active], likelihood[active]
    shares[who] = result
    return shares


def _em(odds, peak, starts, row, allowed) -> tuple[np.ndarray, np.ndarray]:
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        weight = odds * share[row]
        total = weight.sum(axis=1, keepdims=True)
        share = np.add.reduceat(weight / total, starts)
        share /= share.sum(axis=1, keepdims=True)
    total = (odds * share[row]).sum(axis=1)
    return share, np.add.reduceat(np.log(total) + peak, starts)


def _predict(model: Model, batch: pa.RecordBatch) -> dict:
    texts = [t or "" for t in batch.column("text").to_pylist()]
    shares = np.zeros((len(texts), len(model.languages)))
    at = 0
    while at < len(texts) and model.languages:  # so many texts at a time that memory stays bounded
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) < 200_000):
            size += len(texts[to])
            to += 1
        shares[at:to] = mixtures(*segment_scores(model, [t.replace("\x00", " ") for t in texts[at:to]]), to - at)
        at = to
    sure = shares.sum(axis=1) > 0
    best = shares.argmax(axis=1) if model.languages else np.zeros(len(texts), int)
    languages, mixed = [], []
    for i, share in enumerate(shares):
        languages.append(model.languages[best[i]] if sure[i] else UNDETERMINED)
        mixed.append(",".join(f"{model.languages[j]}:{share[j]:.3f}" for j in np.argsort(-share, kind="stable") if share[j] > 0))
    score = shares.max(axis=1, initial=0.0)
    return {
        "doc_id": batch.column("doc_id"),
        "held_out": batch.column("held_out"),
        "lang_pred": pa.array(languages, pa.string()),
        "score": pa.array(np.minimum(score, 1.0)),
        "languages": pa.array(mixed, pa.string()),
    }


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score and the mixture as text."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    schema = "doc_id long, held_out boolean, lang_pred string, score double, languages string"
    return map_texts(rows, partial(_predict, model), schema)


def fit_and_identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Learn from the documents that are not held out, then predict all."""
    learn = docs.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    return identify(docs, fit(learn, sample))


def keep_identified(docs: DataFrame, model: Model, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` whose language is certain enough; rows and columns stay as they are."""

    def run(batches):
        for batch in batches:
            told = _predict(model, _with_blank(batch))
            keep = np.array(told["lang_pred"].to_pylist(), object) != UNDETERMINED
            yield batch.filter(pa.array(keep & (told["score"].to_numpy() >= least)))

    bound_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def _with_blank(batch: pa.RecordBatch) -> pa.RecordBatch:
    blank = pa.nulls(batch.num_rows)
    return pa.RecordBatch.from_arrays([blank, blank, batch.column("text")], ["doc_id", "held_out", "text"])
