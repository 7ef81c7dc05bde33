"""Quality rules with a hashed n-gram likelihood ratio (operator 10).

Multinomials over ``BUCKETS`` hashed byte 4-grams: one of the whole raw
corpus, one of the trusted target (labelled good and not toxic) and one of
the documents labelled toxic, both smoothed towards the raw one.  The quality
ratio is the log-likelihood ratio target to raw per 4-gram, the clean ratio
that of target to toxic.  A document is kept if its base rules hold and both
reach their cuts; its score is the smaller of the quality ratio and the clean
ratio moved so that both cuts meet, so it is kept at the quality cut or more.
Nothing is drawn at random: equal inputs give equal verdicts.

Counts cover every document.  Labelled rows are used up to ``MAX_LABELLED``
(those of the smallest id hash), and up to as many labelled good but toxic, so
what is broadcast has a fixed bound: the labels, and two numbers a bucket.
One labelled document in five (by hash) is held out of the multinomials and
sets the cuts: the score that best separates the held-out documents labelled
good and not toxic from those labelled bad (quality ratio) or toxic (clean
ratio), where a lost good one counts ``KEEP_WEIGHT`` times.  The quality cut
is ``NO_CALIBRATION`` if one kind is missing there; without a toxic document
to count and one to hold out, or a good one to hold out, the clean ratio is not
used.  Without any labelled good document every score is 0 and every document
that passes the base rules is kept.

Null or empty texts have no words and fail the base rules.  A label row
with a null is not used; of several rows for an id the worst counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text import U, chunks, cover, grams, tokenise

BUCKETS = 1 << 18
GRAM = 4
MAX_LABELLED = 20_000
SMOOTHING = 0.02            # weight of the raw multinomial in the target one
NO_CALIBRATION = -1.0
KEEP_WEIGHT = 5
MIN_WORDS, WINDOW, MAX_REPEAT = 20, 8, 30
_SHIFT = np.uint32(32 - BUCKETS.bit_length() + 1)
_SYMBOLS = b"#*$%&|<>"


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte 4-grams of the texts, and their offsets."""
    n = np.diff(off)
    count = np.maximum(n - GRAM + 1, 0)
    at = np.concatenate([[0], np.cumsum(count)])
    if len(data) < GRAM:
        return np.zeros(0, np.uint32), at
    g = np.ndarray((len(data) - GRAM + 1,), "<u4", np.ascontiguousarray(data), strides=(1,))
    k = (g * np.uint32(0x9E3779B1)) ^ (g >> np.uint32(15))
    k = (k * np.uint32(0x85EBCA77)) >> _SHIFT
    if len(off) > 2:                                # 4-grams that would pass the end of a text
        ok = np.ones(len(k) + GRAM, bool)
        for back in range(1, GRAM):
            end = off[1:-1] - back
            ok[end[end >= 0]] = False
        k = k[ok[:len(k)]]
    return k, at


def _rows(labels: DataFrame, which: str):
    one = labels.dropna(subset=["doc_id", "quality", "toxic"]).groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic")).filter(which)
    some = one.withColumn("h", F.xxhash64("id")).orderBy("h", "id").limit(MAX_LABELLED)
    return some.selectExpr("id", "quality = 1 AND toxic = 0 AS good", "quality = 0 AS bad", "toxic = 1 AS toxic", "pmod(h, 5) = 0 AS held").toPandas().sort_values("id")


def labelled(labels: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids (sorted), whether good, whether held out, of the sample labelled
    bad or not toxic."""
    got = _rows(labels, "quality = 0 OR toxic = 0")
    return got.id.to_numpy(np.int64), got.good.to_numpy(bool), got.held.to_numpy(bool)


def sample(labels: DataFrame) -> dict[str, np.ndarray]:
    """id (sorted), good, bad, toxic and held of the labelled sample and of
    the one labelled good but toxic."""
    got = [_rows(labels, w) for w in ("quality = 0 OR toxic = 0", "NOT (quality = 0 OR toxic = 0)")]
    out = {c: np.concatenate([g[c].to_numpy(np.int64 if c == "id" else bool) for g in got]) for c in ("id", "good", "bad", "toxic", "held")}
    order = np.argsort(out["id"])
    return {c: x[order] for c, x in out.items()}


def _lookup(ids: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Places of ``known`` in the sorted ids, -1 where absent."""
    if not len(ids):
        return np.full(len(known), -1)
    p = np.searchsorted(ids, known)
    p[p == len(ids)] = 0
    return np.where(ids[p] == known, p, -1)


def _ids(rows) -> np.ndarray:
    return rows.column(0).fill_null(-(1 << 63)).to_numpy()


def _count(labels):
    schema = pa.schema([("bucket", pa.int32()), ("raw", pa.int64()), ("target", pa.int64()), ("toxic", pa.int64())])

    def run(batches):
        ids, kinds = labels.value            # of the ids, whether they count in target and in toxic
        raw, own = np.zeros(BUCKETS, np.int64), np.zeros((2, BUCKETS), np.int64)
        for rows, data, off in chunks(batches):
            k, at = features(data, off)
            raw += np.bincount(k, minlength=BUCKETS)
            p = _lookup(ids, _ids(rows))
            for kind, to in zip(kinds, own):
                for i in np.flatnonzero((p >= 0) & kind[p]) if len(ids) else ():
                    to += np.bincount(k[at[i]:at[i + 1]], minlength=BUCKETS)
        at = np.flatnonzero(raw)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(own[0][at]), pa.array(own[1][at])], schema=schema)
    return run


def ratio_table(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio target to raw of every bucket."""
    if not target.sum():
        return np.zeros(BUCKETS)
    p = (raw + 1.0) / (raw.sum() + BUCKETS)
    return np.log((1 - SMOOTHING) * (target / target.sum()) / p + SMOOTHING)


def scores(data, off, table) -> np.ndarray:
    """Length-normalised log-likelihood ratio of each text (0 without 4-grams)."""
    k, at = features(data, off)
    n = np.diff(at)
    out = np.zeros(len(n))
    full = np.flatnonzero(n)
    if len(full):
        out[full] = np.add.reduceat(table[k], at[full]) / n[full]
    return out


def judged(data, off, model) -> np.ndarray:
    """The score of each text: the smaller of the quality ratio and the clean
    ratio, if there is one, moved by the distance of the cuts."""
    quality, clean, move = model
    score = scores(data, off, quality)
    return score if clean is None else np.minimum(score, scores(data, off, clean) + move)


def _score(tables):
    schema = pa.schema([("id", pa.int64()), ("quality", pa.float64()), ("clean", pa.float64())])

    def run(batches):
        for rows, data, off in chunks(batches):
            yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(scores(data, off, t)) for t in tables.value)], schema=schema)
    return run


def threshold(score: np.ndarray, good: np.ndarray) -> float:
    """The cut with the best weighted hit rates of both kinds: the middle of
    the gap there, and of several cuts the lowest."""
    if not good.any() or good.all():
        return NO_CALIBRATION
    o = np.argsort(score, kind="stable")
    s, g = score[o], good[o]
    bad_below = np.concatenate([[0], np.cumsum(~g)]) / (~g).sum()
    good_above = 1 - np.concatenate([[0], np.cumsum(g)]) / g.sum()
    rate = bad_below + KEEP_WEIGHT * good_above
    rate[1:-1][s[1:] == s[:-1]] = -1                 # no cut between equal scores
    i = int(np.argmax(rate))
    return float(s[0] - 1 if i == 0 else s[-1] + 1 if i == len(s) else (s[i - 1] + s[i]) / 2)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """(model, threshold): the log ratios of every bucket, with the distance
    of their cuts, and the cut of the score."""
    sc = docs.sparkSession.sparkContext
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known = sample(labels)
    ids, held = known["id"], known["held"]
    counts = texts.mapInArrow(_count(sc.broadcast((ids, (known["good"] & ~held, known["toxic"] & ~held)))), "bucket int, raw long, target long, toxic long")
    counts = counts.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ("raw", "target", "toxic"))).toArrow()
    raw, target, toxic = (np.zeros(BUCKETS, np.int64) for _ in range(3))
    at = counts.column("bucket").to_numpy()
    for c, to in (("raw", raw), ("target", target), ("toxic", toxic)):
        to[at] = counts.column(c).to_numpy()
    quality = ratio_table(raw, target)
    if not target.any():
        return (quality, None, 0.0), float("-inf")
    if not held.any():
        return (quality, None, 0.0), NO_CALIBRATION
    clean = quality - ratio_table(raw, toxic)
    held_ids = docs.sparkSession.createDataFrame(pa.table({"id": ids[held]}))
    some = texts.join(F.broadcast(held_ids), "id").mapInArrow(_score(sc.broadcast((quality, clean))), "id long, quality double, clean double").toPandas()
    p = _lookup(ids, some.id.to_numpy())

    def cut(score: str, against: str) -> float:
        use = (known["good"] | known[against])[p]
        own, at = some[score].to_numpy()[use], p[use]
        o = np.lexsort((own, ids[at]))
        return threshold(own[o], known["good"][at][o])
    least = cut("quality", "bad")
    if not toxic.any() or not known["toxic"][p].any() or not known["good"][p].any():
        return (quality, None, 0.0), least
    return (quality, clean, least - cut("clean", "toxic")), least


COLUMNS = (("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long"),
           ("base_failed", "boolean"), ("score", "double"), ("kept", "boolean"))
_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}


def base_counts(w) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    def per_text(running, off):
        running = np.concatenate([[0], np.cumsum(running)])
        return running[off[1:]] - running[off[:-1]]

    lead = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
    chars = per_text(lead[w.end] - lead[w.start], w.off)
    sym = np.zeros(len(w.data), bool)
    for c in _SYMBOLS:
        sym |= w.data == c
    lines = []
    raw = w.data.tobytes()
    for a, b in zip(w.text_off[:-1].tolist(), w.text_off[1:].tolist()):
        held = [x for x in raw[a:b].split(b"\n") if x.strip()]
        lines.append(len(held) - len(set(held)))
    n = len(w.hash)
    repeat = np.zeros(n, bool)
    if n >= WINDOW:
        g = grams(w.hash, WINDOW)
        doc = np.searchsorted(w.off, np.arange(len(g)), "right") - 1
        inside = np.flatnonzero(np.arange(len(g)) + WINDOW <= w.off[doc + 1])
        key = g[inside] ^ (doc[inside].astype(U) * U(0x9FB21C651E98DF25))
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        twice = inside[count[back] > 1]
        repeat = cover(twice, twice + WINDOW, n)
    return [np.diff(w.off), chars, per_text(sym, w.text_off), np.array(lines, np.int64), per_text(repeat, w.off)]


def _judge(model, cut: float):
    schema = pa.schema([("id", pa.int64()), *((c, _ARROW[t]) for c, t in COLUMNS)])

    def run(batches):
        for rows, data, off in chunks(batches):
            w = tokenise(data, off)
            base = base_counts(w)
            failed = (base[0] < MIN_WORDS) | (100 * base[4] > MAX_REPEAT * base[0])
            score = judged(data, off, model.value)
            yield pa.RecordBatch.from_arrays([rows.column(0), *map(pa.array, base), pa.array(failed), pa.array(score), pa.array(~failed & (score >= cut))], schema=schema)
    return run


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and COLUMNS for every row."""
    model, cut = fit(docs, labels, id_col, text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = texts.mapInArrow(_judge(docs.sparkSession.sparkContext.broadcast(model), cut), ", ".join(["id long", *(f"{c} {t}" for c, t in COLUMNS)]))
    return out.withColumnRenamed("id", "doc_id")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents (all columns) that are kept."""
    model, cut = fit(docs, labels, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for rows, data, off in chunks(batches, text_col):
            base = base_counts(tokenise(data, off))
            failed = (base[0] < MIN_WORDS) | (100 * base[4] > MAX_REPEAT * base[0])
            yield rows.filter(pa.array(~failed & (judged(data, off, model.value) >= cut)))
    return docs.mapInArrow(run, docs.schema)
