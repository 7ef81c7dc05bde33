"""Benchmark decontamination by FM-indexes over the training shards (operator 2).

A shard is a run of documents of bounded size inside a scan task.  Its words
(A-Z lower-cased; runs of digits, letters and non-ASCII) become an FM-index;
words that no phrase has can be part of no occurrence, so they only separate
texts, as do runs shorter than the shortest phrase.  All phrases are searched
backwards in lockstep through the ranks of the wavelet matrix, the
occurrences located by sampled suffix positions, and the spans merged.
Documents are never shuffled.

Phrases are windows of ``window`` consecutive words of an item; an item of
fewer words, but not none, is one phrase.  Tasks cut the items into runs of
words and write the phrases to files of the shared folder, blocks of at most
``MAX_BLOCK_WORDS`` item words; a scan task holds one block at a time, and each
further one is one more search over the documents within the same stage.

Null or empty texts have no words and no hits; a null item id counts as the
item ''; rows of one item id are one item.  A clashing input column of the
name of a result column is replaced by the result.
"""

from __future__ import annotations

import io
import json

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .files import drop_tables, new_folder, once, open_folder, publish, store
from .fmindex import FMIndex
from .text import alnum, chunks, cover, runs_of, tokenise

WINDOW = 10
MAX_BLOCK_WORDS = 2_000_000
SHARD_BYTES = 1 << 20
SAMPLE = 16
RESULT = ("n_words", "n_hit", "items", "hit_starts", "hit_ends", "cleaned")


def _item_words(text_col: str, window: int, longest: int):
    """The items as hashes of their words, in runs of at most ``longest`` +
    ``window`` - 1 words that hold every window of the item once."""
    schema = pa.schema([("item", pa.string()), ("part", pa.int64()), ("n", pa.int64()), ("words", pa.binary())])

    def run(batches):
        for rows, data, off in chunks(batches, text_col):
            w = tokenise(data, off, alnum, True)
            names, out = rows.column(rows.schema.get_field_index("item")).to_pylist(), []
            for name, x, y in zip(names, w.off[:-1].tolist(), w.off[1:].tolist()):
                for k, at in enumerate(range(x, max(x + 1, y - window + 1), longest) if y > x else ()):
                    h = w.hash[at:min(y, at + longest + window - 1)]
                    out.append((name, k, len(h), h.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, schema.types)], schema=schema)
    return run


def _write_blocks(folder: str, window: int):
    schema = pa.schema([("name", pa.string())])

    def run(batches):
        files, base = open_folder(folder)
        files.create_dir(base)
        held, block = [], None

        def put():
            name, mark = f"block-{block:06d}", f".{TaskContext.get().taskAttemptId()}.tmp"
            *arrays, names = _block(held, window)
            raw = io.BytesIO()
            np.savez(raw, *arrays, np.frombuffer(json.dumps(names).encode(), np.uint8))
            with files.open_output_stream(f"{base}/{name}{mark}") as out:
                out.write(raw.getbuffer())
            publish(files, f"{base}/{name}", f"{base}/{name}{mark}")
            return pa.RecordBatch.from_arrays([pa.array([name])], schema=schema)

        for rows in batches:                    # sorted by block
            for name, words, k in zip(*(rows.column(rows.schema.get_field_index(c)).to_pylist() for c in ("item", "words", "block"))):
                if held and k != block:
                    yield put()
                    held = []
                block = k
                held.append((name, np.frombuffer(words, np.uint64)))
        if held:
            yield put()
    return run


def write_blocks(items: DataFrame, id_col: str, text_col: str, window: int) -> tuple[str, list[str]]:
    """(folder, file names): the phrases of all items, dealt to files of at most
    ``MAX_BLOCK_WORDS`` words; a long item is cut into overlapping runs."""
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    runs = store(rows.mapInArrow(_item_words("text", window, MAX_BLOCK_WORDS // 16), "item string, part long, n long, words binary").dropDuplicates(["item", "words"]), "phrases")
    blocks = max(1, -(-2 * (runs.agg(F.sum("n")).head()[0] or 0) // MAX_BLOCK_WORDS))
    while True:                                 # dealt by hash: more blocks, until the largest fits
        dealt = runs.withColumn("block", F.expr(f"CASE WHEN {blocks} = 1 THEN 0 ELSE pmod(xxhash64(item, part, words), {blocks}) END"))
        if (dealt.groupBy("block").agg(F.sum("n").alias("n")).agg(F.max("n")).head()[0] or 0) <= MAX_BLOCK_WORDS:
            break
        blocks *= 2
    folder = new_folder(items.sparkSession, "phrase-blocks")
    done = dealt.repartition(blocks, "block").sortWithinPartitions("block", "item", "part").mapInArrow(_write_blocks(folder, window), "name string").collect()
    drop_tables(runs)
    return folder, sorted(r.name for r in done)


def _read_block(folder: str, name: str):
    files, base = open_folder(folder)
    with files.open_input_file(f"{base}/{name}") as f, np.load(io.BytesIO(f.read())) as got:
        *arrays, names = (got[f"arr_{i}"] for i in range(6))
    return *arrays, json.loads(names.tobytes())


def _block(held, window):
    vocabulary = np.unique(np.concatenate([h for _, h in held]))
    rows, lens, owner = [], [], []
    for i, (item, h) in enumerate(held):
        ids = np.searchsorted(vocabulary, h) + 1
        k = min(window, len(ids))
        v = np.lib.stride_tricks.sliding_window_view(ids, k)
        pat = np.zeros((len(v), window), np.int32)
        pat[:, window - k:] = v
        rows.append(pat)
        lens.append(np.full(len(v), k))
        owner.append(np.full(len(v), i))
    pat, back = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    back = back.ravel()
    length = np.zeros(len(pat), np.int64)
    length[back] = np.concatenate(lens)
    pairs = np.unique(np.stack([back, np.concatenate(owner)], 1), axis=0)
    return vocabulary, pat, length, np.append(np.searchsorted(pairs[:, 0], np.arange(len(pat))), len(pairs)), pairs[:, 1], [i for i, _ in held]


def _search(w, block):
    """(document, item) pairs and the hit words of a chunk of documents."""
    vocabulary, pat, length, owner_at, owner, names = block
    shortest = int(length.min())
    place = np.searchsorted(vocabulary, w.hash)
    place[place == len(vocabulary)] = 0
    known = vocabulary[place] == w.hash
    ids = np.where(known, place + 1, 0)
    # text: the words with a 0 before each document; then only runs long enough
    at = np.arange(len(ids)) + 1 + np.searchsorted(w.off[1:], np.arange(len(ids)), "right")
    text = np.zeros(len(ids) + len(w.off), np.int64)
    text[at] = ids
    a, b = runs_of(text > 0)
    long = b - a >= shortest
    a, b = a[long], b[long]
    hits = np.zeros(len(ids), bool)
    none = np.zeros(0, np.int64)
    if not len(a):
        return hits, none, none
    lens = b - a
    word_at = np.full(len(text), -1, np.int64)
    word_at[at] = np.arange(len(ids))
    source = np.repeat(a - np.concatenate([[0], np.cumsum(lens + 1)[:-1]]), lens + 1) + np.arange(int(lens.sum()) + len(lens))
    run_text = text[source]
    ends = np.cumsum(lens + 1) - 1
    run_text[ends] = 0
    used, dense = np.unique(run_text, return_inverse=True)     # symbols of this shard: 0 and what it has
    fm = FMIndex(dense.astype(np.int64), len(used), SAMPLE)
    p = np.searchsorted(used, pat)
    p[p == len(used)] = 0
    local = np.where(used[p] == pat, p, -1)
    lo, hi = fm.search(local, length)
    found = np.flatnonzero(hi > lo)
    n = hi[found] - lo[found]
    phrase = np.repeat(found, n)
    rows = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[found], n)
    first = word_at[source[fm.locate(rows)]]
    hits = cover(first, first + length[phrase], len(ids))
    doc = np.searchsorted(w.off, first, "right") - 1
    pairs = np.unique(np.stack([doc, phrase], 1), axis=0) if len(doc) else np.zeros((0, 2), np.int64)
    k = owner_at[pairs[:, 1] + 1] - owner_at[pairs[:, 1]]
    d = np.repeat(pairs[:, 0], k)
    item = owner[np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k) + np.repeat(owner_at[pairs[:, 1]], k)]
    both = np.unique(np.stack([d, item], 1), axis=0)
    return hits, both[:, 0], both[:, 1]


def _task(folder, names, text_col, passed):
    def run(batches):
        for rows, data, off in chunks(batches, text_col, SHARD_BYTES):
            w = tokenise(data, off, alnum, True)
            hits, items = np.zeros(len(w.hash), bool), [set() for _ in range(rows.num_rows)]
            for name in names:                  # one block in memory, kept for the next chunk if it is the only one
                block = once(("phrases", folder, name), lambda: _read_block(folder, name))
                h, docs, which = _search(w, block)
                hits |= h
                for d, i in zip(docs.tolist(), which.tolist()):
                    items[d].add(block[-1][i])
            a, b = runs_of(hits)
            inner = w.off[(w.off > 0) & (w.off < len(hits))]     # split runs that pass the end of a document
            inner = inner[hits[inner - 1] & hits[inner]]
            a, b = np.unique(np.append(a, inner)), np.unique(np.append(b, inner))
            cut = np.searchsorted(a, w.off)
            sa, sb = (w.start[a], w.end[b - 1]) if len(a) else (np.zeros(0, np.int64),) * 2
            doc = np.searchsorted(w.off, a, "right") - 1
            texts = rows.column(rows.schema.get_field_index(text_col))
            cleaned = texts
            touched = np.flatnonzero(np.diff(cut))
            if len(touched):
                raw = data.tobytes()
                values = texts.to_pylist()
                for d in touched.tolist():
                    keep, at = [], int(off[d])
                    for x, y in zip(sa[cut[d]:cut[d + 1]].tolist(), sb[cut[d]:cut[d + 1]].tolist()):
                        keep.append(raw[at:x])
                        at = y
                    values[d] = b"".join([*keep, raw[at:int(off[d + 1])]]).decode()
                cleaned = pa.array(values, pa.string())
            total = np.concatenate([[0], np.cumsum(hits)])
            spans = pa.array(cut.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(rows.schema.get_field_index(c)) for c in passed), pa.array(np.diff(w.off)),
                 pa.array(np.diff(total[w.off])),
                 pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                 pa.ListArray.from_arrays(spans, pa.array(sa - off[doc])), pa.ListArray.from_arrays(spans, pa.array(sb - off[doc])),
                 cleaned.cast(pa.string())],
                names=[*passed, *RESULT])
    return run


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents' columns, ``n_words``, ``n_hit`` (hit words), ``items`` (ids, as strings and
    sorted), ``hit_starts``/``hit_ends`` (merged byte spans of the hit words
    in the UTF-8 text) and ``cleaned`` (the text without them)."""
    folder, names = write_blocks(items, item_id, item_text, window)
    passed = [c for c in docs.columns if c not in RESULT]
    longs = ArrayType(LongType())
    schema = StructType([*(docs.schema[c] for c in passed), StructField("n_words", LongType()), StructField("n_hit", LongType()),
                         StructField("items", ArrayType(StringType())),
                         StructField("hit_starts", longs), StructField("hit_ends", longs), StructField("cleaned", StringType())])
    return docs.select(*passed).mapInArrow(_task(folder, names, text_col, passed), schema)


def digests(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    got = decontaminate(docs.select("doc_id", "text"), items)
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
