"""Token ids in Arrow stream files of equal-length sequences (operator 8).

Texts are encoded with a given tokenizer file, each document's ids end with
``end_id``, and the ids are laid one after the other, in ascending id order,
into sequences of ``length`` tokens.  A range partition of the documents
writes one file: an Arrow IPC stream whose batches hold fixed-size lists of
ids (uint16 where the vocabulary allows, else uint32) and of masks (false in
the padding of a file's last sequence), so a memory map gives any sequence
without copying.  A second stream beside it lists its documents (id, start
within the file, number of tokens).  The manifest has one row a file with
the ids before it, so starts are global when read.

Beside every stream lies an index of its batches' byte offsets, so sequence i
is read by one seek (``Sequences``, and ``read_sequences`` for many at once).

White space never joins two words, so ids are looked up by
white-space-separated pieces, each encoded once by the library.  This holds
for lower-casing word tokenizers like the one given; others are refused.  A
piece reaches the library as it stands: normalisers and added tokens such as
``<|endoftext|>`` tell capitals apart.  Only pieces of plain letters (ASCII and
U+00C0 to U+00FF, which composition cannot change) share the look-up of their
lower-cased form, and up to eight marks after one have their own, if a probe
shows that they part from letters; new ones are encoded by the library's model
many at a time, without its normaliser, where a probe shows that this gives
the same ids.  All that only where no added token can lie in them.

Null and empty texts have the end id only.  Rows of one id are ordered by a
hash of the text; a null id comes first.  Finished files appear under their
name at once, so another attempt of a task is harmless.
"""

from __future__ import annotations

import os
import re
import string
import zlib
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .files import new_folder, once, open_folder, publish
from .routing import keyed
from .text import chunks

END_ID = 2
LENGTH = 2048
ROWS = 256              # sequences of a batch
CACHE = 300_000         # pieces kept in a task


# a line: plain letters and marks, or anything else
_LINE = "^(?:([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([%s]{0,8})|(.*))$"
_MARKED = ["Word", "naïveté", "zzzzxqjÿ"]
_PROBE = ["a", "word", "Words", "ÀÉÎÕÜ", "straße", "naïvetés", "zzzzxqj", "ÿþ", "internationalisation"]


class _Encoder:
    def __init__(self, model: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer = Tokenizer.from_str(model)
        self.kind, self.size = kind, np.dtype(kind).itemsize
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.shared = not any(c.isalpha() or "." in c or "," in c for c in added)
        # marks that part from the letters before them, and lie in no added token
        free = [c for c in string.punctuation if not any(c in t for t in added)]
        split = [self._library([x + c, x + 2 * c]) == [a + b for a in self._library([x]) for b in self._library([c, 2 * c])] for c in free for x in _MARKED]
        marks = [c for i, c in enumerate(free) if all(split[i * len(_MARKED):(i + 1) * len(_MARKED)])]
        self.line = re.compile(_LINE % re.escape("".join({".", ",", *marks})), re.M)
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        # the model alone, for lower-case letters between spaces; a word ends with an id that says so
        self.plain = Tokenizer.from_str(model)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if suffix:
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        probe = [w.lower() for w in _PROBE]
        self.fast = bool(suffix) and self._library(_PROBE) == self._library(probe) == self._model(probe)

    def _library(self, parts: list[str]) -> list[bytes]:
        return [np.array(g.ids, self.kind).tobytes() for g in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _model(self, parts: list[str]) -> list[bytes]:
        """Ids of words of plain lower-case letters."""
        got = self.plain.encode_batch_fast([" ".join(parts[i:i + 2000]) for i in range(0, len(parts), 2000)], add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(g.ids for g in got), self.kind)
        raw, cut = ids.tobytes(), [0, *((np.flatnonzero(self.ends[ids]) + 1) * self.size).tolist()]
        return [raw[x:y] for x, y in zip(cut[:-1], cut[1:])]

    def _learn(self, new: list[bytes]) -> None:
        """Ids of new words, into the cache."""
        text = b"\n".join(new).decode()
        if self.shared:
            letters, marks, others = zip(*self.line.findall(text))
            letters = "\n".join(letters).lower().split("\n")
        else:
            others = text.split("\n")
            letters = marks = [""] * len(others)
        if len(self.parts) > CACHE:
            self.parts = {}
        known = self.parts
        known[""] = b""
        for parts, encode in ((set(letters), self._model if self.fast else self._library), (set(others).union(marks), self._library)):
            if parts := [p for p in parts if p not in known]:
                known.update(zip(parts, encode(parts)))
        ids = known.__getitem__                         # of a word, letters or else the rest are empty
        self.cache.update(zip(new, map(add, map(ids, map(add, letters, others)), map(ids, marks))))

    def __call__(self, texts: list[bytes], end: bytes) -> list[bytes]:
        """Ids of each text and the end id, little-endian."""
        words = [t.split() for t in texts]
        new = [w for w in set().union(*words) if w not in self.cache]
        if new:
            if len(self.cache) + len(new) > CACHE:      # words not met since the last turn are forgotten
                self.older, self.cache = self.cache, {}
                new = list(set().union(*words))
            older = self.older
            self.cache.update((w, older[w]) for w in new if w in older)
            if fresh := [w for w in new if w not in older]:
                self._learn(fresh)
        ids = self.cache.__getitem__
        return [b"".join(map(ids, w)) + end for w in words]


DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _sequences(length: int, width: pa.DataType) -> pa.Schema:
    return pa.schema([("ids", pa.list_(width, length)), ("mask", pa.list_(pa.bool_(), length))])


def _write(folder: str, model, end_id: int, length: int, wide: bool):
    width, kind = (pa.uint32(), "<u4") if wide else (pa.uint16(), "<u2")
    schema = pa.schema([("name", pa.string()), ("part", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        store, base = open_folder(folder)
        encoder, end = once(("ids", model.value), lambda: _Encoder(model.value, kind)), np.array([end_id], kind).tobytes()
        part, mark = TaskContext.get().partitionId(), f".{TaskContext.get().taskAttemptId()}.tmp"
        name = f"part-{part:06d}"
        store.create_dir(base)
        at, rest = 0, np.zeros(0, kind)
        with store.open_output_stream(f"{base}/{name}.arrows{mark}") as a, store.open_output_stream(f"{base}/{name}.docs{mark}") as b:
            shape = _sequences(length, width)
            ids_file, docs_file, places = pa.ipc.new_stream(a, shape), pa.ipc.new_stream(b, DOCUMENTS), []

            def put(values, mask):
                for lo in range(0, len(values), ROWS * length):
                    places.append(a.tell())
                    ids_file.write_batch(pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(x[lo:lo + ROWS * length]), length) for x in (values, mask)], schema=shape))

            for rows, data, off in chunks(batches):
                raw = data.tobytes()
                out = encoder([raw[x:y] for x, y in zip(off[:-1].tolist(), off[1:].tolist())], end)
                n = np.array([len(o) for o in out]) // np.dtype(kind).itemsize
                ids = rows.column(0).to_numpy()
                docs_file.write_batch(pa.RecordBatch.from_arrays([pa.array(ids, mask=ids == -(1 << 63)), pa.array(at + np.cumsum(n) - n), pa.array(n)], schema=DOCUMENTS))
                at += int(n.sum())
                rest = np.concatenate([rest, np.frombuffer(b"".join(out), kind)])
                if len(rest) >= ROWS * length:
                    full = len(rest) // (ROWS * length) * ROWS * length     # whole batches: sequence i is in batch i // ROWS
                    put(rest[:full], np.ones(full, bool))
                    rest = rest[full:].copy()
            if len(rest):
                pad = -len(rest) % length
                put(np.concatenate([rest, np.zeros(pad, kind)]), np.arange(len(rest) + pad) < len(rest))
            ids_file.close()
            docs_file.close()
        if at:
            with store.open_output_stream(f"{base}/{name}.index{mark}") as c:
                c.write(np.array(places, "<i8").tobytes())
            for ext in ("index", "docs", "arrows"):
                publish(store, f"{base}/{name}.{ext}", f"{base}/{name}.{ext}{mark}")
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([part]), pa.array([at])], schema=schema)
        else:
            for ext in ("arrows", "docs"):
                store.delete_file(f"{base}/{name}.{ext}{mark}")
    return run


def write_files(docs: DataFrame, tokenizer_file: str, length: int = LENGTH, end_id: int = END_ID, id_col: str = "doc_id",
                text_col: str = "text", rows_per_file: int = 10_000) -> tuple[str, DataFrame]:
    """(folder, manifest): the written folder and its files in order, as
    (name, base, n_tokens) with the ids before the file as base."""
    from tokenizers import Tokenizer
    spark = docs.sparkSession
    with open(tokenizer_file) as f:
        text = f.read()
    probe = Tokenizer.from_str(text)
    for a, b in (("Word, one.", "word , one ."), ("a\tB\nc", "a b c")):
        if probe.encode(a, add_special_tokens=False).ids != probe.encode(b, add_special_tokens=False).ids:
            raise ValueError("the tokenizer must lower-case, drop white space and split off punctuation")
    if any(c.isspace() for t in probe.get_added_tokens_decoder().values() for c in t.content):
        raise ValueError("an added token holds white space")
    wide = max(probe.get_vocab_size(), end_id + 1) > 1 << 16
    model = spark.sparkContext.broadcast(text)
    rows = keyed(docs, id_col, text_col)
    files = max(1, -(-docs.count() // rows_per_file))
    folder = new_folder(spark, "token-files")
    done = rows.repartitionByRange(files, "dk", "tie").sortWithinPartitions("dk", "tie").mapInArrow(
        _write(folder, model, end_id, length, wide), "name string, part long, n_tokens long").toPandas().sort_values("part")
    base = np.cumsum(done.n_tokens.to_numpy()) - done.n_tokens.to_numpy()
    manifest = pa.table({"name": pa.array(done.name.to_list(), pa.string()), "base": pa.array(base, pa.int64()), "n_tokens": pa.array(done.n_tokens.to_numpy(), pa.int64())})
    return folder, spark.createDataFrame(manifest, "name string, base long, n_tokens long").repartition(max(1, len(done)), "name")


def _source(store, path: str):
    return pa.memory_map(path) if store.type_name == "local" else store.open_input_file(path)


class Sequences:
    """Random access to the sequences of one file: ``file[i]`` gives (ids,
    mask) of sequence i, from its batch alone; over a memory map nothing is
    copied."""

    def __init__(self, folder: str, name: str):
        store, root = open_folder(folder)
        self.file = _source(store, f"{root}/{name}.arrows")
        with store.open_input_stream(f"{root}/{name}.index") as c:
            self.places = np.frombuffer(c.read(), "<i8")
        self.schema = pa.ipc.open_stream(self.file).schema
        self.at, self.batch = -1, None

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        k = i // ROWS
        if i < 0 or k >= len(self.places):
            raise IndexError(i)
        if k != self.at:
            self.file.seek(int(self.places[k]))
            message = pa.ipc.read_message(self.file)
            if message.type == "schema":            # the stream writes it with its first batch
                message = pa.ipc.read_message(self.file)
            self.at, self.batch = k, pa.ipc.read_record_batch(message, self.schema)
        if i % ROWS >= self.batch.num_rows:
            raise IndexError(i)
        row = [self.batch.column(c).slice(i % ROWS, 1).flatten() for c in (0, 1)]
        return row[0].to_numpy(), row[1].to_numpy(zero_copy_only=False)

    def close(self) -> None:
        self.file.close()

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()


def numbered_files(manifest: DataFrame, length: int = LENGTH) -> DataFrame:
    """The manifest with ``first``, the number of sequences in all files before,
    and ``sequences``, those of the file."""
    files = manifest.withColumn("sequences", F.expr(f"(n_tokens + {length - 1}) div {length}"))
    before = Window.orderBy("base").rowsBetween(Window.unboundedPreceding, -1)         # one row a file
    return files.withColumn("first", F.coalesce(F.sum("sequences").over(before), F.lit(0)))


def read_sequences(folder: str, manifest: DataFrame, wanted: DataFrame, length: int = LENGTH) -> DataFrame:
    """sequence, ids and mask of the sequences numbered in ``wanted`` (column
    ``sequence``, over all files in order); numbers that are null or beyond
    the last one are left out, repeated ones come once.  Tasks seek to what is
    wanted and read no other batch."""
    files = numbered_files(manifest, length).select("name", "first", "sequences")
    hits = wanted.select(F.col("sequence").cast("long").alias("sequence")).distinct().join(F.broadcast(files), F.expr("sequence >= first AND sequence < first + sequences"))
    hits = hits.select("name", "sequence", (F.col("sequence") - F.col("first")).alias("at")).repartitionByRange("name", "at").sortWithinPartitions("name", "at")
    schema = pa.schema([("sequence", pa.int64()), ("ids", pa.list_(pa.int64())), ("mask", pa.list_(pa.bool_()))])

    def run(batches):
        held, name = None, None
        for rows in batches:
            for lo in range(0, rows.num_rows, ROWS):
                part, ids, masks = rows.slice(lo, ROWS).to_pylist(), [], []
                for r in part:
                    if r["name"] != name:
                        if held:
                            held.close()
                        name, held = r["name"], Sequences(folder, r["name"])
                    x, m = held[r["at"]]
                    ids.append(x.astype(np.int64))
                    masks.append(m)
                yield pa.RecordBatch.from_arrays([pa.array([r["sequence"] for r in part], pa.int64()), pa.array(ids, pa.list_(pa.int64())), pa.array(masks, pa.list_(pa.bool_()))], schema=schema)
        if held:
            held.close()
    return hits.mapInArrow(run, "sequence long, ids array<long>, mask array<boolean>")


def read_documents(folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        store, root = open_folder(folder)
        for row in (r for b in batches for r in b.to_pylist()):
            with _source(store, f"{root}/{row['name']}.arrows") as a, _source(store, f"{root}/{row['name']}.docs") as b:
                sequences = pa.ipc.open_stream(a)
                held, begin = np.zeros(0, "<u2"), 0         # ids from ``begin`` on
                for docs in pa.ipc.open_stream(b):
                    out = []
                    for start, n in zip(docs.column(1).to_pylist(), docs.column(2).to_pylist()):
                        crc, at, end = 0, start, start + n
                        while at < end:
                            if at >= begin + len(held):
                                begin += len(held)
                                held = sequences.read_next_batch().column(0).flatten().to_numpy()
                                continue
                            part = held[at - begin:end - begin]
                            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                            at += len(part)
                        out.append(crc)
                    yield pa.RecordBatch.from_arrays([docs.column(0), pa.array(docs.column(1).to_numpy() + row["base"]), docs.column(2), pa.array(out, pa.int64())], schema=schema)
    return manifest.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
