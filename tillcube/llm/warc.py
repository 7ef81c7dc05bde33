"""WARC archives with Zstandard frames and a dictionary (operator 6).

An archive file starts with a skippable frame that holds the dictionary
(itself compressed or not), followed by one Zstandard frame per record, all
compressed with it, so a reader can take any record by its frame.  The
reader loads the dictionary from the leading frame, decodes frame by frame,
and checks the headers, the two line ends after the block and the lengths.

Records of equal payload digest (SHA-1) and at least ``min_bytes`` bytes:
the one with the smallest page id is a response, the others are revisits
that refer to it and hold the HTTP header only.  Null html is an empty
payload; a null page id comes after all others; of rows that repeat an id
and payload one is the response.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .files import drop_tables, new_folder, open_folder, publish, store
from .skew import COPIES, join_facts

SKIPPABLE = 0x184D2A5D          # fixed value: magic number of the dictionary frame
ZSTD_MAGIC = 0xFD2FB528         # fixed value: magic number of a Zstandard frame
DICT_BYTES, DICT_SAMPLES = 32 << 10, 400
DATE = "2024-01-01T00:00:00Z"   # records carry no clock, so a rewrite gives the same bytes
BUFFER = 1 << 20


def dictionary(pages: DataFrame, text_col: str = "html") -> bytes:
    """A dictionary fitted on up to ``DICT_SAMPLES`` records (of the smallest
    digests), the first 8 kB of each; empty if there is too little text."""
    digests = pages.filter(F.length(text_col) > 0).select(F.md5(text_col).alias("h"))
    # every task sends DICT_SAMPLES digests; only the chosen texts follow, one a digest
    chosen = [r.h for r in digests.distinct().orderBy("h").limit(DICT_SAMPLES).collect()]
    some = pages.select(F.md5(text_col).alias("h"), F.substring(text_col, 1, 8192).alias("t")).filter(F.col("h").isin(chosen))
    raw = [r.t.encode() for r in some.groupBy("h").agg(F.first("t").alias("t")).orderBy("h").collect()]
    if sum(map(len, raw)) < 8 * DICT_BYTES:
        return b""
    try:
        return zstandard.train_dictionary(DICT_BYTES, raw).as_bytes()
    except zstandard.ZstdError:
        return b""


def record(page_id, url: str, kind: str, block: bytes, payload_digest: str, refers_to=None) -> bytes:
    """Bytes of one WARC record."""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}",
            "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{payload_digest}",
            f"WARC-Block-Digest: sha1:{digest(block)}"]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def dictionary_frame(raw: bytes) -> bytes:
    return struct.pack("<II", SKIPPABLE, len(raw)) + raw


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of a record; raises ValueError on a bad one."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not mark or not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC header")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name:
            raise ValueError(f"bad header line {line!r}")
        headers[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ValueError(f"no {name}")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"block of {len(rest) - 4} bytes, {length} told")
    block = rest[:length]
    if headers.get("warc-block-digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
        raise ValueError("block digest differs")
    return headers, block


def read_archive(stream):
    """Records of an archive, one frame after the other, in bounded memory."""
    head = stream.read(8)
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != SKIPPABLE:
        raise ValueError("no dictionary frame")
    size = struct.unpack("<I", head[4:])[0]
    raw = stream.read(size)
    if len(raw) != size:
        raise ValueError("cut dictionary frame")
    if raw[:4] == struct.pack("<I", ZSTD_MAGIC):
        raw = zstandard.ZstdDecompressor().decompress(raw)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
    rest = b""
    while True:
        frame, out = reader.decompressobj(), []
        if not rest and not (rest := stream.read(BUFFER)):
            return
        while not frame.eof:
            if not rest and not (rest := stream.read(BUFFER)):
                raise ValueError("cut frame")
            out.append(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else b""
        yield parse(b"".join(out))


def _write(folder: str, raw_dictionary):
    schema = pa.schema([("name", pa.string()), ("records", pa.int64())])

    def run(batches):
        raw = raw_dictionary.value
        store, base = open_folder(folder)
        store.create_dir(base)
        mark = f".{TaskContext.get().taskAttemptId()}.tmp"
        name = f"part-{TaskContext.get().partitionId():06d}.warc.zst"
        writer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
        n = 0
        with store.open_output_stream(f"{base}/{name}{mark}", compression=None) as out:
            out.write(dictionary_frame(zstandard.ZstdCompressor().compress(raw) if raw else b""))
            for rows in batches:
                for lo in range(0, rows.num_rows, 64):
                    for r in rows.slice(lo, 64).to_pylist():
                        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['size']}\r\n\r\n".encode()
                        sha = base64.b32encode(bytes.fromhex(r["sha"])).decode()
                        kind, payload = ("revisit", b"") if r["html"] is None else ("response", r["html"].encode())
                        data = record(r["page_id"], " ".join((r["url"] or "").split()), kind, http + payload, sha, r["response"])
                        out.write(writer.compress(data))
                        n += 1
        if n:
            publish(store, f"{base}/{name}", f"{base}/{name}{mark}")
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n])], schema=schema)
        else:
            store.delete_file(f"{base}/{name}{mark}")
    return run


def write_archives(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> tuple[str, DataFrame]:
    """(folder, files): archives of all pages, one file a partition."""
    spark = pages.sparkSession
    raw = spark.sparkContext.broadcast(dictionary(pages, html_col))
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.octet_length(html).cast("long").alias("size"),
                        F.sha1(F.encode(html, "UTF-8")).alias("sha"), html.alias("html"))
    large, nothing = F.col("size") >= min_bytes, F.lit(None)
    place = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")
    # equal rows are one with their number; the first of a payload is its response, the rest revisit it
    known = store(rows.filter(large).groupBy("sha", "page_id", "url", "size").agg(F.count("*").alias("rows")), "warc-rows")
    firsts = known.groupBy("sha").agg(F.min(place).alias("first"), F.count("*").alias("copies"))
    again = join_facts(known, firsts, "sha", "copies", known.count())
    again = again.withColumn("rows", F.col("rows") - (place == F.col("first")).cast("long")).filter("rows > 0")
    again = again.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(rows - 1) div {COPIES}")))).repartition("sha", "page_id", "run")
    again = again.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES), F.col("rows") - F.col("run") * COPIES))))
    again = again.select("page_id", "url", "size", "sha", nothing.cast("string").alias("html"), F.col("first.page_id").alias("response"))
    payloads = rows.filter(large).groupBy("sha").agg(F.min(place).alias("first"), F.first("size").alias("size"), F.first("html").alias("html"))
    columns = [F.col("first.page_id").alias("page_id"), F.col("first.url").alias("url"), "size", "sha", "html", nothing.cast("long").alias("response")]
    every = payloads.select(*columns).union(again)
    if min_bytes > 0:
        every = every.union(rows.filter(~large).select("page_id", "url", "size", "sha", "html", nothing.cast("long").alias("response")))
    folder = new_folder(spark, "warc")
    done = every.mapInArrow(_write(folder, raw), "name string, records long").toPandas()
    drop_tables(known)
    files = pa.table({"name": pa.array(done.name.to_list(), pa.string()), "records": pa.array(done.records.to_numpy(), pa.int64())})
    return folder, spark.createDataFrame(files, "name string, records long").repartition(max(1, len(done)), "name")


def read_archives(folder: str, files: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url and
    payload (null in a revisit) of every record; a bad or missing record
    fails the job."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.string())])

    def number(urn):
        urn = urn.strip("<>").rsplit(":", 1)[1]
        return None if urn == "None" else int(urn)

    def run(batches):
        store, base = open_folder(folder)
        for row in (r for b in batches for r in b.to_pylist()):
            out, n, held = [], 0, 0
            with store.open_input_stream(f"{base}/{row['name']}", compression=None) as stream:
                for headers, block in read_archive(stream):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    told = int(next(x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")))
                    name, kind = headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"]
                    if kind == "response" and (len(payload) != told or digest(payload) != name):
                        raise ValueError(f"payload of {headers['warc-record-id']} differs")
                    refers = headers.get("warc-refers-to")
                    out.append((number(headers["warc-record-id"]), told, name, kind, number(refers) if refers else None, headers.get("warc-target-uri"), payload.decode() if kind == "response" else None))
                    n, held = n + 1, held + len(payload)
                    if held >= BUFFER * 4:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                        out, held = [], 0
            if n != row["records"]:
                raise ValueError(f"{row['name']}: {n} records, {row['records']} written")
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
    return files.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload string")
