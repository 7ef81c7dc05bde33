"""Token counts through a digest cache (operator 11).

The cache is a Parquet table of (tokenizer, content, n_tokens): the digest of
a tokenizer version (library, its version and the vocabulary file) and the
sha256 of a normalised content.  Counting joins the digests of all rows to
the stored counts, encodes every distinct content that is missing once, with
the tokenizer's own library, and appends the new counts; so a second run over
grown or changed data encodes only what it has not met.

The normalised content is the text in the form that the tokenizer cannot tell
from it: null is empty, and for sentencepiece models that remove extra white
space, runs of spaces are one and outer spaces go.  Files ending in
``.model`` go to sentencepiece, others to tokenizers; neither adds begin, end
or special tokens, truncates or pads.

Texts move only where contents are missing, one a content and map task.  A
content of many copies is aggregated before the shuffle; its count returns to
the rows by a broadcast of the contents of most copies (a bounded number, see
``skew.join_facts``), and to all other rows by a shuffled join.

Every row gets its own result, also with a null or repeated id.  An empty
table gives no rows.  An append that is done twice (a retried job) stores the
same counts twice and is read as one.  Columns that are not named are ignored.
"""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .files import drop_tables, once, store
from .skew import join_facts
from .text import chunks

LIMIT = 4096
STORED = "tokenizer string, content binary, n_tokens long"


@dataclass(frozen=True)
class Tokenizer:
    """A vocabulary file's bytes, and whether sentencepiece reads it."""

    data: bytes
    pieces: bool

    @classmethod
    def read(cls, path: str) -> Tokenizer:
        with open(path, "rb") as f:
            return cls(f.read(), path.endswith(".model"))

    def version(self) -> str:
        """Digest of all that decides a count."""
        import sentencepiece
        import tokenizers
        library = sentencepiece if self.pieces else tokenizers
        return hashlib.sha256(f"{library.__name__} {library.__version__}\n".encode() + self.data).hexdigest()

    def normalised(self, text: Column) -> Column:
        text = F.coalesce(text, F.lit(""))
        if self.pieces:
            from sentencepiece import sentencepiece_model_pb2
            model = sentencepiece_model_pb2.ModelProto.FromString(self.data)
            if model.normalizer_spec.remove_extra_whitespaces:
                return F.trim(F.regexp_replace(text, " +", " "))
        return text

    def counter(self):
        """Function from texts to numbers of tokens."""
        if self.pieces:
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_proto=self.data)
            return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers
        model = tokenizers.Tokenizer.from_str(self.data.decode())
        model.no_truncation()
        model.no_padding()
        return lambda texts: [len(e.ids) for e in model.encode_batch_fast(texts, add_special_tokens=False)]


class CountCache:
    """The stored counts, one folder a tokenizer version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def counts(self, version: str) -> DataFrame:
        """(content, n_tokens), each content once."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/tokenizer={version}")
        if not p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(p):
            return self.spark.createDataFrame([], "content binary, n_tokens long")
        found = self.spark.read.schema(STORED).parquet(self.path).filter(F.col("tokenizer") == version)
        return found.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, counts: DataFrame, version: str) -> None:
        counts.select(F.lit(version).alias("tokenizer"), "content", "n_tokens").write.mode("append").partitionBy("tokenizer").parquet(self.path)


def _encode(texts: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """(content, n_tokens) of the contents (content, text)."""
    model = texts.sparkSession.sparkContext.broadcast(tokenizer)
    schema = pa.schema([("content", pa.binary()), ("n_tokens", pa.int64())])

    def run(batches):
        count = once(("counter", model.value.data), model.value.counter)
        for rows, _, _ in chunks(batches):
            yield pa.RecordBatch.from_arrays([rows.column(0).cast(pa.binary()), pa.array(count(rows.column(1).to_pylist()), pa.int64())], schema=schema)
    return texts.select("content", "text").mapInArrow(run, "content binary, n_tokens long")


def _missing_texts(docs: DataFrame, content: Column, text: Column, missing: DataFrame, number: int, contents: int) -> DataFrame:
    """One text of every missing content."""
    spark = docs.sparkSession
    texts = docs.select(content.alias("content"), text.alias("text"))
    if number < contents and number * 48 <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold():
        return texts.join(F.broadcast(missing), "content", "left_semi").groupBy("content").agg(F.first("text").alias("text"))
    texts = texts.groupBy("content").agg(F.first("text").alias("text"))
    return texts.join(missing, "content", "left_semi") if number < contents else texts


def count_tokens(docs: DataFrame, tokenizer_file: str, cache: CountCache, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes and n_tokens of every row; the cache holds their counts then."""
    tokenizer = Tokenizer.read(tokenizer_file)
    version = tokenizer.version()
    text = tokenizer.normalised(F.col(text_col))
    content = F.unhex(F.sha2(text, 256))
    rows = store(docs.select(F.col(id_col).alias("id"), F.octet_length(F.coalesce(text_col, F.lit(""))).cast("long").alias("n_bytes"), content.alias("content")), "token-digests")
    contents = store(rows.groupBy("content").agg(F.count("*").alias("copies")), "token-contents")
    missing = store(contents.join(cache.counts(version), "content", "left_anti").select("content"), "token-misses")
    if number := missing.count():
        cache.append(_encode(_missing_texts(docs, content, text, missing, number, contents.count()), tokenizer), version)
    counts = contents.join(cache.counts(version), "content")
    out = join_facts(rows, counts, "content", "copies", rows.count())
    out = store(out.select("id", "n_bytes", "n_tokens"), "token-counts")
    drop_tables(rows, contents, missing)
    return out
