"""Registered queries of the package and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import decontaminate, license_scan, manifest, near_dedup, quality, sentencepiece_fst, spelling, substring_dedup, suffix_dedup, token_counts, token_files, url_filter, warc
from .files import new_folder

TOKENIZERS = "/opt/tokenizers"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark, sf_dir):
    """Groups of documents whose 2-word shingle sets are 0.8 similar or more."""
    return near_dedup.groups(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_decontaminate(spark, sf_dir):
    """Benchmark passages in every document, by FM-index search."""
    return decontaminate.digests(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_substring_dedup(spark, sf_dir):
    """Repeated runs of 20 words in every document, by FM-index matching statistics."""
    return substring_dedup.digests(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_suffix_dedup(spark, sf_dir):
    """Repeated strings of 400 bytes in every document, by induced suffix sorting."""
    return suffix_dedup.digests(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_sentencepiece(spark, sf_dir):
    """Piece ids of every document, checked by decoding them."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_fst.encode(docs, f"{TOKENIZERS}/piece_bpe_32k.model").select("doc_id", "ids", "n_tokens", "round_trip")


def op6_warc(spark, sf_dir):
    """Archives of all pages, written and read again."""
    folder, files = warc.write_archives(_table(spark, sf_dir, "pages"))
    return warc.read_archives(folder, files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_url_filter(spark, sf_dir):
    """Verdict on every page's URL, by rules and language-model ratio."""
    return url_filter.judge(_table(spark, sf_dir, "pages").select("page_id", "url"))


def op8_token_files(spark, sf_dir):
    """Token ids of all documents in Arrow stream files, written and read again."""
    return token_files.read_documents(*token_files.write_files(_table(spark, sf_dir, "documents").select("doc_id", "text"), f"{TOKENIZERS}/word_bpe_49k.json"))


def op9_license_scan(spark, sf_dir):
    """Licence notices in every document."""
    return license_scan.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_quality(spark, sf_dir):
    """Base counts, likelihood ratio and verdict of every document."""
    return quality.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))


def op11_token_counts(spark, sf_dir):
    """Tokens of every document, each distinct text encoded once, by a cache of digests."""
    cache = token_counts.CountCache(spark, new_folder(spark, "token-cache"))
    got = token_counts.count_tokens(_table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model", cache)
    return got.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > token_counts.LIMIT).alias("over_limit"))


def op12_spelling(spark, sf_dir):
    """Near words and canonical forms of the vocabulary of all documents."""
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark, sf_dir):
    """Merkle proofs of all documents, a third of them altered, and their verification."""
    return manifest.digests(_table(spark, sf_dir, "documents"), manifest.tampered_claim())


QUERIES = {f.__name__: f for f in (op1_near_dedup, op2_decontaminate, op3_substring_dedup, op4_suffix_dedup, op5_sentencepiece,
                                   op6_warc, op7_url_filter, op8_token_files, op9_license_scan, op10_quality, op11_token_counts, op12_spelling, op13_merkle_manifest)}

def _crc32(text: str) -> str:
    """DuckDB's unsigned crc32 of a text's UTF-8 bytes, bit by bit."""
    bits = f"flatten([[CAST('0x' || substr(hex(encode({text})), 2 * k + 1, 2) AS BIGINT), 0, 0, 0, 0, 0, 0, 0] FOR k IN range(octet_length(encode({text})))])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295)"


def _merkle_sql(levels: int = 7, top: int = 3) -> str:
    """Groups of up to 8^levels rows, up to 8^top groups; ``c``: nodes of the level."""
    leaf = " || ".join(f"coalesce(octet_length(encode(CAST({{{c}}} AS VARCHAR))) || ':' || {{{c}}}, '-')" for c in manifest.FIELDS)
    plain = leaf.format(**{c: c for c in manifest.FIELDS})
    low = leaf.format(**{c: c for c in manifest.FIELDS} | {"text": "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"})
    out = [f"""d AS (SELECT doc_id, coalesce(1 || lang, '0') AS g, sha256({plain}) AS leaf, CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN sha256({low}) ELSE sha256({plain}) END AS claim FROM documents)""",
           "a0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS p, count(*) OVER (PARTITION BY g) AS c, leaf AS h FROM d)"]

    def climb(name, count):
        for k in range(count):
            out.append(f"""{name}{k + 1} AS (SELECT g, p, h, count(*) OVER (PARTITION BY g) AS c FROM
  (SELECT g, p // 8 AS p, CASE WHEN any_value(c) > 1 THEN sha256(string_agg(h, '' ORDER BY p)) ELSE any_value(h) END AS h FROM {name}{k} GROUP BY g, p // 8))""")
            out.append(f"""{name}s{k} AS (SELECT x.g, x.p, any_value(x.c) > 1 AS up, coalesce(string_agg(y.h, '' ORDER BY y.p) FILTER (y.p < x.p), '') AS l, coalesce(string_agg(y.h, '' ORDER BY y.p) FILTER (y.p > x.p), '') AS r
  FROM {name}{k} x JOIN {name}{k} y ON x.g = y.g AND x.p // 8 = y.p // 8 GROUP BY x.g, x.p)""")
    climb("a", levels)
    out.append(f"b0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g) - 1 AS p, h, count(*) OVER () AS c, g AS of FROM a{levels})")
    climb("b", top)
    joins = " ".join([f"JOIN as{k} ON as{k}.g = a.g AND as{k}.p = a.p // {8 ** k}" for k in range(levels)] + ["JOIN b0 b ON b.of = a.g"]
                     + [f"JOIN bs{k} ON bs{k}.p = b.p // {8 ** k}" for k in range(top)])
    steps = [f"as{k}" for k in range(levels)] + [f"bs{k}" for k in range(top)]
    fold = "a.claim"
    out.append(f"f0 AS (SELECT a.doc_id, a.leaf, a.claim AS h, b.h AS subroot, {', '.join(f'{s}.up AS u{i}, {s}.l AS l{i}, {s}.r AS r{i}' for i, s in enumerate(steps))} FROM a0 a {joins})")
    for i in range(len(steps)):
        out.append(f"f{i + 1} AS (SELECT * REPLACE (CASE WHEN u{i} THEN sha256(l{i} || h || r{i}) ELSE h END AS h) FROM f{i})")
    proof = " || ".join(f"l{i} || r{i}" for i in range(len(steps)))
    return f"WITH {', '.join(out)} SELECT doc_id, leaf, subroot, t.root, sha256({proof}) AS proof_sha256, h AS folded_root, h = t.root AS verified FROM f{len(steps)} CROSS JOIN (SELECT h AS root FROM b{top}) t"


ORACLE = {
    "op1_near_dedup": """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 1], ' ') AS x FROM d, unnest(range(1, greatest(len(w), 2))) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN m ON m.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op2_decontaminate": """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS phrase
      FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
k AS (SELECT DISTINCT k FROM p),
v AS (SELECT doc_id, i, k.k AS k, array_to_string(w[i:i + k.k - 1], ' ') AS phrase
      FROM d, k, unnest(range(1, greatest(len(w) - k.k + 1, 0) + 1)) AS t(i)),
h AS (SELECT v.doc_id, v.i, v.k, p.item_id FROM v JOIN p ON v.k = p.k AND v.phrase = p.phrase),
n AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM h, unnest(range(i, i + k)) AS t(x) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(m.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(m.items, '')) AS items_sha256, coalesce(n.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN m ON d.doc_id = m.doc_id""",
    "op3_substring_dedup": """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
v AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM d, unnest(range(1, greatest(len(w) - 19, 0) + 1)) AS t(i)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM v),
g AS (SELECT DISTINCT doc_id, x FROM r, unnest(range(i, i + 20)) AS t(x) WHERE k > 1),
l AS (SELECT doc_id, list(x) AS xs FROM g GROUP BY doc_id),
e AS (SELECT d.doc_id, len(d.w) AS n, coalesce(len(l.xs), 0) AS m, d.w, coalesce(l.xs, []) AS xs FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
t AS (SELECT doc_id, string_agg(w[i], ' ' ORDER BY i) AS kept FROM e, unnest(range(1, n + 1)) AS t(i) WHERE NOT list_contains(xs, i) GROUP BY doc_id)
SELECT e.doc_id, CAST(n AS BIGINT) AS n_words, CAST(m AS BIGINT) AS n_removed, sha256(coalesce(t.kept, '')) AS kept_sha256
FROM e LEFT JOIN t ON e.doc_id = t.doc_id""",
    "op4_suffix_dedup": """
WITH d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
v AS (SELECT doc_id, i, md5(substr(h, 2 * i - 1, 800)) AS k FROM d, unnest(range(1, greatest(n - 399, 0) + 1)) AS t(i)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY k) AS c FROM v) WHERE c > 1),
s AS (SELECT doc_id, i, lag(i) OVER w AS p FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i - p > 400 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM s),
m AS (SELECT doc_id, span, min(i) AS a, max(i) + 400 AS b FROM g GROUP BY doc_id, span),
o AS (SELECT doc_id, span, a, b, lag(b, 1, 1) OVER (PARTITION BY doc_id ORDER BY span) AS prev FROM m),
k AS (SELECT o.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last, string_agg(substr(h, 2 * prev - 1, 2 * (a - prev)), '' ORDER BY span) AS kept
      FROM o JOIN d ON o.doc_id = d.doc_id GROUP BY o.doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN k.doc_id IS NULL THEN h ELSE kept || substr(h, 2 * last - 1) END)) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op6_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS s FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY s) AS first FROM h),
q AS (SELECT f.*, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(((('0x' || substr(s, 1 + 5 * (k // 4), 5))::BIGINT >> (15 - 5 * (k % 4))) & 31) AS INTEGER), 1), '' ORDER BY k) AS d
      FROM f, unnest(range(32)) AS t(k) GROUP BY ALL)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to FROM q""",
    "op12_spelling": f"""
WITH RECURSIVE r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w FROM documents),
o AS (SELECT d, w, count(*) AS n FROM r WHERE length(w) >= 6 GROUP BY d, w),
h AS (SELECT w, n, {_crc32("d || ':' || w")} AS h FROM o),
c AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM c WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
e AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM v, unnest(range(1, length(word) + 1)) AS t(i)),
p AS (SELECT a.word AS a, b.word AS b FROM e a JOIN e b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
      UNION SELECT a.word, b.word FROM e a JOIN v b ON a.cut = b.word UNION SELECT b.word, a.word FROM e a JOIN v b ON a.cut = b.word),
s AS (SELECT a, count(*) AS n_near, min((-v.n, b)) AS best FROM p JOIN v ON v.word = b GROUP BY a),
f AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 5 * n THEN best[2] END AS form, CASE WHEN -best[1] >= 5 * n THEN -best[1] END AS form_n FROM v LEFT JOIN s ON a = word),
g AS (SELECT word, word AS root FROM f UNION ALL SELECT g.word, f.form FROM g JOIN f ON f.word = g.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, g.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM f JOIN g ON g.word = f.word JOIN f z ON z.word = g.root AND z.form IS NULL""",
    "op13_merkle_manifest": _merkle_sql(),
}
