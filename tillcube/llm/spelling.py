"""Spelling variants by a variable-length gram index (operator 12).

Words are the runs of letters of the texts, A-Z lower-cased, with at least
``LETTERS`` code points and ``TIMES`` occurrences; two are near if one code
point inserted, deleted or replaced makes one the other.

1. Gram dictionary, pruned by frequency: grams have 2 to 4 code points, and a
   gram is extended only while it occurs more than T times in the words.  T
   grows with the words, so at most ``DICTIONARY`` grams of a length are
   frequent; they are broadcast and stand for the dictionary.
2. Decomposition: at every start a word has the dictionary's longest gram
   there.  A gram depends on its own characters alone (and on the word's end),
   so an edit affects only the grams over its place.
3. Bounds: a word's most affected grams by one edit, over all places, bound
   what it shares with a near word: all but that many of its grams.  So a merge
   may skip its (grams - affected - 1) most frequent lists: a near word is met
   in one of the (affected + 1) least frequent ones of both.
4. List merging: left of the edit everything is equal, and right of it too.  So
   a gram is listed under (start, the word up to its end) and under (length,
   the word from its start).  Only the lists that the bounds leave are joined,
   and those of less than ``STRONG`` code points are split before: by the
   edit's place, the word goes on alike for two code points, or all but two of
   its other end are alike.
5. Pairs that meet are verified by edit distance, in the join itself.

Spark sizes an exploded table by what it was before and a stored one by its
compressed files, so joins on the vocabulary's tables and lists are by merging:
none is broadcast, however small it seems (``by_merge``).

Every word of six code points or more keeps a gram at any edit, so no pair is
lost.  A null text has no words; a null id counts as an empty one where ids
take part.  Rows that repeat an id count each.  An empty table gives no words.
Columns that are not named are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .files import drop_tables, store

LETTERS = 6
TIMES = 5
RATIO = 5               # a form's occurrences, in those of the word
SHORTEST, LONGEST = 2, 4
FREQUENT = 50           # least T
DICTIONARY = 20_000     # frequent grams of a length at most
STRONG = 6              # code points of a list that need no split
RUN = f"[a-zÀ-ÿ]{{{LETTERS},}}"


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int = 199) -> DataFrame:
    """(word, n).  With ``damage``, a run whose crc32 h (of ``id:run``) it
    divides loses the code point h % length first; 0: none does."""
    text = F.translate(text_col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("word"))
    if damage:
        runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word").cast("binary")))
        cut = F.expr("CAST(h % char_length(word) AS INT)")
        runs = runs.select(F.when(F.col("h") % damage == 0, F.concat(F.substring("word", F.lit(1), cut), F.substring("word", cut + 2, F.char_length("word")))).otherwise(F.col("word")).alias("word"))
        runs = runs.filter(F.char_length("word") >= LETTERS)
    return runs.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= TIMES)


def frequent_grams(vocabulary: DataFrame) -> dict[str, int]:
    """Grams that occur more than T times in the words, with their number."""
    places = F.sequence(F.lit(1), F.char_length("word") - SHORTEST + 1)
    grams = vocabulary.select("word", F.explode(places).alias("at")).select(
        F.explode(F.array(*[F.when(F.col("at") + q - 1 <= F.char_length("word"), F.substring("word", F.col("at"), F.lit(q))) for q in range(SHORTEST, LONGEST + 1)])).alias("gram"))
    total = vocabulary.agg(F.sum(F.char_length("word"))).head()[0] or 0
    counts = grams.filter("gram IS NOT NULL").groupBy("gram").count()
    return dict(counts.filter(F.col("count") > max(FREQUENT, -(-total // DICTIONARY))).toPandas().itertuples(index=False))


def decompose(word: str, frequent: dict[str, int]) -> tuple[list[int], int]:
    """Ends of the grams at starts 0, 1, ..., and how many of them one edit affects at most."""
    n = len(word)
    ends = []
    hit = [0] * (2 * n + 2)         # places: gap 0, letter 0, gap 1, ..., gap n; differences
    for i in range(n - SHORTEST + 1):
        j = i + SHORTEST
        while j < n and j - i < LONGEST and word[i:j] in frequent:
            j += 1
        ends.append(j)
        open_end = j == n and j - i < LONGEST and word[i:j] in frequent       # a letter after the word would extend it
        hit[2 * i + 1] += 1
        hit[2 * j if not open_end else 2 * j + 1] -= 1
    worst = now = 0
    for d in hit:
        now += d
        worst = max(worst, now)
    return ends, worst


def split_list(side: str, word: str, end: int) -> list[str]:
    """Lists of the words that begin like this one up to ``end``, by the edit's
    place behind it: beyond two more code points, which are alike then, or
    before, and what follows is alike (one code point less of it, if the other
    word is the shorter one)."""
    n, m = len(word), end + 2
    if end >= STRONG:
        return [f"{side}<{word[:end]}"]
    tails = {max(0, n - m), max(0, n - m - 1)} if n > LETTERS else {max(0, n - m)}
    return [f"{side}<{word[:end]}|{word[n - x:]}" for x in tails] + ([f"{side}={word[:m]}"] if n >= m else [])


_LISTS = pa.schema([("word", pa.string()), ("n", pa.int64()), ("lists", pa.list_(pa.string()))])


def _index(frequent):
    """The words with the lists that their bound leaves."""
    def run(batches):
        common = frequent.value
        for rows in batches:
            found = []
            for word in rows.column(0).to_pylist():
                ends, worst = decompose(word, common)
                order = sorted(range(len(ends)), key=lambda i: (common.get(word[i:ends[i]], 0), word[i:ends[i]], i))
                back = word[::-1]
                found.append(list({k for i in order[:worst + 1] for k in (*split_list(f"L{i}", word, ends[i]), *split_list(f"R{ends[i] - i}", back, len(word) - i))}))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(found, pa.list_(pa.string()))], schema=_LISTS)
    return run


def by_merge(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """The join by shuffle and sort, of sides that grow with the vocabulary."""
    return left.join(right.hint("merge"), on, how)


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(a, na, b, nb): every two near words once."""
    frequent = vocabulary.sparkSession.sparkContext.broadcast(frequent_grams(vocabulary))
    index = vocabulary.select("word", "n").mapInArrow(_index(frequent), "word string, n long, lists array<string>")
    lists = index.select("word", "n", F.explode("lists").alias("list")).select(F.xxhash64("list").alias("list"), F.col("word").alias("a"), F.col("n").alias("na"))
    other = lists.select("list", F.col("a").alias("b"), F.col("na").alias("nb"))
    near = F.expr("a < b AND abs(char_length(a) - char_length(b)) <= 1 AND levenshtein(a, b, 1) = 1")
    pairs = by_merge(lists, other, "list").filter(near).drop("list").distinct()
    return store(pairs, "near-words")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the last of word, its form,
    its form's form, ...  Each round doubles the steps; a form's n is at least
    RATIO times the word's, so the rounds grow with the log of the log of n."""
    at = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.selectExpr("word AS mid", "root AS far")
        if not by_merge(at, on, F.col("root") == F.col("mid"), "left_semi").limit(1).count():
            return at
        further = store(by_merge(at, on, F.col("root") == F.col("mid"), "left").select("word", F.coalesce("far", "root").alias("root")), "roots")
        drop_tables(at)
        at = further


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int = 199) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word."""
    vocabulary = store(words(docs, id_col, text_col, damage), "vocabulary")
    pairs = near_pairs(vocabulary)
    sides = pairs.selectExpr("a AS word", "b AS other", "nb AS m").union(pairs.selectExpr("b AS word", "a AS other", "na AS m"))
    best = sides.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    near = by_merge(vocabulary, best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.expr(f"CASE WHEN -best.m >= {RATIO} * n THEN best END").alias("best"))
    near = store(near.select("word", "n", "n_near", F.col("best.other").alias("form"), (-F.col("best.m")).alias("form_n")), "near-forms")
    ends = roots(near.filter("form IS NOT NULL"))
    out = by_merge(near, ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    out = store(out, "spelling")
    drop_tables(vocabulary, pairs, near, ends)
    return out
