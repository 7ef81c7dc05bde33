"""URL filter by rules and a character language-model ratio (operator 7).

A rule (host, path prefix) fits its host and all subdomains if the path
starts with the rule's; the longest that fits wins.  URLs without a rule are
judged by two variable-order Markov models over the characters of host and
path: one of the URLs that rules accept, one of those that rules reject,
both interpolated over contexts of 0 to ``ORDER`` characters with
Witten-Bell weights.  All grams and contexts of all URLs count, however rare.

The models are a table, a row a gram with its context's totals; the
probabilities of the longest grams come from order by order joins with those
of the next shorter ones.  The URLs are dealt by hash into groups of about
``GROUP``; a group's distinct grams are joined to the probabilities and meet
its URLs again, which are scored there.  Only grams of orders 0 and 1 (at most
65,792, whatever the input) are sent to all tasks.

The score is the difference of the log-likelihoods per character.  The
threshold is calibrated on one rule-decided URL in five (by hash), which the
models do not see: the cut, in steps of 1/``STEPS``, with the best mean of
both classes' hit rates.  If one class has no URL, every score is 0 and the
URLs without a rule are allowed.

A null URL or one without '://' has an empty host and path and score 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .files import drop_tables, store

ORDER = 4
GROUP = 64
BATCH = 20_000
STEPS, SPAN = 1000, 16
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
_START, _END = 2, 3


def split(url: str | None) -> tuple[str, str]:
    """(host with A-Z lower-cased, path)."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    for c in "#?":
        rest = rest.partition(c)[0]
    host, slash, path = rest.partition("/")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), slash + path


def rule_table(rules) -> dict[str, list[tuple[str, str, str]]]:
    """host -> (path prefix, rule, verdict), longest path first."""
    table: dict[str, list[tuple[str, str, str]]] = {}
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        table.setdefault(host, []).append((slash + path, rule, verdict))
    for v in table.values():
        v.sort(key=lambda x: -len(x[0]))
    return table


def decide(table, host: str, path: str) -> tuple[str | None, str | None]:
    """(rule, verdict) of the longest rule that fits."""
    best: tuple[str | None, str | None] = (None, None)
    while True:
        for prefix, rule, verdict in table.get(host, ()):
            if path.startswith(prefix):
                if best[0] is None or len(rule) > len(best[0]):
                    best = (rule, verdict)
                break
        _, dot, host = host.partition(".")
        if not dot:
            return best


def _windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the last ORDER + 1 bytes up to each character (and the end
    mark), and the offsets of the texts."""
    pad = bytes([_START]) * ORDER
    joined = np.frombuffer(b"".join(pad + t + bytes([_END]) for t in texts), np.uint8)
    lens = np.array([len(t) + 1 for t in texts])
    off = np.concatenate([[0], np.cumsum(lens)])
    at = np.arange(off[-1]) + np.repeat(np.arange(len(texts)) * ORDER, lens)
    return np.stack([joined[at + k] for k in range(ORDER + 1)], 1), off


def _keys(rows: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed context of ``order`` characters, and with the next character."""
    ctx = np.zeros(len(rows), np.int64)
    for k in range(ORDER - order, ORDER):
        ctx = (ctx << 8) | rows[:, k]
    tag = np.int64(order + 1) << 40
    return ctx | tag, ((ctx << 8) | rows[:, ORDER]) | (tag << 8)


def _held(texts: list[bytes]) -> np.ndarray:
    from zlib import crc32
    return np.array([crc32(t) % 5 == 0 for t in texts], bool)


def _text(url: str | None) -> bytes:
    return "".join(split(url)).encode()


def _train(rules):
    schema = pa.schema([("gram", pa.int64()), ("accepted", pa.int64()), ("rejected", pa.int64())])

    def run(batches):
        table = rule_table(rules)
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                parts = [split(u) for u in batch.column(0).slice(lo, BATCH).to_pylist()]
                verdicts = np.array([decide(table, *p)[1] or "" for p in parts])
                texts = ["".join(p).encode() for p in parts]
                seen = ~_held(texts)
                rows, off = _windows(texts)
                gram, back = np.unique(np.concatenate([_keys(rows, k)[1] for k in range(ORDER + 1)]), return_inverse=True)

                def count(kind):
                    own = np.tile(np.repeat(seen & (verdicts == kind), np.diff(off)), ORDER + 1)
                    return pa.array(np.bincount(back[own], minlength=len(gram)).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(gram), count("allow"), count("block")], schema=schema)
    return run


def fit(pages: DataFrame, rules=RULES, url_col: str = "url") -> DataFrame | None:
    """Every gram of the URLs, of all orders, with its count among accepted
    and rejected URLs and the total and number of different next characters of
    its context in both (0 where not seen); None if a class has no URL."""
    grams = pages.select(url_col).mapInArrow(_train(rules), "gram long, accepted long, rejected long").groupBy("gram").agg(
        F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    context = Window.partitionBy(F.expr("shiftright(gram, 8)"))          # at most 256 rows
    grams = store(grams.select("*", *(f(kind).over(context).alias(f"{name}_{kind}") for kind in ("accepted", "rejected") for name, f in (
        ("total", F.sum), ("kinds", lambda c: F.sum(F.when(F.col(c) > 0, 1).otherwise(0)))))), "url-grams")
    sizes = _order(grams, 0).agg(F.sum("accepted"), F.sum("rejected")).first()
    if not all(sizes):
        drop_tables(grams)
        return None
    return grams


def _order(grams: DataFrame, order: int) -> DataFrame:
    return grams.filter((F.col("gram") >= (order + 1) << 48) & (F.col("gram") < (order + 2) << 48))


def probabilities(grams: DataFrame) -> DataFrame:
    """gram, accepted, rejected: the interpolated probabilities of the grams
    of ``ORDER`` + 1 characters in both classes."""
    p = None
    for order in range(ORDER + 1):
        own = _order(grams, order)
        if p is None:
            own = own.withColumn("p_accepted", F.lit(1 / 256)).withColumn("p_rejected", F.lit(1 / 256))
        else:
            own = own.withColumn("shorter", F.col("gram").bitwiseAND(F.lit((1 << 8 * order) - 1)).bitwiseOR(F.lit(order << 48)))
            own = own.join(F.broadcast(p) if order <= 2 else p, "shorter", "left")
        p = own.select("gram", *(F.expr(f"CASE WHEN total_{k} > 0 THEN ({k} + kinds_{k} * p_{k}) / (total_{k} + kinds_{k}) ELSE p_{k} END").alias(k) for k in ("accepted", "rejected")))
        if order < ORDER:
            p = p.select(F.col("gram").alias("shorter"), F.col("accepted").alias("p_accepted"), F.col("rejected").alias("p_rejected"))
    return p


def _wanted(batches):
    """group and gram: the different longest grams of each group's URLs."""
    schema = pa.schema([("group", pa.int64()), ("gram", pa.int64())])
    for batch in batches:
        for lo in range(0, batch.num_rows, BATCH):
            rows = batch.slice(lo, BATCH)
            windows, off = _windows([_text(u) for u in rows.column(1).to_pylist()])
            group, at = np.unique(rows.column(0).to_numpy(), return_inverse=True)
            pairs = np.stack([np.repeat(at, np.diff(off)), _keys(windows, ORDER)[1]])
            pairs = pairs[:, np.lexsort(pairs[::-1])]
            pairs = pairs[:, np.concatenate([[True], (pairs[:, 1:] != pairs[:, :-1]).any(0)])]
            yield pa.RecordBatch.from_arrays([pa.array(group[pairs[0]]), pa.array(pairs[1])], schema=schema)


def scores(texts: list[bytes], gram: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Log-likelihood difference per character (0 for an empty text), from
    the sorted grams of the texts and their log ratios."""
    if not texts:
        return np.zeros(0)
    rows, off = _windows(texts)
    s = np.add.reduceat(ratio[np.searchsorted(gram, _keys(rows, ORDER)[1])], off[:-1]) / np.diff(off)
    return np.where(np.diff(off) > 1, s, 0.0)


_SCORED = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("decided", pa.string()), ("score", pa.float64()), ("held", pa.bool_())])
_SCORED_DDL = "page_id long, host string, path string, rule string, decided string, score double, held boolean"


def _decided(ids, urls, rules, score) -> pa.Table:
    """Rows of _SCORED; ``score`` gives the scores of the texts."""
    table = rule_table(rules)
    parts = [split(u) for u in urls]
    found = [decide(table, *p) for p in parts]
    texts = ["".join(p).encode() for p in parts]
    return pa.Table.from_arrays([ids, pa.array([p[0] for p in parts], pa.string()), pa.array([p[1] for p in parts], pa.string()), pa.array([r for r, _ in found], pa.string()),
                                 pa.array([v for _, v in found], pa.string()), pa.array(score(texts)), pa.array(_held(texts))], schema=_SCORED)


def _judge_group(rules):
    def run(pages: pa.Table, grams: pa.Table) -> pa.Table:
        gram = grams.column("gram").to_numpy()
        order = np.argsort(gram)
        ratio = (np.log(grams.column("accepted").to_numpy()) - np.log(grams.column("rejected").to_numpy()))[order]
        return _decided(pages.column("page_id"), pages.column("url").to_pylist(), rules, lambda texts: scores(texts, gram[order], ratio))
    return run


def _judge_plain(rules):
    def run(batches):
        for batch in batches:
            yield from _decided(batch.column(1), batch.column(2).to_pylist(), rules, lambda texts: np.zeros(len(texts))).to_batches()
    return run


def threshold(scored: DataFrame) -> float:
    """The cut from the held-out URLs that rules decide."""
    step = F.least(F.greatest(F.floor(F.col("score") * STEPS), F.lit(-SPAN * STEPS)), F.lit(SPAN * STEPS))
    steps = scored.filter("held AND decided IS NOT NULL").groupBy((F.col("decided") == "allow").alias("accepted"), step.alias("step")).agg(F.count("*").alias("n")).toPandas()
    good, bad = (np.zeros(2 * SPAN * STEPS + 1, np.int64) for _ in range(2))
    for kind, to in ((True, good), (False, bad)):
        own = steps[steps.accepted == kind]
        np.add.at(to, own.step.to_numpy(np.int64) + SPAN * STEPS, own.n.to_numpy(np.int64))
    if not good.any() or not bad.any():
        return 0.0
    below = lambda x: np.concatenate([[0], np.cumsum(x)]) / x.sum()
    rate = below(bad) - below(good)                # cut before step i
    best = np.flatnonzero(rate == rate.max())
    return float(best[len(best) // 2] - SPAN * STEPS) / STEPS


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict and score of every page."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"))
    groups = max(1, -(-rows.count() // GROUP))
    rows = rows.select(F.pmod(F.xxhash64("page_id", "url"), F.lit(groups)).alias("group"), "page_id", "url")
    grams, cut = fit(rows, rules), 0.0
    if grams is None:
        scored = rows.mapInArrow(_judge_plain(rules), _SCORED_DDL)
    else:
        wanted = rows.select("group", "url").mapInArrow(_wanted, "group long, gram long").distinct()
        found = wanted.join(probabilities(grams), "gram")
        scored = store(rows.groupBy("group").cogroup(found.groupBy("group")).applyInArrow(_judge_group(rules), _SCORED_DDL), "url-scores")
        drop_tables(grams)
        cut = threshold(scored)
    verdict = F.coalesce("decided", F.when(F.col("score") >= cut, "allow").otherwise("block"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
