"""Token counts, spelling variants and the Merkle manifest against brute force, on edge rows and small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tillcube.llm import manifest, queries, skew, spelling, token_counts
from tillcube.llm.files import new_folder

MODEL = f"{queries.TOKENIZERS}/piece_bpe_32k.model"
WORDS = f"{queries.TOKENIZERS}/word_bpe_49k.json"


# ------------------------------------------------------------- token counts
def library_count(text):
    import sentencepiece
    return len(sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(text or ""))


def test_token_counts_equal_the_library(spark, real_docs, edge_docs):
    odd = spark.createDataFrame([(20, "  two  spaces "), (21, "<s> </s> <unk> <0x41>"), (22, "é́ ▁ 　 x"), (23, "\x00\t\n")], "doc_id long, text string")
    docs = real_docs.select("doc_id", "text").union(edge_docs.select("doc_id", "text")).union(odd)
    cache = token_counts.CountCache(spark, new_folder(spark, "cache"))
    got = Counter(map(tuple, token_counts.count_tokens(docs, MODEL, cache).collect()))
    assert got == Counter((r.doc_id, len((r.text or "").encode()), library_count(r.text)) for r in docs.collect())


def test_token_counts_of_a_word_tokenizer(spark, edge_docs):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(WORDS)
    cache = token_counts.CountCache(spark, new_folder(spark, "cache"))
    got = sorted(tuple(r)[1:] for r in token_counts.count_tokens(edge_docs, WORDS, cache).collect())
    assert got == sorted((len((r.text or "").encode()), len(model.encode(r.text or "", add_special_tokens=False).ids)) for r in edge_docs.collect())


def test_only_distinct_misses_are_encoded(spark, monkeypatch):
    encoded = []
    plain = token_counts._encode

    def spy(texts, tokenizer):
        encoded.append(sorted(r.text for r in texts.collect()))
        return plain(texts, tokenizer)
    monkeypatch.setattr(token_counts, "_encode", spy)
    cache = token_counts.CountCache(spark, new_folder(spark, "cache"))
    rows = [(i, f"text {i % 3}") for i in range(60)] + [(None, None), (61, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    first = token_counts.count_tokens(docs, MODEL, cache)
    assert encoded == [["", "text 0", "text 1", "text 2"]] and first.count() == 62
    grown = docs.union(spark.createDataFrame([(70, "text 1"), (71, "new"), (72, "new")], docs.schema))
    assert token_counts.count_tokens(grown, MODEL, cache).count() == 65
    assert encoded[1:] == [["new"]]
    assert token_counts.count_tokens(docs, MODEL, cache).count() == 62 and len(encoded) == 2
    cache.append(cache.counts(token_counts.Tokenizer.read(MODEL).version()), token_counts.Tokenizer.read(MODEL).version())     # a retried append
    assert sorted(map(tuple, token_counts.count_tokens(docs, MODEL, cache).collect()), key=repr) == sorted(map(tuple, first.collect()), key=repr)
    token_counts.count_tokens(docs, WORDS, cache)               # another tokenizer has its own counts
    assert len(encoded) == 3 and len(encoded[2]) == 4


def test_token_counts_of_hot_contents_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr(skew, "COPIES", 3)
    docs = spark.createDataFrame([(i, "hot" if i % 2 else f"rare {i}") for i in range(40)], "doc_id long, text string")
    cache = token_counts.CountCache(spark, new_folder(spark, "cache"))
    got = {r.id: r.n_tokens for r in token_counts.count_tokens(docs, MODEL, cache).collect()}
    assert got == {i: library_count("hot" if i % 2 else f"rare {i}") for i in range(40)}
    assert token_counts.count_tokens(docs.limit(0), MODEL, cache).collect() == []


# ----------------------------------------------------------------- spelling
def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute_variants(rows, damage=199):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % damage == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= 5}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def variants_of(docs, **kw):
    return sorted(map(tuple, spelling.variants(docs, **kw).collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_spelling_variants(spark, monkeypatch, seed):
    """Few letters and dense edits; frequent grams of every length."""
    monkeypatch.setattr(spelling, "FREQUENT", (50, 5, 1)[seed])
    rng = random.Random(seed)
    letters = ("abÀé", "abcdefgh", "ab")[seed]
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 12))) for _ in range(120)]
    rows = []
    for i in range(400):
        ws = []
        for _ in range(30):
            w = rng.choice(base[:10] if rng.random() < 0.5 else base)
            if rng.random() < 0.4:
                k = rng.randrange(len(w) + 1)
                w = w[:k] + rng.choice(["", letters[0], letters[1]]) + w[k + rng.randint(0, 1):]
            ws.append(w.upper() if rng.random() < 0.1 and w.isascii() else w)
        rows.append((i % 350, rng.choice([" ", "-", "1"]).join(ws)))
    rows += [(None, "nobody nobody nobody nobody nobody"), (400, None), (401, ""), (402, "x" * 5000)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, word string")
    assert variants_of(docs) == brute_variants(rows)


def test_spelling_forms_of_forms(spark):
    counts = {"planets": 5, "planetes": 25, "planetese": 125, "unrelated": 9}
    rows = [(None, " ".join([w] * c)) for w, c in counts.items()]
    got = {r.word: (r.form, r.root, r.n_near, r.form_n) for r in spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"), damage=0).collect()}
    assert got == {"planets": ("planetes", "planetese", 1, 25), "planetes": ("planetese", "planetese", 2, 125), "planetese": (None, "planetese", 1, None),
                   "unrelated": (None, "unrelated", 0, None)}


def test_spelling_of_edge_rows(spark, edge_docs):
    assert variants_of(edge_docs) == brute_variants([(r.doc_id, r.text) for r in edge_docs.collect()])
    assert spelling.variants(edge_docs.limit(0)).collect() == []


def test_spelling_broadcasts_no_table(spark, monkeypatch):
    """However small Spark takes the words and their lists to be."""
    plans = []
    stored = spelling.store
    monkeypatch.setattr(spelling, "store", lambda df, name: plans.append((name, df._jdf.queryExecution().toString())) or stored(df, name))
    counts = {"planets": 5, "planetes": 25, "planetese": 125}
    docs = spark.createDataFrame([(1, " ".join([w] * c)) for w, c in counts.items()], "doc_id long, text string")
    assert spelling.variants(docs, damage=0).count() == 3
    assert [n for n, p in plans if "SortMergeJoin" in p] == ["near-words", "near-forms", "roots", "spelling"]
    assert not [n for n, p in plans if "Broadcast" in p]


def test_affected_grams_bound():
    """No edit changes more grams than the bound says, whatever grams are frequent."""
    rng = random.Random(7)
    for _ in range(3000):
        frequent = {"".join(rng.choice("ab") for _ in range(rng.randint(2, 4))): 9 for _ in range(rng.randint(0, 12))}
        word = "".join(rng.choice("ab") for _ in range(rng.randint(6, 10)))
        k = rng.randrange(len(word) + 1)
        other = word[:k] + rng.choice(["", "a", "b"]) + word[k + rng.randint(0, 1):]
        if not one_edit(word, other):
            continue
        ends, worst = spelling.decompose(word, frequent)
        theirs, _ = spelling.decompose(other, frequent)
        listed = [{k for i, j in enumerate(e) for k in (f"{i}<{w[:j]}", f"{j - i}>{w[i:]}")} for w, e in ((word, ends), (other, theirs))]
        assert len(ends) - worst >= 1 and len(listed[0] & listed[1]) >= len(ends) - worst


# ----------------------------------------------------------------- manifest
def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, fields):
    return H(*("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in fields))


def climb(nodes, paths):
    """Root of the nodes; every node's members get its siblings' digests."""
    members = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, owned = [], []
        for k in range(0, len(nodes), 8):
            run = nodes[k:k + 8]
            for s in range(len(run)):
                for m in members[k + s]:
                    paths[m].append(run[:s] + run[s + 1:])
            up.append(H(*run))
            owned.append(sum(members[k:k + 8], []))
        nodes, members = up, owned
    return nodes[0]


def brute_manifest(rows, fields=manifest.FIELDS):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, fields), r))
    out, subroots, all_paths = [], [], []
    for lang in sorted(groups, key=lambda g: (g is not None, (g or "").encode())):
        members = sorted(groups[lang], key=lambda x: x[:3])
        paths = [[] for _ in members]
        subroots.append(climb([m[2] for m in members], paths))
        all_paths.append((members, paths))
    top = [[] for _ in subroots]
    root = climb(list(subroots), top) if subroots else None
    for (members, paths), above, sub in zip(all_paths, top, subroots):
        for (_, _, h, r), p in zip(members, paths):
            i = r["doc_id"]
            bad = i is not None and zlib.crc32(str(i).encode()) % 3 == 0 and r["text"] is not None and r["text"] != re.sub("[A-Z]", lambda m: m[0].lower(), r["text"])
            out.append((i, h, sub, root, H(*(x for level in p + above for x in level)), not bad))
    return sorted(out, key=repr)


def manifest_of(docs):
    got = manifest.digests(docs, manifest.tampered_claim()).collect()
    assert all((r.folded_root == r.root) == r.verified for r in got)
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) for r in got), key=repr)


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, pos string, tree int, hash string")


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 9, None: 8, "de": 1, "é": 65}, {"": 7, "en": 73, "z": 2, **{f"l{i}": 1 for i in range(70)}}])
def test_manifest(spark, sizes):
    rng = random.Random(len(sizes))
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append((i if i % 11 else None, rng.choice([None, "", "src"]), lang, rng.choice([None, 7]), rng.choice([None, "", "Some TEXT é", f"lower {i}", "X" * 3000]), "clash", 1, "clash"))
    rows += rows[:3]                                    # repeated rows
    docs = documents(spark, rows).repartition(5)
    assert manifest_of(docs) == brute_manifest([r.asDict() for r in docs.collect()])


def test_manifest_of_blocks_and_no_rows(spark, monkeypatch, real_docs):
    monkeypatch.setattr(manifest, "BLOCK", 16)          # several windows a level
    assert manifest_of(real_docs) == brute_manifest([r.asDict() for r in real_docs.collect()])
    assert manifest_of(real_docs.limit(0)) == []


def test_manifest_can_be_kept_and_checked(spark, real_docs):
    made = manifest.build(real_docs)
    root = made.root().head()[0]
    kept = manifest.proofs(made).select("id", manifest.fold().alias("folded"))
    assert kept.filter(kept.folded != root).count() == 0
    again = manifest.build(real_docs.repartition(3)).root().head()[0]
    assert again == root
    made.drop()
