"""Near-dedup: repeated ids, clashing columns, large groups of near copies; recall against all pairs."""

import random

from tillcube.llm import near_dedup
from test_operators import brute_groups


def groups_of(docs, size=2):
    return sorted(map(tuple, near_dedup.groups(docs, size).collect()), key=repr)


def test_repeated_ids_are_linked_by_each_text(spark):
    a = " ".join(f"a{i}" for i in range(60))
    b = " ".join(f"b{i}" for i in range(60))
    rows = [(1, a), (1, b), (2, b + " more"), (3, a + " more"), (4, "else " * 9)]
    want = [(1, 59, 1, True), (1, 59, 1, True), (2, 60, 1, False), (3, 60, 1, False), (4, 1, 4, True)]
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        assert groups_of(spark.createDataFrame(order, "doc_id long, text string").repartition(3)) == want


def test_clashing_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a b c", "mine", 7), (2, "a b c", "yours", 8), (3, None, None, 9)], "doc_id long, text string, node string, node0 int")
    got = near_dedup.drop_near_duplicates(docs, 2)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == [(1, "a b c", "mine", 7), (3, None, None, 9)]


def near_copies(seed, n, words, most):
    """Copies of one text with up to ``most`` changed words: similarities all around 0.8."""
    rng = random.Random(seed)
    base = [f"{rng.choice('abcdefgh')}{i}" for i in range(words)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, most)):
            w[rng.randrange(words)] = rng.choice(base) if rng.random() < 0.5 else f"z{rng.randrange(500)}"
        rows.append((i, " ".join(w)))
    return rows


def test_groups_of_near_copies_equal_all_pairs(spark):
    """No link between groups is lost: components equal those of all pairs."""
    for seed in range(2):
        rows = near_copies(seed, 300, 100, 22)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.groups(docs, 2).collect()}
        want = brute_groups(rows, 2, 80)
        assert got == want and len({c for _, c, _ in want.values()}) > 20


def test_rare_pairs_hold_every_link(spark):
    """The exact join alone, without any hub: every link between groups is a candidate."""
    rows = near_copies(5, 120, 60, 12)
    sets = {i: set(zip(t.split(), t.split()[1:])) for i, t in rows}
    links = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    number = {s: k for k, s in enumerate(sorted(set().union(*sets.values())))}
    held = spark.createDataFrame([(i, [number[x] for x in s]) for i, s in sets.items()], "sid long, set array<long>")
    members = spark.createDataFrame([(i, i, len(s), i) for i, s in sets.items()], "sid long, rep long, n long, comp long")
    got = {(r.a, r.b) for r in near_dedup._rare_pairs(members, held, 80).collect()}
    assert links and links <= got and len(got) < 120 * 119 // 2


def test_stages_keep_clashing_columns(spark, sf_dir):
    """Columns named like an operator's own results pass the stages as they are."""
    import corpus_pipeline
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(40)), 777, "mine", "node", 5) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words long, items string, node string, n_hit int")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        got = stage(spark, docs, sf_dir)
        assert got.columns == docs.columns, name
        assert sorted(map(tuple, got.collect())) == rows, name
