"""Archives with many copies and ties; token files read at random."""

from collections import Counter

import numpy as np
import pytest

from tillcube.llm import queries, token_files, warc
from tillcube.llm.files import open_folder

WORDS = f"{queries.TOKENIZERS}/word_bpe_49k.json"


def archived(pages, **kw):
    got = warc.read_archives(*warc.write_archives(pages, **kw)).collect()
    return Counter((r.page_id, r.url, r.payload_bytes, r.record_type, r.refers_to, r.payload) for r in got)


def test_one_response_a_payload_whatever_the_ties(spark):
    rows = [(5, "u5", "same"), (3, "u3", "same"), (3, "u3", "same"), (3, "u2", "same"), (3, None, "same"), (None, "x", "same"), (None, None, None), (None, None, None),
            (8, "e", ""), (9, "one", "alone é")]
    schema = "page_id long, url string, html string"
    want = Counter([(3, "", 4, "response", None, "same"), (3, "u2", 4, "revisit", 3, None), (3, "u3", 4, "revisit", 3, None), (3, "u3", 4, "revisit", 3, None),
                    (5, "u5", 4, "revisit", 3, None), (None, "x", 4, "revisit", 3, None), (8, "e", 0, "response", None, ""),
                    (None, "", 0, "revisit", 8, None), (None, "", 0, "revisit", 8, None), (9, "one", 8, "response", None, "alone é")])
    for order in (rows, rows[::-1]):
        assert archived(spark.createDataFrame(order, schema).repartition(3)) == want
    few = archived(spark.createDataFrame(rows, schema), min_bytes=5)
    assert all(kind == "response" for _, _, _, kind, _, _ in few) and sum(few.values()) == len(rows)


def test_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(warc, "COPIES", 7)
    pages = spark.createDataFrame([(1, "u", "page")] * 50 + [(2, "v", "page")], "page_id long, url string, html string")
    assert archived(pages) == Counter({(1, "u", 4, "response", None, "page"): 1, (1, "u", 4, "revisit", 1, None): 49, (2, "v", 4, "revisit", 1, None): 1})


# ------------------------------------------------------------- token files
@pytest.fixture(scope="module")
def written(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 50, rng.integers(0, 400)))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder, manifest = token_files.write_files(docs, WORDS, length=16, rows_per_file=70)
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(WORDS)
    ids = [[*model.encode(t, add_special_tokens=False).ids, 2] for _, t in rows]
    return folder, manifest.orderBy("base").collect(), manifest, ids


def test_any_sequence_is_read_by_one_seek(written):
    folder, files, _, ids = written
    flat = [x for d in ids for x in d]
    for f in files:
        own = flat[f.base:f.base + f.n_tokens]
        n = -(-len(own) // 16)
        with token_files.Sequences(folder, f.name) as s:
            assert len(s.places) == -(-n // token_files.ROWS) and len(s.places) > 1
            for i in (n - 1, 0, n // 2, 257, 1):
                got, mask = s[i]
                part = own[16 * i:16 * i + 16]
                assert got[mask].tolist() == part and mask.sum() == len(part)
            for bad in (-1, n, n + 10_000):
                with pytest.raises(IndexError):
                    s[bad]
    store, root = open_folder(folder)
    assert store.type_name == "local"


def test_sequences_by_number(spark, written):
    folder, files, manifest, ids = written
    flat = [x for d in ids for x in d]
    want, first = {}, 0
    for f in files:
        own = flat[f.base:f.base + f.n_tokens]
        for k in range(-(-len(own) // 16)):
            want[first + k] = own[16 * k:16 * k + 16]
        first += -(-len(own) // 16)
    numbers = [0, 5, 5, first - 1, first, 300, 299, -1, None]
    wanted = spark.createDataFrame([(n,) for n in numbers], "sequence long")
    got = {r.sequence: [x for x, m in zip(r.ids, r.mask) if m] for r in token_files.read_sequences(folder, manifest, wanted, 16).collect()}
    assert got == {n: want[n] for n in {0, 5, first - 1, 300, 299}}
    assert token_files.read_sequences(folder, manifest, wanted.limit(0), 16).count() == 0


def test_encoder_equals_the_library_on_odd_words():
    import random
    from tokenizers import Tokenizer
    with open(WORDS) as f:
        text = f.read()
    encoder, model, rng = token_files._Encoder(text, "<u2"), Tokenizer.from_str(text), random.Random(1)
    assert encoder.fast
    letters = "abcXYZéÀÜßñ.,'’0189 -\t\n<|>µªº×÷İſKåΣςﬁ̱́  ÿŸ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    texts += ["<|EndOfText|> <|endoftext|>.", "H̱ J̌", "Word,word. Word.. ,a a,", ""]
    got = encoder([t.encode() for t in texts], b"")
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [model.encode(t, add_special_tokens=False).ids for t in texts]


def test_marks_after_letters_are_looked_up_apart():
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer
    from tillcube.llm import token_files
    with open(public_tokenizers.path("word_bpe_49k.json")) as f:
        model = f.read()
    library, encoder, asked = Tokenizer.from_str(model), token_files._Encoder(model, "<u2"), []
    encode = encoder._library
    encoder._library = lambda parts: asked.extend(parts) or encode(parts)
    marks = ["###", "$$$", "%%%", "&&&", "***", ",###", ".", "!?", ")", "'", "_", "<|", "|>", "<|endoftext|>", "~" * 9, "'s", "́"]
    words = [w + m for w in ("Word", "üöß", "ÉTÉ", "zzxqj", "naïve") for m in marks] + ["###", "3###", "a#b#"]
    got = encoder([" ".join(words).encode(), *[w.encode() for w in words]], b"\2\0")
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids + [2] for t in (" ".join(words), *words)]
    assert "###" in asked and not {"Word###", "üöß$$$", "zzxqj,###"} & set(asked)
