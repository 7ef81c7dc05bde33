"""The vectorised kernels against plain Python."""

import random
import re

import numpy as np
import pytest

from tillcube.llm import fmindex, suffix_dedup, text, warc

SPACED, ALNUM = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@pytest.mark.parametrize("cls,pattern,lower", [(text.spaced, SPACED, False), (text.spaced, SPACED, True), (text.alnum, ALNUM, True)])
def test_words(cls, pattern, lower):
    rng = random.Random(1)
    for _ in range(400):
        docs = ["".join(rng.choice("aB \n\tzé9-_\x0b\x1f漢Q") for _ in range(rng.randint(0, 25))) for _ in range(4)]
        raw = [d.encode() for d in docs]
        w = text.tokenise(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in raw])]), cls, lower)
        for i, d in enumerate(docs):
            d = re.sub("[A-Z]", lambda m: m[0].lower(), d) if lower else d
            got = [w.data[a:b].tobytes().decode() for a, b in zip(w.start[w.off[i]:w.off[i + 1]], w.end[w.off[i]:w.off[i + 1]])]
            assert got == re.findall(pattern, d)


def test_word_hash_tells_words_apart():
    words = [b"a" * k for k in range(1, 1200, 7)] + [b"b" * 600, b"a" * 599 + b"b"]
    data = np.frombuffer(b" ".join(words), np.uint8)
    assert len(set(text.tokenise(data, np.array([0, len(data)])).hash.tolist())) == len(words)


def _suffixes(s):
    def key(i):
        out = []
        for j in range(i, len(s)):
            if s[j] == 0:
                return [*out, (0, j)]
            out.append((1, int(s[j])))
        return out
    return sorted(range(len(s)), key=key)


def test_suffix_arrays_and_prefixes():
    rng = random.Random(2)
    for _ in range(300):
        sym = []
        for _ in range(rng.randint(1, 5)):
            sym += [rng.randint(1, rng.randint(1, 3)) for _ in range(rng.randint(1, 25))] + [0]
        sym = np.array(sym, np.uint8)
        want = _suffixes(sym)
        assert fmindex.suffix_array(sym.astype(np.int64))[0].tolist() == want
        sa = suffix_dedup.induced_suffix_array(sym)
        assert sa.tolist() == want
        left = np.array([next(k for k in range(len(sym)) if sym[i + k] == 0) for i in range(len(sym))], np.int32)
        lcp, phi = suffix_dedup.permuted_lcp(sym, sa, left)
        for a, b in zip(want[1:], want):
            n = 0
            while sym[a + n] == sym[b + n] and sym[a + n]:
                n += 1
            assert (lcp[a], phi[a]) == (n, b)


def test_fm_index_counts_and_locates():
    rng = random.Random(3)
    for _ in range(100):
        s = np.array([rng.randint(0, 4) for _ in range(rng.randint(1, 70))] + [0], np.int64)
        fm = fmindex.FMIndex(s, 5, sample=4)
        pats = np.array([[rng.randint(1, 4) for _ in range(2)] for _ in range(6)])
        lo, hi = fm.search(pats, np.full(6, 2))
        for p, a, b in zip(pats, lo, hi):
            assert sorted(fm.locate(np.arange(a, b)).tolist() if b > a else []) == [i for i in range(len(s) - 1) if (s[i:i + 2] == p).all()]


def test_warc_reader_refuses_damage():
    import io

    import zstandard
    good = warc.record(5, "http://a", "response", b"HTTP/1.1 200 OK\r\n\r\nbody", warc.digest(b"body"))
    pack = lambda data: warc.dictionary_frame(b"") + zstandard.ZstdCompressor().compress(data)
    headers, block = next(iter(warc.read_archive(io.BytesIO(pack(good)))))
    assert headers["warc-type"] == "response" and block.endswith(b"body")
    for bad in (good[:-1], good.replace(b"Content-Length: ", b"Content-Length: 1"), good.replace(b"body", b"bodY"), good.replace(b"WARC/1.1", b"XARC/1.1")):
        with pytest.raises(ValueError):
            list(warc.read_archive(io.BytesIO(pack(bad))))
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(pack(good)[8:])))
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(pack(good)[:-3])))
