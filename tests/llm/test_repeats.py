"""Both substring operators against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from matchlore.llm import fmindex, repeats, suffixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def marked_bytes(all_rows, window=200):
    seen = Counter()
    for r in all_rows:
        b = (r[1] or "").encode()
        seen.update(b[i : i + window] for i in range(len(b) - window + 1))
    out = []
    for r in all_rows:
        b = (r[1] or "").encode()
        mark = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                mark[i : i + window] = b"\1" * window
        out.append((b, mark))
    return out


def byte_rows(all_rows):
    return sorted(
        (
            repr(r[0]), len(b), sum(m), len(re.findall(b"\1+", bytes(m))),
            hashlib.sha256(bytes(x for x, y in zip(b, m) if not y)).hexdigest(),
        )
        for r, (b, m) in zip(all_rows, marked_bytes(all_rows))
    )


def word_rows(all_rows, window=50):
    order = lambda i: float("inf") if i is None else i
    least = {}
    for r in all_rows:
        w = WORD.findall(r[1] or "")
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            least[key] = min(least.get(key, float("inf")), order(r[0]))
    out = []
    for r in all_rows:
        w = WORD.findall(r[1] or "")
        mark = [0] * len(w)
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < order(r[0]):
                mark[i : i + window] = [1] * window
        kept = " ".join(x for x, y in zip(w, mark) if not y)
        out.append((repr(r[0]), len(w), sum(mark), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_bytes(docs, rows):
    found = suffixes.byte_digests(docs).collect()
    assert sorted((repr(r[0]), *r[1:]) for r in found) == byte_rows(rows)


def test_words(docs, rows):
    found = fmindex.word_digests(docs).collect()
    assert sorted((repr(r[0]), *r[1:]) for r in found) == word_rows(rows)


def test_empty(none):
    assert suffixes.byte_digests(none).count() == 0
    assert fmindex.word_digests(none).count() == 0


@pytest.mark.parametrize("most", [0, 2])
def test_crowded_anchors_give_the_same(docs, most):
    texts = repeats.keyed(docs.select("doc_id", "text"))
    spans = lambda df: sorted((r[0], r[1], tuple(map(tuple, repeats.merged([tuple(s) for s in r[2]])))) for r in df.collect())
    assert spans(suffixes.repeated_spans(texts, most=most)) == spans(suffixes.repeated_spans(texts))
    assert spans(fmindex.repeated_spans(texts, most=most)) == spans(fmindex.repeated_spans(texts))


def test_cleaned_texts_keep_characters_whole(docs, rows):
    found = {(r["doc_id"], r["text"]) for r in suffixes.without_repeats(docs).select("doc_id", "text").collect()}
    for r, (b, m) in zip(rows, marked_bytes(rows)):
        if r[1] is None:
            assert (r[0], None) in found
            continue
        text, at = [], 0
        for c in r[1]:
            size = len(c.encode())
            text.append("" if all(m[at : at + size]) else c)
            at += size
        assert (r[0], "".join(text)) in found
    assert suffixes.without_repeats(docs).columns == docs.columns


def test_small_columns_against_brute_force():
    """Periodic and random segments with short windows."""
    drawn = random.Random(7)
    window, gram = 12, 5
    texts = [bytes(drawn.choice(b"ab") for _ in range(drawn.randint(0, 60))) for _ in range(40)] + [b"a" * 40, b"ab" * 20]
    data, bounds = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    found = repeats.anchors(data, bounds, window, gram)
    contents = [texts[t][f : f + n + window - 1] for t, f, n in zip(found["text"], found["first"], found["n"])]
    counts = Counter(found["anchor"].tolist())
    spans = suffixes.class_spans(contents, found["left"], np.ones(len(contents), int), window, gram)
    marks = [bytearray(len(t)) for t in texts]
    for t, f, a, ss in zip(found["text"], found["first"], found["anchor"], spans):
        assert counts[int(a)] > 1 or not ss
        for s in ss:
            marks[t][f + s["_from"] : f + s["_to"]] = b"\1" * (s["_to"] - s["_from"])
    expected = [m for _, m in marked_bytes([(i, t.decode()) for i, t in enumerate(texts)], window)]
    assert marks == expected


def test_long_sequences_in_stretches(monkeypatch):
    drawn = np.random.default_rng(3)
    data, bounds = drawn.integers(0, 3, 3000).astype(np.uint8), np.array([0, 700, 705, 3000])
    whole = repeats.anchors(data, bounds, 40, 10)
    monkeypatch.setattr(repeats, "_AT_ONCE", 300)
    parts = repeats.anchors(data, bounds, 40, 10)
    windows = lambda f: sorted(
        (int(t), int(a + k), int(h)) for t, a, n, h in zip(f["text"], f["first"], f["n"], f["anchor"].view(np.int64)) for k in range(n)
    )
    assert windows(whole) == windows(parts)


def test_suffix_order_and_counts():
    drawn = np.random.default_rng(1)
    text = drawn.integers(0, 4, 300)
    order = fmindex.suffix_array(text, 64)
    assert [text[i : i + 64].tolist() for i in order] == sorted(text[i : i + 64].tolist() for i in range(300))
    tree = fmindex.WaveletMatrix(text, 4)
    symbols, upto = drawn.integers(0, 4, 200), drawn.integers(0, 301, 200)
    assert tree.rank(symbols, upto).tolist() == [int((text[:u] == s).sum()) for s, u in zip(symbols, upto)]


def test_matches_of_the_index():
    drawn = np.random.default_rng(5)
    texts = [drawn.integers(1, 3, drawn.integers(0, 30)) for _ in range(40)]
    documents = drawn.integers(0, 9, 40)
    index = fmindex.FMIndex(texts, documents, max(map(len, texts)))
    window = 6
    least = {}
    for t, d in zip(texts, documents):
        for i in range(len(t) - window + 1):
            key = tuple(t[i : i + window])
            least[key] = min(least.get(key, 99), d)
    for t, d, found in zip(texts, documents, fmindex.matches(index, texts, documents, window)):
        mark, expected = np.zeros(len(t), int), np.zeros(len(t), int)
        for a, b in found:
            mark[a:b] = 1
        for i in range(len(t) - window + 1):
            if least[tuple(t[i : i + window])] < d:
                expected[i : i + window] = 1
        assert mark.tolist() == expected.tolist()


@pytest.mark.parametrize("size", [1, 2, 15, 16, 17, 31, 32, 33, 64, 300])
def test_range_minima(size):
    drawn = np.random.default_rng(size)
    values = drawn.integers(0, 1000, size)
    pairs = np.sort(drawn.integers(0, size + 1, (500, 2)), axis=1)
    low, high = pairs[pairs[:, 0] < pairs[:, 1]].T
    got = fmindex.RangeMinima(values).least(low, high)
    assert got.tolist() == [int(values[a:b].min()) for a, b in zip(low, high)]
