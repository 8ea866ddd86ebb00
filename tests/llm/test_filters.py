import re
from collections import defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
from conftest import prose

from matchlore.llm import filters, kernels

LABELS = "doc_id long, quality int, toxic int"


def failed(rows, text, i):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    marks = "A" if len(words) < 200 else ""
    marks += "B" if 100 * len(set(words)) < 50 * len(words) else ""
    marks += "C" if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else ""
    marks += "D" if re.search(r"[#$%&*|]", text) else ""
    copies = [j for j, t, *_ in rows if (t or "") == text and j is not None and i is not None and j < i]
    return marks + ("E" if copies else "")


def brute(rows, labels):
    """rows: (doc_id, text, lang)."""
    parts = defaultdict(list)
    for i, text, lang in rows:
        said = [(q, t) for j, q, t in labels if j == i and i is not None]
        parts[lang or ""].append((failed(rows, text, i), any(q == 1 for q, _ in said), any(t == 1 for _, t in said)))
    found = []
    for part, judged in parts.items():
        removed = defaultdict(int)
        for order in permutations("ABCDE"):
            for step, f in enumerate(order):
                removed[f] += sum(f in m and not set(m) & set(order[:step]) for m, *_ in judged)
        for order in permutations("ABCDE"):
            for step, f in enumerate(order):
                before = set(order[:step])
                here = [d for d in judged if f in d[0] and not set(d[0]) & before]
                found.append((
                    part, "".join(order), step + 1, sum(not set(m) & (before | {f}) for m, *_ in judged), len(here),
                    sum(f in m and bool(set(m) & before) for m, *_ in judged), sum(m == f for m, *_ in judged),
                    sum(g for _, g, _ in here), sum(t for _, _, t in here), removed[f],
                ))
    return sorted(found)


def columns(df):
    order = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert sorted(df.columns) == sorted(order)
    return sorted(tuple(r[c] for c in order) for r in df.collect())


def test_against_brute_force(spark, docs, rows):
    extra = [(100, prose(50, 260).lower(), "en"), (101, prose(50, 260).lower(), "xx"), (102, "ab " * 300, None), (103, prose(51, 250) + "#", ""),
             (101, prose(50, 260).lower(), "en"), (99, prose(50, 260).lower(), "en")]
    more = spark.createDataFrame(extra, "doc_id long, text string, lang string")
    every = [(r[0], r[1], r[2]) for r in rows] + extra
    said = [(1, 1, 0), (3, 0, 1), (3, 1, None), (12, 1, 1), (101, 1, 0), (None, 1, 1), (999, 1, 1), (17, None, None), (100, 1, 1)]
    labels = spark.createDataFrame(said, LABELS)
    table = docs.select("doc_id", "text", "lang", "n_words", "fp").unionByName(more, allowMissingColumns=True)
    assert columns(filters.interactions(table.repartition(3), labels)) == brute(every, said)


def test_empty(spark, none):
    assert filters.interactions(none, spark.createDataFrame([], LABELS)).count() == 0


def test_counts_of_one_pass():
    texts = ["", "a", " a  a\tA\x0bb\x85c d ", "ÄÖ é ß#", "x" * 70 + " " + "x" * 70 + " " + "x" * 69 + "y", "\n", "aa a aaa aa a", "AB|CD" * 3000]
    data, offsets = kernels.utf8(pa.array(texts))
    got = filters.count_piece(data, offsets, b"#$%&*|").tolist()
    for text, counts in zip(texts, got):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        assert counts == [len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))]


def test_equal_hashes_are_verified(monkeypatch):
    """With a hash that says nothing the words behind it decide."""
    class Flat:
        def __init__(self, data):
            pass

        def __call__(self, starts, ends):
            return np.zeros(len(starts), np.uint64)

    monkeypatch.setattr(kernels, "RunHashes", Flat)
    texts = ["one two one three", "one " + "w" * 80 + " " + "w" * 79 + "x two", "abcdefghi abcdefghj abcdefghi"]
    data, offsets = kernels.utf8(pa.array(texts))
    assert filters.count_piece(data, offsets, b"#")[:, 1].tolist() == [3, 4, 2]
