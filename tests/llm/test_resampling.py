import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from matchlore.llm import resampling


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def grams(text, longest):
    words = words_of(text)
    return [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, longest=1, buckets=10_000, min_words=20, share=10):
    def bucket(gram):
        return zlib.crc32(gram.encode()) % buckets

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, grams(text, longest)))
    for text in target:
        t.update(map(bucket, grams(text, longest)))
    total, aim = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (total + buckets) / ((s[b] + 1) * (aim + buckets)))) for b in s}
    found = []
    for i, text in rows:
        features = grams(text, longest)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(g)] for g in features)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append((i, len(features), weight, score, len(words_of(text)) >= min_words))
    able = sorted((f for f in found if f[4]), key=lambda f: (-f[3], f[0] is None, f[0] or 0))
    ranks = {}
    for r, f in enumerate(able[: 10 * len(able) // 100 if share == 10 else share * len(able) // 100]):
        ranks.setdefault(f, []).append(r + 1)
    return sorted((f[:4] + (ranks[f].pop(0) if ranks.get(f) else None,) for f in found), key=str)


@pytest.mark.parametrize("longest", [1, 3])
def test_against_brute_force(spark, docs, rows, longest):
    target = [rows[3][1], rows[12][1][:4000], None, ""]
    table = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resampled(docs.repartition(3), table, longest=longest, share=40)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in got.dtypes} == {"bigint"}
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([r[:2] for r in rows], target, longest, share=40)


def test_features_over_texts():
    texts = pa.array(["One two-One", "", "Été\x00x9 ", "a"])
    row, crcs, n_words = resampling.features(texts, 2)
    expected = [(i, zlib.crc32(g.encode())) for i, t in enumerate(texts.to_pylist()) for g in grams(t, 2)]
    assert sorted(zip(row.tolist(), crcs.tolist())) == sorted(expected)
    assert n_words.tolist() == [3, 0, 2, 1]


def test_ties_and_hot_scores(spark):
    scored = spark.range(400).selectExpr("if(id % 3 = 0, null, id) AS doc_id", "if(id % 2 = 0, 7L, id % 5) AS score", "id % 10 <> 9 AS eligible")
    got = [tuple(r) for r in resampling.ranked(scored, 50).collect()]
    assert len(got) == 400
    drawn = sorted((r for r in got if r[3]), key=lambda r: r[3])
    assert [r[3] for r in drawn] == list(range(1, 181)) and all(r[2] for r in drawn)
    keys = [(-r[1], r[0] is None, r[0] or 0) for r in drawn]
    assert keys == sorted(keys)
    rest = [(-r[1], r[0] is None, r[0] or 0) for r in got if r[2] and not r[3]]
    assert max(keys) <= min(rest)


def test_empty(spark, docs, none):
    nothing = spark.createDataFrame([], "text string")
    assert resampling.resampled(none, nothing).count() == 0
    assert resampling.resampled(docs, nothing).count() == docs.count()
    long = spark.createDataFrame([(1, "ab " * 400_000), (2, "é" * 1_000_000)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in resampling.resampled(long, nothing, share=100).collect()}
    assert found[1]["n_features"] == 400_000 and found[1]["rank"] == 1
    assert found[2]["n_features"] == 1 and found[2]["rank"] is None
