"""Language identification against plain counts: n-grams, class means and losses worked out one by one."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from matchlore.llm import languages

SMOOTHING = 0.5


def grams(text):
    """How often each bucket of hashed byte n-grams occurs; n-grams that begin with two blanks do not count."""
    data = b"    " + bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in text.lower().encode()) + b"    "
    found = Counter()
    for i in range(len(data) - 4):
        if data[i : i + 2] == b"  ":
            continue
        for place, k in enumerate((2, 3, 4)):
            code = int.from_bytes(data[i : i + k], "little")
            found[place * 4096 + (code * (0x9E3779B1 + 2 * place) % 2**32 >> 20)] += 1
    return found


def brute(rows):
    """rows: (doc_id, text, lang). The prediction, its score and all margins of losses by doc_id."""
    learned = [(grams(t), lang) for i, t, lang in rows if i is not None and t is not None and lang is not None and zlib.crc32(str(i).encode()) % 5]
    names = sorted({lang for _, lang in learned})
    totals = {n: Counter() for n in names}
    for g, lang in learned:
        totals[lang].update(g)
    sums = {n: sum(totals[n].values()) for n in names}
    smooth = SMOOTHING / max(sums.values())
    code = languages.codewords(len(names))
    seen = set().union(*totals.values())

    def odds(signs, bucket):
        share = [[totals[n][bucket] / sums[n] for n, s in zip(names, signs) if s == sign] for sign in (1, -1)]
        high, low = (sum(s) / len(s) + smooth for s in share)
        return math.log(high) - math.log(low)

    known = [{b: odds(signs, b) for b in seen} for signs in code.T]

    def margins(g):
        return [sum(n * w.get(b, 0.0) for b, n in g.items()) / max(1, sum(g.values())) for w in known]

    own = defaultdict(list)
    for g, lang in learned:
        own[lang].append(margins(g))
    bits = range(code.shape[1])
    means = {n: [sum(m[b] for m in own[n]) / len(own[n]) for b in bits] for n in names}
    centre, scale = [], []
    for b in bits:
        high = [means[n][b] for n, s in zip(names, code[:, b]) if s > 0]
        low = [means[n][b] for n, s in zip(names, code[:, b]) if s < 0]
        centre.append((min(high) + max(low)) / 2)
        scale.append(max(1e-6, (sum(high) / len(high) - sum(low) / len(low)) / 4))
    trust = {}
    for k, n in enumerate(names):
        right = [sum((m[b] - centre[b]) * code[k, b] > 0 for m in own[n]) / len(own[n]) + 1e-3 for b in bits]
        trust[n] = [r / sum(right) for r in right]
    out = {}
    for i, text, _ in rows:
        if not any(map(str.isalpha, text or "")):
            out[i] = ("und", 0.0)
            continue
        m = margins(grams(text))
        fit = [min(8, max(-8, (m[b] - centre[b]) / scale[b])) for b in bits]
        loss = sorted((sum(trust[n][b] * math.exp(-code[k, b] * fit[b]) for b in bits), n) for k, n in enumerate(names))
        (first, name), (second, _) = loss[:2]
        out[i] = (name, (1 + (second - first) / (second + first)) / 2)
    return out


def test_against_plain_counts(spark, data):
    """On few documents, all of which are within the sample, every prediction and score is the plain one."""
    extra = spark.createDataFrame([(10**6, "", "en"), (10**6 + 1, None, "de"), (10**6 + 2, "12 34 !", None), (10**6 + 3, "x", None)], "doc_id bigint, text string, lang string")
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang").union(extra)
    rows = [tuple(r) for r in docs.collect()]
    plain = brute(rows)
    found = languages.identified(docs.repartition(3)).collect()
    assert len(found) == len(plain)
    for r in found:
        name, score = plain[r["doc_id"]]
        assert abs(r["score"] - score) < 1e-3, r
        assert r["lang_pred"] == name or abs(score - 0.5) < 1e-3


def test_histograms_against_plain_counts():
    texts = ["", "a", "Ab  c", "über Straße 42", "a" * 50, "ʼn ⅷ x\ty\nz", " lead and trail "]
    got = languages.histograms(texts)
    for row, text in zip(got, texts):
        assert {int(b): int(row[b]) for b in np.flatnonzero(row)} == dict(grams(text))


def test_learning_ignores_held_out(spark, data):
    """Wrong languages on held-out documents change no prediction."""
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang")
    wrong = docs.withColumn("lang", F.when(languages.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert sorted(map(tuple, languages.identified(docs).collect())) == sorted(map(tuple, languages.identified(wrong).collect()))
