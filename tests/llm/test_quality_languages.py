import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from matchlore.llm import languages, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_base_counts(docs, rows):
    found = quality.quality_verdicts(docs).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert sorted((repr(r["doc_id"]), *[r[c] for c in names]) for r in found) == sorted((repr(r[0]), *base(r[1])) for r in rows)
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_lines(spark):
    texts = ["a\na\n\n \na b\na b\n", "\n\n", "x\ny", "x\nx", "#*$%&|<> é##"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").select("doc_id", quality.base_counts().alias("c"))
    for r in frame.collect():
        assert tuple(r["c"][c] for c in quality.COUNTS[:5]) == base(texts[r["doc_id"]])


def drawn_docs(spark, groups=3, each=300, junk=20):
    drawn, rows = random.Random(1), []
    for g in range(groups):
        for i in range(each):
            words = ["".join(drawn.choices("abcdefgh", k=drawn.randint(3, 7 + g))) for _ in range(drawn.randint(60, 120))]
            if i < junk:
                words = [w + "###" for w in words]
            rows.append((len(rows), " ".join(words), "en" if g else None, f"s{g}"))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string"), each, junk


def test_verdicts_keep_the_clean(spark):
    frame, each, junk = drawn_docs(spark)
    found = {r["doc_id"]: r["kept"] for r in quality.quality_verdicts(frame).collect()}
    assert all(kept == (i % each >= junk) for i, kept in found.items())
    assert {r["doc_id"] for r in quality.quality_filter(frame).collect()} == {i for i, kept in found.items() if kept}
    assert quality.quality_filter(frame).columns == frame.columns


def test_sketch_quantiles(spark):
    frame, each, _ = drawn_docs(spark, groups=1)
    counted = frame.select("lang", "source", quality.base_counts().alias("_counts"))
    found = {r["ratio"]: r for r in quality._quartiles(quality.sketches(counted), ["lang", "source"], 0.01).collect()}
    lengths = sorted(r[0] for r in counted.select(F.col("_counts.word_chars") / F.col("_counts.n_words")).collect())
    for q, name in ((0.25, "q1"), (0.75, "q3")):
        exact = lengths[int(np.ceil(q * each)) - 1]
        assert abs(found["word_length"][name] - exact) <= 0.011 * exact


def test_sketches_merge(spark):
    frame, _, _ = drawn_docs(spark, groups=1)
    counted = frame.select("doc_id", "lang", "source", quality.base_counts().alias("_counts"))
    halves = quality.sketches(counted.where("doc_id % 2 = 0")).union(quality.sketches(counted.where("doc_id % 2 = 1")))
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(quality.fences(halves)) == rows(quality.fences(quality.sketches(counted)))


def test_empty(none):
    assert quality.quality_verdicts(none).count() == 0
    assert quality.quality_filter(none).count() == 0
    assert languages.identified(none).count() == 0


def test_codewords_differ():
    for n in (2, 4, 7, 8, 20):
        code = languages.codewords(n)
        assert len(np.unique(code, axis=0)) == n
        assert (abs(code.sum(axis=0)) < n).all()


def test_languages(docs, rows):
    found = languages.identified(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        assert 0 <= r["score"] <= 1
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert [by_id[i]["lang_pred"] for i in (6, 7, 8)] == ["und"] * 3
    assert all(by_id[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in by_id)


def test_held_out_accuracy(spark, data):
    frame = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang")
    found = languages.identified(frame).join(frame, "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) >= 0.95


def test_a_text_is_judged_by_itself(spark, data):
    frame = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang")
    model = languages.fit(frame)
    texts = [r["text"] for r in frame.limit(20).collect()]
    assert model.predict(texts) == [model.predict([t])[0] for t in texts]


def test_many_languages(spark):
    drawn, rows = random.Random(3), []
    for k in range(9):
        letters = [chr(ord("a") + (k * 3 + j) % 26) for j in range(5)]
        rows += [(len(rows) + j, " ".join("".join(drawn.choices(letters, k=5)) for _ in range(30)), f"l{k}") for j in range(30)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = languages.identified(frame).join(frame, "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.9
    alone = languages.identified(frame.where("lang = 'l3'")).collect()
    assert {r["lang_pred"] for r in alone} == {"l3"}
