"""The pipeline on a small table against each stage's brute-force version."""

import re
from collections import Counter, defaultdict

import __spark_entry__
import corpus_pipeline
from test_repeats import marked_bytes

from matchlore.llm import catalog


def test_stages_on_the_table(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    names, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / re.sub(r"\W", "-", name))
        stage(spark, kept[-1], data).write.parquet(out)
        kept.append(spark.read.parquet(out))
    assert all(k.columns == names for k in kept[1:-1])
    rows = [[(r["doc_id"], r["text"], r["lang"], r["source"]) for r in k.collect()] for k in kept[:-1]]
    raw, good, single, clean, mixed = rows
    assert 0 < len(good) < len(raw) and set(good) <= set(raw)
    assert 0 < len(single) <= len(good) and set(single) <= set(good)
    assert len({t for _, t, *_ in single}) == len(single)
    assert {r[0] for r in clean} == {r[0] for r in single}
    left = {r[0]: r[1] for r in clean}
    for r, (b, m) in zip(single, marked_bytes(single)):
        if not any(m):
            assert left[r[0]] == r[1]
        else:
            assert len(left[r[0]].encode()) >= len(b) - sum(m)
    texts = set(clean)
    assert mixed and all(r in texts for r in mixed)
    assert max(Counter(r[0] for r in mixed).values()) <= 2
    sequences = defaultdict(list)
    for r in kept[-1].collect():
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_registered():
    found = __spark_entry__.queries()
    assert set(catalog.QUERIES) | {"pipeline"} <= set(found)
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))


def test_run(spark, data):
    assert corpus_pipeline.run(spark, data).count() > 0
