import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from matchlore.llm import mixing, packing


def filled(sizes, share=1.5, epochs=2.0, weights=(5.0, 2.0, 1.0)):
    """Water-filling by clamping again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level >= epochs * sizes[s]}
        if not over:
            target |= {s: weight[s] * level for s in open_}
            break
        for s in over:
            target[s] = epochs * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_targets(spark):
    drawn = random.Random(2)
    for n in (1, 2, 3, 8, 30):
        sizes = {f"s{i}": drawn.choice([0, 1, 10, 1000, drawn.randint(1, 10**6)]) for i in range(n - 1)} | {None: 50}
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        found = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
        assert found == pytest.approx(filled(sizes))


def test_taken_words(docs, rows):
    found = mixing.mixed_sizes(docs).collect()
    again = mixing.mixed_sizes(docs).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((repr(r["doc_id"]), r["size"]) for r in found) == sorted((repr(r[0]), size(r[1])) for r in rows)
    sums = defaultdict(int)
    for r in rows:
        sums[r[3]] += size(r[1])
    target = filled(dict(sums))
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in found)
    # sources are told apart by their sizes here
    assert len(set(sums.values())) == len(sums)
    for s, total in sums.items():
        mine = [r for r in found if r["source_size"] == total]
        assert mine[0]["target"] == pytest.approx(target[s])
        assert abs(sum(r["taken"] for r in mine) - target[s]) <= 1


def test_mixed_documents_stay_whole(docs, rows, none):
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    texts = {r[1] for r in rows}
    found = mixed.collect()
    assert found and all(r["text"] in texts for r in found)
    times = defaultdict(int)
    for r in found:
        times[r["doc_id"], r["text"], r["source"]] += 1
    copies = defaultdict(int)
    for r in rows:
        copies[r[0], r[1], r[3]] += 1
    assert all(n <= 2 * copies[k] for k, n in times.items())
    assert mixing.mixed_documents(none).count() == 0
    assert mixing.mixed_sizes(none).count() == 0


def placed_one_by_one(lengths, capacity):
    """Best-fit decreasing with one piece at a time."""
    bins = []
    for size in sorted(lengths, reverse=True):
        fits = [b for b in bins if b[0] >= size]
        if fits:
            tightest = min(fits, key=lambda b: b[0])
            tightest[0] -= size
        else:
            bins.append([capacity - size])
    return sorted(b[0] for b in bins)


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit_decreasing(seed):
    drawn = random.Random(seed)
    capacity = drawn.choice([5, 16, 100])
    lengths = [drawn.randint(1, capacity) for _ in range(drawn.choice([0, 1, 7, 300]))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    used, ranks = defaultdict(list), defaultdict(list)
    for size, rank, pieces, each, first, start in packing.plan(counts, capacity):
        for i in range(pieces):
            used[first + i // each].append((start + i % each * size, size))
            ranks[size].append(rank + i)
    for size, n in counts.items():
        assert sorted(ranks[size]) == list(range(n))
    rooms = []
    for pieces in used.values():
        at = 0
        for start, size in sorted(pieces):
            assert start == at
            at += size
        rooms.append(capacity - at)
    assert sorted(rooms) == placed_one_by_one(lengths, capacity)


@pytest.mark.parametrize("block", [3, 100_000])
def test_packed_documents(docs, rows, block):
    tokenizer, capacity = Tokenizer.from_file(packing.VOCABULARY), 128
    pieces = packing.stored(packing.tokenised(docs, capacity), "pieces")
    found = packing.packed(pieces, capacity, block).collect()
    expected = []
    for r in rows:
        ids = np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")
        first = len(ids) % capacity or capacity
        bounds = [0, *range(first, len(ids) + 1, capacity)]
        expected += [(repr(r[0]), n, a, b - a, zlib.crc32(ids[a:b].tobytes())) for n, (a, b) in enumerate(zip(bounds, bounds[1:]))]
    assert sorted((repr(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == sorted(expected)
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_ranks_give_the_ids_of_the_tokenizer(rows):
    tokenizer, encode = Tokenizer.from_file(packing.VOCABULARY), packing.Encoder(packing.VOCABULARY)
    drawn = random.Random(4)
    odd = ["".join(drawn.choice(" \n\t\u00a0ab1.é'<|s\u2028\x1c") for _ in range(40)) for _ in range(300)]
    for text in [*odd, *(r[1] or "" for r in rows), "nul\0 and blank", "<|endoftext|> a <|endoftext|>"]:
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_nothing_to_pack(none):
    assert packing.packed_documents(none).count() == 0


@pytest.mark.parametrize("unit", [" ", "\n", "\t", " \n", "x", " ", "1"])
def test_very_long_runs_are_encoded_whole(unit):
    tokenizer, encode = Tokenizer.from_file(packing.VOCABULARY), packing.encoder(packing.VOCABULARY)
    text = "a" + unit * (2_000_000 // len(unit.encode())) + "b"
    ids = np.frombuffer(encode(text), "<u4").tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_long_white_space_in_the_table(spark):
    docs = spark.createDataFrame([(1, " " * 1_200_000), (None, "a"), (2, None)], "doc_id long, text string")
    rows = packing.packed_documents(docs).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 1_200_001
    assert sum(r["length"] for r in rows if r["doc_id"] is None) == 2
