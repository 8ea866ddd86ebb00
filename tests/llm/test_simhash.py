import random
import re

import numpy as np
import xxhash

from matchlore.llm import simhash


def fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(prints):
    """Least node reachable over pairs that differ in three bits at most."""
    parent = {n: n for n, _ in prints}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, x in prints:
        for b, y in prints:
            if (x ^ y).bit_count() <= 3:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {n: root(n) for n, _ in prints}


def test_fingerprints_and_components(docs, rows):
    found = simhash.near_duplicates(docs).select("doc_id", simhash.hex16("fp"), "component_id").collect()
    known = [(r[0], fingerprint(r[1])) for r in rows]
    by_print = {}
    for i, fp in known:
        if i is not None:
            by_print[fp] = min(by_print.get(fp, i), i)
    component = brute([(n, fp) for fp, n in by_print.items()])
    expected = sorted((repr(i), f"{fp:016x}", component.get(by_print.get(fp))) for i, fp in known)
    assert sorted((repr(a), b, c) for a, b, c in found) == expected


def planted(count, seed=1):
    """Chains and clouds of fingerprints that are near each other."""
    drawn = random.Random(seed)
    prints = []
    for _ in range(count):
        fp = drawn.getrandbits(64)
        for _ in range(drawn.choice([1, 2, 12])):
            prints.append(fp)
            for _ in range(drawn.randint(1, 5)):
                fp ^= 1 << drawn.randrange(64)
    return list(enumerate(dict.fromkeys(prints)))


def test_links_in_blocks(spark):
    prints = planted(60)
    signed = [(fp - (1 << 64) if fp >> 63 else fp, n) for n, fp in prints]
    expected = brute(prints)
    frame = spark.createDataFrame(signed, "fp bigint, node bigint")
    for block in (2, 2048):
        found = {r["node"]: r["component"] for r in simhash.components(simhash.links(frame, block=block)).collect()}
        assert {n: found.get(n, n) for n, _ in prints} == expected


def test_forest_emits_no_pairs(spark):
    """A cloud of one-bit neighbours: edges stay below nodes times postings."""
    prints = [(1 << b | 1 << c, 64 * b + c) for b in range(20) for c in range(b + 1, 20)]
    frame = spark.createDataFrame(prints, "fp bigint, node bigint")
    edges = simhash.links(frame)
    assert edges.count() < 8 * len(prints)
    assert {r["component"] for r in simhash.components(edges).collect()} == {1}


def test_long_chain_of_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in simhash.components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_one_of_each_group_stays(docs, rows, none):
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    components = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect() if r["doc_id"] is not None}
    assert sorted(i for i in ids if i is not None) == sorted(set(components.values()))
    assert ids.count(None) == 2  # rows without an id cannot be named, so they stay
    assert simhash.deduplicated(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0


def test_tally_keeps_what_can_be_near():
    left = np.array([0, 0x0101010101010101], np.uint64)
    a, b = simhash.linked(left, np.array([7, 0x0101, 0xFFFF], np.uint64), 5, 3)
    assert sorted(zip(a.tolist(), b.tolist())) == [(0, 0), (0, 1)]


def test_deduplicated_does_not_depend_on_partitions(spark):
    a, b = "alpha beta gamma delta epsilon zeta", "one two three four five six seven eight nine"
    rows = [(3, a, "x"), (5, a, "x"), (5, b, "y"), (5, b, "z"), (5, b, "z"), (None, a, None), (7, "", "e"), (6, None, "e")]
    expected = [(3, a, "x"), (6, None, "e"), (None, a, None)]
    for parts in (1, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").repartition(parts)
        found = [tuple(r) for r in simhash.deduplicated(docs).collect()]
        assert sorted(set(found) & set(expected), key=str) == sorted(expected, key=str)
        (rest,) = [r for r in found if r not in expected]
        assert rest[:2] == (5, b) and len(found) == 4
        chosen = rest if parts == 1 else chosen
        assert rest == chosen
