import random
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from hiregrain.llm import golay
from hiregrain.llm.components import components
from hiregrain.llm.simhash import fingerprint, links, near_duplicates, one_of_each


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_words_two_bits_apart_share_a_codeword():
    tables = golay.tables()
    source = np.random.default_rng(0)
    words = source.integers(0, 1 << 23, 300)
    own = golay.keys(words, *tables)
    for bits in [(), *combinations(range(23), 1), *combinations(range(23), 2)]:
        other = golay.keys(words ^ sum(1 << b for b in bits), *tables)
        assert (own[:, :, None] == other[:, None, :]).any((1, 2)).all()


def test_fingerprint_equals_the_definition():
    for text in ("a", "One two", "One two three four", "x " * 40, "é à\tü\nö " * 9):
        words = text.encode().lower().split()
        parts = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
        hashes = [xxhash.xxh64_intdigest(part, 42) for part in parts]
        bits = [sum(h >> b & 1 for h in hashes) * 2 > len(hashes) for b in range(64)]
        assert fingerprint(text.encode()) == sum(1 << b for b in range(64) if bits[b])
    assert fingerprint(None) == fingerprint(b" \n") == 0


def test_links_connect_all_close_fingerprints(spark):
    source = random.Random(3)
    prints = set()
    for _ in range(12):  # chains and crowds around centres, some with the top bit
        at = source.getrandbits(64)
        for _ in range(40):
            prints.add(at)
            at ^= sum(1 << b for b in source.sample(range(64), source.choice([1, 2, 3])))
    centre = source.getrandbits(64)
    prints |= {centre ^ 1 << a ^ 1 << b for a, b in combinations(range(0, 64, 3), 2)}
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    close = [(a, b) for a, b in combinations(prints, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    frame = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    for most in (64, 3):  # few keys are crowded, most keys are
        found = [tuple(row) for row in links(frame, most).collect()]
        assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in found)
        assert roots(prints, found) == roots(prints, close)


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 40)] + [(7, 7)]
    nodes = {n for edge in edges for n in edge}
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert dict(map(tuple, found.collect())) == roots(nodes, edges)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(odd_docs):
    found = near_duplicates(odd_docs).collect()
    assert len(found) == odd_docs.count()
    group = {row["doc_id"]: row["component_id"] for row in found}
    assert group[1] == group[2] == group[3] == 1
    assert group[8] == group[9] == 8 and group[4] == 4 and group[None] is None
    kept = one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(row["doc_id"]) for row in kept.collect()) == ["1", "4", "6", "7", "8", "None"]
    empty = odd_docs.where(F.lit(False))
    assert near_duplicates(empty).count() == 0 and one_of_each(empty).count() == 0
