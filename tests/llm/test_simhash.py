import random

import pytest
import xxhash

from rowtide.llm.components import components
from rowtide.llm.simhash import fingerprint, keep_one_of_each, near_pairs, simhash_duplicates


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, distance):
    """Smallest reachable value of each, by comparing all pairs."""
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= distance:
                a_root, b_root = find(a), find(b)
                root[max(a_root, b_root)] = min(a_root, b_root)
    return {v: find(v) for v in values}


def test_fingerprints(spark, documents, odd_docs):
    texts = [r.text or "" for r in documents.collect()] + ["", "a", "A  b", "a b c", "É\x85é x y z"]
    for text in texts:
        assert fingerprint(text.encode()) == plain_fingerprint(text)


def test_spark_hashes_alike(spark):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([("a b c",)], "t string").select(F.xxhash64("t")).first()
    assert row[0] % 2**64 == fingerprint(b"a b c")


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("distance", [0, 1, 2])
@pytest.mark.parametrize("crowd", [1, 4, 10_000])
def test_links_join_the_same_groups_as_all_pairs(spark, distance, crowd):
    random.seed(distance)
    values = {0, (1 << 64) - 1}
    for _ in range(12):
        value = random.getrandbits(64)
        for _ in range(12):
            values.add(value)
            for _ in range(random.randint(1, 3)):
                value ^= 1 << random.randrange(64)
    values |= {random.getrandbits(64) for _ in range(60)}
    expected = groups([signed(v) for v in values], distance)
    distinct = spark.createDataFrame([(signed(v),) for v in values], "f long")
    links = near_pairs(distinct, max_distance=distance, crowd=crowd)
    for a, b in links.collect():
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= distance
    got = {r.node: r.root for r in components(links).collect()}
    assert {v: got.get(v, v) for v in expected} == expected


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 30)]
    edges += [(1, 2), (2, 3), (3, 1), (5, 5), (None, 4), (4, None), (2, 1)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    expected = {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 30)} | {1: 1, 2: 1, 3: 1}
    assert got == expected
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_documents(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    root = groups(prints.values(), 2)
    least = {}
    for i, f in prints.items():
        least[root[f]] = min(i, least.get(root[f], i))
    got = {r.doc_id: r for r in simhash_duplicates(documents).collect()}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in prints.items()}
    assert {i: r.component_id for i, r in got.items()} == {i: least[root[f]] for i, f in prints.items()}
    kept = keep_one_of_each(documents)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values())


def test_odd_rows(spark, odd_docs, no_docs):
    rows = simhash_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    wordless = [r for r in rows if r.fingerprint == "0" * 16]
    assert sorted(str(r.doc_id) for r in wordless) == ["3", "4", "5", "None"]
    assert {r.component_id for r in wordless} == {3}
    assert [r.component_id for r in rows if r.doc_id in (1, 2)] == [1, 1, 1]
    kept = keep_one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == ["1", "3", "6", "7", "8", "9", "None"]
    assert simhash_duplicates(no_docs).count() == 0 and keep_one_of_each(no_docs).count() == 0
