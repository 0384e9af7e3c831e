"""The trie of conversation prefixes against a plain one."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rowtide.llm import prefixtrie
from rowtide.llm.prefixtrie import prefix_trie

COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def plain(conversations):
    """The trie of ``{conversation: [(role, text), ...]}``."""
    members = {}
    for conv, turns in conversations.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    children = {key: [c for c in members if len(c) == len(key) + 1 and c[: len(key)] == key] for key in members}

    def leaves(key):
        return sum(map(leaves, children[key])) or 1

    def saved(key):
        return (len(members[key]) - 1) * (len(key[-1][1]) if key else 0) + sum(map(saved, children[key]))

    return sorted(
        (
            min(convs),
            len(key),
            min(members[key[:-1]]) if key else -1,
            len(convs),
            len(children[key]),
            leaves(key),
            saved(key),
            hashlib.sha256(",".join(str(c) for c in sorted(convs) if len(conversations[c]) == len(key)).encode()).hexdigest(),
        )
        for key, convs in members.items()
    )


def got(trie):
    assert trie.columns == COLUMNS
    return sorted(tuple(-1 if v is None else v for v in row) for row in trie.collect())


def rows_of(spark, conversations):
    rows = [(c, n, *turn) for c, turns in conversations.items() for n, turn in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def some(seed, n, words, longest):
    rng = random.Random(seed)
    found = {}
    for conv in rng.sample(range(-50, 100_000), n):
        if found and rng.random() < 0.5:
            turns = list(rng.choice(list(found.values())))[: rng.randint(1, longest)]
        else:
            turns = []
        while not turns or rng.random() < 0.5 and len(turns) < longest:
            turns.append((rng.choice("ua"), rng.choice(words)))
        found[conv] = turns
    return found


@pytest.mark.parametrize("cells,shard", [(1, 50), (9, 60), (40, 10_000), (1 << 19, 70)])
def test_trie_equals_a_plain_one(spark, monkeypatch, cells, shard):
    monkeypatch.setattr(prefixtrie, "CHUNK_IDS", 3)
    conversations = some(cells, 150, ["", "a", "b", "ää", "u"], 7)
    assert got(prefix_trie(rows_of(spark, conversations), shard_turns=shard, block_cells=cells)) == plain(conversations)


def test_copies_fill_many_shards(spark):
    turns = [("user", "hello"), ("assistant", "yes?"), ("user", "no")]
    conversations = {c: turns[: 3 if c % 5 else 2] for c in range(400)} | {1000: turns + [("assistant", "why")], 1001: [("user", "x")]}
    trie = prefix_trie(rows_of(spark, conversations), shard_turns=80, block_cells=40)
    assert got(trie) == plain(conversations)


def test_conversations_with_heads_of_others(spark):
    conversations = some(7, 120, ["a", "b"], 8)
    conversations = {c % 400: turns for c, turns in conversations.items()}
    base, heads = F.col("conv_id") - F.col("conv_id") % 100, F.pmod(F.col("conv_id"), F.lit(6)).cast("int")
    trie = prefix_trie(rows_of(spark, conversations), base=base, heads=heads, shard_turns=100, block_cells=64)
    changed = {c: conversations.get(c - c % 100, [])[: c % 6] + turns[c % 6 :] for c, turns in conversations.items()}
    assert any(not turns for turns in changed.values())
    assert got(trie) == plain(changed)


def test_a_very_long_conversation(spark):
    long = [("user", "ab")] * 3000
    conversations = {1: long, 2: long[:2999] + [("user", "c")], 3: long[:5], 4: [("user", "x" * 3_000_000)]}
    trie = prefix_trie(rows_of(spark, conversations), block_cells=5000).cache()
    assert trie.count() == 1 + 3000 + 1 + 1 and trie.filter("depth > 3000").count() == 0
    root = trie.filter("depth = 0").first()
    assert (root.n_convs, root.n_leaves, root.n_children, root.saved_tokens) == (4, 3, 2, 2 * 2999 + 2 * 5)
    assert trie.filter("n_convs = 3").agg(F.max("depth")).first()[0] == 5


def test_odd_rows(spark):
    rows = [
        (1, 1, "u", "b"),
        (1, None, "u", "a"),
        (2, 0, "u", "a"),
        (2, 1, "u", "b"),
        (3, 0, None, None),
        (4, 0, "", ""),
        (5, 0, "u", "a"),
        (5, 0, "u", "a"),
        (6, 0, "ua", ""),
        (None, 0, "u", "a"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table = table.withColumns({n: F.lit("own") for n in ("ids", "sizes", "turns", "kind", "key", "base", "head", "depth", "one")})
    ab = [("u", "a"), ("u", "b")]
    expected = {1: ab, 2: ab, 3: [("", "")], 4: [("", "")], 5: [ab[0], ab[0]], 6: [("ua", "")]}
    assert got(prefix_trie(table)) == plain(expected)
    assert got(prefix_trie(table.limit(0))) == []
    nothing = prefix_trie(table.filter("conv_id = 3"), base=F.lit(9), heads=F.lit(1))
    assert got(nothing) == [(3, 0, -1, 1, 0, 1, 0, hashlib.sha256(b"3").hexdigest())]
