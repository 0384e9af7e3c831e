import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowtide.llm.common import remainder
from rowtide.llm.suffixtree import END, Layer, SuffixTree, _Reach, score_texts



def train():
    return remainder(F.col("doc_id"), 10) != 0


def plain_tokens(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        text = text.replace(blank, " ")
    return [w.encode() for w in text.split(" ") if w] + [END]


class PlainModel:
    """The tree as dictionaries of strings, grown and walked one position at a time."""

    def __init__(self, texts, share, entry_share, depth, divergence, discount, smoothing):
        self.c = Counter(w for t in texts for w in t)
        self.n, v = sum(self.c.values()), len(self.c)
        self.below = self.n + 0.1 * (v + 1)
        self.discount, self.smoothing = discount, smoothing
        least = max(2, math.ceil(self.n * share))
        entry_least = max(2, math.ceil(self.n * entry_share))
        self.symbols = {w for w, n in self.c.items() if n >= least}
        self.root = {w: self.base(w) for w in self.symbols}
        self.root[None] = 1 - sum(self.root.values())
        sequences = [[END if END in self.symbols else None, *map(self.symbol, t)] for t in texts]
        self.nodes = {}
        candidates = {(s,) for s in self.root}
        for d in range(1, depth + 1):
            follow = {c: Counter() for c in candidates}
            for s in sequences:
                for i in range(1, len(s)):
                    if i >= d and tuple(s[i - d : i]) in follow:
                        follow[tuple(s[i - d : i])][s[i]] += 1
            level = {}
            for context, counts in follow.items():
                total = sum(counts.values())
                kept = {s: n for s, n in counts.items() if n >= entry_least}
                gain, own, other = 0.0, 0.0, 0.0
                for s, n in kept.items():
                    p, q = n / total, self.p(context[1:], s)
                    gain, own, other = gain + p * math.log(p / q), own + p, other + q
                rest = max(1 - own, 0)
                if rest > 0:
                    gain += rest * math.log(rest / max(1 - other, 1e-12))
                level[context] = (total, kept, gain >= divergence)
            longer = {
                (*context, s) for context, (_, kept, _) in level.items() for s, n in kept.items() if n >= least
            }
            self.nodes |= level
            candidates = {c for c in longer if c[1:] in level}

    def symbol(self, word):
        return word if word in self.symbols else None

    def base(self, word):
        return (self.c[word] + 0.1) / self.below

    def p(self, context, symbol):
        p = self.root[symbol]
        for d in range(1, len(context) + 1):
            node = self.nodes.get(tuple(context[-d:]))
            if node is None:
                break
            total, kept, retained = node
            if retained:
                left = total - sum(n - self.discount for n in kept.values())
                own = kept[symbol] - self.discount if symbol in kept else 0
                p = (own + (left + self.smoothing) * p) / (total + self.smoothing)
        return p

    def score(self, tokens, depth):
        past, score = [END if END in self.symbols else None], 0.0
        for word in tokens:
            s = self.symbol(word)
            score += math.log10(self.p(past[-depth:], s))
            if s is None:
                score += math.log10(self.base(word) / self.root[None])
            past.append(s)
        return score


def coded(p):
    return min(max(round(-8 * math.log(p)), 0), 255)


def decoded(code):
    return math.exp(-code / 8)


class PlainLongContexts:
    """Contexts of whole words below a plain top, one place at a time."""

    def __init__(self, top, texts, teaches, share, least, divergence, smoothing, stretch):
        self.top, self.least, self.divergence, self.smoothing = top, least, divergence, smoothing
        grown = max((len(c) for c in top.nodes), default=0)
        length = max(2, grown)
        most = (max(2, math.ceil(top.n * share)) - 0.9) / top.below / top.root[None]
        self.logs = {}
        active = {}
        for i, tokens in texts.items():
            symbols = [END if END in top.symbols else None, *map(top.symbol, tokens)]
            for at, word in enumerate(tokens):
                symbol = symbols[at + 1]
                q = top.p(symbols[max(0, at + 1 - max(grown, 1)) : at + 1], symbol)
                p = q * (1 if symbol is not None else top.base(word) / top.root[None])
                self.logs[i, at] = p
                if at >= length:
                    before = tuple(symbols[at + 1 - length : at + 1])
                    held = grown == length and None not in before and before in top.nodes
                    active[i, at] = (p, coded(q * (1 if symbol is not None else min(1, most))), held)
        self.rounds = []
        first = True
        while active:
            active = self.longer(texts, teaches, active, length, first)
            length, first = length * stretch, False
            active = {
                (i, at): v
                for (i, at), v in active.items()
                if at >= length and all(top.c[w] >= 2 for w in texts[i][at - length : at])
            }

    def longer(self, texts, teaches, active, length, first):
        follow, codes = {}, {}
        for (i, at), (_, code, held) in active.items():
            if not held:
                context, word = tuple(texts[i][at - length : at]), texts[i][at]
                follow.setdefault(context, Counter())[word] += teaches[i]
                codes[context, word] = code
        nodes = {}
        for context, counts in follow.items():
            total = sum(counts.values())
            kept = {w: n for w, n in counts.items() if n >= self.least}
            own = {w: n / total for w, n in kept.items()}
            gain = sum(p * math.log(p / decoded(codes[context, w])) for w, p in own.items())
            rest = max(1 - sum(own.values()), 0)
            if rest > 1e-12:
                gain += rest * math.log(rest / max(1 - sum(decoded(codes[context, w]) for w in kept), 1e-12))
            retained = bool(kept) and gain >= self.divergence
            nodes[context] = (total, kept, retained, bool(kept) and max(kept.values()) < total)
        self.rounds.append((length, sum(n[2] for n in nodes.values())))
        further = {}
        for (i, at), (p, code, held) in active.items():
            if held:
                further[i, at] = (p, code, False)
                continue
            word = texts[i][at]
            total, kept, retained, longer = nodes[tuple(texts[i][at - length : at])]
            if retained:
                own = kept[word] - self.top.discount if word in kept else 0
                left = total - sum(n - self.top.discount for n in kept.values()) + self.smoothing
                p = (own + left * p) / (total + self.smoothing)
                code = coded((own + left * decoded(code)) / (total + self.smoothing))
            self.logs[i, at] = p
            if longer:
                further[i, at] = (p, code, False)
        return further

    def score(self, i, tokens):
        return sum(math.log10(self.logs[i, at]) for at in range(len(tokens)))


@pytest.mark.parametrize(
    ("share", "depth", "least", "shard_tokens"), [(1e-3, 2, 2, 5_000), (3e-3, 3, 3, 4_000_000), (0.5, 2, 2, 700), (1e-3, 2, 10**9, 50_000)]
)
def test_scores_equal_the_plain_model(documents, share, depth, least, shard_tokens):
    how = {"entry_share": 1e-4, "depth": depth, "divergence": 0.05, "discount": 0.6, "smoothing": 3.0}
    longer = {"least": least, "long_smoothing": 0.7, "stretch": 2}
    scored = score_texts(
        documents, train(), symbol_share=share, block_bytes=60_000, shard_tokens=shard_tokens, **how, **longer
    )
    got = {r.doc_id: r for r in scored.collect()}
    texts = {r.doc_id: plain_tokens(r.text) for r in documents.collect()}
    teaches = {i: zlib.crc32(str(i).encode()) % 10 != 0 for i in texts}
    model = PlainModel([t for i, t in texts.items() if teaches[i]], share, *how.values())
    below = PlainLongContexts(model, texts, teaches, share, least, how["divergence"], 0.7, 2)
    if least == 2:
        assert len(below.rounds) > 1 and all(n for _, n in below.rounds[:2])
    assert len(got) == len(texts)
    for i, tokens in texts.items():
        r = got[i]
        assert (r.n_tokens, r.train_tokens) == (len(tokens), model.n)
        assert r.n_known == sum(model.c[w] > 0 for w in tokens)
        assert r.base_score == pytest.approx(sum(math.log10(model.base(w)) for w in tokens), rel=1e-9)
        if least == 10**9:
            assert r.score == pytest.approx(model.score(tokens, depth), rel=1e-9)
        assert r.score == pytest.approx(below.score(i, tokens), rel=1e-9)


def test_distributions_sum_to_one():
    rng = np.random.default_rng(0)
    root = rng.dirichlet(np.ones(5))
    entries = np.array([1, 2, 7, 13, 14])
    counts = np.array([3.0, 2.0, 5.0, 1.0, 4.0])
    kept = np.bincount(entries // 5, counts - 0.5, minlength=5)
    first = Layer(np.arange(5), kept + 2, kept, np.array([True, True, False, True, True]), entries, counts)
    second = Layer(np.array([1, 8, 12]), np.array([9.0, 4, 4]), np.array([8.0, 3.5, 0]), np.ones(3, bool), np.array([1, 3, 5]), np.array([6.0, 3, 4]))
    tree = SuffixTree({b"": 0, b"a": 1, b"b": 2, b"c": 3}, root, 0.5, 2.0, [first, second])
    for before in np.ndindex(5, 5):
        total = 0.0
        for last in range(5):
            total += tree.probabilities(np.array([*before, last]), np.array([3]))[2]
        assert total == pytest.approx(1)


def test_held_out_texts_are_likelier_than_by_words_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = score_texts(docs, train()).toPandas()
    held = got[got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 10 == 0)]
    assert len(held) > 50 and (held.score > held.base_score).mean() > 0.9
    assert held.score.sum() > 0.975 * held.base_score.sum()


def test_odd_rows(odd_docs, no_docs):
    rows = score_texts(odd_docs, train()).collect()
    assert len(rows) == odd_docs.count()
    assert sorted(r.n_tokens for r in rows)[:4] == [1, 1, 1, 1]
    assert len({(r.score, r.base_score) for r in rows if r.doc_id in (1, 2)}) == 1
    assert all(r.score <= 0 and r.base_score <= 0 for r in rows)
    assert score_texts(no_docs, train()).count() == 0
    untaught = score_texts(odd_docs, F.lit(False)).collect()
    assert {(r.train_tokens, r.n_known) for r in untaught} == {(0, 0)}
    assert all(r.score == pytest.approx(r.base_score) == pytest.approx(0) for r in untaught)


def test_no_context_is_asked_about_that_has_a_string_seen_once():
    rng = np.random.default_rng(3)
    sizes = np.array([30, 1, 200, 70], np.int32)
    tokens = rng.integers(0, 40, sizes.sum()).astype(np.int32)
    hashes = np.arange(1, 41, dtype=np.uint64)
    hashes[:2] = 0
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.flatnonzero(place >= 2)
    p, codes = rng.random(len(at)), np.arange(len(at)).astype(np.uint8)
    reach = _Reach(tokens, hashes, sizes, np.arange(4, dtype=np.int32), np.array([True, False, True, True]), at, p, codes, place[at])
    go, once = rng.random(len(at)) < 0.7, rng.random(len(at)) < 0.1
    strings = [(j - 2, j) for j in at[once]] + [(j, j) for j in np.flatnonzero(tokens < 2)]
    length, asked = 2, at[once]
    for further in (6, 9):
        left = reach.kept(go, asked, length, further)
        left = _Reach.unpacked(left.packed())
        bound = [i - 1 - max([lo for lo, hi in strings if hi < i], default=-1) for i in at]
        room = np.minimum(place[at], bound)
        want = np.flatnonzero(go & (room >= further))
        assert 0 < len(want) < go.sum() and (left.room == room[want]).all() and (left.codes == codes[want]).all()
        words = left.hashes[left.tokens]
        text = left.rows[np.repeat(np.arange(len(left.sizes)), left.sizes)]
        for k, i in enumerate(want):
            here = slice(left.at[k] - left.room[k], left.at[k] + 1)
            assert (words[here] == hashes[tokens[at[i] - room[i] : at[i] + 1]]).all()
            assert (text[here] == np.searchsorted(np.cumsum(sizes), at[i], side="right")).all()
        # Those that go on are asked about again, and one of the longer strings is not seen twice.
        at, codes, p = at[want], codes[want], p[want]
        reach, length = left, further
        place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        go, one = np.ones(len(at), bool), len(at) // 2
        asked, strings = left.at[[one]], [*strings, (at[one] - further, at[one])]


def test_messages_come_from_one_compressor(monkeypatch):
    import zstandard

    from rowtide.llm import longcontexts

    monkeypatch.setattr(zstandard, "ZstdCompressor", None)
    arrays = [np.arange(1000, dtype=np.uint64), np.zeros(0, np.uint8)]
    for got, want in zip(longcontexts.unpacked(longcontexts.packed(*arrays), np.uint64, np.uint8), arrays, strict=True):
        assert (got == want).all()


def test_nothing_shuffled_is_left_once_it_is_written(spark, documents):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(i).getPath() for i in range(files.size()))
        return {n for n in names if "/shuffle_" in n and n.endswith(".data")}

    before = shuffled()
    score_texts(documents, train(), symbol_share=1e-3, block_bytes=60_000, shard_tokens=5_000)
    left = shuffled() - before
    assert sum(os.path.getsize(n) for n in left if os.path.exists(n)) < 300_000
