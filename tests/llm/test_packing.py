import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from rowtide.llm.packing import B, K1, _Encoder, _Index, _is_word, _nearest, _word_pairs, pack, pack_shard
from rowtide.llm.queries import tokenizer_file


def check(rows, texts, window):
    """Every id of every text lies in one piece, pieces fill sequences without gaps."""
    tokenizer = Tokenizer.from_file(tokenizer_file())
    whole = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts.items()}
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length > 0 and r.doc_tokens == len(whole[r.doc_id])
        ids = np.array(whole[r.doc_id][r.start : r.start + r.length], "<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32
        docs[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces, size in [(docs[i], len(w)) for i, w in whole.items()]:
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert at == size
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    return sequences


def test_parts_between_blanks_have_the_ids_of_the_text():
    texts = [
        "It's 12,5%—and THE end...don't",
        "Ünïcode é İstanbul ΣΑΣ Σ\tx y z​",
        "a <|endoftext|> b<|startoftext|>",
        "",
        " \n ",
        "ǅ ﬁ Å ́x \x85 \x1c y",
        "İİ. a.. b.,; c'.! d). é! ß? 中文。 ١٢. x\u0301. ªº! don't. İ word",
        "<|ENDOFTEXT|> <|Endoftext|>. THE. The, the!",
    ]
    encoder = _Encoder(tokenizer_file(), remember=20)
    tokenizer = Tokenizer.from_file(tokenizer_file())
    for _ in range(2):
        flat, starts = encoder.encode(pa.array([*(t.encode() for t in texts), None]), 2)
        for n, text in enumerate([*texts, ""]):
            plain = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
            assert flat[starts[n] : starts[n + 1]].tolist() == plain
        assert len(starts) == len(texts) + 2
    flat, starts = encoder.encode(pa.array([*(t.encode() for t in texts)] * 2).slice(3, 6), 2)
    assert len(starts) == 7 and starts[-1] == len(flat)
    broken = [b"\xff\xfe word", b"a\xc3"]
    flat, starts = encoder.encode(pa.array(broken), 2)
    assert flat[: starts[1]].tolist() == [*tokenizer.encode(broken[0].decode("utf-8", "replace"), add_special_tokens=False).ids, 2]


def test_words_are_encoded_as_by_the_tokenizer(documents):
    import random

    random.seed(0)
    tokenizer, encoder = Tokenizer.from_file(tokenizer_file()), _Encoder(tokenizer_file())
    assert encoder.words is not None
    words = {w for r in documents.collect() for w in r.text.lower().split()}
    words |= {"".join(random.choices("aeioutnshrdlé日", k=random.randint(1, 30))) for _ in range(20_000)}
    words |= {"a" * n for n in range(1, 80)} | {"ab" * n for n in range(1, 40)}
    words = [w for w in words if _is_word(w.encode())]
    assert len(words) > 30_000
    found = encoder.ids_of_words([w.encode() for w in words])
    for ids, each in zip(found, tokenizer.encode_batch(words, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids, np.uint16).tolist() == each.ids


def test_other_models_have_no_quicker_way():
    assert _word_pairs({"type": "Unigram"}) is None
    assert _word_pairs({"type": "BPE", "end_of_word_suffix": None, "vocab": {}, "merges": []}) is None
    unordered = {"type": "BPE", "end_of_word_suffix": "</w>", "vocab": {"ab": 9, "cd": 8}, "merges": [["a", "b"], ["c", "d"]]}
    assert _word_pairs(unordered) is None


def test_documents(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for shard_tokens in (4_000_000, 30_000):
        rows = pack(documents, tokenizer_file(), shard_tokens=shard_tokens).collect()
        sequences = check(rows, texts, 4096)
        filled = [sum(n for _, n in s) for s in sequences.values()]
        shards = len({s >> 32 for s in sequences})
        assert sum(n < 4096 for n in filled) <= shards
    assert shards > 1


def test_the_ids_can_be_carried(documents):
    r = pack(documents.limit(3), tokenizer_file(), carry_ids=True).first()
    assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32


def test_bm25_scores():
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 30, n).astype(np.uint16) for n in (5, 50, 20, 1, 33)]
    weight = rng.random(30).astype(np.float32)
    index = _Index(docs, weight, 20.0)
    for query in range(5):
        terms = sorted(set(docs[query].tolist()), key=lambda t: (-weight[t], t))[:4]
        for row, score in enumerate(index.scores(query, 4)):
            plain = 0.0
            for t in terms:
                n = int((docs[row] == t).sum())
                norm = K1 * (1 - B + B * len(docs[row]) / 20.0)
                plain += weight[t] * n * (K1 + 1) / (n + norm)
            assert abs(plain - score) < 1e-4


def test_a_window_is_filled_with_the_nearest_unused_documents():
    topics = [np.array([t] * 6 + [t + 1] * 4, np.uint16) for t in (10, 20, 30)]
    docs = [topics[i % 3] for i in range(12)]
    pieces = pack_shard(docs, np.ones(64, np.float32), 10.0, 40)
    by_sequence = defaultdict(set)
    for doc, _, _, sequence, _ in pieces:
        by_sequence[sequence].add(doc % 3)
    assert [len(v) for v in by_sequence.values()] == [1, 1, 1]


def test_neighbours_are_scored_by_all_terms_of_the_seed():
    # The second document shares one of the 16 rarest terms, the third all the others.
    seed = np.arange(60, dtype=np.uint16)
    docs = [seed, np.array([0] + [99] * 43, np.uint16), np.arange(16, 60, dtype=np.uint16)]
    weight = np.where(np.arange(128) < 16, 2.0, 1.0).astype(np.float32)
    pieces = pack_shard(docs, weight, 50.0, 104)
    assert [p[0] for p in pieces if p[3] == 0] == [0, 2]


def test_dropping_used_documents_keeps_the_scores_of_others():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50, n).astype(np.uint16) for n in rng.integers(1, 60, 40)]
    index, unused = _Index(docs, rng.random(50).astype(np.float32), 30.0), rng.random(40) < 0.5
    whole = [index.scores(d) for d in range(40)]
    index.drop(unused)
    for d in range(40):
        assert np.array_equal(index.scores(d), np.where(unused, whole[d], 0))


def test_short_neighbours_fill_the_window_before_others_do():
    rng = np.random.default_rng(2)
    docs = [np.concatenate([[i % 2], rng.integers(2, 40, 99) if i % 2 == 0 else np.full(1999, 50)]) for i in range(120)]
    pieces = pack_shard([d.astype(np.uint16) for d in docs], np.ones(64, np.float32), 1050.0, 4096)
    first = [doc for doc, _, _, sequence, _ in pieces if sequence == 0]
    assert len(first) == 41 and all(doc % 2 == 0 for doc in first)


def test_the_nearest_are_those_of_a_full_sort():
    rng = np.random.default_rng(3)
    for room in (0, 1, 50, 400, 10_000):
        scores = np.maximum(rng.integers(-20, 30, 300), 0).astype(np.float64)
        length = rng.integers(1, 9, 300)
        order = [d for d in np.lexsort((np.arange(300), -scores)).tolist() if scores[d] > 0]
        found = _nearest(scores, length, room)
        assert found == order[: len(found)]
        assert len(found) == len(order) or length[found].sum() >= room


def test_odd_rows(spark, odd_docs, no_docs):
    rows = pack(odd_docs, tokenizer_file()).collect()
    assert sum(r.start == 0 for r in rows) == odd_docs.count()
    assert sum(r.doc_tokens == 1 for r in rows) == 4
    once = odd_docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text for r in once.collect()}
    check(pack(once, tokenizer_file()).collect(), texts, 4096)
    check(pack(once, tokenizer_file(), shard_tokens=100).collect(), texts, 4096)
    assert pack(no_docs, tokenizer_file()).count() == 0
