"""Packing: documents share a training window with their lexical neighbours."""

from __future__ import annotations

import itertools
import json
import os
import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.llm.common import flat_bytes, pieces, stored

K1, B = 1.2, 0.75  # the usual constants of BM25


# ---------------------------------------------------------------------------- tokens


class _Encoder:
    """Token ids of texts, by the ids of their parts between ASCII blanks.

    The tokenizer writes A to Z small and drops white space before it looks at words, so a text's ids
    are those of its blank-separated parts in order. Parts come back often; up to a bound they are
    remembered, as an Arrow column, and their ids as one array of 16-bit numbers.
    """

    def __init__(self, path: str, remember: int = 900_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.remember = remember
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        if self.size > 1 << 16:
            raise ValueError("token ids of more than 16 bits")
        self.last_of_word = np.zeros(self.size, bool)
        self.last_of_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.folds = self._ids(["A"]) == self._ids(["a"])
        self.words = _word_pairs(json.loads(self.tokenizer.to_str())["model"])
        self.parts = pa.array([], pa.string())
        self.ids, self.starts = np.zeros(0, np.uint16), np.zeros(1, np.int64)

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(each.ids, np.uint16).tobytes() for each in found]

    def ids_of_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of letters. Many are encoded as one text; its tokens tell where each word
        ends. Should their number not fit, each goes by itself."""
        found = []
        for low in range(0, len(words), _TOGETHER):
            some = words[low : low + _TOGETHER]
            if self.words:
                raw = np.array(self.words.encode_ordinary(b"\0".join(some).decode() + "\0"), np.uint16).tobytes()
            else:
                raw = self._ids([b" ".join(some).decode()])[0]
            ends = np.flatnonzero(self.last_of_word[np.frombuffer(raw, np.uint16)]) * 2 + 2
            if len(ends) == len(some):
                found += [raw[s:e] for s, e in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            else:
                found += self.ids_of_parts(some)
        return found

    def ids_of_parts(self, parts: list[bytes]) -> list[bytes]:
        return self._ids([p.decode("utf-8", "replace") for p in parts])

    def _ids_of_others(self, parts: list[bytes]) -> list[bytes]:
        """Ids of parts that are not plain words. Signs after a word are looked at apart from it."""
        cores = [p.rstrip(_CLOSING) for p in parts]
        words = list({c for c in cores if _is_word(c)})
        of = dict(zip(words, self.ids_of_words(words), strict=True))
        tails = list({p[len(c) :] for p, c in zip(parts, cores, strict=True) if c in of and c != p})
        tail = dict(zip([b"", *tails], [b"", *self.ids_of_parts(tails)], strict=True))
        rest = [p for p, c in zip(parts, cores, strict=True) if c not in of]
        whole = dict(zip(rest, self.ids_of_parts(rest), strict=True))
        return [of[c] + tail[p[len(c) :]] if c in of else whole[p] for p, c in zip(parts, cores, strict=True)]

    def _remember(self, parts: pa.Array) -> np.ndarray:
        """Looks new parts up and keeps them behind the others; gives their places."""
        plain = pc.and_(pc.ascii_is_alpha(parts), pc.ascii_is_lower(parts))
        first = np.asarray(plain)
        place = len(self.parts) + np.where(first, np.cumsum(first), first.sum() + np.cumsum(~first)) - 1
        words, others = parts.filter(plain), parts.filter(pc.invert(plain))
        found = self.ids_of_words(words.view(pa.binary()).to_pylist())
        found += self._ids_of_others(others.view(pa.binary()).to_pylist())
        self.parts = pa.concat_arrays([self.parts, words, others])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), np.uint16)])
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 2
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        return place

    def _places(self, parts: pa.Array) -> np.ndarray:
        """Where different parts are remembered, the new ones among them after they are looked up."""
        place = pc.index_in(parts, value_set=self.parts)
        if len(self.parts) + place.null_count > self.remember and place.null_count:
            # The parts that came first are on the whole the most frequent ones.
            keep = min(self.remember // 2, len(self.parts))
            self.parts, self.starts = pa.concat_arrays([self.parts.slice(0, keep)]), self.starts[: keep + 1]
            self.ids = self.ids[: self.starts[-1]].copy()
            place = pc.index_in(parts, value_set=self.parts)
        new = np.asarray(pc.is_null(place))
        places = place.fill_null(-1).to_numpy().astype(np.int64)
        if place.null_count:
            places[new] = self._remember(parts.filter(pa.array(new)))
        return places

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each text and ``end``, one after another, and where each text's begin.

        Parts are cut, told apart and found by Arrow; the ids of each different one are then put in the
        places of all.
        """
        # Kernels for text look at bytes alone; these need not be valid.
        whole = texts.fill_null(b"").view(pa.string())
        if self.folds:
            # A special token's name is only known as it is written.
            special = pc.match_substring(whole, "<|")
            lower = pc.replace_substring_regex(pc.ascii_lower(whole), _CLOSED, r"\1 \2\3")
            whole = pc.if_else(special, whole, lower) if pc.any(special).as_py() else lower
        split = pc.ascii_split_whitespace(whole)
        each = split.flatten().dictionary_encode()
        known = self._places(each.dictionary)
        # The end is one more part, after the last one of each text.
        counts = split.value_lengths().to_numpy()
        place = np.insert(known[each.indices.to_numpy()], np.cumsum(counts), len(self.parts))
        begin = np.append(self.starts[:-1], len(self.ids))[place]
        length = np.append(np.diff(self.starts), 1)[place]
        ends = np.cumsum(length)
        ids = np.append(self.ids, np.uint16(end))
        flat = ids[np.repeat(begin - ends + length, length) + np.arange(length.sum())]
        return flat, np.concatenate([[0], ends[np.cumsum(counts + 1) - 1]])


_TOGETHER = 1024
_TEXT_BYTES = 8_000_000
_CLOSING = b".,;:!?"
# Signs between a letter and a blank are a word of their own to the tokenizer.
_CLOSED = r"([a-z])([.,;:!?]+)(\s|$)"


def _is_word(part: bytes) -> bool:
    """Whether a part has letters only, which are composed and in lower case."""
    if part.isascii():
        return part.isalpha() and part.islower()
    try:
        text = part.decode()
    except UnicodeDecodeError:
        return False
    return text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text)


def _word_pairs(model: dict) -> tiktoken.Encoding | None:
    """A quicker encoder of lower-case words by the same byte pairs, if the model's allow it.

    Where every token's number is the rank of the merge that makes it, to merge the pair of the
    lowest token, as this encoder does, is to merge the pair of the first rule. The end of a word is
    a zero byte here, which no word has. Words' ids are compared with the tokenizer's in the tests.
    """
    vocabulary = model.get("vocab", {})
    plain = model.get("type") == "BPE" and model.get("end_of_word_suffix") == "</w>"
    if not plain or model.get("dropout") or model.get("ignore_merges") or model.get("byte_fallback"):
        return None
    made = [vocabulary.get("".join(pair)) for pair in model["merges"] if not isinstance(pair, str)]
    if len(made) != len(model["merges"]) or None in made or made != sorted(made):
        return None
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    ranks = {}
    for token in [*byte, *(c + "</w>" for c in byte), *("".join(pair) for pair in model["merges"])]:
        body = token.removesuffix("</w>")
        end = b"\0" if body != token else b""
        ranks[bytes(byte[c] for c in body) + end] = vocabulary[token]
    if len(ranks) != 2 * len(byte) + len(made):
        return None
    return tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def _encoder(path: str) -> _Encoder:
    """An encoder that the tasks of a worker hand on. What it remembers is bounded, and some tens of
    MB, as its parts are Arrow columns."""
    return _Encoder(path)


def _tokenised(docs: DataFrame, ident: str, text: str, tokenizer: str, end: int) -> DataFrame:
    """A written table: documents with their ids, and for each task how many have each token."""
    narrow = docs.select(F.col(ident).alias("id"), F.col(text).cast("binary").alias("text"))
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("id", narrow.schema["id"].dataType),
            T.StructField("ids", T.BinaryType()),
            T.StructField("have", T.ArrayType(T.IntegerType())),
        ]
    )

    def encode(batches):
        encoder = _encoder(tokenizer)
        numbers = itertools.count(TaskContext.get().partitionId() << 33)
        have = np.zeros(encoder.size, np.int32)
        for batch in batches:
            texts = batch.column(1)
            for low, high in pieces(flat_bytes(texts)[1], _TEXT_BYTES):
                flat, starts = encoder.encode(texts.slice(low, high - low), end)
                n = len(starts) - 1
                for first, last in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                    have[_distinct(flat[first:last])] += 1
                offsets = pa.py_buffer((2 * starts).astype(np.int32))
                ids = pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(itertools.islice(numbers, n)), pa.int64()),
                        batch.column(0).slice(low, n),
                        ids,
                        pa.nulls(n, pa.list_(pa.int32())),
                    ],
                    schema.names,
                )
            kind = batch.schema.field(0).type
        if have.any():
            counts = pa.ListArray.from_arrays(pa.array([0, len(have)], pa.int32()), pa.array(have))
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, kind), pa.nulls(1, pa.binary()), counts],
                schema.names,
            )

    return stored(narrow.mapInArrow(encode, schema), "packing-tokens", compression="zstd")


def _distinct(ids: np.ndarray) -> np.ndarray:
    ordered = np.sort(ids)
    fresh = np.ones(len(ordered), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    return ordered[fresh]


# ---------------------------------------------------------------------------- one shard


class _Index:
    """A BM25 inverted index of the documents of one shard."""

    def __init__(self, docs: list[np.ndarray], weight: np.ndarray, mean: float) -> None:
        terms, rows, counts = [], [], []
        for row, ids in enumerate(docs):
            ordered = np.sort(ids)
            first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            terms.append(ordered[first])
            counts.append(np.diff(np.append(first, len(ordered))))
            rows.append(np.full(len(first), row, np.int32))
        self.terms = terms
        self.weight = weight
        length = np.array([len(d) for d in docs], np.float32)
        self.size = len(docs)
        every, n = np.concatenate(terms), np.concatenate(counts).astype(np.float32)
        row = np.concatenate(rows)
        norm = K1 * (1 - B + B * length / max(mean, 1.0))
        impact = weight[every] * n * (K1 + 1) / (n + norm[row])
        order = np.argsort(every, kind="stable")
        self.row, self.impact = row[order], impact[order].astype(np.float64)
        self.start = np.searchsorted(every[order], np.arange(len(weight) + 1))

    def drop(self, unused: np.ndarray) -> None:
        """Takes the used documents out of the lists; the others keep their scores."""
        stays = unused[self.row]
        self.start = np.concatenate([[0], np.cumsum(stays)])[self.start]
        self.row, self.impact = self.row[stays], self.impact[stays]

    def scores(self, doc: int, words: int | None = None) -> np.ndarray:
        """BM25 of all documents for the terms of one of them, or for its ``words`` rarest ones."""
        terms = self.terms[doc].astype(np.int64)
        if words is not None and len(terms) > words:
            terms = terms[np.argsort(-self.weight[terms], kind="stable")[:words]]
        spans = [slice(self.start[t], self.start[t + 1]) for t in terms.tolist()]
        rows = np.concatenate([self.row[s] for s in spans])
        return np.bincount(rows, np.concatenate([self.impact[s] for s in spans]), self.size)


def _nearest(scores: np.ndarray, length: np.ndarray, room: int, several: int = 16) -> list[int]:
    """Documents of positive score, the best first, as many as fill ``room`` or all of them."""
    best = np.flatnonzero(scores > 0)
    while several < len(best):
        least = np.partition(scores, -several)[-several]
        some = np.flatnonzero(scores >= least)
        if length[some].sum() >= room:
            best = some
            break
        several *= 4
    return best[np.lexsort((best, -scores[best]))].tolist()


def pack_shard(
    docs: list[np.ndarray], weight: np.ndarray, mean: float, window: int, words: int | None = None
) -> list[tuple[int, int, int, int, int]]:
    """Pieces of a shard's documents: ``document, start, length, sequence, offset``.

    The first unused document is the seed of a window; the unused documents that it retrieves
    follow in the order of their BM25 score, for all distinct terms of the seed, until the window is
    full, and where none of positive score is left the next unused ones do. The document that does
    not fit is cut, and its rest opens the next window as its seed. So all windows but the last are
    full. Equal scores go by place.
    """
    index = _Index(docs, weight, mean)
    unused = np.ones(len(docs), bool)
    length = np.array([len(d) for d in docs], np.int64)
    pieces = []
    sequence, offset, following = 0, 0, 0
    queue: list[int] = []
    rest: tuple[int, int] | None = None
    remaining = listed = len(docs)
    while rest or remaining:
        if rest:
            doc, start = rest
        else:
            queue = [d for d in queue if unused[d]]
            if not queue:
                while not unused[following]:
                    following += 1
                queue = [following]
            doc, start = queue.pop(0), 0
            unused[doc] = False
            remaining -= 1
        take = min(int(length[doc]) - start, window - offset)
        if offset == 0 and remaining and take < window:
            # A new window: this document is its seed.
            if remaining < 0.8 * listed:
                index.drop(unused)
                listed = remaining
            found = index.scores(doc, words)
            found[~unused] = 0
            queue = _nearest(found, length, window - take)
        pieces.append((doc, start, take, sequence, offset))
        offset += take
        rest = (doc, start + take) if start + take < length[doc] else None
        if offset == window:
            sequence, offset, queue = sequence + 1, 0, []
    return pieces


# ---------------------------------------------------------------------------- all shards


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    ident: str = "doc_id",
    text: str = "text",
    end: int = 2,
    window: int = 4096,
    shard_tokens: int = 4_000_000,
    words: int | None = None,
    carry_ids: bool = False,
) -> DataFrame:
    """Sequences of at most ``window`` tokens: a row for each piece of a document.

    ``ident, start, length, ids_crc32, doc_tokens, sequence_id, offset``, and with ``carry_ids``
    the ids themselves as little-endian 32-bit numbers, ``ids``. Each document's token ids are those of ``tokenizer`` (a file of at most 65,536 tokens) and ``end``;
    every id is in one piece.

    Documents are dealt at random to shards of about ``shard_tokens`` tokens; each shard has its own
    inverted index and fills its windows by itself, so memory is bounded by the shard. A seed's
    neighbours are scored by all its distinct terms; ``words`` limits them to that many of the rarest. The
    terms' document frequencies and the mean length are those of all documents; they are sent
    to all tasks and bounded by the tokenizer's vocabulary. All sequences but the last of a shard are
    full. Null and empty texts are the end alone; rows that repeat an id are packed each, and a
    null id stays null. No documents give no sequences. Other columns are not read.
    """
    rows = _tokenised(docs, ident, text, tokenizer, end)
    total, count = rows.agg(
        F.coalesce(F.sum(F.length("ids") / 2), F.lit(0)).cast("long"), F.count("ids")
    ).first()
    parts = rows.filter("have IS NOT NULL").select(F.posexplode("have").alias("token", "n")).filter("n > 0")
    have = parts.groupBy("token").agg(F.sum("n").alias("n")).toArrow()
    shards = max(1, round(total / shard_tokens))
    token, n = have.column("token").to_numpy(), have.column("n").to_numpy()
    frequency = np.zeros(1 << 16)
    frequency[token] = n
    weight = np.log1p((count - frequency + 0.5) / (frequency + 0.5)).astype(np.float32)
    sent = SparkSession.getActiveSession().sparkContext.broadcast(weight)
    mean = total / max(count, 1)
    kind = rows.schema["id"].dataType
    schema = T.StructType(
        [
            T.StructField(ident, kind),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
        + [T.StructField("ids", T.BinaryType())] * carry_ids
    )

    def fill(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by("row")
        number = shard.column("shard")[0].as_py()
        tokens = [np.frombuffer(b, np.uint16) for b in shard.column("ids").to_pylist()]
        made = pack_shard(tokens, sent.value, mean, window, words)
        doc, start, length, sequence, offset = (np.array(c, np.int64) for c in zip(*made, strict=True))
        cuts = [tokens[d][s : s + n].astype("<u4").tobytes() for d, s, n, _, _ in made]
        sizes = np.array([len(t) for t in tokens], np.int64)
        ids = [pa.array(cuts, pa.binary())] * carry_ids
        return pa.Table.from_arrays(
            [
                shard.column("id").take(pa.array(doc)),
                pa.array(start),
                pa.array(length),
                pa.array([zlib.crc32(c) for c in cuts], pa.int64()),
                pa.array(sizes[doc]),
                pa.array(number * (1 << 32) + sequence),
                pa.array(offset),
                *ids,
            ],
            schema.names,
        )

    dealt = rows.filter("ids IS NOT NULL").select(
        "row", "id", "ids", F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard")
    )
    return dealt.groupBy("shard").applyInArrow(fill, schema)
