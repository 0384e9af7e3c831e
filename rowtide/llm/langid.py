"""Language identification by compression with one dictionary for each language."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowtide.llm.common import stored, texts_of

UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_ASCII_LETTERS = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")


def fold(text: bytes) -> bytes:
    """Lower case, and each run of anything but letters as one blank."""
    return b" ".join(_words(text))


_TO_BLANK = bytes(
    c if c >= 128 or chr(c).isalpha() else 32 for c in range(256)
)


def _words(text: bytes) -> list[bytes]:
    return text.lower().translate(_TO_BLANK).split()


def has_letter(text: bytes) -> bool:
    """Whether any character is a letter of any script."""
    if not _ASCII_LETTERS.isdisjoint(text):
        return True
    return _LETTER.search(text.decode("utf-8", "replace")) is not None


@dataclass(frozen=True)
class LanguageModel:
    """For each language the raw content of its dictionary, and how texts are cut."""

    languages: tuple[str, ...]
    contents: tuple[bytes, ...]
    piece: int
    level: int
    margin: float

    def sizes(self, text: bytes) -> np.ndarray:
        """Bytes that the text takes with each dictionary, all pieces of it together."""
        folded = fold(text)
        total = np.zeros(len(self.languages))
        for low in range(0, max(len(folded), 1), self.piece):
            part = folded[low : low + self.piece]
            total += [len(c.compress(part)) - _FRAME for c in _compressors(self)]
        return np.maximum(total, 1)

    def decide(self, text: bytes | None) -> tuple[str, float, bool]:
        """Language, score and whether the margin is wide enough.

        The margin is by how much of its size the second best dictionary takes more than the best.
        The score grows with it, from 0 for no margin towards 1. Equal sizes go to the language that comes
        first by code point, and are rejected.
        """
        if not text or not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0, False
        sizes = self.sizes(text)
        best = int(sizes.argmin())
        if len(sizes) == 1:
            return self.languages[best], 1.0, True
        margin = float(np.partition(sizes, 1)[1] / sizes[best] - 1)
        return self.languages[best], margin / (margin + self.margin), margin >= self.margin

    def column(self, text: Column) -> Column:
        """A struct of ``lang, score, accepted`` for a text column."""
        sent = SparkSession.getActiveSession().sparkContext.broadcast(self)

        @F.arrow_udf("struct<lang: string, score: double, accepted: boolean>")
        def language(texts: pa.Array) -> pa.Array:
            model = sent.value
            found = [model.decide(value) for value in texts_of(texts)]
            lang, score, accepted = zip(*found, strict=True) if found else ((), (), ())
            return pa.StructArray.from_arrays(
                [
                    pa.array(lang, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(accepted, pa.bool_()),
                ],
                ["lang", "score", "accepted"],
            )

        return language(text.cast("binary"))


_FRAME = 6
_BROADCAST_ROWS = 200_000


@lru_cache(maxsize=2)
def _compressors(model: LanguageModel) -> list:
    """One compressor for each language, built once in a worker."""
    made = []
    for content in model.contents:
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        params = zstandard.ZstdCompressionParameters.from_level(
            model.level,
            write_checksum=False,
            write_content_size=False,
            write_dict_id=False,
        )
        data.precompute_compress(compression_params=params)
        made.append(zstandard.ZstdCompressor(dict_data=data, compression_params=params))
    return made


def fit_languages(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    per_language: int = 400,
    dictionary_bytes: int = 65_536,
    all_bytes: int = 8_388_608,
    piece: int = 2048,
    level: int = 6,
    margin: float = 0.01,
) -> LanguageModel:
    """Learns the dictionaries from the texts and languages of ``docs``.

    Every language is learned. The bound of the sample: at most ``per_language`` texts of each, chosen
    by a hash of the text, of which each gives an equal share of ``dictionary_bytes``, from a place that
    the hash says and not from its beginning, which many texts may share. All dictionaries together take at
    most ``all_bytes``: with very many languages each has less. Null languages and texts, and repeats of a
    text, teach nothing.
    """
    known = docs.select(
        F.col(lang).alias("lang"), F.col(text).cast("binary").alias("text")
    ).filter("lang IS NOT NULL AND length(text) > 0")
    hashed = stored(
        known.groupBy("lang", F.xxhash64("text").alias("order")).agg(F.count("*").alias("n")),
        "language-sample",
    )
    names = sorted((r.lang for r in hashed.select("lang").distinct().collect()), key=lambda s: s.encode())
    if not names:
        return LanguageModel((), (), piece, level, margin)
    dictionary_bytes = min(dictionary_bytes, max(all_bytes // len(names), 256))
    first = Window.partitionBy("lang").orderBy("order")
    chosen = hashed.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= per_language)
    picked = chosen.select("lang", "order")
    if len(names) * per_language <= _BROADCAST_ROWS:
        # So the texts are not shuffled; the number of rows is bounded by that of the languages.
        picked = F.broadcast(picked)
    longest = max(16 * dictionary_bytes // per_language, 64)
    spare = F.greatest(F.length("text") - longest, F.lit(0))
    start = F.pmod("order", spare + 1).cast("int")
    # A word that is cut at the place is left out.
    cut = F.when(start > 0, F.concat(F.lit(b"\0"), F.substring("text", start + 1, F.lit(longest)))).otherwise(
        F.substring("text", 1, longest)
    )
    rows = (
        known.withColumn("order", F.xxhash64("text"))
        .join(picked, ["lang", "order"])
        .groupBy("lang", "order")
        .agg(F.min(cut).alias("text"))
        .orderBy("lang", "order")
        .collect()
    )
    texts: dict[str, list[bytes]] = {name: [] for name in names}
    for row in rows:
        part = bytes(row.text)
        if part.startswith(b"\0"):
            part = part[1:].partition(b" ")[2]
        texts[row.lang].append(fold(part))
    contents = {name: _content(texts[name], dictionary_bytes) for name in names}
    kept = {name: content for name, content in contents.items() if len(content) >= 8}
    return LanguageModel(tuple(kept), tuple(kept.values()), piece, level, margin)


def _content(texts: list[bytes], limit: int) -> bytes:
    """The texts' beginnings in equal shares, repeats left out, up to the limit."""
    different = list(dict.fromkeys(t for t in texts if t))
    if not different:
        return b""
    share = max(limit // len(different), 1)
    short = sum(max(share - len(t), 0) for t in different)
    longer = sum(len(t) > share for t in different)
    share += short // max(longer, 1)
    return b" ".join(t[:share] for t in different)[:limit]


def identify_languages(docs: DataFrame, model: LanguageModel, *, text: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``lang_pred``, ``lang_score`` and ``lang_accepted``; none of an empty table,
    and rows that repeat are each told.

    Null texts and texts without a letter are ``und``, score 0, not accepted. Whole texts are
    compressed, cut into pieces so that a long text does not become its own dictionary. Columns
    of ``docs`` that are named like the results are replaced.
    """
    found = docs.withColumn("lang_pred", model.column(F.col(text)))
    return found.select(
        *(F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "lang_score", "lang_accepted")),
        F.col("lang_pred.lang").alias("lang_pred"),
        F.col("lang_pred.score").alias("lang_score"),
        F.col("lang_pred.accepted").alias("lang_accepted"),
    )
