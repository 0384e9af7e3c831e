import random
import zlib

from rowtide.llm import queries
from rowtide.llm.langid import LanguageModel, _compressors, fit_languages, fold, has_letter, identify_languages


def test_folding_and_letters():
    assert fold(b"The  HOUSE, 12 x-y!\n") == b"the house x y"
    assert fold("Été déjà".encode()) == "Été déjà".encode().lower()
    assert has_letter("ж".encode()) and has_letter(b"1a") and not has_letter("12 – !! ٣".encode())


def test_sizes_are_those_of_whole_texts_in_pieces():
    contents = (b"the house and the river " * 20, b"la maison et la riviere " * 20)
    model = LanguageModel(("en", "fr"), contents, 64, 3, 0.01)
    text = b"the house by the river is old and " * 30
    sizes = model.sizes(text)
    for size, packer in zip(sizes, _compressors(model), strict=True):
        folded = fold(text)
        parts = [folded[i : i + 64] for i in range(0, len(folded), 64)]
        assert b"".join(parts) == folded
        assert size == sum(len(packer.compress(p)) - 6 for p in parts)
    assert model.decide(text)[0] == "en" and model.decide(text)[2]


def test_ties_and_narrow_margins():
    model = LanguageModel(("aa", "bb"), (b"same content here",) * 2, 2048, 3, 0.01)
    assert model.decide(b"anything at all") == ("aa", 0.0, False)
    assert model.decide(None) == model.decide(b"12 34") == ("und", 0.0, False)
    assert LanguageModel(("aa",), (b"same content here",), 2048, 3, 0.01).decide(b"x") == ("aa", 1.0, True)
    assert LanguageModel((), (), 2048, 3, 0.01).decide(b"x") == ("und", 0.0, False)


def test_held_out_accuracy(spark):
    got = queries.op5_language(spark, "/root/testdata/sf0.01").toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    held = got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    assert (held == got.held_out).all()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas()
    known = got[got.held_out].merge(docs, on="doc_id")
    assert (known.lang_pred == known.lang).mean() > 0.95
    assert known.accepted.mean() > 0.97
    assert set(got.lang_pred) <= set(docs.lang) | {"und"}


def test_odd_rows(odd_docs, no_docs):
    model = fit_languages(odd_docs)
    assert set(model.languages) == {"en", "fr"}
    found = identify_languages(odd_docs, model)
    assert set(found.columns) == set(odd_docs.columns) | {"lang_score", "lang_accepted"}
    rows = found.collect()
    assert len(rows) == odd_docs.count()
    und = [r for r in rows if r.lang_pred == "und"]
    assert {r.lang_score for r in und} == {0.0} and not any(r.lang_accepted for r in und)
    assert sorted(str(r.doc_id) for r in und) == ["3", "4", "5", "7", "None"]
    assert [r.lang_pred for r in rows if r.doc_id in (6, 9)] == ["en", "fr"]
    assert identify_languages(no_docs, model).count() == 0
    untaught = identify_languages(odd_docs, fit_languages(no_docs))
    assert {r.lang_pred for r in untaught.collect()} == {"und"}


def test_repeats_of_a_text_teach_once(spark):
    rows = [("the same words over and over again", "en")] * 50 + [("le renard brun et le chien noir", "fr")]
    model = fit_languages(spark.createDataFrame(rows, "text string, lang string"))
    assert model.contents == (b"the same words over and over again", b"le renard brun et le chien noir")


def invented(seed, n, words=60):
    """Texts in an invented language."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzéßñ", k=rng.randint(2, 8))) for _ in range(words)]
    return [" ".join(rng.choices(vocabulary, k=80)) for _ in range(n)]


def test_every_language_is_learned(spark):
    rows = [(t, f"l{n}") for n in range(100) for t in invented(n, 4)]
    learned = [r for i, r in enumerate(rows) if i % 4]
    model = fit_languages(spark.createDataFrame(learned, "text string, lang string"), all_bytes=200_000)
    assert len(model.languages) == 100 and sum(map(len, model.contents)) <= 200_000
    held = [r for i, r in enumerate(rows) if i % 4 == 0]
    found = identify_languages(spark.createDataFrame(held, "text string, lang string"), model).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 98


def test_what_all_texts_begin_with_does_not_fill_the_dictionaries(spark):
    notice = "the same long notice stands before every text here whatever it is in " * 60
    rows = [(notice + t, lang) for n, lang in enumerate(("aa", "bb")) for t in invented(n, 150, words=400)]
    rows = [(f"{i} {t * 3}", lang) for i, (t, lang) in enumerate(rows)]
    model = fit_languages(spark.createDataFrame(rows, "text string, lang string"), dictionary_bytes=16_384)
    shared = [c.count(b"notice stands") / len(c) for c in model.contents]
    assert max(shared) < 0.9 / len("the same long notice stands before every text here whatever it is in ")
    held = [(t, lang) for n, lang in enumerate(("aa", "bb")) for t in invented(n, 200, words=400)[150:]]
    found = identify_languages(spark.createDataFrame(held, "text string, lang string"), model).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 95
