import random
import re

import pytest
from pyspark.sql import functions as F

from rowtide.llm.licenses import PHRASES, TEMPLATES, LicenseScanner, SuffixAutomaton, scan_licenses, words_of


def plain_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def places(text):
    words = plain_words(text)
    found = []
    for label, phrase in PHRASES:
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return found


@pytest.mark.parametrize("seed", range(6))
def test_the_automaton_knows_all_substrings_and_their_ends(seed):
    random.seed(seed)
    sequences = [[random.randrange(3) for _ in range(random.randint(0, 12))] for _ in range(4)]
    sequences.append(list(sequences[1]))
    automaton = SuffixAutomaton()
    for number, sequence in enumerate(sequences):
        automaton.add(number, sequence)
    automaton.close()
    ends = {}
    for number, s in enumerate(sequences):
        for i in range(len(s)):
            for j in range(i, len(s)):
                ends.setdefault(tuple(s[i : j + 1]), set()).add((number, j))
    strings = {(): 0}
    queue = [()]
    while queue:
        string = queue.pop()
        for symbol, state in automaton.step[strings[string]].items():
            strings[(*string, symbol)] = state
            queue.append((*string, symbol))
    assert set(strings) - {()} == set(ends)
    assert all(automaton.ends[strings[s]] == e for s, e in ends.items())


def test_phrases_equal_a_plain_search(documents):
    random.seed(1)
    vocabulary = "mit license apache general public MIT the gnu, é License".split()
    texts = [r.text for r in documents.collect()]
    texts += [" ".join(random.choices(vocabulary, k=random.randint(0, 60))) for _ in range(500)]
    texts += ["MIT\nLicense mit-license", "mitlicense", "general public license license", "émit license"]
    scanner = LicenseScanner()
    for text in texts:
        found, expected = scanner.scan(text.encode()), places(text)
        assert found["n_words"] == len(plain_words(text)) == len(words_of(text.encode()))
        assert found["n_base"] == len(expected)
        starts = [i for i, _ in expected]
        assert found["first_word"] == min(starts, default=None)
        assert found["last_word"] == max(starts, default=None)
        assert found["base_labels"] == ",".join(sorted({label for _, label in expected}))
        assert set(found["base_labels"].split(",")) <= {*found["labels"].split(","), ""}
        assert 0 <= found["score"] <= 1 and (found["score"] == 1 or not expected)


@pytest.mark.parametrize(("label", "text"), TEMPLATES)
def test_each_template_is_covered_whole_and_with_changes(label, text):
    scanner = LicenseScanner()
    around = f"some words before {text} and some words after"
    span = next(s for s in scanner.scan(around.encode())["spans"] if s["label"] == label)
    assert (span["start"], span["end"], span["covered"]) == (3, 3 + len(words_of(text.encode())), 1.0)
    words = text.split()
    if len(words) > 20:
        words[10:11] = ["quite", "another", "thing"]
        changed = scanner.scan(" ".join(words).encode())
        span = next(s for s in changed["spans"] if s["label"] == label)
        assert 0.6 <= span["covered"] < 1 and span["end"] == changed["n_words"]


def test_a_template_is_found_inside_a_match_of_another():
    scanner = LicenseScanner()
    short, notice = dict(TEMPLATES)["apache-short"], dict(TEMPLATES)["apache-notice"]
    found = scanner.scan(f"{short}. The code is big".encode())
    assert found["labels"] == "apache,apache-short"
    assert [(s["label"], s["start"], s["end"], s["covered"]) for s in found["spans"]] == [("apache-short", 0, 8, 1.0)]
    spans = scanner.scan(notice.encode())["spans"]
    assert [(s["label"], s["start"], s["end"]) for s in spans] == [("apache-short", 0, 8), ("apache-notice", 0, 31)]


@pytest.mark.parametrize("seed", range(5))
def test_matches_of_each_template_equal_a_plain_search(seed):
    random.seed(seed)
    templates = [[random.choice("abcd") for _ in range(random.randint(3, 15))] for _ in range(4)]
    scanner = LicenseScanner((), tuple((str(i), " ".join(t)) for i, t in enumerate(templates)))
    text = [w for _ in range(30) for w in random.choice([random.choice(templates), random.choices("abcd", k=4)])]

    def places(template, words):
        return tuple(e for e in range(len(template)) if template[max(e - len(words) + 1, 0) : e + 1] == words)

    expected = []
    for end in range(len(text)):
        for number, template in enumerate(templates):
            fits = [b for b in range(end + 1) if places(template, text[b : end + 1])]
            more = fits and end + 1 < len(text) and places(template, text[fits[0] : end + 2])
            if fits and end + 1 - fits[0] >= scanner.shortest and not more:
                expected.append((number, fits[0], end + 1 - fits[0], places(template, text[fits[0] : end + 1])))
    numbers, automaton, complete, inside, _ = scanner._index
    matches = []
    scanner._walk([numbers[w.encode()] for w in text], 0, automaton, complete, inside, [], matches)
    assert sorted(matches) == sorted(expected)


def test_an_overlapping_match_does_not_end_a_span():
    # After the change, "c d b" repeats words of the template and overlaps the first match.
    scanner = LicenseScanner((), (("t", "c d b x y a b c d e f g h"),))
    spans = scanner.scan(b"x y a b c d b e f g h")["spans"]
    assert [(s["label"], s["start"], s["end"]) for s in spans] == [("t", 0, 11)]


def test_clean_texts_have_no_labels():
    scanner = LicenseScanner()
    text = "The software runs on any computer and a copy of the file is on the disk. All rights are hers."
    assert scanner.scan(text.encode())["labels"] == ""
    assert scanner.scan(b"the above the following the conditions of the software")["score"] == 0


def test_odd_rows(odd_docs, no_docs):
    found = scan_licenses(odd_docs)
    assert found.columns == odd_docs.columns
    rows = found.collect()
    assert len(rows) == odd_docs.count()
    empty = [r.licenses for r in rows if not (r.text or "").strip()]
    assert len(empty) == 4
    for r in empty:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.labels, r.score) == (0, 0, None, None, "", 0.0)
    assert scan_licenses(no_docs).count() == 0
    long = odd_docs.filter("doc_id = 6").select(F.concat("text", F.lit(" MIT License")).alias("text"))
    r = scan_licenses(long).first().licenses
    assert (r.n_base, r.first_word, r.n_words) == (1, 240_000, 240_002)
