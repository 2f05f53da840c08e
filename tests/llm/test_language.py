import zlib

import numpy as np
import pytest
import regex

from flowtally.llm import language


@pytest.fixture(scope="module")
def model(documents):
    return language.fit(documents)


def fold(doc_id):
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % 4


def brute_counts(rows):
    counts = {}
    for lang, text in rows:
        for word in regex.findall(r"[\p{L}\p{M}]+", text.lower()):
            if len(word) > language.LONGEST_WORD:
                continue
            padded = f" {word} "
            grams = [(0, word)] + [(n, padded[i : i + n]) for n in range(1, 6) for i in range(len(padded) - n + 1)]
            for level, gram in grams:
                counts[(lang, level, gram)] = counts.get((lang, level, gram), 0) + 1
    return counts


def brute_score(text, counts, names, levels, totals, kinds):
    """Per language: words by interpolated log frequency, unseen ones by their longest known n-grams."""
    words = regex.findall(r"[\p{L}\p{M}]+", (text or "").lower())
    if not regex.search(r"\p{L}", text or ""):
        return "und", 0.0

    def log(lang, level, gram):
        over_all = sum(counts.get((x, level, gram), 0) for x in names) / sum(totals[x, level] for x in names)
        n, t = counts.get((lang, level, gram), 0), kinds[lang, level]
        return np.log((n + t * over_all) / (totals[lang, level] + t))

    rows = []
    for word in words:
        if word in levels[0]:
            rows.append([log(lang, 0, word) for lang in names])
            continue
        for n in range(5, 0, -1):
            known = [g for i in range(len(word) + 3 - n) if (g := f" {word} "[i : i + n]) in levels[n]]
            if known:
                rows.append([np.mean([log(lang, n, g) for g in known]) for lang in names])
                break
        else:
            rows.append([0.0 for _ in names])
    mean = np.mean(rows, axis=0)
    return names[int(mean.argmax())], float(1 / np.exp(mean - mean.max()).sum())


def test_equals_brute_force(documents, model):
    rows = documents.select("doc_id", "text", "lang").collect()
    counts = brute_counts([(r.lang, r.text) for r in rows if fold(r.doc_id) != 2])
    names = sorted({r.lang for r in rows if fold(r.doc_id) != 2})
    levels = [{g for (_, n, g) in counts if n == level} for level in range(6)]
    totals = {(lang, level): sum(c for (a, n, _), c in counts.items() if (a, n) == (lang, level)) for lang in names for level in range(6)}
    kinds = {(lang, level): sum((a, n) == (lang, level) for (a, n, _) in counts) for lang in names for level in range(6)}
    found = {r.doc_id: r for r in language.identified(documents, model).collect()}
    assert len(found) == len(rows)
    for r in rows[::7]:
        name, score = brute_score(r.text, counts, names, levels, totals, kinds)
        assert (found[r.doc_id].lang_pred, found[r.doc_id].held_out) == (name, fold(r.doc_id) == 2)
        assert found[r.doc_id].score == pytest.approx(score, abs=1e-9)


def test_held_out_accuracy(documents, model):
    truth = {r.doc_id: r.lang for r in documents.collect()}
    held = [r for r in language.identified(documents, model).collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.95


def test_bounds_cut_rare_entries(documents):
    small = language.fit(documents, sample=20, words=100, grams=50)
    size = len(small.languages)
    assert 0 < len(small.words) <= 100 * size
    assert all(len(k) <= 50 * size for k in small.gram_keys)
    assert all(len(level.gains) <= (50 if n else 100) * size for n, level in enumerate(small.levels))


def test_every_labelled_language_can_be_found(spark):
    """More languages than the model has rows of any one; each has words of its own."""
    signs = "abcdefghij"
    words = {n: [f"{signs[n % 10]}{signs[n // 10 % 10]}{signs[n // 100]}{w}" for w in ("ka", "lomi", "taru", "sen")] for n in range(130)}
    rows = [(4 * n + k, " ".join(words[n] * 3), f"l{n:03d}") for n in range(130) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert len(model.languages) == 130
    found = {(r.doc_id, r.lang_pred) for r in language.identified(docs, model).collect()}
    assert sum((i, lang) in found for i, _, lang in rows) > 0.95 * len(rows)


def test_a_language_with_few_labels_does_not_win_by_knowing_little(spark, documents):
    english = [(r.doc_id, r.text, "en") for r in documents.where("lang = 'en'").limit(100).collect()]
    few = [(10_000 + k, t, "sw") for k, t in enumerate(["habari ya asubuhi rafiki yangu", "karibu nyumbani kwetu leo jioni", "asante sana kwa chakula kizuri"])]
    model = language.fit(spark.createDataFrame(english + few, "doc_id long, text string, lang string"))
    assert model.languages == ["en", "sw"]
    probes = [t for _, t, _ in english] + ["Quantum chromodynamics explains hadronization", "habari yangu rafiki"]
    names = language.Scorer(model).predict(probes)[0]
    assert names[:-1] == ["en"] * (len(probes) - 1) and names[-1] == "sw"
    assert language.Scorer(model).predict(["ΩΨΞ"])[1][0] < 0.55  # known nowhere but for the blanks around it


def test_odd_rows(odd, odd_rows, model):
    found = sorted((tuple(r) for r in language.identified(odd, model).collect()), key=str)
    assert len(found) == len(odd_rows)
    unknown = {r[0] for r in found if r[2] == "und"}
    assert unknown == {1, 2, 3, 10}
    assert all(0 <= r[3] <= 1 for r in found)
    kept = language.keep_identified(odd, model)
    assert kept.schema == odd.schema
    assert {r.doc_id for r in kept.collect()} == {None, 5, 6, 7, 8, 9}


def test_empty_tables_and_no_labels(empty, odd, model):
    assert language.identified(empty, model).collect() == []
    nothing = language.fit(empty)
    assert {(r.lang_pred, r.score) for r in language.identified(odd, nothing).collect()} == {("und", 0.0)}
