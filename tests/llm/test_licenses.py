import pytest
import regex

from flowtally.llm import licenses


def words(text):
    return regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())


def runs(found):
    return [" ".join(found[i : i + 5]) for i in range(len(found) - 4)]


def brute(rows):
    out = {}
    for name, template in licenses.TEMPLATES.items():
        want = set(runs(words(template)))
        span = 1 << (len(want) - 1).bit_length()
        for doc_id, text in rows:
            found = runs(words(text))
            best = None
            for start in range(0, len(found), span):  # overlapping windows of two spans
                at = [i for i in range(start, min(start + 2 * span, len(found))) if found[i] in want]
                share = len({found[i] for i in at}) / len(want)
                if at and share >= 0.8 and (best is None or (-share, at[0]) < best[:2]):
                    best = (-share, at[0], at[-1] + 4)
            if best:
                out[(doc_id, name)] = (-best[0], best[1], best[2])
    return out


def found(df):
    return {(r.doc_id, r.template): (r.containment, r.first_word, r.last_word) for r in df.collect()}


def test_equals_brute_force(documents, texts):
    want = brute(list(texts.items()))
    assert want and found(licenses.scan(documents)) == want


def test_planted_notices(spark):
    filler = " ".join(f"filler{i}" for i in range(300))
    rows = []
    for i, (name, template) in enumerate(licenses.TEMPLATES.items()):
        rows.append((i, f"{filler} {template}. {filler}"))
        rows.append((100 + i, f"{filler} {' '.join(reversed(template.split()))} {filler}"))
    got = found(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute(rows)
    assert {(i, n) for i, n in enumerate(licenses.TEMPLATES)} <= set(got)
    assert not [k for k in got if k[0] >= 100]


def test_odd_rows(odd, spark):
    assert licenses.scan(odd).collect() == []
    more = spark.createDataFrame([(None, "Released under the MIT License."), (7, "released UNDER the\nmit   license"), (7, "released UNDER the\nmit   license")], "doc_id long, text string")
    assert set(found(licenses.scan(more))) == {(None, "MIT"), (7, "MIT")}


def test_rows_without_an_id_and_with_the_same_are_kept_apart(spark):
    """Two halves of a notice in two rows make no match, whatever their ids."""
    notice = licenses.TEMPLATES["Apache-2.0 notice"].split()
    halves = [" ".join(notice[:11]), " ".join(notice[11:])]
    rows = [(None, halves[0]), (None, halves[1]), (7, halves[0]), (7, halves[1]), (8, halves[0]), (9, halves[1])]
    assert licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect() == []
    whole = spark.createDataFrame([(None, " ".join(notice))] * 2 + [(7, " ".join(notice)), (7, "other text of five words")], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.template) for r in licenses.scan(whole).collect()) == [(False, "Apache-2.0 notice")] + [(True, "Apache-2.0 notice")] * 2


def test_full_texts_with_changes(spark):
    """Long texts with names filled in and lines lost are found; short notices inside them too."""
    rows, want = [], set()
    for i, name in enumerate(["BSD-3-Clause", "MIT full text", "Unlicense", "GPL-3.0 file header", "Zlib", "ISC"]):
        words_ = licenses.TEMPLATES[name].split()
        changed = [w for k, w in enumerate(words_) if not 40 <= k < 44]
        changed[10:10] = ["(c)", "2020", "Somebody"]
        rows.append((i, "intro words here " * 50 + " ".join(changed) + " and the code follows" * 30))
        want.add((i, name))
    got = found(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute(rows) and want <= set(got)
    assert (1, "Unlicense") not in got and (2, "MIT full text") not in got


def test_empty_tables_and_short_templates(empty, odd):
    assert licenses.scan(empty).collect() == []
    assert licenses.scan(odd, {}).collect() == []
    with pytest.raises(ValueError, match="less than 5 words"):
        licenses.scan(odd, {"short": "MIT License"})
