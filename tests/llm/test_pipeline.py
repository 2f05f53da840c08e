import re

import xxhash

import corpus_pipeline
from flowtally.llm import exact_dedup, language, packing, simhash


def test_stages_apply_their_decisions(spark, folder, documents):
    docs, ids = documents, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.dtypes == documents.dtypes
        before, rows = {r.doc_id: r for r in docs.collect()}, kept.collect()
        assert all(tuple(before[r.doc_id]) == tuple(r) for r in rows)
        ids[name] = {r.doc_id for r in rows}
        if name == "language":
            model = language.fit(docs)
            found, least = language.identified(docs, model).collect(), corpus_pipeline.LEAST_LIFT / len(model.languages)
            assert ids[name] == {r.doc_id for r in found if r.lang_pred != "und" and r.score >= least}
        if name == "exact_dedup":
            assert ids[name] == {r.doc_id for r in exact_dedup.text_owners(docs).collect() if r.kept}
        if name == "near_dedup":
            assert ids[name] == {r.doc_id for r in simhash.near_groups(docs).collect() if r.doc_id == r.component_id}
        docs = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == ids["near_dedup"]
    assert max(r.bin_tokens for r in packed) <= packing.CAPACITY
    key = lambda r: (r.doc_id, r.piece)
    assert sorted(corpus_pipeline.run(spark, folder).collect(), key=key) == sorted(packed, key=key)


def test_odd_and_empty_tables(spark, folder, odd, empty):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).collect() == [], name
        rows = stage(spark, odd, folder)
        assert rows.count() > 0, name
        if name != "packing":
            assert rows.schema.names == odd.schema.names


def test_stages_are_those_of_the_contract():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "packing"]


def plain_components(docs):
    """Smallest id reachable over fingerprints of at most 4 differing bits, by comparing all pairs."""
    prints = [(i, fingerprint(t)) for i, t in docs]
    root = {i: i for i, _ in prints}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in prints:
        for j, y in prints:
            if i < j and (x ^ y).bit_count() <= 4:
                low, high = sorted((top(i), top(j)))
                root[high] = low
    return {i: top(i) for i in root}


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_whole_run_against_plain_loops(spark, folder, documents):
    """Which documents reach the bins: letters, then the first of equal texts, then the first of near ones."""
    docs = sorted((r.doc_id, r.text) for r in documents.collect())
    docs = [(i, t) for i, t in docs if any(c.isalpha() for c in t or "")]
    first = {}
    for i, t in docs:
        first.setdefault(t, i)
    docs = [(i, t) for i, t in docs if first[t] == i]
    near = plain_components(docs)
    want = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) + 1 for i, t in docs if near[i] == i}
    packed = corpus_pipeline.run(spark, folder).collect()
    found = {}
    for r in packed:
        found[r.doc_id] = found.get(r.doc_id, 0) + r.n_tokens
    assert found == want
    bins = {}
    for r in packed:
        bins.setdefault(r.bin_id, []).append(r)
    for rows in bins.values():
        assert sum(r.n_tokens for r in rows) == rows[0].bin_tokens <= packing.CAPACITY
        assert len({r.source for r in rows if r.source is not None}) == sum(r.source is not None for r in rows)
