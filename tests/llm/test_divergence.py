from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from kpiloom.llm import divergence
from tests.llm.conftest import DOCS, documents, prose


def brute(rows):
    """Every term of every source, with whole numbers without bounds."""
    count, spread, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))
        count[lang, source].update(found)
        spread[lang].update(set(found))
    out = []
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang, sources in groups.items():
        terms = [t for t, n in spread[lang].items() if n >= 10]
        whole = {s: sum(count[lang, s][t] for t in terms) for s in sources}
        p = lambda c, n: 1 + 10**9 * (c + 2) // (n + 2 * len(terms))  # noqa: B023, E731
        of = {s: {t: p(count[lang, s][t], whole[s]) for t in terms} for s in sources}
        all_of = {t: p(sum(count[lang, s][t] for s in sources), sum(whole.values())) for t in terms}
        for s in sources:
            pairs = sorted((-sum(f(of[s][t], of[o][t]) for t in terms), o.encode()) for o in sources - {s})
            own = sorted((-f(of[s][t], all_of[t]), t.encode()) for t in terms if count[lang, s][t] and of[s][t] > all_of[t])[:10]
            out += [(lang, s, part, item.decode(), -v, k) for part, found in (("pair", pairs), ("term", own)) for k, (v, item) in enumerate(found, 1)]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def corpus(rng):
    texts = [prose(rng, rng.randint(0, 60)).title() if rng.random() < 0.8 else rng.choice([None, "", "1 2 3", "Été ÉTÉ été über, Ünder", "a\x00b\x7fc d"]) for _ in range(400)]
    sources = [rng.choice(["s0", "s0", "s0", "s1", "s2", "é", None, ""]) for _ in texts]
    langs = [rng.choice(["en", "en", "fr", None]) for _ in texts]
    return texts + texts[:30], sources + ["s9"] * 30, langs + ["en"] * 30


def test_against_brute_force(spark, corpus):
    texts, sources, langs = corpus
    texts, sources, langs = [*texts, "word"], [*sources, "alone"], [*langs, "lonely"]
    found = rows_of(divergence.divergences(documents(spark, texts, sources, langs=langs)))
    assert found == brute(list(zip(texts, langs, sources, strict=True))) and any(r[2] == "term" for r in found) and any(r[2] == "pair" and r[4] for r in found)


def test_spills_tiles_and_long_texts(spark, corpus, monkeypatch):
    """Small bounds: many spills, buckets and tiles, texts cut in slices; the result is the same."""
    texts, sources, langs = corpus
    want = brute(list(zip(texts, langs, sources, strict=True)))
    monkeypatch.setattr(divergence, "BUCKET_STRIPES", 8)
    monkeypatch.setattr(divergence, "CELLS", 9)
    frame = documents(spark, texts, sources, langs=langs).repartition(7)
    assert rows_of(divergence.divergences(frame)) == want
    monkeypatch.setattr(divergence, "_SLICE", 10)
    monkeypatch.setattr(divergence, "SPILL_ENTRIES", 50)
    import pyarrow as pa

    own = [pa.record_batch({"lang": [x or "" for x in langs[k:k + 20]], "source": [x or "" for x in sources[k:k + 20]], "text": pa.array([(x or "").encode() for x in texts[k:k + 20]], pa.binary())}) for k in range(0, len(texts), 20)]
    small = list(divergence.folded(iter(own)))
    monkeypatch.undo()
    large = list(divergence.folded(iter(own)))
    assert len(small) > len(large)
    lines = lambda batches: pa.Table.from_batches(batches).sort_by([("lang", "ascending"), ("term", "ascending")])
    as_sets = lambda batches: [(r["lang"], r["term"], r["documents"], sorted(zip(r["sources"], r["counts"], strict=True))) for b in divergence.merged(iter(b for t in [lines(batches)] for b in t.to_batches(max_chunksize=13))) for r in b.to_pylist()]
    assert as_sets(small) == as_sets(large)


def test_cases_without_terms(spark):
    assert rows_of(divergence.divergences(documents(spark, []))) == []
    frame = documents(spark, [None, "few words"], ["a", None], langs=[None, ""])
    assert rows_of(divergence.divergences(frame)) == [("", "", "pair", "a", 0, 1), ("", "a", "pair", "", 0, 1)]
    wide = spark.createDataFrame([(1, "x", "en", "s", 1, "t", 5)] * 12, DOCS + ", term string, value long")
    assert rows_of(divergence.divergences(wide)) == []  # one source that is its language


def test_shares_are_exact():
    rng = np.random.default_rng(3)
    totals = rng.integers(1, 9 * 10**15, 2000)
    counts = (totals * rng.random(2000)).astype(np.int64)
    assert divergence.share(counts, totals).tolist() == [1 + 10**9 * int(c) // int(t) for c, t in zip(counts, totals, strict=True)]
    with pytest.raises(OverflowError):
        divergence.Tile("en", 0, [("a", 2**62, 1, True)])
