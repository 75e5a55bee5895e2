from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from kpiloom.llm import phrases
from tests.llm.conftest import DOCS, documents, prose


def brute(rows, least, top):
    """All phrases of every piece, counted one by one."""
    count, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda x: x[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            count[lang].update(tuple(w[i:i + k]) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    out = []
    for lang, f in count.items():
        found = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        rank = []
        for p, a in found.items():
            if any(len(o) > len(p) and 100 * b >= 80 * a and any(o[i:i + len(p)] == p for i in range(len(o))) for o, b in found.items()):
                continue
            score, cut = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            rank.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        out += [(lang, k, p.decode(), -a, x, y, total[lang], -s) for k, (s, a, p, x, y) in enumerate(sorted(rank)[:top], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def corpus(rng):
    fixed = ["in order to form", "New York City", "as a matter of fact", "of the of the of the of the", "über allen Gipfeln"]
    word = lambda: rng.choice(["the", "of", "a", "in", "York", "to", "x", "é", prose(rng, 1)])
    text = lambda: "".join(rng.choice([word(), word(), word(), rng.choice(fixed)]) + rng.choice([" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!?"]) for _ in range(rng.randint(0, 60)))
    texts = [text() if rng.random() < 0.9 else rng.choice([None, "", " ", "...", "the of the of the of", "a b c\x00d"]) for _ in range(300)]
    return texts, [rng.choice(["en", "en", "", None]) for _ in texts]


@pytest.mark.parametrize("least, top", [(30, 2000), (5, 12), (1, 50)])
def test_against_brute_force(spark, corpus, least, top):
    texts, langs = corpus
    if least == 1:
        texts, langs = texts[:25], langs[:25]
    found = rows_of(phrases.collocations(documents(spark, texts, langs=langs).repartition(5), least, top))
    assert found == brute(list(zip(texts, langs, strict=True)), least, top) and found


def test_sieve_loses_no_phrase(spark, corpus, monkeypatch):
    """A sieve of 64 buckets lets nearly all through: the result is the same."""
    texts, langs = corpus
    frame = documents(spark, texts, langs=langs)
    want = rows_of(phrases.phrase_counts(frame, 7))
    monkeypatch.setattr(phrases, "MOST_BITS", 6)
    assert rows_of(phrases.phrase_counts(frame, 7)) == want
    buckets = np.random.default_rng(1).integers(0, 1 << 20, 50_000).astype(np.uint32)
    buckets[:9000] = 77
    monkeypatch.undo()
    batch = phrases.packed(buckets.copy(), 40)
    got = {}
    for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
        places, n = phrases.unpacked(counts)
        got |= {(block << 16) + int(p): int(c) for p, c in zip(places, n, strict=True)}
    assert got == {k: min(n, 40) for k, n in Counter(buckets.tolist()).items()}


def test_rare_prefixes_are_padded(spark):
    """Only one row leaves a task for all windows that cannot become phrases."""
    texts = [f"w{k} v{k} u{k}" for k in range(2000)] + ["so it goes on"] * 40
    rows = phrases.windows(documents(spark, texts, langs=["en"] * len(texts)).select("lang", "text").coalesce(1)).collect()
    assert sum(r.n for r in rows) == 6160 and {(r.w1, r.w2, r.w3, r.w4) for r in rows} >= {("so", "it", "goes", "on"), ("on", "", "", ""), ("", "", "", "")} and len(rows) < 20


def test_empty_long_and_other_columns(spark):
    assert rows_of(phrases.collocations(documents(spark, []))) == []
    assert rows_of(phrases.collocations(documents(spark, [None, "", " . "]))) == []
    frame = spark.createDataFrame([(1, "Big Data " * 20_000, "en", "s", 1, "p", 2)], DOCS + ", phrase string, n long")
    assert rows_of(phrases.collocations(frame)) == brute([("Big Data " * 20_000, "en")], 30, 2000)
    with pytest.raises(ValueError):
        phrases.phrase_counts(frame, 0)
