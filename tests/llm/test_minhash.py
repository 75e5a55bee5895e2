from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kpiloom.llm import minhash
from kpiloom.llm.words import shingle_sets
from tests.llm.conftest import documents, edited, prose


def words(text):
    return re.findall(mixed_word, (text or "").translate({c: c + 32 for c in range(65, 91)}))


mixed_word = r"[^\x20\x09-\x0D]+"


def shingles(text, width=4):
    w = words(text)
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def brute(rows):
    """rows: (doc_id, text). Component by doc_id, links on exact sets."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and root(i) != root(j):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {i: (len(s), root(i)) for i, s in sets}


def test_components_against_all_pairs(spark, rng):
    texts = []
    for _ in range(25):
        base = prose(rng, rng.choice([6, 30, 120, 400]))
        texts += [base] + [edited(rng, base, rng.randint(0, 6)) for _ in range(rng.randint(0, 9))]
    chain = prose(rng, 200).split(" ")
    texts += [" ".join(chain[4 * k:] + [f"n{k}x{i}" for i in range(4 * k)]) for k in range(12)]
    texts += ["", None, "one", "ONE", "one two three", " \t one\x0btwo three\n", "İ two É é"] + [prose(rng, 50) for _ in range(40)]
    rng.shuffle(texts)
    want = brute(list(enumerate(texts)))
    got = {r.doc_id: r for r in minhash.near_duplicates(documents(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, (n, component) in want.items():
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (n, component, component == i), texts[i]


def test_a_large_group_of_near_copies_whose_text_is_not_first(spark, rng, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_BYTES", 1 << 14)
    base = prose(rng, 300)
    texts = [edited(rng, base, 12) for _ in range(150)] + [base]
    want = brute(list(enumerate(texts)))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(spark, texts)).collect()}
    assert got == {i: c for i, (_, c) in want.items()}


def test_nulls_repeated_rows_and_no_rows(spark, rng):
    text = prose(rng, 60)
    docs = documents(spark, [text, text, text, None, prose(rng, 40)], ids=[5, 5, None, 7, 5]).withColumns({"node": F.lit(1), "digest": F.lit("x"), "keys": F.lit(0)})
    got = sorted(minhash.near_duplicates(docs).collect(), key=lambda r: (r.doc_id or 0, r.n_shingles))
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == [(None, 5, None), (5, 5, True), (5, 5, True), (5, 5, True), (7, 7, True)]
    assert minhash.near_duplicates(docs.limit(0)).collect() == []


def test_shingles_do_not_depend_on_the_blocks(rng):
    texts = [prose(rng, rng.randint(0, 30)) for _ in range(50)] + [prose(rng, 200_000), "", "A b"]
    apart = [next(shingle_sets(pa.array([t]), 4))[2][0] for t in texts]
    together = [s for _, _, sets in shingle_sets(pa.array(texts), 4) for s in sets]
    assert all(np.array_equal(a, b) for a, b in zip(apart, together, strict=True))
    assert [len(s) for s in together] == [len(shingles(t)) for t in texts]


def test_signature_values_agree_as_often_as_the_sets(rng):
    a = np.unique(np.random.default_rng(1).integers(0, 2**64, 3000, np.uint64))
    both = minhash.min_max([a[:2400], a[600:]])
    assert abs((both[:, 0] == both[:, 1]).mean() - 0.6) < 0.15


def test_blocks_of_differences_give_the_exact_links(rng):
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(f"v{rng.random()}" if rng.random() < rate else w for w in base) for rate in [0, *[rng.choice([0.02, 0.05, 0.08]) for _ in range(40)]]]
    texts += [" ".join(texts[k].split(" ")[:-3]) for k in range(5, 12)]
    sets = [s for _, _, got in shingle_sets(pa.array(texts), 4) for s in got]
    pack = {"b": list(range(1, len(texts))), "near": [False] * (len(texts) - 1), "size": [len(s) for s in sets[1:]], "apart": [np.setxor1d(sets[0], s).tobytes() for s in sets[1:]]}
    found = minhash.block_links(pack, pack, 80)
    parent = {i: i for i in pack["b"]}
    for a, b in found:
        assert len(np.intersect1d(sets[a], sets[b])) * 100 >= 80 * len(np.union1d(sets[a], sets[b]))
        low, high = sorted((parent[a], parent[b]))
        parent = {i: low if p == high else p for i, p in parent.items()}
    for a in pack["b"]:
        for b in pack["b"]:
            if len(np.intersect1d(sets[a], sets[b])) * 100 >= 80 * len(np.union1d(sets[a], sets[b])):
                assert parent[a] == parent[b]
    assert 0 < len(found) < len(texts)


def test_exactly_one_row_of_a_group_stays(spark, rng):
    """Ids that repeat, are null, or belong to different texts: rows are judged one by one."""
    copy, own, other = (prose(rng, 60) for _ in range(3))
    near = copy + " end"
    docs = documents(spark, [copy, near, own, copy, copy, own, other, other, None, ""], ids=[7, 5, 5, 5, None, None, None, None, 5, 5])
    left = sorted((r.doc_id or 0, r.text or "") for r in minhash.without_copies(docs).collect())
    assert [t for _, t in left if t in (copy, near)] in ([copy], [near]) and (5, own) in left
    assert [d for d, t in left if t == own] == [5] and [d for d, t in left if t == other] == [0]
    assert left.count((5, "")) == 2  # without words there are no copies


def test_equal_rows_leave_one_whatever_their_other_columns(spark, rng):
    text = prose(rng, 30)
    docs = documents(spark, [text, text, text], ["a", "b", "b"], ids=[1, 1, 1])
    assert minhash.without_copies(docs).count() == 1
    assert minhash.without_copies(docs).columns == docs.columns
