from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from kpiloom.llm import repeats
from tests.llm.conftest import documents, prose

SPACE = "\x20\x09-\x0d"


def units_of(text, unit):
    """(start, end, words) of every unit of a text."""
    if unit == "paragraph":
        spans, place, now = [], 0, None
        for raw in [*text.split("\n"), ""]:
            if re.search(f"[^{SPACE}]", raw):
                now = (now or (place, 0))[0], place + len(raw)
            elif now:
                spans, now = [*spans, now], None
            place += len(raw) + 1
        if now:
            spans.append(now)
    else:
        spans = [m.span() for m in re.finditer("[^\n]+", text)]
        if unit == "sentence":
            spans = [(a + m.start(), a + m.end()) for a, b in spans for m in re.finditer(rf".+?(?:[.!?](?=[{SPACE}])|$)", text[a:b], re.S)]
    out = []
    for a, b in spans:
        found = [(m.start() + a, m.end() + a, re.sub("[A-Z]", lambda x: x[0].lower(), m[0])) for m in re.finditer(f"[^{SPACE}]+", text[a:b])]
        if found:
            out.append((found[0][0], found[-1][1], [w for _, _, w in found]))
    return out


def brute(rows, unit, least):
    """(doc, unit, start, end, words, first doc, first unit, removed) of the runs that occur again, in one ordered pass."""
    seen = {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        own = units_of(text or "", unit)
        for n in range(len(own)):
            words, k = [], n
            while len(words) < least and k < len(own):
                words += own[k][2]
                k += 1
            if len(words) >= least:
                seen.setdefault(tuple(words), []).append((doc, n, own[n][0], own[k - 1][1], len(words)))
    return sorted((*place, *places[0][:2], place != places[0]) for places in seen.values() if len(places) > 1 for place in places)


@pytest.mark.parametrize(("unit", "least"), [("line", 5), ("line", 1), ("paragraph", 3), ("sentence", 1), ("sentence", 12)])
def test_runs_against_one_pass_in_order(spark, rng, unit, least):
    base = [prose(rng, rng.randint(1, 12)) + rng.choice(["", " É.", ".", "?!", " . ."]) for _ in range(15)]
    texts = []
    for _ in range(120):
        chosen = [rng.choice([str.upper, str, str])(rng.choice(base)).replace(" ", rng.choice([" ", "  ", "\t"])) for _ in range(rng.randint(0, 7))]
        texts.append(rng.choice(["", " ", "é\n"]) + "".join(c + rng.choice(["\n", "\n", " \r\n", "\n\n", "\n \n", " ", ". "]) for c in chosen))
    got = sorted(tuple(r) for r in repeats.occurrences(documents(spark, texts), unit, least).drop("key").collect())
    assert got == brute(list(enumerate(texts)), unit, least) and any(r[-1] for r in got)
    gone = sorted(tuple(r) for r in repeats.repeats(documents(spark, texts), unit, least).collect())
    assert gone == [r[:-1] for r in got if r[-1]]
    # What is left is the text without the removed stretches.
    left = {r.doc_id: r.text for r in repeats.without_repeats(documents(spark, texts), unit, least).collect()}
    for doc, text in enumerate(texts):
        cut = [any(r[0] == doc and r[2] <= k < r[3] for r in gone) for k in range(len(text))]
        assert left[doc] == "".join(c for c, x in zip(text, cut, strict=True) if not x)
    words = lambda some: {tuple(u[2]) for t in some for u in units_of(t, unit)}
    if unit == "line" and least == 1:
        assert words(left.values()) == words(texts)  # no line is lost everywhere


def test_nulls_repeated_rows_long_texts_clashing_columns_and_no_rows(spark, rng):
    long = prose(rng, 60_000)
    docs = documents(spark, [None, "", long, f"x\n {long}\nend", long, "\n\n"], ids=[1, 2, 3, 4, None, 5]).withColumns({"unit": F.lit("x"), "name": F.lit(1), "start": F.lit(0), "key": F.lit(2)})
    got = sorted((r.doc_id or 99, r.unit, r.start, r.first_doc_id) for r in repeats.repeats(docs, "line").collect())
    assert got == [(4, 1, 3, 3), (99, 0, 0, 3)]
    left = {r.doc_id: r for r in repeats.without_repeats(docs, "line").collect()}
    assert left[3].text == long and left[None].text == "" and left[1].text is None and left[4].unit == "x" and left[4].text == "x\n \nend"
    assert repeats.repeats(docs.limit(0)).collect() == [] and len(left) == 6


def test_rows_that_share_an_id_keep_their_own_text(spark, rng):
    passage, own, other = prose(rng, 55) + ".", prose(rng, 60) + ".", prose(rng, 70) + "."
    texts = [f"{passage}\n{prose(rng, 20)}", f"{passage}\n{own}", f"{other}\nand a line that occurs nowhere else\n{passage}", own, own]
    docs = documents(spark, texts, ids=[1, 3, 3, None, None])
    left = sorted(r.text.strip() for r in repeats.without_repeats(docs).collect())
    assert left == sorted([texts[0], own, f"{other}\nand a line that occurs nowhere else", "", ""])


def test_a_very_common_passage(spark, rng):
    """All documents share one passage: its runs are dealt to many parts, and all but one are removed."""
    passage = prose(rng, 60) + "."
    texts = [f"{prose(rng, 20)}.\n{passage}\n{prose(rng, 15)}" for _ in range(400)]
    got = repeats.repeats(documents(spark, texts)).collect()
    assert sorted(r.doc_id for r in got) == list(range(1, 400)) and {(r.first_doc_id, r.n_words) for r in got} == {(0, 60)}


def test_the_query_names_passages_over_several_lines(spark, rng, tmp_path):
    passage = [prose(rng, 20) for _ in range(4)]
    texts = [f"x\n{prose(rng, 8)}", "\n".join([prose(rng, 9), *passage]), f"{prose(rng, 70)}\nx\n \nX", "\n".join([*passage, "x", prose(rng, 9)])]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in repeats.query(spark, str(tmp_path)).collect())
    assert got == brute(list(enumerate(texts)), "sentence", repeats.PASSAGE_WORDS)
    assert [(r[0], r[1], r[4], r[-1]) for r in got] == [*((1, k, 40, False) for k in (1, 2, 3)), *((3, k, 40, True) for k in (0, 1, 2))]


def test_words_as_units_find_passages_inside_sentences_and_no_shorter_ones(spark, rng):
    passage, short, twice = prose(rng, 55).split(" "), prose(rng, 50), prose(rng, 60)
    shown = [" ".join(passage), " \n".join(passage).upper(), f"{' '.join(passage[:30])}.\n{' '.join(passage[30:])}"]
    texts = [*(f"{prose(rng, 12)} {x} {prose(rng, 9)}" for x in (*shown[:2], shown[2], short, short)), twice, prose(rng, 300), f"{prose(rng, 3)} {twice} {twice}", "", None]
    got = sorted(tuple(r) for r in repeats.occurrences(documents(spark, texts), "word", 51).drop("key").collect())
    words = [[(m.start(), m.end(), m[0].lower()) for m in re.finditer(f"[^{SPACE}]+", t or "")] for t in texts]
    seen = {}
    for doc, own in enumerate(words):
        for k in range(len(own) - 50):
            seen.setdefault(tuple(w for _, _, w in own[k:k + 51]), []).append((doc, k, own[k][0], own[k + 50][1], 51))
    assert got == sorted((*place, *places[0][:2], place != places[0]) for places in seen.values() if len(places) > 1 for place in places)
    # The third text has a point inside the passage, so that it shares no 51 words; 50 shared words are too few.
    assert {r[0] for r in got} == {0, 1, 5, 7} and not {r[0] for r in repeats.occurrences(documents(spark, texts)).collect()} >= {0, 1}
    left = {r.doc_id: r.text for r in repeats.without_repeats(documents(spark, texts), "word", 51).collect()}
    assert left[0] == texts[0] and left[3] == texts[3] and left[1] == texts[1].replace(shown[1], "") and left[7].split() == texts[7].split()[:3]
