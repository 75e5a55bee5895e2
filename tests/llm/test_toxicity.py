from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from kpiloom.llm import toxicity
from kpiloom.llm.common import table
from tests.llm.conftest import documents, prose


def score(words: str) -> float:
    order = {w: c for c, names in toxicity.SEEDS.items() for w in names.split()}
    classes = [toxicity.CLASSES.index(order.get(w, "other")) for w in words.split()]
    return sum(toxicity.contributions(classes, [1.0] * len(classes)))


def test_the_composed_grammar_scores_clauses():
    plain = score("what an idiot")
    assert plain == 1.0 and score("a plain clause about you") == 0.0
    assert score("you are an idiot") == 1.5 and score("i will hurt you") == 2.0 and score("you i will hurt") == 2.0
    assert score("not an idiot") == pytest.approx(0.2)
    assert score("not a b c d idiot") == plain  # beyond what a negation covers
    assert score("he said idiot") == pytest.approx(0.5) and score("he said not an idiot") < 0.5


def test_a_negation_in_another_clause_covers_nothing():
    g = toxicity.made({})
    import pyarrow as pa

    x = g.features(pa.array(["not. idiot", "not idiot", "idiot idiot. idiot", "", None, "IDIOT"]))
    assert x[0, 0] == toxicity.SEED_WEIGHT and x[1, 0] == pytest.approx(toxicity.SEED_WEIGHT / 5)
    assert x[2, 0] == x[5, 0] == toxicity.SEED_WEIGHT and not x[3, :3].any() and not x[4, :3].any()


def test_learns_words_and_leaves_held_out_rows_alone(spark, rng):
    bad = ["zorkum", "zorkel", "zorkish", "fleem"]
    texts, toxic = [], []
    for _ in range(500):
        words = prose(rng, 60).split(" ")
        toxic.append(int(rng.random() < 0.2))
        for _ in range(4 * toxic[-1]):
            words[rng.randrange(60)] = rng.choice(bad)
        texts.append(" ".join(words))
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.scored(docs, labels).collect()}
    hidden = [i for i in range(500) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((out[i].score >= 0.7) == bool(toxic[i]) for i in hidden) >= 0.97 * len(hidden)
    assert out[0].text == texts[0] and out[0].source == "s"
    # Labels of held-out rows change nothing.
    flipped = spark.createDataFrame([(i, 1, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, t in enumerate(toxic)], labels.schema)
    assert {r.doc_id: r.score for r in toxicity.scored(docs, flipped).collect()} == {i: r.score for i, r in out.items()}
    assert sorted(r.doc_id for r in toxicity.without_toxic(docs, labels).collect()) == sorted(i for i, r in out.items() if r.score < 0.7)


def test_nulls_ties_clashing_columns_and_no_rows(spark, rng):
    docs = documents(spark, [None, "", "idiot " * 40_000, "you idiot. you moron. scum", "x"], ids=[1, None, 3, 3, 4])
    docs = docs.withColumns({"score": F.lit("mine"), "toxic": F.lit(1), "fold": F.lit(1)})
    labels = spark.createDataFrame([(3, None, 1), (3, 1, 0), (None, 1, 1), (4, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.scored(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.scored(docs.limit(0), labels).collect() == []
    assert len(toxicity.scored(docs, labels.limit(0)).collect()) == 5
    assert "score" in toxicity.without_toxic(docs, labels).columns


def test_query_on_the_small_table(spark):
    d = "/root/testdata/sf0.01"
    out = toxicity.query(spark, d)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in out.collect()}
    labels = {r.doc_id: r.toxic for r in table(spark, d, "labels").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) for i, r in rows.items())
    hidden = [i for i in labels if rows[i].held_out]
    caught = [rows[i].predicted for i in hidden if labels[i]]
    assert sum(caught) >= 0.6 * len(caught) and sum(rows[i].predicted for i in hidden if not labels[i]) <= 2
