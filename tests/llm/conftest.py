from __future__ import annotations

import random

import pytest

VOWELS = ["the", "and", "of", "ther", "in", "ation", "ble", "or", "ti", "sh", "ed", "er", "re", "on", "ha"]


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice(VOWELS) for _ in range(rng.randint(1, 3))) for _ in range(words))


def edited(rng: random.Random, text: str, edits: int) -> str:
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = prose(rng, 1)
    return " ".join(words)


@pytest.fixture
def rng() -> random.Random:
    return random.Random(7)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, sources=None, ids=None, langs=None):
    rows = [(i if ids is None else ids[i], t, "en" if langs is None else langs[i], "s" if sources is None else sources[i], None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)
