"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become classes: insult, threat, target, negation, report (of speech),
other. Three transducers rewrite a clause's classes from left to right: one
marks what a negation covers, one marks what is reported speech, one marks
insults and threats that are aimed at a target, before or after it. A fourth
gives every marked class a factor. They are composed once into one table, and
along a clause's path every insult or threat contributes factor times weight.
Clauses without one are never run; a word that a text repeats contributes once.

Insults come from a short seed list and from labelled rows: words and word
beginnings whose log-odds of toxic against clean rows are high even at the
lower end of their error. A logistic curve over the clauses' sum, their
largest score, both by length, gives the score; it is fitted on rows whose
fold the words were not learnt from. Both fits see at most ``TOXIC_ROWS`` and
``CLEAN_ROWS`` labelled rows, by the order of a hash of doc_id; the words are
at most ``LEXICON``. Held-out rows (crc32(doc_id) mod 3 = 1) are in no fit.

Defined results: null and empty texts score like a text without matches;
rows with a null doc_id are not held out and never learnt from; rows that
repeat a doc_id are scored each; labels that are null or neither 0 nor 1 are not learnt from; without labelled rows of both
kinds the seed list and a fixed curve are used; an empty table gives an empty
result. Other columns are ignored, or passed on by ``scored``.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.llm.common import in_arrow, table, utf8_parts, written
from kpiloom.llm.words import running, span_hashes, word_spans

TOXIC_ROWS, CLEAN_ROWS = 4000, 8000
LEXICON = 20_000
LEAST_ODDS = 1.5
FOLDS = 3
RIDGE = 0.05
PREFIXES = (4, 5, 6)  # bytes of word beginnings
THRESHOLD = 0.7
# --- Fixed values: seed words by class (English, German, French, Spanish) ---
SEEDS = {
    "insult": "idiot moron stupid worthless scum loser pathetic trash idiotin dumm imbécile idiote estúpido idiota",
    "threat": "kill hurt destroy töten tuer matar",
    "target": "you your yourself he she they them du dich ihr sie tu toi vous te usted ustedes él ellos",
    "negation": "not no never isn't aren't don't nicht kein keine nie ne pas jamais nunca",
    "report": "said says wrote claimed quoted sagte schrieb dit écrit dijo escribió",
}
SEED_WEIGHT = 3.0
# --- end of fixed values ---
CLASSES = ("other", *SEEDS, "end")
_BETWEEN = np.ones(256, bool)  # words are runs of letters, digits, apostrophes and non-ASCII characters
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), 39, *range(128, 256)]] = False
_STOP = np.zeros(256, bool)
_STOP[[10, 33, 34, 40, 41, 46, 58, 59, 63]] = True  # clause ends
NEGATED_WORDS = 4  # words after a negation that it covers


# A transducer: (state, symbol) -> (next state, output symbol); a symbol that has no entry is passed on, the state kept.
Transducer = dict[tuple[object, str], tuple[object, str]]


def negation() -> Transducer:
    rules: Transducer = {}
    for left in range(NEGATED_WORDS + 1):
        for one in ("other", "target", "report"):
            rules[left, one] = (max(left - 1, 0), one)
        for one in ("insult", "threat"):
            rules[left, one] = (max(left - 1, 0), f"not-{one}" if left else one)
        rules[left, "negation"] = (NEGATED_WORDS, "other")
        rules[left, "end"] = (0, "end")
    return rules


def reported() -> Transducer:
    rules: Transducer = {(0, "report"): (1, "other"), (1, "report"): (1, "other"), (1, "end"): (0, "end")}
    return rules | {(1, f"{no}{one}"): (1, f"said-{no}{one}") for no in ("", "not-") for one in ("insult", "threat")}


def aimed() -> Transducer:
    """States: nothing yet, a target was seen, an insult or threat was seen, both."""
    rules: Transducer = {("", "target"): ("target", "other"), ("target", "target"): ("target", "other"), ("both", "target"): ("both", "other"),
                         ("attack", "target"): ("both", "late-target")}
    for one in ("insult", "threat"):
        rules |= {("", one): ("attack", one), ("attack", one): ("attack", one), ("target", one): ("both", f"aimed-{one}"), ("both", one): ("both", f"aimed-{one}")}
    return rules | {(state, "end"): ("", "end") for state in ("target", "attack", "both")}


FACTORS = {"insult": 1.0, "threat": 1.0, "aimed-insult": 1.5, "aimed-threat": 2.0, "not-insult": 0.2, "not-threat": 0.2, "said-insult": 0.5, "said-threat": 0.5,
           "said-not-insult": 0.1, "said-not-threat": 0.1}
LATE_TARGET = 1.0  # added when a target follows what is aimed at it


def composed(machines: tuple[tuple[Transducer, object], ...]) -> tuple[np.ndarray, list[list[str]]]:
    """The machines in a row as one: next states and output symbols by state and class; state 0 is the first."""
    states = {tuple(start for _, start in machines): 0}
    todo, after, output = list(states), [], []
    for state in todo:  # grows while it is read
        after.append([])
        output.append([])
        for symbol in CLASSES:
            to = []
            for (rules, _), own in zip(machines, state, strict=True):
                own, symbol = rules.get((own, symbol), (own, symbol))
                to.append(own)
            if (new := tuple(to)) not in states:
                states[new] = len(states)
                todo.append(new)
            after[-1].append(states[new])
            output[-1].append(symbol)
    return np.array(after), output


_AFTER, _OUTPUT = composed(((negation(), 0), (reported(), 0), (aimed(), "")))
_NEXT = _AFTER.tolist()
_FACTOR = [[FACTORS.get(x, 0.0) for x in row] for row in _OUTPUT]
_BONUS = [[LATE_TARGET if x == "late-target" else 0.0 for x in row] for row in _OUTPUT]


def contributions(classes: list[int], weights: list[float]) -> list[float]:
    """What each word of a clause contributes on the clause's path."""
    state, out, last = 0, [], 0
    for at, (one, weight) in enumerate(zip(classes, weights, strict=True)):
        out.append(_FACTOR[state][one] * weight)
        if out[-1]:
            last = at
        out[last] += _BONUS[state][one]
        state = _NEXT[state][one]
    return out


@dataclass
class Grammar:
    """Word hashes with their classes and weights, and the curve from clause scores to a score."""

    words: np.ndarray
    classes: np.ndarray
    weights: np.ndarray
    curve: list[float] = field(default_factory=lambda: [-4.0, 0.6, 0.6, 0.5, 0.0])

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        found = self.words[at] == hashes
        return np.where(found, self.classes[at], 0), np.where(found, self.weights[at], 0.0)

    def features(self, column: pa.Array) -> np.ndarray:
        """Of each text: the sum of what its words contribute, the largest clause, the sum by length, the length."""
        out = np.zeros((len(column), 4))
        for row, _, data, offsets in utf8_parts(column):
            starts, ends, begin = word_spans(data, offsets, _BETWEEN)
            sums = running(data)
            hashes = span_hashes(sums, starts, ends)
            kind, weight = self.of(hashes)
            for k in PREFIXES:
                long = np.flatnonzero((ends - starts > k) & ((kind == 0) | (kind == 1)))
                more, heavy = self.of(beginnings(sums, starts[long], k))
                better = more.astype(bool) & (heavy > weight[long])
                kind[long[better]], weight[long[better]] = more[better], heavy[better]
            out[row:row + len(offsets) - 1, 3] = np.log1p(np.diff(begin))
            hits = np.flatnonzero((kind == 1) | (kind == 2))
            clause = np.cumsum(_STOP[data])[starts] if len(hits) else starts
            text = np.searchsorted(begin, hits, "right") - 1
            best: dict[int, dict[int, float]] = defaultdict(dict)
            largest: dict[int, float] = defaultdict(float)
            done = (-1, -1)
            for i, t in zip(hits.tolist(), text.tolist(), strict=True):
                if done == (t, clause[i]):
                    continue
                done = (t, clause[i])
                a, b = max(int(np.searchsorted(clause, clause[i])), int(begin[t])), min(int(np.searchsorted(clause, clause[i], "right")), int(begin[t + 1]))
                words: dict[int, float] = {}
                for word, value in zip(hashes[a:b].tolist(), contributions(kind[a:b].tolist(), weight[a:b].tolist()), strict=True):
                    if value > words.get(word, 0):
                        words[word] = value
                largest[t] = max(largest[t], sum(words.values()))
                for word, value in words.items():
                    best[t][word] = max(value, best[t].get(word, 0.0))
            for t, words in best.items():
                total = sum(words.values())
                out[row + t, :3] = total, largest[t], total / np.sqrt(20 + begin[t + 1] - begin[t])
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        z = self.curve[0] + self.features(column) @ np.array(self.curve[1:])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def beginnings(sums: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    return span_hashes(sums, starts, starts + length) ^ np.uint64(length << 56 | 1)


def hash_of(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(span_hashes(running(data), np.array([0]), np.array([len(data)]))[0])


def seeds() -> dict[int, tuple[int, float]]:
    return {hash_of(w): (CLASSES.index(c), SEED_WEIGHT if c in ("insult", "threat") else 0.0) for c, words in SEEDS.items() for w in words.split()}


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic, fold of a bounded number of labelled rows that are not held out."""
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("id"))
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic")).withColumn("place", F.xxhash64(F.lit("toxicity"), "id"))
    chosen = known.where("toxic = 1").orderBy("place", "id").limit(TOXIC_ROWS).union(known.where("toxic = 0").orderBy("place", "id").limit(CLEAN_ROWS))
    chosen = chosen.withColumn("fold", F.pmod("place", F.lit(FOLDS)).cast("int"))
    # At most TOXIC_ROWS + CLEAN_ROWS rows of three numbers.
    return docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(chosen), "id").select("text", "toxic", "fold")


def counted(rows: DataFrame) -> np.ndarray:
    """Of at most LEXICON word and beginning hashes: toxic rows and rows by fold. rows: text, toxic, fold."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        toxic, fold, found = batch.column("toxic").to_numpy(), batch.column("fold").to_numpy(), []
        for row, _, data, offsets in utf8_parts(batch.column("text")):
            starts, ends, begin = word_spans(data, offsets, _BETWEEN)
            sums = running(data)
            hashes, of = [span_hashes(sums, starts, ends)], [np.arange(len(starts))]
            for k in PREFIXES:
                long = np.flatnonzero(ends - starts > k)
                hashes.append(beginnings(sums, starts[long], k))
                of.append(long)
            texts = row + np.searchsorted(begin, np.concatenate(of), "right") - 1
            found.append(np.unique(np.stack([np.concatenate(hashes), texts.astype(np.uint64)]), axis=1))
        pairs = np.concatenate(found, axis=1)
        word, at = np.unique(pairs[0], return_inverse=True)
        text = pairs[1].astype(np.int64)
        out = {"word": pa.array(word.view(np.int64))}
        for k in range(FOLDS):
            mine = fold[text] == k
            out[f"toxic{k}"] = pa.array(np.bincount(at[mine], toxic[text[mine]], len(word)).astype(np.int64))
            out[f"rows{k}"] = pa.array(np.bincount(at[mine], minlength=len(word)).astype(np.int64))
        return pa.record_batch(out)

    names = [f"{what}{k}" for k in range(FOLDS) for what in ("toxic", "rows")]
    counts = in_arrow(rows, each, "word long, " + ", ".join(f"{n} long" for n in names)).groupBy("word").agg(*[F.sum(n).alias(n) for n in names])
    toxic, all_rows = (sum(F.col(f"{what}{k}") for k in range(FOLDS)) for what in ("toxic", "rows"))
    best = counts.where(toxic >= 2).orderBy(F.desc(toxic / F.sqrt(all_rows - toxic + 1)), "word").limit(LEXICON)
    got = best.select("word", *names).collect()  # at most LEXICON rows of a few numbers
    return np.array([tuple(r) for r in got], np.int64).reshape(-1, 1 + len(names))


def weighted(counts: np.ndarray, totals: np.ndarray, folds: list[int]) -> dict[int, float]:
    """Words with the lower end of their log-odds, counted over some folds. totals: toxic rows and rows by fold."""
    (toxic, rows), (positive, n) = ((counts[:, 1 + np.array(folds) * 2 + k].sum(axis=1) for k in (0, 1)), totals[folds].sum(axis=0))
    if not len(counts) or not positive or positive == n:
        return {}
    clean = rows - toxic
    odds = np.log((toxic + 0.5) / (positive + 1)) - np.log((clean + 0.5) / (n - positive + 1))
    odds = np.minimum(odds, 6.0) - np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    good = (odds >= LEAST_ODDS) & (toxic >= max(2, positive // 100))
    return dict(zip(counts[good, 0].view(np.uint64).tolist(), odds[good].tolist(), strict=True))


def made(words: dict[int, float]) -> Grammar:
    known = seeds()
    for word, odds in words.items():
        kind, weight = known.get(word, (1, 0.0))
        if kind in (1, 2):
            known[word] = (kind, max(weight, odds))
    order = sorted(known)
    return Grammar(np.array(order, np.uint64), np.array([known[w][0] for w in order]), np.array([known[w][1] for w in order]))


def fitted(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Logistic regression by iteratively reweighted least squares, with a small ridge on the slopes; the rarer
    kind weighs more, by the root of the ratio; only the last one may be negative."""
    design, ridge = np.column_stack([np.ones(len(x)), x]), np.diag([1e-3] + [RIDGE] * x.shape[1])
    mass = np.where(y == 1, np.sqrt((1 - y.mean()) / y.mean()), 1.0)
    free = list(range(design.shape[1]))
    while True:
        beta = np.zeros(design.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
            part = design[:, free]
            step = np.linalg.solve((part * (mass * p * (1 - p))[:, None]).T @ part + ridge[np.ix_(free, free)], part.T @ (mass * (y - p)) - ridge[np.ix_(free, free)] @ beta[free])
            beta[free] += step
            if np.abs(step).max() < 1e-8:
                break
        below = [k for k in free if 0 < k < design.shape[1] - 1 and beta[k] < 0]
        if not below:
            return beta.tolist()
        free.remove(min(below, key=lambda k: beta[k]))


def grammar(docs: DataFrame, labels: DataFrame) -> Grammar:
    rows = written(training_rows(docs, labels), "toxicity-rows")
    totals = np.zeros((FOLDS, 2), np.int64)
    for r in rows.groupBy("fold").agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")).collect():
        totals[r.fold] = r.toxic, r.n
    counts = counted(rows)
    parts = [made(weighted(counts, totals, [k for k in range(FOLDS) if k != fold])) for fold in range(FOLDS)]

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        fold = batch.column("fold").to_numpy()
        x = np.zeros((batch.num_rows, 4))
        for k, part in enumerate(parts):
            x[fold == k] = part.features(batch.column("text").filter(pa.array(fold == k)))
        return pa.record_batch({"x": pa.array(x.tolist(), pa.list_(pa.float64())), "y": batch.column("toxic")})

    got = in_arrow(rows, each, "x array<double>, y int").collect()  # at most TOXIC_ROWS + CLEAN_ROWS rows
    got.sort(key=lambda r: (r.y, r.x))
    x, y = np.array([r.x for r in got]), np.array([r.y for r in got], float)
    out = made(weighted(counts, totals, list(range(FOLDS))))
    if len(set(y)) == 2:
        out.curve = fitted(x, y)
    return out


def scored(docs: DataFrame, labels: DataFrame, score: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 in a column of that name (which replaces one of ``docs``)."""
    known = grammar(docs, labels)
    kept = docs.drop(score)
    schema = T.StructType([*kept.schema.fields, T.StructField(score, T.DoubleType())])

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(known.score(batch.column("text")))], names=[*batch.schema.names, score])

    return in_arrow(kept, each, schema)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    name = "score" + "_" * max((len(c) for c in docs.columns), default=0)
    return scored(docs, labels, name).where(F.col(name) < threshold).drop(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
