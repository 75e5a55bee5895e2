"""Substring deduplication by hashing lines or paragraphs.

A unit is a line, a line cut at the ends of its sentences (after a word that
ends in ``.``, ``!`` or ``?``), a paragraph: a run of lines without a blank one between
them, or a word. Units are normalised to their words (runs of characters other than 0x20 and
0x09-0x0D, A-Z as a-z). What is looked for are passages of at least
``passage_words`` words: from every unit on, the shortest run of consecutive units
that has so many, which is the unit itself where ``passage_words`` is 1. Two independent 64-bit hashes of
a run's words name it. Runs are grouped by name over all documents; the
earliest, by (doc_id, unit number), stays and the others are removed. Their
places refer to the original text, in characters. Every unit begins a run unless its
text ends first, so a passage of whole units is found wherever it begins; one that is repeated only
inside longer units is not. With words as units every passage of ``passage_words`` words is found wherever it
stands, and none that is shorter: a row then is a stretch of just so many words, one for each word that
begins one, so that rows and shuffle grow with the words of the texts instead of their sentences.

Every word of a removed run has an equal one in an earlier place, so no
unit is removed everywhere, also where runs overlap.

Defined results: null, empty and blank texts have no runs, nor have texts of fewer
words; rows with a null doc_id come after all others; a row is told by its doc_id and its
text: rows equal in both are treated alike, rows that share an id only are documents of their own; an
empty table gives an empty result. Other columns are ignored, or passed on by
``without_repeats``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.common import in_arrow, table, utf8_parts, written
from kpiloom.llm.words import mixed, powers, running, span_hashes, word_spans

PASSAGE_WORDS = 40  # a repeated passage of some 50 words holds so many in whole units, though its ends may stand within others
UNITS = ("line", "sentence", "paragraph", "word")
_OTHER = np.uint64(0xD6E8FEB86659FD93)
_SENTENCE_ENDS = np.isin(np.arange(256), [*b".!?"])


def runs(docs: DataFrame, unit: str = "sentence", passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """doc_id, key (of the text), unit, start, end, n_words, name, name2: the run that begins at each unit."""
    if unit not in UNITS:
        raise ValueError(f"a unit is one of {', '.join(UNITS)}")
    fields = ("unit", "start", "end", "n_words", "name", "name2")

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = []
        for row, _, data, offsets in utf8_parts(batch.column("text")):
            starts, ends, begin = word_spans(data, offsets)
            if not len(starts):
                continue
            text = np.searchsorted(begin, np.arange(len(starts)), "right") - 1
            line = np.concatenate([[0], np.cumsum(data == 10)])[starts]
            apart = (np.diff(line) > (1 if unit == "paragraph" else 0)) | (np.diff(text) > 0)
            if unit == "sentence":
                apart |= _SENTENCE_ENDS[data[ends[:-1] - 1]]
            elif unit == "word":
                apart[:] = True
            first = np.flatnonzero(np.concatenate([[True], apart]))
            end = np.append(first[1:], len(starts))
            last = np.searchsorted(end, first + max(passage_words, 1))  # the unit in which the run has enough words
            number = np.arange(len(first)) - np.searchsorted(text[first], text[first])
            enough = last < len(first)
            enough[enough] = text[first[last[enough]]] == text[first[enough]]
            first, end, number = first[enough], end[last[enough]], number[enough]
            words = span_hashes(running(data), starts, ends)
            power, inverse = powers(len(words) + 1)
            names = []
            for value in (words, mixed(words ^ _OTHER)):
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * power[:len(words)], dtype=np.uint64)])
                names.append(mixed((sums[end] - sums[first]) * inverse[first] + (end - first).astype(np.uint64)).view(np.int64))
            place = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters before a byte
            own = text[first]
            parts.append((row + own, number, place[starts[first]] - place[offsets[own]], place[ends[end - 1]] - place[offsets[own]], end - first, *names))
        rows, *columns = (np.concatenate([p[k] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64) for k in range(1 + len(fields)))
        of = batch.select(["doc_id", "key"]).take(pa.array(rows))
        return pa.RecordBatch.from_arrays([*of.columns, *map(pa.array, columns)], names=["doc_id", "key", *fields])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    return in_arrow(given, each, "doc_id long, key long, " + ", ".join(f"{f} long" for f in fields))


def occurrences(docs: DataFrame, unit: str = "sentence", passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """doc_id, key, unit, start, end, n_words, first_doc_id, first_unit, removed: the runs that occur more than once.

    removed is false for the earliest one. A name's runs are combined before they are dealt, and its earliest place
    is written, so that the join with all runs has two plain sides, of which the adaptive join splits a frequent name's.
    The runs are made twice, by the same texts, rather than kept.
    """
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key", "unit")
    first = runs(docs, unit, passage_words).groupBy("name", "name2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = runs(docs, unit, passage_words).join(written(first, "repeats-first"), ["name", "name2"])
    return again.select("doc_id", "key", "unit", "start", "end", "n_words", F.col("first.doc_id").alias("first_doc_id"), F.col("first.unit").alias("first_unit"),
                        (place != F.col("first")).alias("removed"))


def repeats(docs: DataFrame, unit: str = "sentence", passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """doc_id, unit, start, end, n_words, first_doc_id, first_unit: one row for each run to remove."""
    return occurrences(docs, unit, passage_words).where("removed").drop("key", "removed")


def without_repeats(docs: DataFrame, unit: str = "sentence", passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """``docs`` without the repeated runs. A removed run leaves what stands around it."""
    gone = occurrences(docs, unit, passage_words).where("removed")
    spans = gone.groupBy("doc_id", "key").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("__spans"))  # at most the units of one text
    spans = spans.withColumnsRenamed({"doc_id": "__id", "key": "__key"})
    joined = docs.join(spans, docs["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__key")), "left").drop("__id", "__key")
    begin = F.concat(F.array(F.lit(0).cast("long")), F.transform("__spans", lambda s: s["end"]))
    end = F.concat(F.transform("__spans", lambda s: s["start"]), F.array(F.length("text").cast("long")))
    # A later run ends later; where runs overlap nothing stands between them.
    left = F.array_join(F.zip_with(begin, end, lambda b, e: F.substring(F.col("text"), (b + 1).cast("int"), F.greatest(e - b, F.lit(0)).cast("int"))), "")
    return joined.withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(left)).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occurrences(table(spark, sf_dir, "documents")).drop("key")


_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_CUT = "chr(57344)"
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT k, doc_id, string_split(replace(regexp_replace(text, '([.!?])([\x20\x09-\x0D])', '\1' || {_CUT} || '\2', 'g'), chr(10), chr(10) || {_CUT}), {_CUT}) AS pieces FROM d),
p AS (SELECT k, doc_id, unnest(pieces) AS raw, unnest(range(len(pieces))) AS i FROM s),
o AS (SELECT *, sum(length(raw)) OVER (PARTITION BY k ORDER BY i) - length(raw) AS begin_at, len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) AS n FROM p),
u AS (SELECT k, doc_id, row_number() OVER (PARTITION BY k ORDER BY i) - 1 AS unit, begin_at + length(raw) - length(ltrim(raw, {_SPACES})) AS b, begin_at + length(rtrim(raw, {_SPACES})) AS e,
             sum(n) OVER (PARTITION BY k ORDER BY i) AS upto, sum(n) OVER (PARTITION BY k ORDER BY i) - n AS before FROM o WHERE n > 0),
r AS (SELECT x.k, x.doc_id, x.unit, x.b, y.e, x.before, y.upto FROM u x JOIN u y ON x.k = y.k AND y.unit >= x.unit AND y.upto - x.before >= {PASSAGE_WORDS} AND y.before - x.before < {PASSAGE_WORDS}),
f AS (SELECT r.*, array_to_string(words[before + 1:upto], ' ') AS name FROM r JOIN d USING (k)),
q AS (SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS first_doc_id, first_value(unit) OVER w AS first_unit, count(*) OVER (PARTITION BY name) AS copies
      FROM f WINDOW w AS (PARTITION BY name ORDER BY doc_id NULLS LAST, unit))
SELECT doc_id, unit, CAST(b AS BIGINT) AS start, CAST(e AS BIGINT) AS "end", CAST(upto - before AS BIGINT) AS n_words, first_doc_id, first_unit, place > 1 AS removed
FROM q WHERE copies > 1
"""
