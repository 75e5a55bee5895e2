"""Collocations: phrases of 2 to 4 words that occur more often than their parts let expect.

A text (A-Z as a-z) is split into pieces at ``.,;:!?`` and at 0x0A-0x0D, a
piece into words at spaces and tabs. Only the longest windows are counted: every
word begins one window, held in as many lead columns as a phrase may have words
(w1 to w4), and padded with '' where the piece ends. ROLLUP over (lang, w1, w2, w3, w4)
sums these counts over ever shorter prefixes: a prefix that ends in a word is a
phrase, and its sum is how often it occurs, as each of its occurrences begins exactly one
window. The level of the language alone counts all words.

A window need not go on beyond a prefix that occurs less than ``least`` times, as
nothing longer is a phrase then. A sieve tells most of such prefixes: every
task counts the hashes of its prefixes of every length in buckets, the counts are
added up by blocks of buckets, and a bit for each bucket with ``least`` or more goes to
the tasks that make the windows. A bucket never has less than one of its
prefixes, so no phrase is lost, and what the sieve lets through
wrongly is counted like all else and found too rare in the end. The number of
buckets follows the size of the texts, up to 2 ** ``MOST_BITS`` (a bitmap of
128 MiB); beyond about 20 GB of text more rare windows pass, up to one for
every word: then the shuffles grow, the result stays.

Within a task equal windows are added up before they leave it, each slice by exact codes of its words.

Defined results: a null text is empty, a null lang is ``und``; texts without
words add nothing; repeated rows count again; ids are not read; an empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import in_arrow, release, slices, table, utf8_parts, written
from kpiloom.llm.words import mixed, running, span_hashes, word_spans

LONGEST = 4  # words of a phrase
LEAST = 30
SHARE = 80  # percent of a phrase's occurrences that lie in a longer candidate: then it is dropped
TOP = 2000  # phrases of a language
SCALE = 2_000_000
MOST_BITS = 30
BUCKET_BYTES = 18  # of text for each bucket: three words, each of which counts LONGEST prefixes
SALTS = 16  # parts of a language that are cut to TOP before the language is
_PENDING = 1 << 23  # prefixes that a task holds before it adds them up
_BLOCK = 16  # bits of a bucket within its block

_PIECE_ENDS = np.zeros(256, bool)
_PIECE_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BETWEEN = _PIECE_ENDS.copy()
_BETWEEN[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LEADS = np.random.Generator(np.random.PCG64(1357)).integers(1, 2**64, 16, np.uint64, endpoint=False) | np.uint64(1)
LEAD_COLUMNS = [f"w{k + 1}" for k in range(LONGEST)]


class Words:
    """The words of some texts: codes into the distinct words, the row of each, and whether the next one goes on its piece."""

    def __init__(self, row: int, data: np.ndarray, offsets: np.ndarray) -> None:
        starts, ends, begin = word_spans(data, offsets, _BETWEEN)
        letters = _LOWER[data[~_BETWEEN[data]]]
        places = np.concatenate([[0], np.cumsum(ends - starts)])
        coded = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(letters)).dictionary_encode()
        self.codes, self.distinct = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
        self.row = row + np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        pieces = np.cumsum(_PIECE_ENDS[data])[starts] if len(starts) else starts
        self.goes_on = np.zeros(len(starts), bool)
        self.goes_on[:-1] = (pieces[1:] == pieces[:-1]) & (self.row[1:] == self.row[:-1])

    def prefixes(self, langs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 1 to LONGEST words: the hash of the window's prefix, and where its piece has so many."""
        _, offsets, letters = self.distinct.buffers()
        offsets = np.frombuffer(offsets, np.int64)[:len(self.distinct) + 1]
        hashes = span_hashes(running(np.frombuffer(letters, np.uint8) if letters else np.zeros(0, np.uint8)), offsets[:-1], offsets[1:])
        words = hashes[self.codes] if len(hashes) else np.zeros(0, np.uint64)
        prefix, there = mixed(words ^ langs[self.row]), np.ones(len(words), bool)
        yield prefix, there
        for k in range(1, LONGEST):
            there = there & led(self.goes_on, k - 1)
            prefix = mixed(prefix + led(words, k) * _LEADS[k])
            yield prefix, there


def led(values: np.ndarray, by: int) -> np.ndarray:
    """The value ``by`` places further on; zero beyond the end."""
    out = np.zeros_like(values)
    out[:max(len(values) - by, 0)] = values[by:]
    return out


def _lang_hashes(langs: pa.Array) -> np.ndarray:
    coded = langs.dictionary_encode()
    own = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in coded.dictionary.to_pylist()], np.uint64)
    return own[coded.indices.to_numpy(zero_copy_only=False)]


def taken(pending: list[np.ndarray]) -> np.ndarray:
    """All of them as one array; the list is empty then."""
    out = np.concatenate(pending)
    pending.clear()
    return out


def packed(buckets: np.ndarray, least: int) -> pa.RecordBatch:
    """Counts of the buckets, up to ``least``, a compressed row for each block. Sorts ``buckets``."""
    buckets.sort()
    first = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
    counts = np.minimum(np.diff(np.append(first, len(buckets))), least).astype(np.uint16)
    own = buckets[first]
    block, inner = own >> np.uint32(_BLOCK), (own & np.uint32((1 << _BLOCK) - 1)).astype(np.uint16)
    cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    pack, rows = zstandard.ZstdCompressor(level=1), []
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(own)], strict=True):
        gaps = np.diff(inner[a:b], prepend=np.uint16(0))
        rows.append(pack.compress(b"".join(x.view(np.uint8).reshape(-1, 2).T.tobytes() for x in (gaps, counts[a:b]))))
    return pa.record_batch({"block": pa.array(block[cuts].astype(np.int32)), "counts": pa.array(rows, pa.binary())})


def unpacked(counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(counts), np.uint8).reshape(4, -1).astype(np.uint16)
    return np.cumsum(raw[0] | raw[1] << 8, dtype=np.uint16), raw[2] | raw[3] << 8


def sieve(docs: DataFrame, least: int, bits: int) -> np.ndarray:
    """A bitmap of 2 ** bits buckets, of those that ``least`` or more prefixes fall into."""
    shift = np.uint64(64 - bits)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, size = [], 0
        for batch in batches:
            for part in slices(batch):
                langs = _lang_hashes(part.column("lang"))
                for row, _, data, offsets in utf8_parts(part.column("text"), 2 << 20):
                    for prefix, there in Words(row, data, offsets).prefixes(langs):
                        pending.append((prefix[there] >> shift).astype(np.uint32))
                        size += len(pending[-1])
                    if size > _PENDING:
                        yield packed(taken(pending), least)
                        size = 0
                        release()
        if size:
            yield packed(taken(pending), least)
        release()

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sums = None, None
        result = lambda: pa.record_batch({"block": pa.array([block], pa.int32()), "bits": pa.array([np.packbits(sums >= least).tobytes()], pa.binary())})
        for batch in batches:
            for own, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                if own != block:
                    if block is not None:
                        yield result()
                    block, sums = own, np.zeros(1 << _BLOCK, np.uint32)
                places, more = unpacked(counts)
                sums[places] = np.minimum(sums[places] + more, least)
        if block is not None:
            yield result()

    counts = docs.mapInArrow(counted, "block int, counts binary").repartition("block").sortWithinPartitions("block")
    out = np.zeros(max(1 << (bits - 3), 1 << (_BLOCK - 3)), np.uint8)  # its size is given by ``bits``, whatever the corpus
    for row in counts.mapInArrow(added, "block int, bits binary").toLocalIterator():
        begin = row.block << (_BLOCK - 3)
        out[begin:begin + (1 << (_BLOCK - 3))] = np.frombuffer(row.bits, np.uint8)
    return out


def windows(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, w1 to w4, n: the padded longest windows, added up within each slice of a task."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max((size // BUCKET_BYTES).bit_length(), _BLOCK), MOST_BITS)
    frequent = docs.sparkSession.sparkContext.broadcast(sieve(docs, least, bits))
    shift = np.uint64(64 - bits)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        bitmap, langs, parts = frequent.value, batch.column("lang"), []
        hashes, coded = _lang_hashes(langs), langs.dictionary_encode()
        lang_codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        for row, _, data, offsets in utf8_parts(batch.column("text"), 2 << 20):
            words = Words(row, data, offsets)
            if not len(words.codes):
                continue
            leads, kept = [], np.ones(len(words.codes), bool)
            for k, (prefix, there) in enumerate(words.prefixes(hashes)):
                bucket = prefix >> shift
                kept = kept & there & ((bitmap[bucket >> np.uint64(3)] >> (np.uint8(7) - (bucket & np.uint64(7)).astype(np.uint8)) & 1) == 1)
                leads.append(np.where(kept, led(words.codes, k) + 1, 0))
            base = len(words.distinct) + 1
            key, keys = lang_codes[words.row], []
            for lead in leads:  # whole windows as one number: pairs of codes, renumbered
                distinct, key = np.unique(key * base + lead, return_inverse=True)
                keys.append(distinct)
            counts = np.bincount(key)
            columns, at = [], np.arange(len(counts))
            for distinct in reversed(keys):
                own = distinct[at]
                columns.append(own % base)
                at = own // base
            names = pa.concat_arrays([pa.array([""], pa.large_string()), words.distinct]).cast(pa.string())
            parts.append(pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(at)), *(names.take(pa.array(c)) for c in reversed(columns)), pa.array(counts.astype(np.int64))], names=["lang", *LEAD_COLUMNS, "n"]))
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if parts else None

    return in_arrow(docs, each, f"lang string, {', '.join(f'{c} string' for c in LEAD_COLUMNS)}, n long")


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, k, phrase, f: every phrase of 1 to LONGEST words that occurs ``least`` times, and for k = 0 the number of words."""
    if not 1 <= least < 1 << 16:
        raise ValueError("a phrase occurs at least once; the sieve counts to 65,535")
    own = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Equal windows meet first, in as many rows as tasks hold them; only what is left of them is expanded to the levels.
    whole = windows(own, least).groupBy("lang", *LEAD_COLUMNS).agg(F.sum("n").alias("n"))
    summed = whole.rollup("lang", *LEAD_COLUMNS).agg(F.grouping_id().alias("level"), F.sum("n").alias("f"))
    # The grouping id has a bit for each column summed over: 0 for whole windows, 2 ** LONGEST - 1 for the language.
    sizes = {(1 << (LONGEST - k)) - 1: k for k in range(LONGEST + 1)}
    k = F.element_at(F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair]), F.col("level").cast("int"))
    last = F.coalesce(*[F.col(c) for c in reversed(LEAD_COLUMNS)])  # of the columns that the level has
    found = summed.where(f"level < {1 << LONGEST}").where((F.col("level") == (1 << LONGEST) - 1) | ((last != "") & (F.col("f") >= least)))
    return found.select("lang", k.alias("k"), F.concat_ws(" ", *LEAD_COLUMNS).alias("phrase"), "f")


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of every candidate, by its lowest-scoring cut."""
    words = F.split("phrase", " ")
    cuts = counts.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", F.array_join(F.slice("w", 1, F.col("cut")), " ").alias("first"), F.array_join(F.slice("w", F.col("cut") + 1, F.col("k")), " ").alias("rest"))
    part = lambda name, size: counts.where("k > 0").select("lang", F.col("phrase").alias(name), F.col("f").alias(size))
    both = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    wide = "CAST({} AS DECIMAL(20,0))".format
    score = F.expr(f"CAST({SCALE} AS DECIMAL(7,0)) * {wide('a')} DIV ({wide('l')} + {wide('r')})")
    lowest = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))
    return lowest.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def within_longer(counts: DataFrame) -> DataFrame:
    """lang, phrase, most: for every phrase within longer candidates, the count of the most frequent of them."""
    shorter = F.expr("flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), s -> array_join(slice(split(phrase, ' '), s, m), ' '))))")
    return counts.where("k > 2").select("lang", F.explode(shorter).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("most"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language."""
    counts = written(phrase_counts(docs, least), "phrase-counts")
    own = scored(counts).join(within_longer(counts), ["lang", "phrase"], "left")
    own = own.where(F.expr(f"most IS NULL OR 100 * CAST(most AS DECIMAL(20,0)) < {SHARE} * CAST(a AS DECIMAL(20,0))"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))  # a language is cut in parts first, so that no task gets all of it
    some = own.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(f"place <= {top}")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(f"rank <= {top}")
    totals = counts.where("k = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


_GRAMS = " UNION ALL ".join(f"SELECT lang, {k} AS k, array_to_string(w[i:i + {k - 1}], ' ') AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM p WHERE len(w) >= {k})" for k in range(1, LONGEST + 1))
SQL = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
g AS ({_GRAMS}),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= {LEAST}),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
s AS (SELECT c.lang, c.k, c.phrase, c.a, x.f AS l, y.f AS r, cut, CAST(CAST({SCALE} AS HUGEINT) * c.a // (x.f + y.f) AS BIGINT) AS score
      FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:], ' ')
      QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut) = 1),
i AS (SELECT lang, array_to_string(w[b:b + m - 1], ' ') AS phrase, max(a) AS most FROM (SELECT *, unnest(range(1, k - m + 2)) AS b FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY 1, 2)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM s JOIN n USING (lang) LEFT JOIN i USING (lang, phrase) WHERE most IS NULL OR 100 * CAST(most AS HUGEINT) < {SHARE} * CAST(a AS HUGEINT)
QUALIFY rank <= {TOP}
"""
