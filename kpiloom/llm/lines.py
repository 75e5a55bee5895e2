"""Near-duplicate lines by a segment-partition edit join.

Lines are compared by their characters without white space at either end.
Equal lines are one text, known by its 64-bit digest. Two texts of at least
``LEAST_CHARS`` characters are linked if at most ``EDITS`` insertions,
deletions and replacements part them. Of EDITS + 1 segments that a text is
split into, one must then stand unchanged in the other text, near its place;
so the segments are indexed by their number and the text's length, and each
text probes the indexes of its own and slightly smaller lengths with only
those substrings that such an alignment allows. Candidates whose character
counts differ too much are left out where they are found; the rest are
verified on the whole texts by banded bit-parallel edit distance.

Index and probe entries travel as packed arrays, dealt by their key, so that a
shuffled row holds thousands of them. A frequent segment makes no pairs of
rows: its entries are compared as arrays, some million at a time. Keys that a
sample of the texts shows to have many entries are cut into blocks, and each
pair of blocks is a part of its own; so the entries of one part stay few, but
the comparisons of a frequent segment grow with the square of its texts.

A class is a connected component of linked texts. Its earliest line, by
(doc_id, line number), is kept and the others go.

Defined results: blank lines and null texts have no rows; shorter lines are
linked with equal lines only; a row is told by its doc_id and a hash of its
text, in this order, so rows that share an id are documents of their own; lines of rows
with a null doc_id come after all others; of rows equal in both, lines
at the same place as the earliest are kept like it; an empty table gives an
empty result. Other columns are ignored, or passed on by ``without_repeats``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.common import in_arrow, release, slices, table, utf8_parts, written
from kpiloom.llm.components import components
from kpiloom.llm.words import mixed, powers

EDITS = 2
LEAST_CHARS = 20
PAIRS = 1 << 21  # candidate pairs looked at together
PART = 1 << 20  # entries of a part, about
BLOCK = 1 << 15  # index or probe entries of a key that are compared in one part, about
SAMPLE = 64  # of so many texts one is counted to find the frequent keys
OWN, PROBE, INDEX = range(3)  # entries: indexed and compared among themselves, probing, indexed for others' probes only
_SPACES = np.array([9, 10, 11, 12, 13, 32, 0xA0, 0x2028, 0x2029, 0x3000], np.uint32)
_GROUP = (mixed(np.arange(1 << 12, dtype=np.uint64)) & np.uint64(7)).astype(np.uint8)


class Lines:
    """The non-blank lines of some texts, as code points. row: of the text, number: in it, start and end: in ``chars``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first_row: int = 0):
        self.chars = chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        text = lead[offsets]
        breaks = np.flatnonzero(chars == 10)
        starts = np.unique(np.concatenate([text, breaks + 1]))  # a break at a text's end opens no line
        starts = starts[starts < len(chars)]
        row = np.searchsorted(text, starts, "right") - 1
        ends = np.concatenate([starts[1:], text[-1:]])
        inner = np.flatnonzero(~np.isin(chars, _SPACES))
        at, until = np.searchsorted(inner, starts), np.searchsorted(inner, ends)
        number = np.arange(len(starts)) - np.searchsorted(starts, text[:-1])[row]
        some = until > at
        self.row, self.number = first_row + row[some], number[some]
        self.start, self.end = inner[at[some]], inner[until[some] - 1] + 1
        self.offset = self.start - text[row[some]]
        power, _ = powers(len(chars) + 1)
        self.sums = np.zeros(len(chars) + 1, np.uint64)
        np.cumsum(mixed(chars.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) * power[:len(chars)], out=self.sums[1:])
        self.digest = self.spans(self.start, self.end - self.start)

    def spans(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        _, inverse = powers(len(self.sums))
        return mixed((self.sums[start + length] - self.sums[start]) * inverse[start] + length.astype(np.uint64))

    def counts(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often characters of eight groups occur, each modulo 16, in 32 bits."""
        group, out = _GROUP[self.chars & 0xFFF], np.zeros(len(start), np.uint32)
        for g in range(8):
            sums = np.concatenate([[0], np.cumsum(group == g)])
            out |= ((sums[end] - sums[start]) & 15).astype(np.uint32) << np.uint32(4 * g)
        return out


def lines_of(column: pa.Array) -> Iterator[Lines]:
    for row, _, data, offsets in utf8_parts(column, 1 << 21):
        yield Lines(data, offsets, row)


def occurrences(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, text_key, line, start, end (code points of the text), digest, sampled: one row per non-blank line.

    sampled: the line itself, for one in ``sample`` texts, chosen by their digest.
    """

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns, sampled = [], []
        for p in lines_of(batch.column("text")):
            columns.append((p.row, p.number, p.offset, p.offset + p.end - p.start, p.digest.view(np.int64)))
            texts = np.full(len(p.row), None, object)
            for k in np.flatnonzero(p.digest % np.uint64(sample) == 0).tolist():
                texts[k] = p.chars[p.start[k]:p.end[k]].tobytes().decode("utf-32-le")
            sampled.append(texts)
        row, number, start, end, digest = (np.concatenate(x) for x in zip(*columns, strict=True))
        return pa.record_batch({"doc_id": batch.column("doc_id").take(pa.array(row)), "text_key": batch.column("text_key").take(pa.array(row)), "line": pa.array(number.astype(np.int32)),
                                "start": pa.array(start), "end": pa.array(end), "digest": pa.array(digest), "sampled": pa.array(np.concatenate(sampled), pa.string())})

    return in_arrow(named(docs), each, "doc_id long, text_key long, line int, start long, end long, digest long, sampled string")


def named(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, text: a row is told by its doc_id and a hash of its text, as ids may repeat or be null."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")


def same_row(docs: DataFrame, other: DataFrame) -> Column:
    """other: __id and __key."""
    return docs["doc_id"].cast("long").eqNullSafe(other["__id"]) & (F.xxhash64(docs["text"]) == other["__key"])


def segments(length: np.ndarray, edits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Place and length of the edits + 1 segments of a text of that length; the last ones are one longer."""
    short, longer = length // (edits + 1), length % (edits + 1)
    return [(i * short + np.maximum(longer - (edits + 1 - i), 0), short + (i >= edits + 1 - longer)) for i in range(edits + 1)]


def keyed(lines: Lines, start: np.ndarray, size: np.ndarray, length: np.ndarray, number: int) -> np.ndarray:
    return mixed(lines.spans(start, size) + length.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) + np.uint64(number))


def entries(lines: Lines, chosen: np.ndarray, edits: int) -> tuple[list, list]:
    """Index and probe entries of the chosen lines: (key, line) arrays. An index entry also probes its own length and place."""
    start, length = lines.start[chosen], (lines.end - lines.start)[chosen]
    index = [(keyed(lines, start + place, size, length, i), chosen) for i, (place, size) in enumerate(segments(length, edits))]
    probes = []
    for less in range(edits + 1):
        for i, (place, size) in enumerate(segments(length - less, edits)):
            # An unchanged segment with i segments before and edits - i behind it can have moved by so much.
            low, high = max(-i, less - (edits - i)), min(i, less + edits - i)
            for move in range(low, high + 1):
                if less or move:
                    fits = (place + move >= 0) & (place + move + size <= length)
                    probes.append((keyed(lines, start[fits] + place[fits] + move, size[fits], length[fits] - less, i), chosen[fits]))
    return index, probes


def sampled(occ: DataFrame, edits: int, least: int) -> DataFrame:
    """key, probe: the entries of the sampled texts."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [(np.zeros(0, np.uint64), np.zeros(0, bool))]
        for lines in lines_of(batch.column("sampled")):
            chosen = np.flatnonzero(lines.end - lines.start >= max(least, edits + 1))
            for probe, side in enumerate(entries(lines, chosen, edits)):
                got += [(key, np.full(len(key), bool(probe))) for key, _ in side]
        key, probe = (np.concatenate(x) for x in zip(*got, strict=True))
        return pa.record_batch({"key": pa.array(key.view(np.int64)), "probe": pa.array(probe)})

    texts = occ.where("sampled is not null").select("digest", "sampled").dropDuplicates(["digest"])
    return in_arrow(texts.select("sampled"), each, "key long, probe boolean")


def sizes(occ: DataFrame, edits: int, least: int, block: int, sample: int) -> tuple[int, np.ndarray, np.ndarray]:
    """About how many entries there are; the keys, in order, with more than ``block`` index or probe entries, and the blocks to cut each into.

    The sample only says how the work is cut: whatever it says, all entries are compared.
    """
    probes = F.sum(F.col("probe").cast("long"))
    counts = written(sampled(occ, edits, least).groupBy("key").agg(F.count(F.lit(1)).alias("n"), probes.alias("probes")), "lines-keys")
    total = (counts.agg(F.sum("n")).first()[0] or 0) * sample
    most = F.greatest(F.col("probes"), F.col("n") - F.col("probes")) * sample
    found = counts.where(most > block).select("key", F.ceil(most / block).alias("blocks")).collect()  # at most entries / block rows
    keys, blocks = np.array([r.key for r in found], np.int64).view(np.uint64), np.array([r.blocks for r in found], np.int64)
    order = np.argsort(keys)
    return total, keys[order], blocks[order]


def packed(docs: DataFrame, edits: int, least: int, parts: int, frequent: np.ndarray, blocks: np.ndarray) -> DataFrame:
    """part, kind, keys, digests, counts: entries whose keys belong to the part, as arrays.

    The kind is OWN, PROBE or INDEX. A frequent key's entries are cut into
    blocks by their digest; each pair of blocks (i, j) is a part of its own,
    with the index entries of j and the probe entries of i, and for i < j the
    index entries of i as probes.
    """
    before = parts + np.concatenate([[0], np.cumsum(blocks * blocks)])

    def batch_of(lines: Lines, counts: np.ndarray, kind: int, part: np.ndarray, key: np.ndarray, line: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(part.astype(np.uint16) if len(part) and part.max() < 1 << 16 else part, kind="stable")  # so few are sorted by counting
        part, key, line = part[order], key[order], line[order]
        cut = np.append(np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])[:len(part)]), len(part)).tolist()
        out = [{"part": int(part[b]), "kind": kind, "keys": key[b:e].tobytes(), "digests": lines.digest[line[b:e]].tobytes(), "counts": counts[line[b:e]].tobytes()}
               for b, e in zip(cut[:-1], cut[1:], strict=True)]
        return pa.RecordBatch.from_pylist(out, pa.schema([("part", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("digests", pa.binary()), ("counts", pa.binary())]))

    def dealt(lines: Lines, counts: np.ndarray, probe: bool, key: np.ndarray, line: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = np.searchsorted(frequent, key)
        often = np.append(frequent, np.uint64(0))[at] == key
        often &= at < len(frequent)
        rare = ~often
        yield batch_of(lines, counts, PROBE if probe else OWN, ((key[rare] >> np.uint64(32)) % np.uint64(parts)).astype(np.int64), key[rare], line[rare])
        at, key, line = at[often], key[often], line[often]
        many, first = blocks[at], before[at]
        own = (mixed(lines.digest[line]) % many.astype(np.uint64)).astype(np.int64)
        for other in range(int(many.max()) if len(many) else 0):
            some = other < many
            if not probe:
                for kind, where in ((OWN, some & (own == other)), (INDEX, some & (own != other))):
                    yield batch_of(lines, counts, kind, (first + other * many + own)[where], key[where], line[where])
                some &= own < other
            yield batch_of(lines, counts, PROBE, (first + own * many + other)[some], key[some], line[some])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for part in slices(batch):
                    for lines in lines_of(part.column("text")):
                        eligible = np.flatnonzero(lines.end - lines.start >= max(least, edits + 1))
                        if not len(eligible):
                            continue
                        eligible = eligible[np.unique(lines.digest[eligible], return_index=True)[1]]
                        counts = np.zeros(len(lines.start), np.uint32)
                        counts[eligible] = lines.counts(lines.start[eligible], lines.end[eligible])
                        for probe, got in enumerate(entries(lines, eligible, edits)):
                            yield from (b for b in dealt(lines, counts, bool(probe), *(np.concatenate([g[k] for g in got]) for k in (0, 1))) if b.num_rows)
        finally:
            release()

    return docs.select("text").mapInArrow(each, "part long, kind int, keys binary, digests binary, counts binary")


def distinct_entries(side: list[np.ndarray]) -> list[np.ndarray]:
    """Keys, digests and counts in order of key and digest, each pair of them once."""
    order = np.lexsort((side[1], side[0]))
    keys, digests, counts = (x[order] for x in side)
    fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (digests[1:] != digests[:-1])])[:len(keys)]
    return [keys[fresh], digests[fresh], counts[fresh]]


def matched(index: list[np.ndarray], probe: list[np.ndarray], edits: int, among: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of digests (smaller first) with a common key whose character counts allow so few edits. Arrays: keys, digests, counts. among: also those of two index entries."""
    keys, digests, counts = distinct_entries(index)
    for own in (True, False) if among else (False,):
        k, d, c = (keys, digests, counts) if own else probe
        low = np.arange(1, len(keys) + 1) if own else np.searchsorted(keys, k)
        size = np.searchsorted(keys, k, "right") - low
        some = np.flatnonzero(size > 0)
        ends = np.cumsum(size[some])
        begin = 0
        while begin < len(some):
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + PAIRS, "right")))
            at = some[begin:end]
            many = size[at]
            left = np.repeat(at, many)
            right = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low[at], many)
            apart = (digests[right] != d[left]) & (difference(c[left], counts[right]) <= 2 * edits)
            a, b = d[left[apart]], digests[right[apart]]
            yield np.minimum(a, b), np.maximum(a, b)
            begin = end


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A lower bound of the summed differences of two packed counts."""
    out = np.zeros(len(a), np.uint8)
    for g in range(8):
        apart = ((a >> np.uint32(4 * g)) - (b >> np.uint32(4 * g))).astype(np.uint8) & 15
        out += np.minimum(apart, 16 - apart)
    return out


class Held:
    """The entries of one part. Entries that came again are dropped whenever those held have doubled, from ``PART`` on."""

    def __init__(self) -> None:
        self.sides = {kind: [[np.zeros(0, t)] for t in (np.uint64, np.int64, np.uint32)] for kind in (OWN, PROBE, INDEX)}
        self.size, self.most = 0, PART

    def add(self, batch: pa.RecordBatch) -> None:
        for kind, *row in zip(*(batch.column(n).to_pylist() for n in ("kind", "keys", "digests", "counts")), strict=True):
            for held, data, t in zip(self.sides[kind], row, (np.uint64, np.int64, np.uint32), strict=True):
                held.append(np.frombuffer(data, t))
            self.size += len(row[0]) // 8
        if self.size > self.most:
            self.sides = {kind: [[x] for x in distinct_entries(self.side(kind))] for kind in self.sides}
            self.size = sum(len(x[0][0]) for x in self.sides.values())
            self.most = max(PART, 2 * self.size)

    def side(self, kind: int) -> list[np.ndarray]:
        return [np.concatenate(x) for x in self.sides[kind]]

    def pairs(self, edits: int) -> Iterator[pa.RecordBatch]:
        """Some at a time, those of ``PAIRS`` each once."""
        own, other = self.side(OWN), self.side(INDEX)  # a part has entries of one of these kinds
        among = not len(other[0])
        found, size = [], 0
        for step in matched(own if among else other, self.side(PROBE), edits, among):
            found, size = [*found, np.stack(step)], size + len(step[0])
            if size >= PAIRS:
                yield unique_pairs(found)
                found, size = [], 0
        if size:
            yield unique_pairs(found)


def unique_pairs(found: list[np.ndarray]) -> pa.RecordBatch:
    pairs = np.unique(np.concatenate(found, axis=1), axis=1)
    return pa.record_batch({"a": pa.array(pairs[0]), "b": pa.array(pairs[1])})


def candidates(docs: DataFrame, occ: DataFrame, edits: int, least: int, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """a, b: digests of texts with a segment in common. occ: the occurrences of the lines of ``docs``, with that sample."""
    dealt = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total, frequent, blocks = sizes(occ, edits, least, block, sample)
    parts = max(4 * dealt, -(-total // PART))
    rows = packed(docs, edits, least, parts, frequent, blocks).repartition(max(dealt, parts // 64), "part").sortWithinPartitions("part")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = None, None
        for batch in batches:
            of = batch.column("part").to_numpy()
            for part in np.unique(of).tolist():
                if held and part != now:
                    yield from held.pairs(edits)
                    held = None
                held, now = held or Held(), part
                held.add(batch.slice(*(lambda b, e: (b, e - b))(*np.searchsorted(of, [part, part + 1]).tolist())))
        if held:
            yield from held.pairs(edits)
        release()

    return rows.mapInArrow(each, "a long, b long").distinct()


def within(a: str, b: str, edits: int) -> bool:
    """Whether at most so many edits part two texts: a band of 2 * edits + 1 diagonals, a bit for each."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > edits:
        return False
    # Equal ends never need an edit.
    low, high = 0, len(a)
    while low < high:  # the longest common prefix, by halves
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    a, b = a[low:], b[low:]
    low, high = 0, len(a)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[len(a) - middle:len(a) - low] == b[len(b) - middle:len(b) - low] else (low, middle - 1)
    a, b = a[:len(a) - low], b[:len(b) - low]
    n = len(a)
    if not n or not edits:
        return len(b) <= edits
    width = 2 * edits + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << (i + edits)
    # Column j covers the rows j - edits to j + edits of the table; bit 0 is the first of them.
    positive, negative, distance = full & (full << edits), 0, min(edits, n)
    for j, c in enumerate(b):
        match = places.get(c, 0) >> j & full
        diagonal = ((((match & positive) + positive) ^ positive) | match | negative) & full
        across, back = negative | ~(diagonal | positive) & full, diagonal & positive
        if j + edits < n:  # the lowest row of the band, along its diagonal
            distance += not diagonal & top
        else:  # the last row of the table, from left to right
            bit = 1 << (n - 1 - j + edits)
            distance += bool(across & bit) - bool(back & bit)
        if distance > edits + max(len(b) - 1 - j, 0) + edits:
            return False
        shifted = diagonal >> 1
        positive, negative = back | ~(shifted | across) & full, shifted & across
    return distance <= edits


def linked(docs: DataFrame, pairs: DataFrame, first: DataFrame, edits: int) -> DataFrame:
    """Those of the pairs that so few edits part. first: digest, doc_id, text_key, line of one line with that text."""
    wanted = pairs.select(F.col("a").alias("digest")).union(pairs.select("b")).distinct()
    wanted = wanted.join(first, "digest").groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(
        F.collect_set(F.struct("line", "digest")).alias("wanted"))  # at most the lines of one document

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = {"digest": [], "text": []}
        want = batch.column("wanted").to_pylist()
        for lines in lines_of(batch.column("text")):
            for row in range(int(lines.row[0]), int(lines.row[-1]) + 1) if len(lines.row) else ():
                mine = slice(*np.searchsorted(lines.row, [row, row + 1]))
                place = {n: k for k, n in enumerate(lines.number[mine].tolist(), mine.start)}
                for w in want[row]:
                    k = place.get(w["line"])
                    if k is not None and int(lines.digest[k].view(np.int64)) == w["digest"]:
                        out["digest"].append(w["digest"])
                        out["text"].append(lines.chars[lines.start[k]:lines.end[k]].tobytes().decode("utf-32-le"))
        return pa.record_batch({"digest": pa.array(out["digest"], pa.int64()), "text": pa.array(out["text"], pa.string())})

    both = docs.join(wanted, same_row(docs, wanted))
    texts = written(in_arrow(both.select("text", "wanted"), each, "digest long, text string"), "lines-texts")

    def verify(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = [within(x.as_py(), y.as_py(), edits) for x, y in zip(batch.column("x"), batch.column("y"), strict=True)]
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = (pairs.join(texts.select(F.col("digest").alias("a"), F.col("text").alias("x")), "a")
              .join(texts.select(F.col("digest").alias("b"), F.col("text").alias("y")), "b"))
    return in_arrow(joined.select("a", "b", "x", "y"), verify, "a long, b long").distinct()


def line_classes(docs: DataFrame, edits: int = EDITS, least: int = LEAST_CHARS) -> DataFrame:
    """The result of ``keyed_classes`` without the text_key."""
    return keyed_classes(docs, edits, least).drop("text_key")


def keyed_classes(docs: DataFrame, edits: int, least: int) -> DataFrame:
    """doc_id, text_key, line, start, end, n_links, class_doc_id, class_line, class_documents, kept: one row per non-blank line.

    The class is named by its earliest line; n_links counts other texts that
    the line's text is linked with directly, class_documents the documents that
    hold a line of the class.
    """
    occ = written(occurrences(docs), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "line")
    texts = occ.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    texts = written(texts, "lines-distinct")
    pairs = written(candidates(docs, occ, edits, least), "lines-pairs")
    first = texts.select("digest", "first.doc_id", "first.text_key", "first.line")
    links = written(linked(docs, pairs, first, edits), "lines-links")
    joined = components(links, "a", "b").select(F.col("node").alias("digest"), "component")
    degree = links.select(F.col("a").alias("digest")).union(links.select("b")).groupBy("digest").agg(F.count(F.lit(1)).alias("n_links"))
    # Only texts that occur again or have links need more than their own line says.
    again = texts.join(joined, "digest", "left").join(degree, "digest", "left").where("n > 1 or component is not null")
    again = written(again.withColumn("component", F.coalesce("component", "digest")), "lines-again")
    holders = occ.join(again.select("digest", "component"), "digest").select("component", "doc_id", "text_key").distinct()
    classes = again.groupBy("component").agg(F.min("first").alias("class")).join(holders.groupBy("component").agg(F.count(F.lit(1)).alias("class_documents")), "component")
    known = again.join(classes, "component").select("digest", "class", "class_documents", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    own = occ.join(known, "digest", "left").withColumn("class", F.coalesce("class", place))
    kept = F.col("doc_id").eqNullSafe(F.col("class.doc_id")) & (F.col("text_key") == F.col("class.text_key")) & (F.col("line") == F.col("class.line"))
    return own.select("doc_id", "text_key", "line", "start", "end", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("class.doc_id").alias("class_doc_id"),
                      F.col("class.line").alias("class_line"), F.coalesce("class_documents", F.lit(1)).cast("long").alias("class_documents"), kept.alias("kept"))


def without_repeats(docs: DataFrame, least_documents: int, edits: int = EDITS, least: int = LEAST_CHARS) -> DataFrame:
    """``docs`` without the lines that repeat an earlier one, of classes that so many documents share.

    Rows that share a doc_id are documents of their own, told by their texts; rows equal in both are treated
    alike. A document of which no non-blank line is left goes; one that had none
    stays. n_chars, where there is such a column, becomes the new length.
    """
    again = keyed_classes(docs, edits, least).where(~F.col("kept") & (F.col("class_documents") >= least_documents))
    gone = again.groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(F.collect_set("line").alias("__gone"))  # at most the lines of one document
    whole = docs.join(gone, same_row(docs, gone), "left").drop("__id", "__key")
    lines = F.split("text", "\n", -1)
    left = F.filter(lines, lambda _, i: ~F.array_contains(F.col("__gone"), i))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    whole = whole.withColumn("text", text).where(F.col("__gone").isNull() | F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        whole = whole.withColumn("n_chars", F.when(F.col("__gone").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return whole.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_classes(table(spark, sf_dir, "documents"))
