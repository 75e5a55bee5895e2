"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Adjacent symbol pairs whose union is a piece wait on an agenda ordered by
score, then by place; the best is merged and its new neighbours join the
agenda, until it is empty. A symbol that is no piece falls back to its bytes.

A merge never crosses a place whose two characters stand side by side in no
piece. Texts are cut at such places into chunks (in most vocabularies a word
with the spaces before it), and each distinct chunk is encoded once for a
block of texts, or not at all if the worker's bounded cache has it. The
agendas of short chunks of one length are kept side by side in arrays, a row
for each chunk, and every round merges the best pair of each row; a longer
chunk has a heap. Every chunk that is encoded, and one whole text of each Arrow
batch, is held against the sentencepiece library; a difference fails the job.

Defined results: null and empty texts have no ids and decode to the empty
text; repeated rows and null ids are encoded like others; texts of any length
are encoded whole, a window of chunks at a time; an empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.common import in_arrow, table, utf8_parts

SPACE = "▁"
CACHE = 400_000  # chunks a worker keeps
WINDOW = 1 << 20  # characters of a long text at a time
BLOCK = 4 << 20  # bytes of texts that are cut and looked up together
SHORT = 32  # characters of a chunk whose agenda is a row of an array
NONE = np.int32(2**31 - 1)
_codecs: dict[str, PieceCodec] = {}


class PieceCodec:
    """Encoder and decoder for one model, given as the bytes of its file."""

    def __init__(self, model: bytes):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(sp.vocab_size())
        self.pieces = [sp.id_to_piece(i) for i in ids]
        plain = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        if any(sp.is_unused(i) for i in plain):
            raise ValueError("vocabularies with unused pieces are not supported")
        self.id = {self.pieces[i]: i for i in plain}
        # The agenda's order: higher scores first. Equal scores share a rank, so that the place decides.
        ranks = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in plain}, reverse=True))}
        self.rank = {self.pieces[i]: ranks[sp.get_score(i)] for i in plain}
        self.byte = {int(self.pieces[i][3:5], 16): i for i in ids if sp.is_byte(i)}
        self.value = {i: b for b, i in self.byte.items()}
        self.unknown, self.control = sp.unk_id(), {i for i in ids if sp.is_control(i)}
        joined = [p for p in self.id if len(p) > 1]
        self.cut_spaces = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in joined)
        self.cut_lines = not any("\n" in p for p in joined)
        # Symbols of the array agenda: every piece, and every character that is a part of one.
        self.symbols = [*self.id, *sorted({c for p in joined for c in p} - set(self.id))]
        number = {p: n for n, p in enumerate(self.symbols)}
        self.char = np.full(0x110000, -1, np.int32)
        for p, n in number.items():
            if len(p) == 1:
                self.char[ord(p)] = n
        pairs = sorted((number[p[:k]] * len(number) + number[p[k:]], number[p], self.rank[p]) for p in joined for k in range(1, len(p)) if p[:k] in number and p[k:] in number)
        self.pair, self.union, self.order = (np.array([x[k] for x in pairs], t) for k, t in ((0, np.int64), (1, np.int32), (2, np.int32)))
        self.symbol_id = np.array([self.id.get(p, -1) for p in self.symbols], np.int32)
        self.decimal = pa.array([str(i).encode() for i in ids], pa.binary())
        self.bytes_of = pa.array([bytes([self.value[i]]) if i in self.value else self.surface([i]).encode() for i in ids], pa.binary())
        self.known = pa.array([], pa.binary())
        self.coded = (np.zeros(0, np.int64), pa.array([], pa.binary()), pa.array([], pa.binary()))

    def ids_of(self, symbols: list[str]) -> list[int]:
        out = []
        for one in symbols:
            if (i := self.id.get(one)) is not None:
                out.append(i)
            else:
                out += [self.byte[b] for b in one.encode()] if self.byte else [self.unknown]
        return out

    def agenda(self, text: str) -> list[int]:
        """The ids of a normalised text, by a heap."""
        symbol, rank = list(text), self.rank
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := rank.get(symbol[i] + symbol[i + 1])) is not None]
        heapify(heap)
        while heap:
            _, i, size = heappop(heap)
            one, j = symbol[i], after[i]
            if not one or j >= n or len(one) + len(symbol[j]) != size:
                continue  # one of the two was merged meanwhile
            symbol[i] = one = one + symbol[j]
            symbol[j] = ""
            after[i] = j = after[j]
            if j < n:
                before[j] = i
                if (r := rank.get(both := one + symbol[j])) is not None:
                    heappush(heap, (r, i, len(both)))
            if (k := before[i]) >= 0 and (r := rank.get(both := symbol[k] + one)) is not None:
                heappush(heap, (r, k, len(both)))
        return self.ids_of([s for s in symbol if s])

    def ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each pair of symbols: the rank of its union (NONE if that is no piece) and the union."""
        key = left.astype(np.int64) * len(self.symbols) + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        found = (self.pair[at] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.order[at], NONE), self.union[at]

    def agendas(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The agendas of chunks of one length side by side: all ids, and how many each chunk has."""
        width, n = len(chunks[0]), len(chunks)
        flat = "".join(chunks)
        symbol = self.char[np.frombuffer(flat.encode("utf-32-le"), np.uint32)].reshape(n, width)
        symbol[symbol < 0] = -1 - np.flatnonzero(symbol.ravel() < 0).astype(np.int32)  # a character that no piece has, by its place
        out, length, rows = symbol.copy(), np.full(n, width), np.arange(n)
        rank, union = self.ranked(symbol[:, :-1], symbol[:, 1:]) if width > 1 else (np.zeros((n, 0), np.int32),) * 2
        while width > 1 and len(rows):
            best = rank.argmin(axis=1)  # the first one of equal ranks
            at = np.arange(len(rows))
            some = rank[at, best] != NONE
            if not some.all():
                done = ~some
                out[rows[done], :width] = symbol[done]
                length[rows[done]] = width
                rows, symbol, rank, union, best = rows[some], symbol[some], rank[some], union[some], best[some]
                at = np.arange(len(rows))
                if not len(rows):
                    break
            symbol[at, best] = union[at, best]
            width -= 1
            column = np.arange(width)
            symbol = np.take_along_axis(symbol, column + (column > best[:, None]), 1)
            column = np.arange(width - 1)
            moved = np.minimum(column + (column >= best[:, None]), width - 1)
            rank, union = np.take_along_axis(rank, moved, 1), np.take_along_axis(union, moved, 1)
            for place in (best - 1, best):
                on = np.flatnonzero((place >= 0) & (place < width - 1))
                rank[on, place[on]], union[on, place[on]] = self.ranked(symbol[on, place[on]], symbol[on, place[on] + 1])
        out[rows, :width] = symbol
        length[rows] = width
        got = out[np.arange(out.shape[1]) < length[:, None]]
        ids = np.where(got >= 0, self.symbol_id[got], -1)
        odd = np.flatnonzero(ids < 0)
        if not len(odd):
            return ids, length
        parts = [self.ids_of([self.symbols[g] if g >= 0 else flat[-1 - g]]) for g in got[odd].tolist()]
        many = np.ones(len(ids), np.int64)
        many[odd] = list(map(len, parts))
        spread = np.repeat(ids, many)
        spread[np.repeat(np.isin(np.arange(len(ids)), odd), many)] = [i for p in parts for i in p]
        ends = np.cumsum(length)
        return spread, np.add.reduceat(many, np.concatenate([[0], ends[:-1]]))

    def surface(self, ids: list[int]) -> str:
        """The text of ids, with the spaces that its words begin with."""
        out, run = [], bytearray()
        for i in ids:
            if i in self.value:
                run.append(self.value[i])
                continue
            if run:
                out.append(replaced(run))
                run.clear()
            out.append(" ⁇ " if i == self.unknown else "" if i in self.control else self.pieces[i].replace(SPACE, " "))
        return "".join(out) + replaced(run)

    def decode(self, ids: list[int]) -> str:
        return self.surface(ids).removeprefix(" ") if ids and self.pieces[ids[0]].startswith(SPACE) else self.surface(ids)

    def new_chunks(self, raw: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Of chunks that the cache lacks: the number of ids, the ids joined by commas, the text decoded from them."""
        chunks = [c.decode().replace(" ", SPACE) for c in raw.to_pylist()]
        size = np.array(list(map(len, chunks)))
        counts, parts, order = np.zeros(len(chunks), np.int64), [], []
        for width in np.unique(size[size <= SHORT]):
            for at in np.array_split(np.flatnonzero(size == width), -(-int((size == width).sum()) // 20_000)):
                ids, counts[at] = self.agendas([chunks[i] for i in at])
                parts.append(ids)
                order.append(at)
        for i in np.flatnonzero(size > SHORT):
            ids = self.agenda(chunks[i])
            counts[i] = len(ids)
            parts.append(np.array(ids, np.int32))
            order.append([i])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts[np.concatenate(order)])]), pa.int32()), pa.array(np.concatenate(parts), pa.int32()))
        lists = lists.take(pa.array(np.argsort(np.concatenate(order))))
        ids = lists.flatten()
        if self.cut_spaces and self.cut_lines:
            theirs = self.library.encode("\n" + "\n".join(chunks), num_threads=1)  # every new chunk is held against the library
            line, starts = self.agenda("\n"), (lists.offsets.to_numpy() - lists.offsets[0].as_py())[:-1]
            mine = np.concatenate([self.agenda(SPACE), np.insert(ids.to_numpy(), starts.repeat(len(line)), np.tile(line, len(starts)))])
            if not np.array_equal(mine, theirs):
                raise ValueError("the library encodes a chunk differently")
        offsets = lists.offsets
        joined = [pc.binary_join(pa.ListArray.from_arrays(offsets, t.take(ids)), s) for t, s in ((self.decimal, b","), (self.bytes_of, b""))]
        return counts, *joined

    def cut(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The chunks of normalised texts, and where each text's chunks begin."""
        (_, _, data, offsets), = utf8_parts(pa.array(texts, pa.large_string()), 1 << 62)
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        if self.cut_spaces:
            space = data == 32
            first[1:-1] |= space[1:] & ~space[:-1]
        if self.cut_lines:
            line = data == 10
            first[:-1] |= line
            first[1:] |= line
        starts = np.flatnonzero(first)
        chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)])
        return chunks.cast(pa.binary()), np.searchsorted(starts, offsets)

    def coded_texts(self, texts: list[str]) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Of normalised, non-empty texts: the number of ids, the ids joined by commas, the decoded surface."""
        chunks, begin = self.cut(texts)
        found = chunks.dictionary_encode()
        place = pc.index_in(found.dictionary, value_set=self.known)
        fresh = found.dictionary.filter(place.is_null())
        if len(fresh):
            if len(self.known) + len(fresh) > CACHE:  # keep what this block needs
                old = pc.drop_null(place)
                self.known, self.coded = self.known.take(old), (self.coded[0][old.to_numpy()], self.coded[1].take(old), self.coded[2].take(old))
            got = self.new_chunks(fresh)
            self.known = pa.concat_arrays([self.known, fresh])
            self.coded = (np.concatenate([self.coded[0], got[0]]), *(pa.concat_arrays([a, b]) for a, b in zip(self.coded[1:], got[1:], strict=True)))
            place = pc.index_in(found.dictionary, value_set=self.known)
        at = place.take(found.indices)
        counts = np.add.reduceat(self.coded[0][at.to_numpy()], begin[:-1])
        lists = [pa.LargeListArray.from_arrays(pa.array(begin, pa.int64()), c.take(at).cast(pa.large_binary())) for c in self.coded[1:]]
        return counts, pc.binary_join(lists[0], pa.scalar(b",", pa.large_binary())), pc.binary_join(lists[1], pa.scalar(b"", pa.large_binary()))

    def windows(self, normal: str) -> list[str]:
        """A normalised text in parts that end where a chunk ends."""
        out, begin = [], 0
        inside = re.compile("(?<! ) ")
        while self.cut_spaces and len(normal) - begin > WINDOW and (cut := inside.search(normal, begin + WINDOW)):
            out.append(normal[begin:cut.start()])
            begin = cut.start()
        return [*out, normal[begin:]]

    def results(self, texts: list[str]) -> list[tuple[int, list[bytes], list[bytes]]]:
        """Of each text: the number of ids, and parts of the ids joined by commas and of the decoded surface."""
        out: list[tuple[int, list[bytes], list[bytes]]] = [(0, [], []) for _ in texts]
        block, size = [], 0

        def flush() -> None:
            nonlocal block, size
            if block:
                counts, ids, surfaces = self.coded_texts([t for _, t in block])
                for (k, _), n, a, b in zip(block, counts.tolist(), ids, surfaces, strict=True):
                    out[k] = (out[k][0] + n, [*out[k][1], a.as_py()], [*out[k][2], b.as_py()])
            block, size = [], 0

        for k, text in enumerate(texts):
            for part in self.windows(self.library.normalize(text).replace(SPACE, " ")) if text else ():
                block.append((k, part))
                size += len(part)
                if size >= BLOCK:
                    flush()
        flush()
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for part in self.results([text])[0][1] for i in part.split(b",")]

    def check(self, text: str) -> None:
        mine, theirs = self.encode(text), self.library.encode(text)
        if mine != theirs or self.decode(mine) != self.library.decode(theirs):
            raise ValueError("the library encodes or decodes a text differently")

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Number of ids, SHA-256 of the decimal ids joined by commas, SHA-256 of the decoded text."""
        return [(n, hashlib.sha256(b",".join(ids)).hexdigest(), hashlib.sha256(b"".join(surface).removeprefix(b" ")).hexdigest())
                for n, ids, surface in self.results(texts)]


def replaced(run: bytes | bytearray) -> str:
    """Bytes as text; each byte that belongs to no character as a replacement character."""
    out, run = [], bytes(run)
    while run:
        try:
            out.append(run.decode())
            break
        except UnicodeDecodeError as wrong:
            out.append(run[:wrong.start].decode() + "�")
            run = run[wrong.start + 1:]
    return "".join(out)


def codec_of(model: bytes) -> PieceCodec:
    """One codec a worker and model; its cache lives as long as the worker."""
    name = hashlib.sha1(model).hexdigest()
    if name not in _codecs:
        _codecs.clear()
        _codecs[name] = PieceCodec(model)
    return _codecs[name]


def tokenised(docs: DataFrame, model_path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if wanted, ids of every document."""
    with open(model_path, "rb") as file:
        model = file.read()

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec, rows = codec_of(model), []
        for begin in range(0, batch.num_rows, 1000):
            texts = batch.column("text").slice(begin, 1000).fill_null("").to_pylist()
            if not begin:
                codec.check(texts[0])
            rows += codec.digests(texts)
        out = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array([r[0] for r in rows], pa.int64()),
               "ids_sha256": pa.array([r[1] for r in rows], pa.string()), "decoded_sha256": pa.array([r[2] for r in rows], pa.string())}
        if with_ids:
            out["ids"] = pa.array([codec.encode(t) for t in batch.column("text").fill_null("").to_pylist()], pa.list_(pa.int32()))
        return pa.record_batch(out)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), each, schema)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenised(table(spark, sf_dir, "documents"), default_model())
