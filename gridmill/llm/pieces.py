"""SentencePiece BPE in rounds of array operations.

A text gets the model's word mark in front, blanks become marks, and it is cut before
every mark that follows something else. The different words of a batch are encoded
together: one flat array of symbols, in which neighbours between which no piece of the
vocabulary can reach are cut apart into segments. Each round looks up the ranks of
neighbouring symbols, takes the least of each segment, merges all its places from the
left, and compacts the arrays; segments without a pair leave. Ranks go by score, so
that pieces of equal score take turns from the left, as the library has it.

Merging all places at once is exact where no piece of a better or equal rank starts or
ends with the merged one; after the others (``late``) only the first place of a segment
is merged in a round. Segments of over ``LONG`` symbols (rows of signs, of blanks) would
need many rounds; they go through a heap, in time n log n.

Decoding looks pieces up, joins their bytes, takes the mark at the text's start away,
and puts U+FFFD for each byte that is not UTF-8.

Models that this holds for are BPE without a normaliser, user pieces or unused pieces,
with byte fallback and marks in front; others are refused. The model's bytes are read in
the driver (half a megabyte here) and sent along.

Defined cases: a null text is empty and has no ids; a text of blanks alone keeps them;
repeated rows are handled alike; an empty table gives no rows; other columns are carried
by :func:`encode_documents`, and dropped by the query.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.llm.common import flat_bytes, table, tidy, windows

MODEL = "piece_bpe_32k.model"
#: Symbols up to which a segment is merged by rounds.
LONG = 512
#: Bytes of texts whose words are encoded together.
WINDOW = 4 << 20
MARK = "▁"
_NONE = np.int32(2**31 - 1)
_BLANK = 32
# Kinds of pieces in a model file.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


def _fields(message: bytes) -> Iterator[tuple[int, object]]:
    """Numbers and values of a protocol buffer's fields."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (message[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if message[at - 1] < 128:
                return value, at

    at = 0
    while at < len(message):
        key, at = number(at)
        if key & 7 == 0:
            value, at = number(at)
        else:
            length, at = number(at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = message[at : at + length], at + length
        yield key >> 3, value


class PairTable:
    """A hash table of pairs of symbols: where a key lies, or none."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(8, int(np.ceil(np.log2(max(1, len(keys)) * 6))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        places, left = self._place(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[places] < 0
            _, first = np.unique(np.where(free, places, -1), return_index=True)
            first = first[free[first]]
            self.keys[places[first]] = keys[left[first]]
            self.values[places[first]] = left[first]
            rest = np.ones(len(left), bool)
            rest[first] = False
            places, left = (places[rest] + 1) & ((1 << self.bits) - 1), left[rest]

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where it is not in the table."""
        places = self._place(keys)
        held = self.keys[places]
        out = np.where(held == keys, self.values[places], np.int32(-1))
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_):
            places[open_] = (places[open_] + 1) & ((1 << self.bits) - 1)
            held = self.keys[places[open_]]
            same = held == keys[open_]
            out[open_[same]] = self.values[places[open_[same]]]
            open_ = open_[~same & (held >= 0)]
        return out


class Codec:
    """A model file's pieces and merges as arrays."""

    def __init__(self, model: bytes):
        pieces, scores, kinds, settings = [], [], [], {}
        for field, value in _fields(model):
            if field == 1:
                piece = dict(_fields(value))
                pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                kinds.append(piece.get(3, _NORMAL))
            elif field in (2, 3):
                settings |= {(field, k): v for k, v in _fields(value)}
        trained, normal = (lambda k, default=0: settings.get((2, k), default)), (lambda k, default: settings.get((3, k), default))
        fits = trained(3, 1) == 2 and trained(35) and not trained(24) and not normal(2, b"") and normal(3, 1) and not normal(4, 1) and normal(5, 1)
        if not fits or not set(kinds) <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE} or kinds.count(_BYTE) != 256:
            raise ValueError("only BPE models without a normaliser, with byte fallback and marks in front, are handled")
        self.n_pieces = len(pieces)
        ranks = {s: k for k, s in enumerate(sorted({s for s, kind in zip(scores, kinds) if kind == _NORMAL}, reverse=True))}
        numbers = {p: i for i, (p, kind) in enumerate(zip(pieces, kinds)) if kind == _NORMAL}
        rank_of = {p: ranks[scores[i]] for p, i in numbers.items()}
        for c in sorted({c for p in numbers for c in p} - numbers.keys()):  # signs that pieces are made of, but that are none
            numbers[c] = self.n_pieces + len(numbers)
        self.unknown = self.n_pieces + len(numbers)  # of any other sign
        keys, merged, rank, late = [], [], [], set()
        for p, r in rank_of.items():
            for k in range(1, len(p)):
                head, tail = p[:k], p[k:]
                if head in numbers and tail in numbers:
                    keys.append(numbers[head] << 32 | numbers[tail])
                    merged.append(numbers[p])
                    rank.append(r)
                late.update(numbers[q] for q in (head, tail) if len(q) > 1 and rank_of.get(q, -1) >= r)
        self.merges, self.merged, self.rank = PairTable(np.array(keys, np.int64)), np.array(merged, np.int32), np.array(rank, np.int32)
        self.late = np.zeros(len(keys), bool)
        self.late[[i for i, m in enumerate(merged) if m in late]] = True
        self.symbol = np.full(0x110000, self.unknown, np.int32)
        self.symbol[[ord(c) for c in numbers if len(c) == 1]] = [i for c, i in numbers.items() if len(c) == 1]
        self.neighbours = PairTable(np.array(sorted({int(self.symbol[ord(a)]) << 32 | int(self.symbol[ord(b)]) for p in rank_of for a, b in zip(p, p[1:])}), np.int64))
        if any(MARK in p.lstrip(MARK) for p in rank_of):
            raise ValueError("pieces with marks behind other signs are not handled")
        self.byte = np.zeros(256, np.int32)
        raw = []
        for i, (p, kind) in enumerate(zip(pieces, kinds)):
            if kind == _BYTE:
                self.byte[int(p[1:-1], 16)] = i
            raw.append({_NORMAL: p.replace(MARK, " ").encode(), _BYTE: bytes([int(p[1:-1], 16)]) if kind == _BYTE else b"", _CONTROL: b"", _UNKNOWN: settings.get((2, 44), " ⁇ ".encode())}[kind])
        self.raw, self.decimals = pa.array(raw, pa.large_binary()), pa.array([str(i) for i in range(self.n_pieces)], pa.large_string())
        self.silent, self.marked = np.array([k == _CONTROL for k in kinds]), np.array([k == _NORMAL and p.startswith(MARK) for p, k in zip(pieces, kinds)])

    def _pairs(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The merge of each symbol ``at`` with the next one, -1 for none."""
        return self.merges.find(symbols[at].astype(np.int64) << 32 | symbols[at + 1].astype(np.int64))

    def merge(self, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What remains of ``symbols`` after all merges, and where each started. ``first``
        marks those before which no merge reaches."""
        done = np.full(len(symbols), -1, np.int32)
        start = np.flatnonzero(first)
        size = np.diff(np.append(start, len(symbols)))
        for s in np.flatnonzero(size > LONG):
            at, end = start[s], start[s] + size[s]
            left, where = self._merge_long(symbols[at:end].tolist())
            done[at + np.array(where)] = left
        single = start[size == 1]
        done[single] = symbols[single]
        stay = np.repeat((size > 1) & (size <= LONG), size)
        origin, s, first = np.flatnonzero(stay), symbols[stay], first[stay]
        pair = np.full(len(s), -1, np.int32)
        inner = np.flatnonzero(~first[1:]) if len(s) else origin
        pair[inner] = self._pairs(s, inner)
        while len(s):
            rank = np.where(pair >= 0, self.rank[pair], _NONE)
            start = np.flatnonzero(first)
            size = np.diff(np.append(start, len(s)))
            least = np.minimum.reduceat(rank, start)
            ended = np.repeat(least == _NONE, size)
            if ended.any():
                done[origin[ended]] = s[ended]
                stay = ~ended
                origin, s, first, pair, rank = origin[stay], s[stay], first[stay], pair[stay], rank[stay]
                open_ = least != _NONE
                least, size = least[open_], size[open_]
                if not len(s):
                    break
            hit = np.flatnonzero(rank == np.repeat(least, size))
            # Of places that overlap in a row, every second one; of late pieces, the segment's first.
            follows = np.zeros(len(hit), bool)
            follows[1:] = hit[1:] == hit[:-1] + 1
            run = np.maximum.accumulate(np.where(follows, 0, np.arange(len(hit))))
            take = (np.arange(len(hit)) - run) % 2 == 0
            if (slow := self.late[pair[hit]]).any():
                segment = np.repeat(np.arange(len(size)), size)[hit]
                head = np.ones(len(hit), bool)
                head[1:] = segment[1:] != segment[:-1]
                any_slow = np.zeros(len(size), bool)
                any_slow[segment[slow]] = True
                take &= head | ~any_slow[segment]
            hit = hit[take]
            s[hit] = self.merged[pair[hit]]
            stay = np.ones(len(s), bool)
            stay[hit + 1] = False
            hit = (np.cumsum(stay) - 1)[hit]
            origin, s, first, pair = origin[stay], s[stay], first[stay], pair[stay]
            pair[hit] = -1
            last = np.append(first[1:], True)  # a segment's last symbol has no pair
            before = hit[~first[hit]] - 1
            for at in (hit[~last[hit]], before):
                pair[at] = self._pairs(s, at)
        where = np.flatnonzero(done >= 0)
        return done[where], where

    def _merge_long(self, symbols: list[int]) -> tuple[list[int], list[int]]:
        """The same for one long segment, merge by merge."""
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        array = np.array(symbols, np.int64)
        found = self.merges.find(array[:-1] << 32 | array[1:])
        heap = [(int(self.rank[p]), i, symbols[i], symbols[i + 1], int(self.merged[p])) for i, p in enumerate(found.tolist()) if p >= 0]
        heapq.heapify(heap)
        known: dict[int, tuple[int, int]] = {}
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue  # one of them has been merged meanwhile
            symbols[i], symbols[j], after[i] = m, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n:
                    key = symbols[left] << 32 | symbols[right]
                    if key not in known:
                        p = int(self.merges.find(np.array([key], np.int64))[0])
                        known[key] = (int(self.rank[p]), int(self.merged[p])) if p >= 0 else (-1, -1)
                    rank, merged = known[key]
                    if rank >= 0:
                        heapq.heappush(heap, (rank, left, symbols[left], symbols[right], merged))
        where = [i for i, x in enumerate(symbols) if x >= 0]
        return [symbols[i] for i in where], where

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has. Blanks stand for marks."""
        flat, offsets = flat_bytes(words)
        heads = (flat & 0xC0) != 0x80
        signs = np.frombuffer(codecs.decode(flat, "utf-8").replace(" ", MARK).encode("utf-32-le"), np.uint32)
        symbols = self.symbol[signs]
        before = np.concatenate([[0], np.cumsum(heads)])[offsets]  # signs before each word
        first = np.zeros(len(symbols) + 1, bool)
        first[before] = True
        first = first[:-1]
        inner = np.flatnonzero(~first)
        first[inner[self.neighbours.find(symbols[inner - 1].astype(np.int64) << 32 | symbols[inner].astype(np.int64)) < 0]] = True
        left, where = self.merge(symbols, first)
        owner = np.searchsorted(before, where, "right") - 1
        other = np.flatnonzero(left >= self.n_pieces)  # signs without a piece become bytes
        if len(other):
            spelt = "".join(map(chr, signs[where[other]].tolist())).encode()
            long = np.ones(len(left), np.int64)
            code = signs[where[other]]
            long[other] = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
            as_bytes = np.zeros(len(left), bool)
            as_bytes[other] = True
            left, owner, as_bytes = np.repeat(left, long), np.repeat(owner, long), np.repeat(as_bytes, long)
            left[as_bytes] = self.byte[np.frombuffer(spelt, np.uint8)]
        return left, np.bincount(owner, minlength=len(words)).astype(np.int64)

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of a batch of texts, and the row of each, a window at a time; in order."""
        texts = pc.replace_substring(texts.fill_null("").cast(pa.large_string()), MARK, " ")
        texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
        flat, offsets = flat_bytes(texts)
        for a, b in windows(flat, offsets, _word_starts, WINDOW):
            first = _word_starts(flat, a, b)
            first[offsets[(offsets >= a) & (offsets < b)] - a] = True
            first[0] = True
            start = np.flatnonzero(first)
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(np.append(start, b - a)), pa.py_buffer(flat[a:b])])
            coded = words.dictionary_encode()
            ids, counts = self.words(coded.dictionary)
            order = coded.indices.to_numpy()
            ends = np.cumsum(counts)
            long = counts[order]
            at = np.repeat((ends - counts)[order] - (np.cumsum(long) - long), long) + np.arange(long.sum())
            yield ids[at], np.repeat(np.searchsorted(offsets, start + a, "right") - 1, long)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The UTF-8 text of each row's ids."""
        joined = self.raw.take(pa.array(ids))
        flat, offsets = flat_bytes(joined)
        whole, ends, out = memoryview(flat), np.cumsum(counts), []
        for at, end in zip((ends - counts).tolist(), ends.tolist()):
            cut = [at, *(at + np.flatnonzero(self.silent[ids[at:end]])).tolist(), end]  # bytes don't join over these
            while at < end and self.silent[ids[at]]:
                at += 1
            skip = offsets[at] + 1 if at < end and self.marked[ids[at]] else 0
            parts = (bytes(whole[max(skip, offsets[a]) : offsets[b]]) for a, b in zip(cut, cut[1:]))
            out.append(b"".join(p if p.isascii() else p.decode("utf-8", "each_byte").encode() for p in parts))
        return out


def _word_starts(flat: np.ndarray, a: int, b: int) -> np.ndarray:
    """Where in [a, b) a blank follows something else: nothing is merged over that."""
    blank = flat[a:b] == _BLANK
    blank[1:] &= flat[a : b - 1] != _BLANK
    if len(blank) and a:
        blank[0] &= flat[a - 1] != _BLANK
    return blank


@functools.lru_cache(maxsize=2)
def _codec(model: bytes) -> Codec:
    return Codec(model)


def load_model(spark: SparkSession, path: str | None = None) -> Broadcast:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _rows(codec: Codec, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and how many each has."""
    parts = list(codec.encode(texts))
    ids = np.concatenate([p for p, _ in parts] or [np.zeros(0, np.int32)])
    return ids, sum((np.bincount(r, minlength=len(texts)) for _, r in parts), np.zeros(len(texts), np.int64))


def encode_documents(docs: DataFrame, model: Broadcast, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text as an array column; one of that name is replaced."""
    docs = docs.drop(ids)
    at, schema = docs.columns.index(text), T.StructType([*docs.schema, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model.value)
        for batch in batches:
            found, counts = _rows(codec, batch.column(at))
            column = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(found, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, ids])

    return docs.mapInArrow(tidy(encode), schema)


def decode_documents(rows: DataFrame, model: Broadcast, ids: str = "ids", text: str = "text") -> DataFrame:
    """``rows`` with the text of each array of ids; null arrays give empty texts."""
    rows = rows.drop(text)
    at, schema = rows.columns.index(ids), T.StructType([*rows.schema, T.StructField(text, T.StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model.value)
        for batch in batches:
            lists = batch.column(at)
            counts = pc.list_value_length(lists).fill_null(0).to_numpy().astype(np.int64)
            texts = codec.decode(lists.flatten().to_numpy(), counts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=[*batch.schema.names, text])

    return rows.mapInArrow(tidy(decode), schema)


def digests(docs: DataFrame, model: Broadcast, text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256 (of the
    text that decoding the ids gives)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model.value)
        for batch in batches:
            ids, counts = _rows(codec, batch.column(1))
            lists = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts))), codec.decimals.take(pa.array(ids)))
            flat, offsets = flat_bytes(pc.binary_join(lists, pa.scalar(",", pa.large_string())))
            whole, offsets = memoryview(flat), offsets.tolist()
            spelt = [hashlib.sha256(whole[a:b]).hexdigest() for a, b in zip(offsets, offsets[1:])]
            decoded = [hashlib.sha256(t).hexdigest() for t in codec.decode(ids, counts)]
            yield pa.record_batch([batch.column(0), pa.array(counts), pa.array(spelt, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(tidy(digest), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op11_pieces(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), load_model(spark))
