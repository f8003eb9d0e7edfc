"""Byte-level BPE: encoding with vectorised pre-tokenisation, and decoding by offsets.

Text is split as the pattern of the rank files splits it,

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

but without a regular expression. Every code point becomes one of eleven
symbols (``symbol_table``), and every symbol is a function on the eleven states
of a small automaton. Composition of functions is associative (and there are only
22 different ones, so that it is a table look-up): the states after all code
points of a chunk come from a prefix scan. Blocks of symbols are composed next
to each other, the functions of the blocks are scanned by doubling, and each
block is replayed from the state it starts in. A transition
says whether a slice starts at its code point or at the one before (the space
that belongs to the next word; an apostrophe that was no contraction).

The slices are merged by rank, the lowest and leftmost pair first; the ids of
short slices are kept in a bounded cache. Each token's end in the text's bytes
is kept beside its id, and decoding puts every token's bytes at that place.

A text longer than a chunk is cut where a slice starts whatever stands around
it (white space after something else), so memory does not grow with its length
beyond its ids; a single slice is merged with a heap.

Defined results: a NULL text counts as empty, an empty text has no tokens;
repeated rows are answered each; an empty table gives no rows. Columns of the
input that are not named in ``keep`` are not read, so extra ones cannot clash.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftlens.llm.common import CHUNK_BYTES, table, text_chunks

#: Slices whose ids a worker keeps (a full cache is emptied), and their longest length in bytes.
CACHED_SLICES = 400_000
CACHED_BYTES = 48
#: Slices longer than this are merged with a heap.
HEAP_FROM = 96

# Symbols of code points.
END, LETTER, NUMBER, SPACE, WHITE, OTHER, QUOTE, ONE, R_OR_V, ELL, E = range(11)
# States: what the current slice is. After a contraction or at the start of a
# text it is FRESH; ``LAST_*`` are white space of one code point, ``RUN_*`` of
# more, by its last one; the others have seen an apostrophe, and r or v, or l.
(FRESH, WORD, DIGITS, SIGNS, LAST_SPACE, LAST_WHITE, RUN_SPACE, RUN_WHITE,
 APOSTROPHE, APOSTROPHE_RV, APOSTROPHE_L) = range(11)
STATES = SYMBOLS = 11
# A slice starts at this code point; at the one before.
HERE, BEFORE = 1, 2

# White_Space of Unicode, and the letters and numbers of Unicode
# 16.0 that Python's older tables do not have.
WHITE_SPACE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002,
               0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029,
               0x202F, 0x205F, 0x3000)
LETTERS_16 = ((0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3),
              (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389),
              (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
              (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
              (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
              (0x1E5F0, 0x1E5F0))
NUMBERS_16 = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139),
              (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))


def symbol_table() -> np.ndarray:
    """The symbol of every code point."""
    of = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((of.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)),
                      np.uint8, 0x110000)
    for ranges, symbol in ((LETTERS_16, LETTER), (NUMBERS_16, NUMBER)):
        for first, last in ranges:
            out[first:last + 1] = symbol
    out[list(WHITE_SPACE)] = WHITE
    for letters, symbol in ((" ", SPACE), ("'", QUOTE), ("stmd", ONE), ("rv", R_OR_V), ("l", ELL),
                            ("e", E)):
        out[list(letters.encode())] = symbol
    return out


def _step(state: int, symbol: int) -> tuple[int, int]:
    """(next state, where a slice starts) of one symbol."""
    letters = (LETTER, ONE, R_OR_V, ELL, E)
    white = (LAST_SPACE, LAST_WHITE, RUN_SPACE, RUN_WHITE)
    if state == APOSTROPHE:
        if symbol == ONE:
            return FRESH, 0
        if symbol in (R_OR_V, ELL):
            return (APOSTROPHE_RV if symbol == R_OR_V else APOSTROPHE_L), 0
        state = SIGNS
    late = 0
    if state in (APOSTROPHE_RV, APOSTROPHE_L):
        if symbol == (E if state == APOSTROPHE_RV else ELL):
            return FRESH, 0
        state, late = WORD, BEFORE  # the letter is a word of its own
    if symbol == END:
        return FRESH, late | HERE
    if symbol in (SPACE, WHITE):
        single, run = ((LAST_SPACE, RUN_SPACE) if symbol == SPACE else (LAST_WHITE, RUN_WHITE))
        return (run, 0) if state in white else (single, late | HERE)
    kind = WORD if symbol in letters else DIGITS if symbol == NUMBER else SIGNS
    if state in (LAST_SPACE, RUN_SPACE):  # the space belongs to what follows
        return kind, BEFORE if state == RUN_SPACE else 0
    if state == kind:
        return kind, late
    if state == RUN_WHITE:
        late = BEFORE
    return (APOSTROPHE if symbol == QUOTE else kind), late | HERE


_TABLE = np.array([[_step(s, y) for y in range(SYMBOLS)] for s in range(STATES)], np.intp)
#: Where slices start, by symbol * STATES + state.
STARTS = np.ascontiguousarray(_TABLE[:, :, 1].T).ravel().astype(np.uint8)


def _closure() -> tuple[np.ndarray, np.ndarray]:
    """The functions that the symbols generate, and the number of f followed by g for all f, g.

    Row i of the first result is a function, as the state that each state goes
    to; functions 0 to SYMBOLS - 1 are those of the symbols.
    """
    functions = [tuple(row) for row in _TABLE[:, :, 0].T.tolist()]
    number = {f: i for i, f in reversed(list(enumerate(functions)))}
    for f in functions:  # the list grows as it is read
        for g in functions[:SYMBOLS]:
            both = tuple(g[s] for s in f)
            if both not in number:
                number[both] = len(functions)
                functions.append(both)
    table = [[number[tuple(g[s] for s in f)] for g in functions] for f in functions]
    return np.array(functions, np.intp), np.array(table, np.intp)


#: 22 functions are all that compositions of any length can be.
FUNCTIONS, COMPOSED = _closure()
_WIDTH = 128


def scan(symbols: np.ndarray) -> np.ndarray:
    """Where slices start, by code point: bit ``HERE`` and bit ``BEFORE``."""
    n, many = len(symbols), len(FUNCTIONS)
    rows = -(-n // _WIDTH)
    padded = np.zeros(rows * _WIDTH, np.intp)
    padded[:n] = symbols
    columns = np.ascontiguousarray(padded.reshape(rows, _WIDTH).T)
    composed = COMPOSED.ravel()
    # the function of each block of symbols
    block = columns[0]
    for column in columns[1:]:
        block = composed.take(block * many + column)
    # those of all blocks up to each, by doubling
    step = 1
    while step < rows:
        block[step:] = composed.take(block[:-step] * many + block[step:])
        step *= 2
    state = np.concatenate([[FRESH], FUNCTIONS[block[:-1], FRESH]])
    out = np.empty((_WIDTH, rows), np.uint8)
    after = np.ascontiguousarray(_TABLE[:, :, 0].T).ravel()
    for i, column in enumerate(columns):
        at = column * STATES + state
        out[i] = STARTS.take(at)
        state = after.take(at)
    return out.T.ravel()[:n]


def slice_starts(data: np.ndarray, offsets: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Byte offsets at which the slices of texts start.

    ``data`` are the texts' UTF-8 bytes, ``offsets`` where they begin and end.
    """
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    first = np.flatnonzero((data & 0xC0) != 0x80)  # byte offset of each code point
    ends = np.searchsorted(first, offsets[1:])
    found = scan(np.insert(symbols[codes], ends, END))
    here = (found & HERE) != 0
    here[:-1] |= (found[1:] & BEFORE) != 0
    here[ends + np.arange(len(ends))] = False
    at = np.flatnonzero(here)
    # without the symbols put in between
    return first[at - np.searchsorted(ends + np.arange(len(ends)), at)]


def _safe_cut(data: np.ndarray, at: int) -> int:
    """The first place from ``at`` on where white space follows something else, or the end."""
    step = 1 << 16
    for low in range(at, len(data), step):
        part = data[low:low + step]
        for place in (np.flatnonzero((part == 32) | ((part >= 9) & (part <= 13))) + low).tolist():
            start = place - 1
            while data[start] & 0xC0 == 0x80:
                start -= 1
            if ord(data[start:place].tobytes().decode()) not in WHITE_SPACE:
                return place
    return len(data)


def _parts(data: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    at = 0
    while at < len(data):
        end = _safe_cut(data, at + limit) if at + limit < len(data) else len(data)
        yield data[at:end]
        at = end


# ------------------------------------------------------------------- merging

def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of a slice: the pair of the lowest rank, the leftmost of them, is merged first."""
    whole = ranks.get(piece)
    if whole is not None:
        return (whole,)
    return _merge_heap(piece, ranks) if len(piece) > HEAP_FROM else _merge_scan(piece, ranks)


_NONE = 1 << 40


def _merge_scan(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    get = ranks.get
    bounds = list(range(len(piece) + 1))
    pairs = [get(piece[i:i + 2], _NONE) for i in range(len(piece) - 1)]
    while pairs and (lowest := min(pairs)) != _NONE:
        at = pairs.index(lowest)
        del bounds[at + 1], pairs[at]
        if at < len(pairs):
            pairs[at] = get(piece[bounds[at]:bounds[at + 2]], _NONE)
        if at:
            pairs[at - 1] = get(piece[bounds[at - 1]:bounds[at + 1]], _NONE)
    return tuple([ranks[piece[a:b]] for a, b in zip(bounds, bounds[1:])])


def _merge_heap(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    n = len(piece)
    after = list(range(1, n + 1))    # start of the next part
    before = list(range(-1, n - 1))  # start of the previous one
    rank = [-1] * n                  # rank of a part with the next one; -1: none

    def pair(i: int) -> int:
        j = after[i]
        return ranks.get(piece[i:after[j]], -1) if j < n else -1

    heap = []
    for i in range(n - 1):
        rank[i] = pair(i)
        if rank[i] >= 0:
            heap.append((rank[i] << 40) | i)
    heapq.heapify(heap)
    while heap:
        top = heapq.heappop(heap)
        i = top & ((1 << 40) - 1)
        if rank[i] != top >> 40:
            continue  # one of its parts has changed
        j = after[i]
        after[i] = after[j]
        rank[j] = -1
        if after[i] < n:
            before[after[i]] = i
        for k in (i, before[i]):
            if k >= 0:
                rank[k] = pair(k)
                if rank[k] >= 0:
                    heapq.heappush(heap, (rank[k] << 40) | k)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return tuple(out)


# ---------------------------------------------------------------- vocabulary

@dataclass
class Vocabulary:
    """A rank file in memory: about 50,000 tokens and a table of the code points' symbols."""

    ranks: dict[bytes, int]
    symbols: np.ndarray
    data: np.ndarray    # the bytes of all tokens, by id
    starts: np.ndarray  # where each id's bytes begin, and the end of the last
    # ids of slices seen: a worker keeps a broadcast value, and with it the cache, between tasks
    cache: dict[bytes, tuple[int, ...]] = field(default_factory=dict)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From a file of lines ``base64 rank``; all 256 bytes must have a rank."""
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank)
                     for token, rank in (line.split() for line in lines if line.strip())}
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError(f"{path}: not every byte has a rank")
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        starts = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
        return cls(ranks, symbol_table(), np.frombuffer(b"".join(tokens), np.uint8), starts)


class Encoder:
    """Ids and ends of texts."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.sizes = np.diff(vocabulary.starts)

    def _ids(self, slices: list[bytes]) -> list[tuple[int, ...]]:
        cache, ranks, out = self.vocabulary.cache, self.vocabulary.ranks, []
        for piece in slices:
            ids = cache.get(piece)
            if ids is None:
                ids = merge(piece, ranks)
                if len(piece) <= CACHED_BYTES:
                    if len(cache) >= CACHED_SLICES:
                        cache.clear()
                    cache[piece] = ids
            out.append(ids)
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ends in the text's bytes, first token of each text and the number of all)."""
        if not len(data):
            return (np.empty(0, np.uint32),) * 2 + (np.zeros(len(offsets), np.int64),)
        starts = slice_starts(data, offsets, self.vocabulary.symbols)
        raw = data.tobytes()
        bounds = [*starts.tolist(), len(raw)]
        found = self._ids([raw[a:b] for a, b in zip(bounds, bounds[1:])])
        ids = np.fromiter(chain.from_iterable(found), np.uint32)
        ends = np.cumsum(self.sizes[ids])
        first = np.concatenate([[0], np.searchsorted(ends, offsets[1:], side="right")])
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        return ids, (ends - offsets[owner]).astype(np.uint32), first

    def encode_long(self, data: np.ndarray, limit: int
                    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``encode`` of one text, part by part."""
        ids, ends, done = [], [], 0
        for part in _parts(data, limit):
            i, e, _ = self.encode(part, np.array([0, len(part)]))
            ids.append(i)
            ends.append(e + np.uint32(done))
            done += len(part)
        ids = np.concatenate(ids)
        return ids, np.concatenate(ends), np.array([0, len(ids)])


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Runs of 32-bit values as binary values, little-endian."""
    data = values.astype("<u4")
    return pa.Array.from_buffers(
        pa.large_binary(), len(bounds) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(bounds * 4, np.int64)), pa.py_buffer(data)]
    ).cast(pa.binary())


def _encode_batches(shared, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            names = [*batch.schema.names[:-1], "ids", "ends"]
            for row, end, data, offsets in text_chunks(batch.column(batch.num_columns - 1), limit):
                if end == row + 1 and len(data) > limit:
                    ids, ends, first = encoder.encode_long(data, limit)
                else:
                    ids, ends, first = encoder.encode(data, offsets)
                kept = [c.slice(row, end - row) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [*kept, _binary(ids, first), _binary(ends, first)], names=names)
    return run


def place_tokens(ids: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary) -> bytes:
    """The tokens' bytes, each at its place (``ends``)."""
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for low in range(0, len(ids), 1 << 16):
        i, e = ids[low:low + (1 << 16)], ends[low:low + (1 << 16)].astype(np.int64)
        size = vocabulary.starts[i + 1] - vocabulary.starts[i]
        begin = int(ends[low - 1]) if low else 0
        if not np.array_equal(e, begin + np.cumsum(size)):
            raise ValueError("token ends do not agree with the lengths of the tokens")
        shift = np.repeat(vocabulary.starts[i] - (e - size), size)
        out[begin:e[-1]] = vocabulary.data[np.arange(begin, e[-1]) + shift]
    return out.tobytes()


def _decode_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            names = [*batch.schema.names[:-2], "decoded"]
            ids, ends = batch.columns[-2:]
            row = 0
            while row < batch.num_rows:  # as many rows at a time as a chunk of text
                out, size, low = [], 0, row
                while row < batch.num_rows and size < CHUNK_BYTES:
                    i = np.frombuffer(ids[row].as_buffer(), "<u4").astype(np.int64)
                    out.append(place_tokens(i, np.frombuffer(ends[row].as_buffer(), "<u4"),
                                            vocabulary))
                    size, row = size + len(out[-1]), row + 1
                kept = [c.slice(low, row - low) for c in batch.columns[:-2]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.binary())], names=names)
    return run


def _fields(frame: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema.fields)


def encode(docs: DataFrame, path: str, keep: list[str], text: str = "text",
           limit: int = CHUNK_BYTES) -> DataFrame:
    """The kept columns, ``ids`` and ``ends``: little-endian unsigned 32-bit integers each.

    ``path`` names a rank file on the driver; the vocabulary (a file of fixed
    size) is broadcast. ``ends[i]`` is where token i ends in the UTF-8 bytes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(path))
    kept = docs.select(*keep)
    return docs.select(*keep, F.col(text).alias("_bpe_text")).mapInArrow(
        _encode_batches(shared, limit), _fields(kept) + "ids binary, ends binary")


def decode(encoded: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """The kept columns and ``decoded``, the bytes of the text; ``ids`` and ``ends`` as ``encode``
    returns them."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary.read(path))
    kept = encoded.select(*keep)
    return encoded.select(*keep, F.col("ids").alias("_bpe_ids"), F.col("ends").alias("_bpe_ends")
                          ).mapInArrow(_decode_batches(shared), _fields(kept) + "decoded binary")


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode(table(spark, sf_dir, "documents"), path, ["doc_id"])
    digests = encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), "ids", "ends")
    return decode(digests, path, ["doc_id", "n_tokens", "ids_sha256"]).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
