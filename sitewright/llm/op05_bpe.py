"""Byte-level BPE encoding and decoding without a regex engine.

Texts become arrays of code points and of their classes. Where a piece starts
follows from an automaton over the classes, run as a scan: every position holds
its transition function, as a row of next states, and functions are composed
with the ones before them until all are constant. Only apostrophes that may
open a contraction are not constant to begin with, so that few rows are
composed. The slices between the starts are merged by rank, each distinct slice
once per worker, and every token keeps the byte at which it starts.

Defined results: a null text is an empty one and has no tokens; rows are never
merged, so repeated rows and ids give repeated results; a null doc_id stays
null; columns other than doc_id and text are ignored.
"""

import base64
import functools
import hashlib
import heapq
import itertools
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sitewright.llm.common import map_texts

# Classes of code points.
LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
# Code points that the pattern's \s matches (fixed values).
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# What may follow an apostrophe in a contraction (fixed values).
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]

# States: what the last character belongs to. BLANK is a space (U+0020), WHITE
# any other white space, EDGE the start of a text, OPEN a contraction.
S_LETTER, S_NUMBER, S_WHITE, S_OTHER, S_BLANK, S_OPEN, S_EDGE = range(7)
# Kinds of characters, rows of STEP: the states' order, and an apostrophe with a contraction's letters behind it.
K_OPEN = 5
STEP = np.array([[s] * 7 for s in (S_LETTER, S_NUMBER, S_WHITE, S_OTHER, S_BLANK)] + [[S_OPEN] * 7], dtype=np.uint8)
STEP[K_OPEN, [S_OTHER, S_BLANK]] = S_OTHER

#: Distinct slices a worker keeps merged; beyond that it starts anew.
CACHE_SLICES = 600_000
# Above every rank.
NONE = 1 << 62
#: Slices of more bytes are merged with a heap.
LONG_SLICE = 48


@functools.cache
def classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for code in range(0x110000):
        kind = kinds.get(unicodedata.category(chr(code))[0])
        if kind is not None:
            table[code] = kind
    table[WHITE_SPACE] = SPACE
    return table


def scan(functions: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The state after each position, by composing transition functions.

    `functions[i, s]` is the state after position i if s was the one before it.
    `first` marks positions that follow EDGE. Composition is associative, so
    rows may be composed in any grouping: those that are not yet constant take
    in the row at their reach, which then doubles.
    """
    functions = functions.copy()
    functions[first] = functions[first, S_EDGE][:, None]
    reach = np.arange(len(functions)) - 1
    left = np.flatnonzero((functions != functions[:, :1]).any(axis=1))
    while len(left):
        before = reach[left]
        functions[left] = np.take_along_axis(functions[left], functions[before].astype(np.intp), axis=1)
        reach[left] = reach[before]
        left = left[(functions[left] != functions[left][:, :1]).any(axis=1)]
    return functions[:, 0]


def piece_starts(codes: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Positions at which pieces start, in joined texts that start at `text_starts`."""
    n = len(codes)
    if not n:
        return np.zeros(0, dtype=np.int64)
    first = np.zeros(n + 1, dtype=bool)
    first[text_starts[text_starts < n]] = True
    first[n] = True
    kind = classes()[codes]
    space = kind == SPACE
    blank = codes == 32
    kinds = np.where(blank, S_BLANK, kind).astype(np.uint8)

    # Apostrophes with a contraction's letters behind them, in the same text.
    length = np.zeros(n, dtype=np.int64)
    marks = np.flatnonzero(codes == 39)
    for tail in CONTRACTIONS:
        at = marks[marks + len(tail) < n]
        fits = np.ones(len(at), dtype=bool)
        for k, letter in enumerate(tail, 1):
            fits &= (codes[at + k] == ord(letter)) & ~first[at + k]
        length[at[fits]] = 1 + len(tail)
    kinds[length > 0] = K_OPEN

    open_at = np.flatnonzero(kinds == K_OPEN)
    state = kinds  # constant functions: the state is the kind
    if len(open_at):
        # The scan's rows: the open apostrophes and the constant ones before them.
        rows = np.unique(np.concatenate([open_at, np.maximum(open_at - 1, 0)]))
        state = kinds.copy()
        state[rows] = scan(STEP[kinds[rows]], first[rows] | (np.diff(rows, prepend=-2) > 1))
        # A row without its predecessor in `rows` is constant or first in its text.

    before = np.empty(n, dtype=np.uint8)
    before[0] = S_EDGE
    before[1:] = state[:-1]
    before[first[:n]] = S_EDGE
    opens = state == S_OPEN
    is_other = (state == S_OTHER) | opens
    run = np.where(is_other, S_OTHER, np.where(space, S_WHITE, state))
    run_before = np.where(before == S_BLANK, S_WHITE, np.where(before == S_OPEN, S_OTHER, before))
    starts = run != run_before
    # A space before anything but white space belongs to what follows.
    starts &= ~((before == S_BLANK) & ~space)
    # The last of several white-space characters stands apart from the others.
    ends = space.copy()
    ends[:-1] &= ~space[1:]
    ends &= ~first[1:]
    starts |= ends
    # Contractions end after their letters.
    at = np.flatnonzero(opens)
    starts[at] = True
    for k in (1, 2):
        starts[(at + k)[length[at] > k]] = False
    after = at + length[at]
    starts[after[after < n]] = True
    return np.flatnonzero(starts)


class Encoder(dict):
    """Token ids by slice; a slice that is missing is merged and kept."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.tokens = {i: token for token, i in ranks.items()}
        self.digits = {i: b"%d" % i for i in self.tokens}
        self.sizes = {i: len(token) for i, token in self.tokens.items()}

    def __missing__(self, piece: bytes) -> tuple[int, ...]:
        if len(self) >= CACHE_SLICES:
            self.clear()
        whole = self.ranks.get(piece)
        if whole is not None:
            ids = (whole,)
        elif len(piece) > LONG_SLICE:
            ids = self._merge_long(piece)
        else:
            ids = self._merge(piece)
        self[piece] = ids
        return ids

    def _merge(self, piece: bytes) -> tuple[int, ...]:
        rank = self.ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [rank(piece[i : i + 2], NONE) for i in range(len(piece) - 1)]
        while pairs and (best := min(pairs)) != NONE:
            i = pairs.index(best)
            parts[i] = merged = parts[i] + parts[i + 1]
            del parts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = rank(merged + parts[i + 1], NONE)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + merged, NONE)
        return tuple(map(self.ranks.__getitem__, parts))

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same merges in n log n: a heap of pairs over a linked list of parts."""
        rank, n = self.ranks.get, len(piece)
        end = list(range(1, n + 1))  # of the part that starts here, 0 if none does
        prior = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapq.heapify(heap)

        def push(i: int) -> None:
            j = end[i]
            if j < n and (r := rank(piece[i : end[j]])) is not None:
                heapq.heappush(heap, (r, i, end[j]))

        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or not end[j] or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            if stop < n:
                prior[stop] = i
                push(i)
            if prior[i] >= 0:
                push(prior[i])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text."""
        return [list(itertools.chain.from_iterable(map(self.__getitem__, p))) for p in self.pieces(texts)]

    def pieces(self, texts: list[str]):
        """Each text's slices, as bytes."""
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        text_starts = np.cumsum(lengths) - lengths
        starts = piece_starts(codes, text_starts)
        widths = 1 + (codes > 0x7F).astype(np.int8) + (codes > 0x7FF) + (codes > 0xFFFF)
        at = np.concatenate([[0], np.cumsum(widths, dtype=np.int64)])
        raw = joined.encode()
        cuts = np.append(at[starts], len(raw)).tolist()
        slices = [raw[a:b] for a, b in itertools.pairwise(cuts)]
        of_text = np.append(np.searchsorted(starts, text_starts), len(starts)).tolist()
        for a, b in itertools.pairwise(of_text):
            yield slices[a:b]

    def starts_of(self, ids: list[int]) -> np.ndarray:
        """The byte of its text at which each token starts."""
        sizes = np.fromiter(map(self.sizes.__getitem__, ids), dtype=np.int64, count=len(ids))
        return np.cumsum(sizes) - sizes

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@functools.cache
def encoder(path: str) -> Encoder:
    """The encoder of a ranks file, one per worker."""
    with open(path, "rb") as lines:
        return Encoder({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [text or "" for text in batch.column(1).to_pylist()]


def encode(docs: DataFrame, ranks: str) -> DataFrame:
    """doc_id, ids and the start byte of every token, for each whole text."""

    def make():
        enc = encoder(ranks)

        def work(batch):
            found = enc.encode_all(_texts(batch))
            starts = [enc.starts_of(ids) for ids in found]
            return pa.record_batch(
                [batch.column(0), pa.array(found, pa.list_(pa.int32())), pa.array(starts, pa.list_(pa.int64()))],
                ["doc_id", "ids", "starts"],
            )

        return work

    return map_texts(docs.select("doc_id", "text"), make, "doc_id long, ids array<int>, starts array<long>")


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """doc_id and the bytes that the ids stand for."""

    def run(batches):
        enc = encoder(ranks)
        for batch in batches:
            out = [enc.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def encoded_digests(docs: DataFrame, ranks: str) -> DataFrame:
    """Per document the number of tokens and the digests of its ids and of what they decode to."""

    def make():
        enc = encoder(ranks)

        def work(batch):
            counts, of_ids, of_bytes = [], [], []
            for ids in enc.encode_all(_texts(batch)):
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(b",".join(map(enc.digits.__getitem__, ids))).hexdigest())
                of_bytes.append(hashlib.sha256(enc.decode(ids)).hexdigest())
            return pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_bytes)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return work

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(docs.select("doc_id", "text"), make, schema)
