"""Byte-level BPE: slices by a scan of transition functions, cached merging, decoding by offsets."""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverledger.llm.common import groups, scanned

#: Code points that are scanned at once, in one or many texts.
WINDOW = 1 << 19
#: Slices whose ids are looked up at once, and what a worker remembers of slices at most.
AT_ONCE, REMEMBERED, REMEMBERED_BYTES = 1 << 18, 300_000, 16 << 20
#: Bytes from which merging keeps a heap; shorter slices are merged so many at a time.
LONG, MERGED = 64, 20_000

# Classes of code points; END stands between texts.
OTHER, LETTER, NUMBER, WHITE, END = range(5)
_END_CODE = 0x110000
# Kinds: a code point's class, told apart further by the one or two code points that follow it.
(
    K_OTHER,
    K_LETTER,
    K_NUMBER,
    K_END,
    K_QUOTE_1,  # an apostrophe before one of s t m d
    K_QUOTE_2,  # an apostrophe before re, ve or ll
    K_INNER,  # white space before white space or the end
    K_BLANK,  # a blank before something else: opens that slice
    K_LAST,  # other white space before something else: a slice of its own
) = range(9)
# States: in a run of one class, after an opening blank, with letters of a contraction to come,
# and where any code point starts a slice.
S_FREE, S_LETTER, S_NUMBER, S_OTHER, S_WHITE, S_BLANK, S_ONE, S_TWO = range(8)


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """For every kind and state: the next state, and whether a slice starts here."""
    after, starts = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)
    runs = ((K_LETTER, S_LETTER), (K_NUMBER, S_NUMBER), (K_OTHER, S_OTHER), (K_INNER, S_WHITE))
    for kind, state in runs:
        after[kind] = state
        starts[kind, state] = False
        starts[kind, S_BLANK] = False
    for kind, state in ((K_QUOTE_1, S_ONE), (K_QUOTE_2, S_TWO)):
        after[kind] = state
        after[kind, [S_OTHER, S_BLANK]] = S_OTHER
        starts[kind, [S_OTHER, S_BLANK]] = False
    after[K_LETTER, [S_ONE, S_TWO]] = S_FREE, S_ONE
    starts[K_LETTER, [S_ONE, S_TWO]] = False
    after[K_BLANK], after[K_LAST], after[K_END] = S_BLANK, S_FREE, S_FREE
    return after, starts


_AFTER, _STARTS = _transitions()


def _functions() -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """All compositions of the kinds' transition functions.

    Returns the functions, the number of each kind's own, the number of "f then g" at
    ``f * count + g``, and the number of the identity.
    """
    own = [tuple(row.tolist()) for row in _AFTER]
    found = {f: k for k, f in enumerate(dict.fromkeys([tuple(range(8)), *own]))}
    todo = list(found)
    for f in todo:
        for g in own:
            both = tuple(g[s] for s in f)
            if both not in found:
                found[both] = len(found)
                todo.append(both)
    then = [found[tuple(g[s] for s in f)] for f in found for g in found]
    kind = np.array([found[f] for f in own], np.uint8)
    return np.array(list(found), np.uint8), kind, np.array(then, np.uint8), 0


_FUNCTIONS, _OF_KIND, _THEN, _IDENTITY = _functions()


@functools.lru_cache(maxsize=2)
def classes(library: str = "tiktoken") -> np.ndarray:
    """The class of every code point, as the pattern engine of a tokenizer library has it.

    The engine is asked once which code points its three classes hold, so that both follow the
    same version of Unicode: tiktoken with a vocabulary of single bytes, tokenizers by a split.
    """
    points = "".join(map(chr, [c for c in range(0x40000) if not 0xD800 <= c < 0xE000]))
    table = np.full(_END_CODE + 1, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (WHITE, r"\s")):
        if library == "tiktoken":
            import tiktoken

            single = {bytes([b]): b for b in range(256)}
            asked = tiktoken.Encoding(
                "class", pat_str=pattern, mergeable_ranks=single, special_tokens={}
            )
            held = bytes(asked.encode_ordinary(points)).decode("utf-8")
        else:
            from tokenizers import Regex, pre_tokenizers

            asked = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
            held = "".join(part for part, _ in asked.pre_tokenize_str(points))
        table[np.frombuffer(held.encode("utf-32-le"), "<u4")] = kind
    table[_END_CODE] = END
    return table


def kinds(codes: np.ndarray, n: int, table: np.ndarray) -> np.ndarray:
    """The kinds of the first ``n`` codes by their classes; those after them are only looked at."""
    codes = np.concatenate([codes, np.full(max(0, n + 2 - len(codes)), _END_CODE, codes.dtype)])
    kind_of_class = np.array([K_OTHER, K_LETTER, K_NUMBER, K_INNER, K_END], np.uint8)
    own = table[codes[: n + 1]]
    out = kind_of_class[own[:n]]
    last = np.flatnonzero((own[:n] == WHITE) & (own[1:] != WHITE) & (own[1:] != END))
    out[last] = np.where(codes[last] == ord(" "), K_BLANK, K_LAST)
    quotes = np.flatnonzero(codes[:n] == ord("'"))
    one, two = codes[quotes + 1], codes[quotes + 2]
    out[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = K_QUOTE_1
    pairs = [(one == ord(a)) & (two == ord(b)) for a, b in ("re", "ve", "ll")]
    out[quotes[pairs[0] | pairs[1] | pairs[2]]] = K_QUOTE_2
    return out


def scan(kind: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Where slices start, and the state after the last code point.

    The codes are laid out in blocks. All blocks compose their functions side by side, the
    composed functions are scanned by doubling, which gives the state in which each block begins,
    and then all blocks step through their codes side by side.
    """
    n = len(kind)
    if not n:
        return np.zeros(0, bool), state
    width = max(1, int(np.sqrt(n / 8)))
    rows = -(-n // width)
    count = len(_FUNCTIONS)
    grid = np.full(rows * width, K_END, np.uint8)
    grid[:n] = kind
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    own = _OF_KIND[grid]
    total = own[0]
    for column in own[1:]:
        total = _THEN[total.astype(np.intp) * count + column]
    step = 1
    while step < rows:
        before = np.full(rows, _IDENTITY, np.uint8)
        before[step:] = total[:-step]
        total = _THEN[before.astype(np.intp) * count + total]
        step *= 2
    states = np.empty(rows, np.uint8)
    states[0] = state
    states[1:] = _FUNCTIONS[total[:-1], state]
    starts = np.empty(grid.shape, bool)
    after, starting = _AFTER.ravel(), _STARTS.ravel()
    left = n - (rows - 1) * width  # codes of the last block
    for k, column in enumerate(grid):
        at = column.astype(np.intp) * 8 + states
        starts[k] = starting[at]
        states = after[at]
        if k == left - 1:
            state = int(states[-1])
    return starts.T.ravel()[:n], state


def slices(texts: list[str], table: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes, each text ended by one zero byte, with the start and end of every slice.

    The last array tells of every text how many slices come before it, with the number of all
    slices at its end.
    """
    joined = "\0".join(texts) + "\0"
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    begun, at_end, state, base = [], [], S_FREE, 0
    for a in range(0, len(joined), WINDOW):
        part = joined[a : a + WINDOW + 2]
        codes = np.frombuffer(part.encode("utf-32-le"), "<u4").copy()
        own = np.searchsorted(ends, [a, a + len(codes)])
        codes[ends[own[0] : own[1]] - a] = _END_CODE
        n = min(WINDOW, len(codes))
        starts, state = scan(kinds(codes, n, table), state)
        codes = codes[:n]
        ending = codes == _END_CODE
        size = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        size[ending] = 1
        place = np.cumsum(size) - size + base
        base += int(size.sum())
        begun.append(place[starts])
        at_end.append(ending[starts])
    begin, ending = np.concatenate(begun), np.concatenate(at_end)
    finish = np.append(begin[1:], base)
    before = np.flatnonzero(ending) - np.arange(len(texts))
    return joined.encode("utf-8"), begin[~ending], finish[~ending], np.append(0, before)


class Pairs:
    """The rank of the token that two neighbouring tokens make: an open hash table in arrays.

    Any way to cut a token's bytes into two tokens is such a pair.
    """

    def __init__(self, ranks: dict[bytes, int]):
        cuts = [
            (ranks[t[:k]], ranks[t[k:]], rank)
            for t, rank in ranks.items()
            for k in range(1, len(t))
            if t[:k] in ranks and t[k:] in ranks
        ]
        left, right, made = np.array(cuts or [(0, 0, 0)], np.int64).T[:, : len(cuts)]
        self.count = max(ranks.values()) + 1
        self.bits = max(4, (4 * len(cuts)).bit_length())
        self.keys, self.made = np.full(1 << self.bits, -1), np.zeros(1 << self.bits, np.int64)
        keys = left * self.count + right
        slots = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slots] < 0)
            own, first = np.unique(slots[free], return_index=True)
            self.keys[own], self.made[own] = keys[free[first]], made[free[first]]
            rest = np.flatnonzero(self.keys[slots] != keys)
            keys, made = keys[rest], made[rest]
            slots = (slots[rest] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """_END_CODE where the two make no token."""
        keys = left * self.count + right
        slots = self._slots(keys)
        out = np.full(len(keys), _END_CODE, np.int64)
        open_ = np.arange(len(keys))
        while len(open_):
            held = self.keys[slots]
            hit = held == keys[open_]
            out[open_[hit]] = self.made[slots[hit]]
            on = np.flatnonzero(~hit & (held >= 0))
            open_, slots = open_[on], (slots[on] + 1) & (len(self.keys) - 1)
        return out


class _Numbers(dict):
    """Numbers keys as they are first asked for, and lists the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, piece: bytes) -> int:
        self.new.append(piece)
        self[piece] = number = len(self)
        return number


class Merger:
    """Ids of slices by pair merging. Remembers the ids of the slices it has met, and forgets all
    when they are more than REMEMBERED or longer together than REMEMBERED_BYTES."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.pairs = ranks, Pairs(ranks)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self._forget()

    def _forget(self) -> None:
        """A slice's number leads to the place and number of its ids in the pool."""
        self.number, self.held = _Numbers(), 0
        self.at, self.n, self.pool = np.zeros((3, 0), np.int64)

    def ids_of(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each slice has."""
        if len(self.number) > REMEMBERED or self.held > REMEMBERED_BYTES:
            self._forget()
        which = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))
        if self.number.new:
            self._learn(self.number.new)
            self.number.new = []
        n = self.n[which]
        until = np.cumsum(n)
        place = np.repeat(self.at[which] - until + n, n)
        return self.pool[place + np.arange(len(place))], n

    def _learn(self, new: list[bytes]) -> None:
        """Whole tokens, long slices one by one, and the others by merging together."""
        whole = [self.ranks.get(p, -1) for p in new]
        size = np.fromiter(map(len, new), np.int64, len(new))
        rest = np.flatnonzero(np.array(whole) < 0)
        long_, short = rest[size[rest] >= LONG], rest[size[rest] < LONG]
        n = np.ones(len(new), np.int64)
        found = {k: self.merge_long(new[k]) for k in long_.tolist()}
        n[long_] = [len(ids) for ids in found.values()]
        merged = []
        for a in range(0, len(short), MERGED):
            some = short[a : a + MERGED]
            ids, n[some] = self.merge([new[k] for k in some.tolist()])
            merged.append(ids)
        at = np.cumsum(n) - n
        pool = np.repeat(np.array(whole, np.int64), n)
        for k, ids in found.items():
            pool[at[k] : at[k] + n[k]] = ids
        if merged:
            own = np.repeat(at[short] - np.cumsum(n[short]) + n[short], n[short])
            pool[own + np.arange(len(own))] = np.concatenate(merged)
        self.at = np.concatenate([self.at, at + len(self.pool)])
        self.n = np.concatenate([self.n, n])
        self.pool = np.concatenate([self.pool, pool])
        self.held += int(size.sum())

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each piece has.

        Each round joins, in every piece, the neighbours of the lowest rank, the first of equal
        ones; pieces in which no two neighbours make a token leave.
        """
        done = []
        token = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        piece = np.repeat(np.arange(len(pieces)), list(map(len, pieces)))
        last = np.append(piece[1:] != piece[:-1], True)
        rank = np.full(len(token), _END_CODE, np.int64)
        inner = np.flatnonzero(~last)
        rank[inner] = self.pairs.rank(token[inner], token[inner + 1])
        while len(token):
            first = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            size = np.diff(first, append=len(token))
            least = np.minimum.reduceat(rank, first)
            ended = least == _END_CODE
            if ended.any():
                on = np.repeat(~ended, size)
                done.append((piece[~on], token[~on]))
                token, piece, rank = token[on], piece[on], rank[on]
                size, least = size[~ended], least[~ended]
            if not len(token):
                break
            at = np.flatnonzero(rank == np.repeat(least, size))
            at = at[np.append(True, piece[at[1:]] != piece[at[:-1]])]
            token[at] = rank[at]
            stay = np.ones(len(token), bool)
            stay[at + 1] = False
            token, piece, rank = token[stay], piece[stay], rank[stay]
            at -= np.arange(len(at))  # one token left before each of them
            around = np.concatenate([at, at[at > 0] - 1])
            ends = np.append(piece[1:] != piece[:-1], True)[around]
            rank[around[ends]] = _END_CODE
            around = around[~ends]
            rank[around] = self.pairs.rank(token[around], token[around + 1])
        piece, token = (np.concatenate(c) for c in zip(*done))
        order = np.argsort(piece, kind="stable")
        return token[order], np.bincount(piece, minlength=len(pieces))

    def merge_long(self, piece: bytes) -> list[int]:
        """The ids of one piece with a heap of pairs, so that n bytes take n log n steps."""
        ranks, n = self.ranks, len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = bytearray(b"\1") * n
        heap = []

        def offer(a: int) -> None:
            if a >= 0 and end[a] < n:
                last = end[end[a]]
                rank = ranks.get(piece[a:last])
                if rank is not None:
                    heapq.heappush(heap, (rank, a, last))

        for a in range(n - 1):
            offer(a)
        while heap:
            _, a, last = heapq.heappop(heap)
            if not alive[a] or end[a] >= n or end[end[a]] != last:
                continue
            alive[end[a]] = 0
            end[a] = last
            if last < n:
                before[last] = a
            offer(a)
            offer(before[a])
        out, a = [], 0
        while a < n:
            out.append(ranks[piece[a : end[a]]])
            a = end[a]
        return out


class Encoder:
    """Encodes texts, many at once; ``ranks`` holds every single byte, and ``library`` is the one
    whose classes of code points hold."""

    def __init__(self, ranks: dict[bytes, int], library: str = "tiktoken"):
        self.merger, self.classes = Merger(ranks), classes(library)
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.size[rank] = len(token)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, the byte of its text at which each token starts, and the tokens
        before every text, with the number of all tokens at the end."""
        if not texts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
        held, begin, finish, before = slices(texts, self.classes)
        ids, counts = [], []
        for a in range(0, len(begin), AT_ONCE):
            spans = zip(begin[a : a + AT_ONCE].tolist(), finish[a : a + AT_ONCE].tolist())
            found, n = self.merger.ids_of([held[b:e] for b, e in spans])
            ids.append(found)
            counts.append(n)
        none = [np.zeros(0, np.int64)]
        all_ids = np.concatenate(ids or none)
        until = np.append(0, np.cumsum(np.concatenate(counts or none), dtype=np.int64))
        bounds = until[before]
        size = self.size[all_ids]
        place = np.cumsum(size) - size
        first = np.append(place, size.sum())[bounds[:-1]]
        return all_ids, place - np.repeat(first, np.diff(bounds)), bounds


class Decoder:
    """Bytes of ids, many texts at once."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = sorted((rank, token) for token, rank in ranks.items())
        count = tokens[-1][0] + 1
        self.size, self.at = np.zeros(count, np.int64), np.zeros(count, np.int64)
        for rank, token in tokens:
            self.size[rank] = len(token)
        self.at[:] = np.cumsum(self.size) - self.size
        self.pool = np.frombuffer(b"".join(t for _, t in tokens), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray, bounds: np.ndarray):
        """The bytes of the texts one after another, and where each begins, with the whole length.

        A token's bytes go where its offset says, so that any run of tokens can be decoded alone.
        """
        size = self.size[ids]
        rows = np.diff(bounds)
        full = np.flatnonzero(rows)
        length = np.zeros(len(rows), np.int64)
        first, last = bounds[full], bounds[full + 1] - 1
        length[full] = offsets[last] + size[last] - offsets[first]
        until = np.append(0, np.cumsum(length))
        base = np.zeros(len(rows), np.int64)
        base[full] = until[full] - offsets[first]
        place = np.repeat(base, rows) + offsets
        out = np.zeros(int(until[-1]), np.uint8)
        for a in range(0, len(ids), AT_ONCE):
            n = size[a : a + AT_ONCE]
            within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            to = np.repeat(place[a : a + AT_ONCE], n) + within
            out[to] = self.pool[np.repeat(self.at[ids[a : a + AT_ONCE]], n) + within]
        return out, until


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base 64 and its rank on every line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(read_ranks(path))


@functools.lru_cache(maxsize=2)
def _decoder(path: str) -> Decoder:
    return Decoder(read_ranks(path))


def encode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column, ``ids`` and ``offsets`` (the byte of the text where each token starts).

    ``ranks`` is a rank file that every worker can read. Each row is encoded by itself, so rows
    without an id, repeated rows and ties need no rule, and other columns, whatever their names,
    are not looked at. A null or empty text has empty arrays. Special tokens' strings are ordinary
    text. A very long text is scanned in windows. An empty table gives an empty result.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            for a, b in groups(sizes, WINDOW):
                ids, offsets, bounds = encoder.encode(texts[a:b])
                at = pa.array(bounds, pa.int32())
                columns = [
                    batch.column(0).slice(a, b - a),
                    pa.ListArray.from_arrays(at, pa.array(ids, pa.int32())),
                    pa.ListArray.from_arrays(at, pa.array(offsets, pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "ids", "offsets"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = scanned(rows, work, f"id {kind}, ids array<int>, offsets array<int>")
    return out.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks: str, id_col: str = "doc_id") -> DataFrame:
    """The id column, ``ids`` and ``decoded``, the bytes that the ids and their ``offsets`` stand for.

    Takes the rows of ``encode`` or any run of their tokens; null or empty arrays give no bytes.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(ranks)
        for batch in batches:
            counts = np.asarray(batch.column(1).value_lengths().fill_null(0), np.int64)
            for a, b in groups(counts, WINDOW):
                ids, offsets = (batch.column(k).slice(a, b - a).flatten() for k in (1, 2))
                bounds = np.append(0, np.cumsum(counts[a:b]))
                found, until = decoder.decode(
                    np.asarray(ids), np.asarray(offsets, np.int64), bounds
                )
                buffers = [None, pa.py_buffer(until.astype(np.int32)), pa.py_buffer(found)]
                decoded = pa.Array.from_buffers(pa.binary(), b - a, buffers)
                columns = [*(batch.column(k).slice(a, b - a) for k in (0, 1)), decoded]
                yield pa.RecordBatch.from_arrays(columns, ["id", "ids", "decoded"])

    rows = encoded.select(F.col(id_col).alias("id"), "ids", "offsets")
    kind = rows.schema["id"].dataType.simpleString()
    out = scanned(rows, work, f"id {kind}, ids array<int>, decoded binary")
    return out.withColumnRenamed("id", id_col)
