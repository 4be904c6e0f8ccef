"""Byte-level BPE encoding and decoding as a tree reduction.

Encoding is a monoid: the encodings of two neighbouring strings determine that of
their concatenation, up to a window around the boundary that has to be encoded
again. Both levels of the problem are reduced that way.

*Inside a pre-token* halves are encoded recursively down to single bytes and joined.
Two tokens are *stable* side by side if merging the bytes of both gives these two
again. A sequence whose neighbours are all stable is the encoding of its bytes: the
first merge across a boundary would have been made in that pair alone as well, since
up to it the pair's merges were the same. So a join encodes the last and first tokens
again, and more of them on a side whose new edge is not stable, until both edges are:
every token outside stays.

*Over a text* halves are split into pre-tokens recursively (blocks of ``BLOCK``
characters at the leaves) and joined. The split pattern looks at most three
characters ahead of a match's start or one behind its end, so a match that ends three
characters before the boundary is settled. From the last settled end the text is
matched anew until a match ends where a match of the right half begins; the pattern
looks at nothing before a match, so all of that half's further matches stay. Texts with
characters that ``regex`` classes unlike tiktoken's matcher use a pattern corrected for these.

Decoding concatenates halves up the tree.

Defined cases: a null or empty text has no ids; repeated rows are encoded one by one;
ids of rows are carried, nulls too; special tokens have no meaning, their strings are
ordinary text; an empty table gives an empty one; other columns of the input are not
carried. Long texts: a text is one row, encoded in a task with four bytes a token
beside it; a pre-token of any length (a megabyte of one letter or of spaces) is joined
from halves like any other, its left half a power of two so that runs of one character
stay aligned.
"""

from __future__ import annotations

import base64
import heapq
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

BLOCK = 4096
#: Pre-tokens kept apart at each end of a part: those that a join can change, and one more.
EDGE = 4
#: Entries of a worker's caches: whole pre-tokens; windows and short strings; token pairs.
PIECES = 1 << 18
CACHE = 1 << 16
PAIRS = 1 << 19
#: Texts of an Arrow batch that are returned together.
ROWS = 256
#: Above this many bytes a window is merged by a heap.
SHORT = 48


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


class _Cache(dict):
    """A mapping that computes what it lacks and starts anew when it is full."""

    def __init__(self, compute, size: int):
        super().__init__()
        self.compute, self.limit = compute, size

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def unpacked(ids: bytes) -> list[int]:
    return [*struct.unpack(f"<{len(ids) // 4}I", ids)]


class PieceEncoder:
    """Encodings of single pre-tokens by a rank table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: b for b, i in ranks.items()}
        self.longest, self.none = max(map(len, ranks)), max(self.tokens) + 1
        self.windows = _Cache(self._merge, CACHE)
        self.stable = _Cache(self._is_stable, PAIRS)
        self.pieces = _Cache(self._piece, PIECES)
        self.whole = _Cache(lambda i: self._merge(self.tokens[i]) == [i], PAIRS)
        self.short = _Cache(self._halves, CACHE)

    def _piece(self, s: str) -> bytes:
        """The ids of a pre-token, four bytes each."""
        whole = self.ranks.get(s.encode())
        return packed([whole] if whole is not None else self.merged(s))

    def _is_stable(self, pair: int) -> bool:
        a, b = pair >> 32, pair & 0xFFFFFFFF
        return self._merge(self.tokens[a] + self.tokens[b]) == [a, b]

    def _merge(self, window: bytes) -> list[int]:
        """The lowest rank first, of equal ranks the leftmost."""
        if len(window) > SHORT:
            return self._merge_by_heap(window)
        ranks, parts = self.ranks, [window[i:i + 1] for i in range(len(window))]
        none = self.none
        costs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while costs and (least := min(costs)) < none:
            i = costs.index(least)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del costs[i]
            if i < len(costs):
                costs[i] = ranks.get(parts[i] + parts[i + 1], none)
            if i:
                costs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        return [ranks[p] for p in parts]

    def _merge_by_heap(self, window: bytes) -> list[int]:
        n, get = len(window), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(window[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i]
            if j < 0 or j >= n or after[j] != end:  # one of the two is not what it was
                continue
            after[i], after[j] = end, -1
            if end < n:
                before[end] = i
                if (r := get(window[i:after[end]])) is not None:
                    heapq.heappush(heap, (r, i, after[end]))
            if (h := before[i]) >= 0 and (r := get(window[h:end])) is not None:
                heapq.heappush(heap, (r, h, end))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[window[i:after[i]]])
            i = after[i]
        return ids

    def join(self, a: list[int], b: list[int]) -> list[int]:
        """The encoding of the bytes of ``a`` and ``b``, both encodings themselves."""
        if not a or not b or self.stable[a[-1] << 32 | b[0]]:
            return a + b
        tokens, i, j, step = self.tokens, len(a) - 1, 1, 1
        while True:
            window = b"".join([tokens[t] for t in a[i:]] + [tokens[t] for t in b[:j]])
            ids = self.windows[window] if len(window) <= SHORT else self._merge(window)
            left = i == 0 or self.stable[a[i - 1] << 32 | ids[0]]
            right = j == len(b) or self.stable[ids[-1] << 32 | b[j]]
            if left and right:
                return a[:i] + ids + b[j:]
            i = i if left else max(0, i - step)
            j = j if right else min(len(b), j + step)
            step *= 2

    def _halves(self, s: str) -> list[int]:
        if len(s) <= self.longest and (i := self.ranks.get(s.encode())) is not None and self.whole[i]:
            return [i]  # its merges give the token
        if len(s) > 1:
            middle = 1 << ((len(s) - 1).bit_length() - 1)
            return self.join(self.merged(s[:middle]), self.merged(s[middle:]))
        ids: list[int] = []
        for byte in s.encode():
            ids = self.join(ids, [self.ranks[bytes([byte])]])
        return ids

    def merged(self, s: str) -> list[int]:
        """The merges of a string, which is cut at half recursively."""
        return self.short[s] if len(s) <= 8 else self._halves(s)


class Part:
    """The pre-tokens of text[start:end] taken for itself: (from, to, packed ids) at both ends, ids alone between them.
    ``middle`` is None while all pre-tokens are in ``left``."""

    __slots__ = ("start", "end", "left", "middle", "right")

    def __init__(self, start, end, left, middle, right):
        self.start, self.end, self.left, self.middle, self.right = start, end, left, middle, right

    @classmethod
    def of(cls, start: int, end: int, left: list, middle: list | None, right: list) -> Part:
        """With ends cut to ``EDGE`` pre-tokens."""
        if middle is None:
            left, right = left + right, []
            if len(left) <= 2 * EDGE:
                return cls(start, end, left, None, [])
            return cls(start, end, left[:EDGE], [_ids(left[EDGE:-EDGE])], left[-EDGE:])
        middle = ([_ids(left[EDGE:])] if len(left) > EDGE else []) + middle + ([_ids(right[:-EDGE])] if len(right) > EDGE else [])
        return cls(start, end, left[:EDGE], middle, right[-EDGE:])

    def ids(self) -> bytes:
        return b"".join([_ids(self.left), *(self.middle or []), _ids(self.right)])


def _ids(pieces: list) -> bytes:
    return b"".join([p[2] for p in pieces])


@lru_cache
def unlike(kind: str) -> tuple[set[str], set[str]]:
    """Characters that only ``regex``, and that only tiktoken's matcher, finds in a class: their Unicode versions differ."""
    import regex
    import tiktoken
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    library = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    ours, theirs = set(regex.findall(kind, every)), set(bytes(library.encode_ordinary(every)).decode())
    return ours - theirs, theirs - ours


def _members(characters: set[str]) -> str:
    """The inside of a set in a pattern; a noncharacter stands for none."""
    ranges: list[list[int]] = []
    for c in sorted(map(ord, characters)) or [0x10FFFF]:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


class TreeEncoder(PieceEncoder):
    """Encodings of whole texts; every match of ``pattern`` is encoded separately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, block: int = BLOCK):
        import regex
        super().__init__(ranks)
        self.block, odd, exact = block, set(), pattern
        for kind in (r"\p{L}", r"\p{N}", r"\s"):
            surplus, missing = unlike(kind)
            odd |= surplus | missing
            if surplus | missing:
                exact = exact.replace(kind, f"[[{kind}--[{_members(surplus)}]]||[{_members(missing)}]]")
        self.usual, self.exact = regex.compile(pattern), regex.compile(exact, regex.V1)
        self.odd, self.pattern = regex.compile(f"[{_members(odd)}]"), self.usual
        self.least_odd = min(map(ord, odd), default=0x10FFFF)

    def _leaf(self, text: str, start: int, end: int) -> Part:
        found, pieces = self.pattern.findall(text, start, end), self.pieces
        if len(found) <= 2 * EDGE:
            return Part(start, end, self._placed(found, start), None, [])
        middle = b"".join(map(pieces.__getitem__, found[EDGE:-EDGE]))
        return Part(start, end, self._placed(found[:EDGE], start), [middle],
                    self._placed(found[-EDGE:], end - sum(map(len, found[-EDGE:]))))

    def _placed(self, found: list[str], at: int) -> list:
        out = []
        for s in found:
            out.append((at, at + len(s), self.pieces[s]))
            at += len(s)
        return out

    def _pure(self, text: str, piece: tuple) -> list[int]:
        """The merges of a pre-token, also where the whole is in the table."""
        s, e, ids = piece
        return unpacked(ids) if e - s > self.longest else self.merged(text[s:e])

    def _join_parts(self, text: str, a: Part, b: Part) -> Part:
        m, b_left = a.end, b.left
        ahead = a.left if a.middle is None else a.right
        keep = len(ahead)
        while keep and ahead[keep - 1][1] > m - 3:
            keep -= 1
        loose, ahead = ahead[keep:], ahead[:keep]
        at = ahead[-1][1] if ahead else a.start
        starts = {p[0]: k for k, p in enumerate(b_left)}
        if b.middle is None:
            starts[b.end] = len(b_left)
        between, rest = [], None
        if at in starts:  # nothing loose
            rest = starts[at]
        else:
            for match in self.pattern.finditer(text, at, b.end):
                s, e = match.span()
                between.append((s, e, self._crossing(text, s, e, m, loose, b_left)))
                if e in starts:
                    rest = starts[e]
                    break
        if rest is None:  # the halves never came together: all of b was matched anew
            b_left, b_middle, b_right = [], None, []
        else:
            b_left, b_middle, b_right = b_left[rest:], b.middle, b.right
        if a.middle is None and b_middle is None:
            return Part.of(a.start, b.end, ahead + between + b_left, None, [])
        if a.middle is None:
            return Part.of(a.start, b.end, ahead + between + b_left, b_middle, b_right)
        if b_middle is None:
            return Part.of(a.start, b.end, a.left, a.middle, ahead + between + b_left)
        return Part.of(a.start, b.end, a.left, [*a.middle, _ids(ahead + between + b_left), *b_middle], b_right)

    def _crossing(self, text, s, e, m, loose, b_left) -> bytes:
        if e - s > self.longest and b_left and b_left[0][:2] == (m, e):
            for piece in loose:
                if piece[:2] == (s, m):
                    return packed(self.join(self._pure(text, piece), self._pure(text, b_left[0])))
        return self.pieces[text[s:e]] if e - s <= 64 else self._piece(text[s:e])

    def _part(self, text: str, start: int, end: int) -> Part:
        if end - start <= self.block:
            return self._leaf(text, start, end)
        middle = start + self.block * (1 << ((-(-(end - start) // self.block) - 1).bit_length() - 1))
        return self._join_parts(text, self._part(text, start, middle), self._part(text, middle, end))

    def encode(self, text: str) -> np.ndarray:
        self.pattern = self.exact if self._is_odd(text) else self.usual
        return np.frombuffer(self._part(text, 0, len(text)).ids(), "<u4")

    def _is_odd(self, text: str) -> bool:
        return not text.isascii() and (int(np.frombuffer(text.encode("utf-32-le"), "<u4").max()) >= self.least_odd
                                       and self.odd.search(text) is not None)


class Decoder:
    """The bytes of ids: those of halves, concatenated."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {i: b for b, i in ranks.items()}

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= BLOCK:
            return b"".join(map(self.tokens.__getitem__, ids.tolist()))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


@lru_cache(maxsize=2)
def rank_table(path: str) -> dict[bytes, int]:
    """The table of a rank file (lines of base64 bytes and rank)."""
    with open(path, "rb") as f:
        return {base64.b64decode(b): int(i) for b, i in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def encoder(path: str) -> TreeEncoder:
    """The encoder of a rank file, which a worker keeps."""
    import public_tokenizers
    return TreeEncoder(rank_table(path), public_tokenizers.PATTERN)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(rank_table(path))


def _slices(batches):
    for b in batches:
        for k in range(0, b.num_rows, ROWS):
            yield b.slice(k, ROWS)


def encode(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers). ``ranks`` is a path on the workers."""
    def run(batches):
        enc = encoder(ranks or default_ranks())
        for b in _slices(batches):
            ids = [enc.encode(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())],
                names=["doc_id", "n_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids binary")


def decode(tokens: DataFrame, ranks: str | None = None) -> DataFrame:
    """The rows of ``tokens`` with ``ids`` replaced by the bytes they stand for, ``decoded``."""
    kept = [c for c in tokens.columns if c != "ids"]

    def run(batches):
        dec = decoder(ranks or default_ranks())
        for b in _slices(batches):
            decoded = [None if (x := i.as_py()) is None else dec.decode(np.frombuffer(x, "<u4")) for i in b.column("ids")]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(decoded, pa.binary())], names=[*kept, "decoded"])

    fields = ", ".join(f"`{c}` {tokens.schema[c].dataType.simpleString()}" for c in kept)
    return tokens.mapInArrow(run, f"{fields}, decoded binary")
