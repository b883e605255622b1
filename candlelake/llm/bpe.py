"""Byte-level BPE by prefix dynamic programming, and decoding.

A text is cut into pieces by a pattern. Of every byte prefix of a piece the last token of its encoding is stored.
It is the one token at the prefix's end that agrees with the last token of the prefix before it: two tokens
agree if their bytes, encoded together, give just these two. The encoding is read off from the end. What
is stored for a prefix depends on nothing behind it, so appended text only adds entries, and after an
edit they are computed anew from the edit on, until as many equal old ones in a row as the longest
token has bytes.

Distinct pieces are encoded together, all prefixes of one length at a time in numpy; pieces of
many bytes one after the other, in time linear in their length.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import map_slices, slices
from candlelake.llm.tokens import RUN, WORDS

#: Bytes of a slice of text; longest piece that goes through numpy; bytes of such pieces at a time; units that a worker remembers.
SLICE, SHORT, BATCH, REMEMBERED = 2_000_000, 64, 300_000, 200_000
#: Ids that are decoded at a time (a longer list is decoded alone).
IDS = 500_000
#: Characters beyond its own end that a match of the pattern may look at.
REACH = 3
NEVER = np.iinfo(np.int64).max
TABLE = "doc_id bigint, text string, prefixes binary"


class Slots:
    """Hash table from 64-bit keys to numbers for arrays of keys; open addressing, a power of two of slots."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int):
        self.missing, self.bits = missing, max(4, (len(keys) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, missing, np.int64)
        todo, at = np.arange(len(keys)), self.slot(keys)
        while len(todo):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[todo[free]]  # of several for one slot the last stays
            done = self.keys[at] == keys[todo]
            self.values[at[done]] = values[todo[done]]
            todo, at = todo[~done], (at[~done] + 1) & ((1 << self.bits) - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        at = self.slot(keys)
        held = self.keys[at]
        out = self.values[at]
        wrong = np.flatnonzero((held != keys) & (held != -1))
        out[held != keys] = self.missing
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & ((1 << self.bits) - 1)
            held = self.keys[at[wrong]]
            same = held == keys[wrong]
            out[wrong[same]] = self.values[at[wrong[same]]]
            wrong = wrong[~same & (held != -1)]
        return out


class Vocabulary:
    """Tokens by rank (their id), and which neighbours agree."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for t, k in ranks.items():
            self.tokens[k] = t
        n = len(self.tokens)
        self.size = np.array([len(t) for t in self.tokens], np.int64)
        self.longest = int(self.size.max())
        #: Parts of a token before its last merge, and when it is made: -1 if never merged.
        self.left, self.right, self.made = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, -1, np.int64)
        #: Tokens that merging can give; others stand for a whole piece only.
        self.alone = np.zeros(n, bool)
        pairs = {}
        for t, k in ranks.items():
            parts = self.merged(t, 2)
            self.alone[k] = len(parts) <= 2
            if len(t) > 1 and len(parts) == 2:
                self.left[k], self.right[k], self.made[k] = ranks[parts[0]], ranks[parts[1]], k
            for p in range(1, len(t)):
                a, b = ranks.get(t[:p]), ranks.get(t[p:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = k
        self.seams = Slots(np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int64), NEVER)
        self.seam_of = pairs
        # prefixes of tokens as numbered states
        states, ends, steps = {b"": 0}, [-1], {}
        for t in sorted(t for t, k in ranks.items() if self.alone[k]):
            for p in range(1, len(t) + 1):
                if t[:p] not in states:
                    states[t[:p]] = len(states)
                    ends.append(-1)
                    steps[states[t[: p - 1]] << 8 | t[p - 1]] = states[t[:p]]
            ends[states[t]] = ranks[t]
        self.steps, self.ends = Slots(np.array(list(steps), np.int64), np.array(list(steps.values()), np.int64), -1), np.array(ends, np.int64)
        self.step_of, self.end_of = steps, ends
        self.sizes, self.is_alone, self.made_at, self.left_of, self.right_of = (x.tolist() for x in (self.size, self.alone, self.made, self.left, self.right))
        self.agreed: dict[int, bool] = {}
        self.memo_keys, self.memo = np.full(1 << 21, -1, np.int64), np.zeros(1 << 21, bool)

    def merged(self, piece: bytes, least: int = 1) -> list[bytes]:
        """The definition: the neighbours of lowest rank are joined, the leftmost first, until ``least`` parts are left."""
        parts = [piece[k : k + 1] for k in range(len(piece))]
        while len(parts) > least:
            low = min((self.ranks.get(a + b, NEVER), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
            if low[0] == NEVER:
                break
            parts[low[1] : low[1] + 2] = [parts[low[1]] + parts[low[1] + 1]]
        return parts

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the bytes of a and b, encoded together, give just a and b; remembered by pair."""
        keys = a << 32 | b
        at = ((keys.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(43)).astype(np.int64)
        out = self.memo[at]
        new = np.flatnonzero(self.memo_keys[at] != keys)
        if len(new):
            some, back = np.unique(keys[new], return_inverse=True)
            found = self._agree(some >> 32, some & 0xFFFFFFFF)
            out[new] = found[back]
            self.memo_keys[at[new]] = keys[new]
            # of several keys for one slot one is kept, so the answers are put where its key is
            kept = self.memo_keys[at[new]] == keys[new]
            self.memo[at[new[kept]]] = out[new[kept]]
        return out

    def _agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Goes back in time along the seam, undoing the later of the two tokens that meet there.

        Before each of these merges the two that met must not have been joined themselves: their rank
        would have to be lower, or the same if the merge undone is on the right, since the leftmost goes first.
        """
        x, y = a.copy(), b.copy()
        out, todo = np.ones(len(a), bool), np.arange(len(a))
        limit = np.full(len(a), NEVER)
        while len(todo):
            joined = self.seams[x << 32 | y]
            good = joined >= limit
            out[todo[~good]] = False
            t, u = self.made[x], self.made[y]
            go = good & ((t >= 0) | (u >= 0))
            todo, x, y, t, u = todo[go], x[go], y[go], t[go], u[go]
            on_left = t > u
            limit = np.where(on_left, t, u + 1)
            x, y = np.where(on_left, self.right[x], x), np.where(on_left, y, self.left[y])
        return out

    def agrees(self, a: int, b: int) -> bool:
        """agree() for one pair."""
        key = a << 32 | b
        known = self.agreed.get(key)
        if known is None:
            x, y, limit, known = a, b, NEVER, True
            while True:
                if self.seam_of.get(x << 32 | y, NEVER) < limit:
                    known = False
                    break
                t, u = self.made_at[x], self.made_at[y]
                if t < 0 and u < 0:
                    break
                if t > u:
                    x, limit = self.right_of[x], t
                else:
                    y, limit = self.left_of[y], u + 1
            if len(self.agreed) > 200_000:
                self.agreed.clear()
            self.agreed[key] = known
        return known

    def prefixes(self, piece: bytes, known: list[int] = (), old: list[int] = (), back: int = 0, edge: int = 0) -> tuple[list[int], int]:
        """(last token of every byte prefix of a piece, how many of them were computed).

        The first are ``known``. From ``edge`` on the bytes are those of an old piece ``back`` places further
        on; its entries ``old`` are taken over once as many in a row are the same as the longest token has bytes.
        """
        out, ends, n = list(known), {}, len(piece)
        s = max(0, len(out) - self.longest + 1)
        same, first = 0, len(out)
        for j in range(s, n):
            # tokens that start here; those of earlier starts came first, so the longest is tried first
            state = 0
            for p in range(j, min(n, j + self.longest)):
                state = self.step_of.get(state << 8 | piece[p], -1)
                if state < 0:
                    break
                if self.end_of[state] >= 0 and p >= first:
                    ends.setdefault(p, []).append(self.end_of[state])
            if j < first:
                continue
            for t in ends.pop(j):
                start = j + 1 - self.sizes[t]
                if start == 0 or self.agrees(out[start - 1], t):
                    out.append(t)
                    break
            else:
                raise ValueError("a prefix without a last token: the vocabulary lacks a byte")
            if old and j >= edge and j + back < len(old):
                same = same + 1 if old[j + back] == out[j] else 0
                if same >= self.longest:
                    out += old[j + back + 1 : n + back]
                    rest, more = (out, 0) if len(out) == n else self.prefixes(piece, out)  # where the old piece ended earlier
                    return rest, j + 1 - first + more
        return out, n - first

    def read(self, last: list[int], piece: bytes) -> list[int]:
        """The ids of a piece from its prefixes; a piece that is a token itself is that token."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        out, k = [], len(piece)
        while k:
            out.append(last[k - 1])
            k -= self.sizes[out[-1]]
        return out[::-1]

    def short(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after the other, ids of each): all prefixes of one length at a time."""
        order = np.argsort([-len(p) for p in pieces], kind="stable")
        data = np.frombuffer(b"".join([pieces[k] for k in order.tolist()]), np.uint8).astype(np.int64)
        size = np.array([len(pieces[k]) for k in order.tolist()], np.int64)
        base = np.cumsum(size) - size
        n = len(data)
        # all tokens at all places, step by step
        left = np.repeat(base + size, size) - np.arange(n)
        found, state, start = [], np.zeros(n, np.int64), np.arange(n)
        for d in range(self.longest):
            state = self.steps[state << 8 | data[start + d]]
            go = state >= 0
            state, start = state[go], start[go]
            token = self.ends[state]
            hit = token >= 0
            found.append((start[hit] + d, token[hit]))
            go = left[start] > d + 1
            state, start = state[go], start[go]
            if not len(start):
                break
        # those that end at a place, the longest first
        here = np.zeros(n + 1, np.int64)
        for end, _ in found:
            here[end + 1] += 1
        first = np.cumsum(here)
        fill, tokens = first[:-1].copy(), np.empty(first[-1], np.int64)
        for end, token in reversed(found):
            tokens[fill[end]] = token
            fill[end] += 1
        last = np.full(n, -1, np.int64)
        active = np.searchsorted(-size, -np.arange(size[0] + 1), "left") if len(size) else np.zeros(1, np.int64)
        for i in range(int(size[0]) if len(size) else 0):
            todo = base[: active[i]] + i
            k = 0
            while len(todo):
                at = first[todo] + k
                if (at >= first[todo + 1]).any():
                    raise ValueError("a prefix without a last token: the vocabulary lacks a byte")
                token = tokens[at]
                start = i + 1 - self.size[token]
                good = start == 0
                inner = np.flatnonzero(~good)
                good[inner] = self.agree(last[todo[inner] - self.size[token[inner]]], token[inner])
                last[todo[good]] = token[good]
                todo = todo[~good]
                k += 1
        # the encodings from their ends
        who, at, rounds = np.arange(len(size)), base + size - 1, []
        while len(who):
            token = last[at]
            rounds.append((who, token))
            at = at - self.size[token]
            go = at >= base[who]
            who, at = who[go], at[go]
        count = np.zeros(len(size), np.int64)
        for w, _ in rounds:
            count[w] += 1
        place = np.cumsum(count) - 1
        out = np.empty(int(count.sum()), np.int64)
        for k, (w, token) in enumerate(rounds):
            out[place[w] - k] = token
        # back to the order of the pieces
        begin, result = np.cumsum(count) - count, np.empty(len(size), np.int64)
        result[order] = np.arange(len(size))
        sizes = count[result]
        steps = np.repeat(begin[result] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(out))
        return out[steps], sizes

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces one after the other, ids of each)."""
        rank = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int64, len(pieces))
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        sizes, parts = np.ones(len(pieces), np.int64), [(np.flatnonzero(rank >= 0), rank[rank >= 0])]
        small = np.flatnonzero((rank < 0) & (length <= SHORT))
        for some in np.split(small, np.flatnonzero(np.diff(np.cumsum(length[small]) // BATCH)) + 1):
            found, sizes[some] = self.short([pieces[k] for k in some.tolist()])
            parts.append((some, found))
        for k in np.flatnonzero((rank < 0) & (length > SHORT)).tolist():
            found = np.array(self.read(self.prefixes(pieces[k])[0], pieces[k]), np.int64)
            sizes[k] = len(found)
            parts.append((np.array([k]), found))
        place, out = np.cumsum(sizes) - sizes, np.empty(int(sizes.sum()), np.int32)
        for at, found in parts:
            n = sizes[at]
            out[np.repeat(place[at] - (np.cumsum(n) - n), n) + np.arange(len(found))] = found
        return out, sizes


class Tokens:
    """The bytes of tokens by id, for decoding."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values()) + 1)
        for t, k in ranks.items():
            tokens[k] = t
        self.table = np.frombuffer(b"".join(tokens), np.uint8)
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.begin = np.cumsum(self.size) - self.size

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all tokens, one after the other."""
        n = self.size[ids]
        return self.table[np.repeat(self.begin[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


class Numbers(dict):
    """Numbers new keys in the order in which they come."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


class Coder:
    """A vocabulary with the pattern that cuts texts into pieces.

    With the plain pattern a match begins at each space that no white space precedes. Texts are first cut
    there, and the ids of these units are remembered, up to a bound.
    """

    def __init__(self, path: str, pattern: str):
        import regex

        self.words = Vocabulary(read_ranks(path))
        # white space is the Unicode property, as in the libraries' regular expressions
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.plain = pattern == WORDS
        self.forget()

    def forget(self) -> None:
        self.units, self.ids, self.sizes = Numbers(), np.empty(0, np.int32), np.empty(0, np.int64)

    def cut(self, texts: list[str], joined: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, ids of each), piece by piece.

        joined: the texts may be matched as one, since each starts with a space and ends with no white space.
        """
        numbers = Numbers()
        if joined:
            pieces = self.pattern.findall("".join(texts))
            ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
            counts = np.searchsorted(ends, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts))), "right")
            every = np.fromiter(map(numbers.__getitem__, pieces), np.int64, len(pieces))
            counts = np.append(0, counts)
        else:
            every, counts = [], [0]
            for t in texts:
                every.extend(map(numbers.__getitem__, self.pattern.findall(t)))
                counts.append(len(every))
        ids, sizes = self.words.encode([p.encode() for p in numbers])
        flat, ends = gathered(ids, sizes, np.asarray(every, np.int64))
        return flat, np.diff(ends[counts])

    def known(self, units: list[str]) -> np.ndarray:
        """Numbers of units (a space, then characters of which the last is no white space) whose ids are remembered from now on."""
        before = len(self.units)
        out = np.fromiter(map(self.units.__getitem__, units), np.int64, len(units))
        if len(self.units) > before:
            ids, sizes = self.cut(list(islice(self.units, before, None)), joined=True)
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, where each text starts: one more than texts). NULL is empty."""
        if len(self.units) > REMEMBERED:
            self.forget()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        n = len(texts)
        # units must not end with white space
        odd = pc.match_substring_regex(texts, f"{RUN}|{RUN[:-1]}$").to_numpy(zero_copy_only=False) if self.plain else np.ones(n, bool)
        sizes, parts = np.zeros(n, np.int64), []
        if not odd.all():
            at = np.flatnonzero(~odd)
            split = pc.split_pattern(texts.take(pa.array(at)), " ")
            edges = split.offsets.to_numpy() - split.offsets[0].as_py()
            coded = split.flatten().dictionary_encode()
            names = coded.dictionary.to_pylist()
            code = coded.indices.to_numpy().astype(np.int64)
            first = np.zeros(len(code), bool)
            first[edges[:-1]] = True  # without a space before it
            inner, heads = np.unique(code[~first]), np.unique(code[first])
            number = np.zeros(len(names), np.int64)
            number[inner] = self.known([" " + names[k] for k in inner.tolist()])
            ids, size = self.cut([names[k] for k in heads.tolist()])
            code[first] = len(self.sizes) + np.searchsorted(heads, code[first])
            code[~first] = number[code[~first]]
            flat, ends = gathered(np.concatenate([self.ids, ids]), np.concatenate([self.sizes, size]), code)
            sizes[at] = np.diff(ends[edges])
            parts.append((at, flat))
        if odd.any():
            at = np.flatnonzero(odd)
            flat, sizes[at] = self.cut(texts.take(pa.array(at)).to_pylist())
            parts.append((at, flat))
        starts = np.concatenate([[0], np.cumsum(sizes)])
        if len(parts) == 1:
            return parts[0][1], starts
        out = np.empty(starts[-1], np.int32)
        for at, flat in parts:
            size = sizes[at]
            out[np.repeat(starts[at] - (np.cumsum(size) - size), size) + np.arange(len(flat))] = flat
        return out, starts


def gathered(ids: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the ids of the entries ``which`` one after the other, where each starts: one more than entries)."""
    size = sizes[which]
    ends = np.concatenate([[0], np.cumsum(size)])
    begin = np.cumsum(sizes) - sizes
    return ids[np.repeat(begin[which] - ends[:-1], size) + np.arange(ends[-1])], ends


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


_CODERS: dict[tuple[str, str], Coder] = {}
_TOKENS: dict[str, Tokens] = {}


def coder(path: str, pattern: str) -> Coder:
    """One per file, pattern and Python worker."""
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = Coder(path, pattern)
    return _CODERS[path, pattern]


def decoded(path: str, lists: pa.Array) -> pa.Array:
    """The bytes of lists of ids; NULL is an empty list, and a list with an id that the vocabulary lacks, or with a NULL, gives NULL."""
    if path not in _TOKENS:
        _TOKENS[path] = Tokens(read_ranks(path))
    words = _TOKENS[path]
    ids = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    held = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    good = (ids >= 0) & (ids < len(words.size))
    ids = np.where(good, ids, 0)
    good &= words.size[ids] > 0
    row = np.repeat(np.arange(len(held)), held)
    raw, size = words.decode(ids), np.bincount(row, words.size[ids], len(held)).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    bad = np.bincount(row[~good], minlength=len(held)) > 0
    return pa.Array.from_buffers(pa.binary(), len(held), [pa.array(~bad).buffers()[1], pa.py_buffer(at.astype(np.int32)), pa.py_buffer(raw)])


def bpe_encode(docs: DataFrame, path: str, pattern: str, text: str = "text", doc_id: str = "doc_id", decode: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (array of int), as the tiktoken library's encode_ordinary gives them.

    path: a file of ranks; pattern: what cuts texts into pieces (it may look REACH characters beyond a match).
    decode: the ids are decoded again in the same task, as ``decoded`` (bytes). NULL
    and empty texts have no ids; a text of any length is encoded whole; rows with equal ids or
    texts are encoded each for itself. An empty table gives no rows; other columns are not read.
    """

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, starts = coder(path, pattern).encode(part.column(1))
        lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))
        more = [decoded(path, lists)] if decode else []
        return pa.RecordBatch.from_arrays([part.column(0), lists, *more], ["doc_id", "ids", "decoded"][: 2 + decode])

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return map_slices(rows, "text", "doc_id bigint, ids array<int>" + ", decoded binary" * decode, work, SLICE)


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``, the bytes. NULL ids are none; a list with an id that the vocabulary lacks, or with a NULL, gives NULL."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # few rows at a time: their bytes are several times their ids
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
            cuts = np.unique(np.append(np.searchsorted(ends, np.arange(0, ends[-1] if len(ends) else 0, IDS), "right"), [0, batch.num_rows])).tolist()
            for a, b in zip(cuts, cuts[1:]):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), decoded(path, part.column(1))], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, decoded binary")


class PrefixTable:
    """A text with the last token of every byte prefix of its pieces, for appends and edits.

    Stored as 32-bit integers, one for each byte of the text; the first of a piece is stored as its complement.
    """

    def __init__(self, coder: Coder, text: str = "", last: list[int] = (), firsts: list[int] = ()):
        self.coder, self.text, self.last, self.firsts = coder, text, list(last), list(firsts)
        #: Entries computed by the last change.
        self.computed = 0

    @classmethod
    def of(cls, coder: Coder, text: str) -> PrefixTable:
        return cls(coder).edit(0, 0, text)

    @classmethod
    def load(cls, coder: Coder, text: str, raw: bytes) -> PrefixTable:
        held = np.frombuffer(raw, "<i4")
        return cls(coder, text, np.where(held < 0, ~held, held).tolist(), np.flatnonzero(held < 0).tolist())

    def raw(self) -> bytes:
        out = np.array(self.last, "<i4")
        out[self.firsts] = ~out[self.firsts]
        return out.tobytes()

    def ids(self) -> list[int]:
        data, out = self.text.encode(), []
        for a, b in zip(self.firsts, [*self.firsts[1:], len(data)]):
            out += self.coder.words.read(self.last[a:b], data[a:b])
        return out

    def append(self, more: str) -> PrefixTable:
        return self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, stop: int, put: str) -> PrefixTable:
        """The table of the text in which ``put`` stands for the characters from start to stop."""
        words, old = self.coder.words, self.text.encode()
        text = self.text[:start] + put + self.text[stop:]
        data = text.encode()
        at = len(self.text[:start].encode())
        safe = len(self.text[: max(0, start - REACH)].encode())
        behind = len(data) - (len(old) - len(self.text[:stop].encode()))  # first byte after what was put
        back = len(old) - len(data)
        edges = [*self.firsts, len(old)]
        k = max(0, int(np.searchsorted(edges, safe, "right")) - 1)  # pieces before it end where the change cannot be seen
        begin = edges[k] if self.firsts else 0
        last, firsts, computed = self.last[:begin], self.firsts[:k], 0
        was = dict(zip(self.firsts, [*self.firsts[1:], len(old)]))
        b = begin
        for m in self.coder.pattern.finditer(text, len(old[:begin].decode())):
            if b >= behind and b + back in was:  # from here on all pieces are the old ones
                firsts += [f - back for f in self.firsts if f >= b + back]
                last += self.last[b + back :]
                break
            piece = m.group().encode()
            same = min(at, was[b], b + len(piece)) - b if b in was and b < at else 0
            # the old piece that reaches from the place of the change into what follows
            j = int(np.searchsorted(self.firsts, behind + back, "right")) - 1 if self.firsts else -1
            tail, shift = ([], 0)
            if j >= 0 and was[self.firsts[j]] > behind + back and self.firsts[j] <= b + len(piece) + back:
                tail, shift = self.last[self.firsts[j] : was[self.firsts[j]]], b + back - self.firsts[j]
            entries, n = words.prefixes(piece, self.last[b : b + same], tail, shift, max(behind - b, 0))
            firsts.append(b)
            last += entries
            computed += n
            b += len(piece)
        out = PrefixTable(self.coder, text, last, firsts)
        out.computed = computed
        return out


def prefix_tables(docs: DataFrame, path: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, text (NULL: empty) and prefixes, the stored table of the text (PrefixTable.raw)."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(part.column(1), "")
        raw = [PrefixTable.of(coder(path, pattern), t).raw() for t in texts.to_pylist()]
        return pa.RecordBatch.from_arrays([part.column(0), texts, pa.array(raw, pa.binary())], ["doc_id", "text", "prefixes"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return map_slices(rows, "text", TABLE, work, SLICE)


def bpe_edit(tables: DataFrame, edits: DataFrame, path: str, pattern: str) -> DataFrame:
    """``tables`` after ``edits`` (doc_id, start, stop, put): doc_id, text, prefixes, ids.

    Characters from start to stop become ``put``; an append has both at the text's length or beyond (NULL: at its end). An
    edit changes all rows of its id; rows without one stay as they are; several edits of one id are not
    defined and give a row each. Only what the edit can change is computed.
    """
    given = edits.select(F.col("doc_id").alias("_id"), F.col("start").cast("bigint"), F.col("stop").cast("bigint"), F.coalesce("put", F.lit("")).alias("put"))
    rows = tables.select("doc_id", "text", "prefixes").join(given, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "text", "prefixes", "_id", "start", "stop", "put")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for part in slices(batches, "text", SLICE):
            out = []
            for r in part.to_pylist():
                table = PrefixTable.load(own, r["text"], r["prefixes"])
                if r["_id"] is not None:
                    n = len(r["text"])
                    start, stop = (n if r[c] is None else min(max(r[c], 0), n) for c in ("start", "stop"))
                    table = table.edit(start, max(start, stop), r["put"])
                out.append((r["doc_id"], table.text, table.raw(), table.ids()))
            columns = list(zip(*out)) if out else [(), (), (), ()]
            kinds = (pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "text", "prefixes", "ids"])

    return rows.mapInArrow(run, f"{TABLE}, ids array<int>")
