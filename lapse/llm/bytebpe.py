"""Byte-level BPE by a pair occurrence index.

A ``Vocabulary`` holds what a tokenizers JSON file says.  ``encode_texts`` works on all texts
of a batch together: texts are cut at spaces, each distinct stretch is cut into pieces once, and
the distinct pieces go through ``merge_pieces`` as one long array of symbols.

``merge_pieces`` maps every pair of neighbouring symbols to all its positions, takes the ranks
that occur in ascending order, merges all positions of a rank at once, and adds the pairs that
come into being to the lists of their own ranks.  A merge only makes pairs of higher ranks (checked
when a vocabulary is read), so this is the order in which each piece alone would be merged.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict

import numpy as np
import regex

# Fixed value: the pattern that the byte-level pre-tokenizer cuts texts with.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_GONE = -1
# Array elements worked on together where a temporary array would be several times as large as its result.
BLOCK = 1 << 18


def byte_symbols() -> list[str]:
    """The character that stands for each byte in the file: itself if printable, else one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(0x100 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """Merges, byte strings and special tokens of one file's content."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model = spec["model"]
        symbols = byte_symbols()
        to_byte = {c: b for b, c in enumerate(symbols)}
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = 1 + max([*ids.values(), *self.special.values()])
        self.bytes = [b""] * self.size
        for token, i in ids.items():
            self.bytes[i] = bytes(to_byte[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.byte_id = np.array([ids[c] for c in symbols], dtype=np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = np.array([(ids[a], ids[b], ids[a + b]) for a, b in pairs], dtype=np.int64)
        self.rank = {(int(a), int(b)): r for r, (a, b, _) in enumerate(self.merges)}
        self._check_order()
        self._index()
        special = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.special_cut = regex.compile(f"({special})") if special else None
        self.pieces = regex.compile(PIECES)

    def _check_order(self) -> None:
        made = {int(n): r for r, (_, _, n) in enumerate(self.merges)}
        if len(made) < len(self.merges) or any(made.get(int(x), -1) >= r for r, m in enumerate(self.merges) for x in m[:2]):
            raise ValueError("a merge of this vocabulary can make a pair of a lower rank")

    def _index(self) -> None:
        """An open hash table from pair to rank, for whole arrays at a time."""
        bits = max(8, (8 * len(self.merges)).bit_length())
        self._shift, self._slots = 64 - bits, 1 << bits
        self._keys = np.full(self._slots, -1, dtype=np.int64)
        self._ranks = np.full(self._slots, _GONE, dtype=np.int32)
        key = self.merges[:, 0] * self.size + self.merges[:, 1]
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            free = todo[self._keys[slot[todo]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            taken = free[first]
            self._keys[slot[taken]] = key[taken]
            self._ranks[slot[taken]] = taken
            todo = np.setdiff1d(todo, taken)
            slot[todo] = (slot[todo] + 1) % self._slots

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self._shift)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; -1 where no merge joins it (or a side is missing: negative)."""
        if len(left) > BLOCK:
            return np.concatenate([self.ranks(left[i:i + BLOCK], right[i:i + BLOCK]) for i in range(0, len(left), BLOCK)])
        key = left.astype(np.int64) * self.size + right
        key[(left < 0) | (right < 0)] = -2
        slot = self._slot(key)
        at = self._keys[slot]
        out = np.where(at == key, self._ranks[slot], _GONE).astype(np.int32)
        open_ = np.flatnonzero((at != key) & (at >= 0) & (key >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) % self._slots
            at = self._keys[slot[open_]]
            hit = at == key[open_]
            out[open_[hit]] = self._ranks[slot[open_[hit]]]
            open_ = open_[~hit & (at >= 0)]
        return out


def merge_pieces(vocab: Vocabulary, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all pieces in one array, and the first index of each piece in it (one more at the end)."""
    sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    raw = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    total = len(raw)
    symbol = np.empty(total + 1, dtype=np.int32)
    symbol[:total] = vocab.byte_id[raw]
    symbol[total] = _GONE
    starts = np.concatenate(([0], np.cumsum(sizes)))
    # Neighbours within the piece; index `total` is the missing one.
    after = np.arange(1, total + 2, dtype=np.int32)
    before = np.arange(-1, total, dtype=np.int32)
    used = starts[1:][sizes > 0]
    after[used - 1] = total
    before[starts[:-1][sizes > 0]] = total
    after[total] = before[total] = total

    index: dict[int, list[np.ndarray]] = defaultdict(list)
    active: list[int] = []

    def add(positions: np.ndarray) -> None:
        rank = vocab.ranks(symbol[positions], symbol[after[positions]])
        known = rank >= 0
        positions, rank = positions[known], rank[known]
        if not len(rank):
            return
        order = np.argsort(rank, kind="stable")
        positions, rank = positions[order], rank[order]
        edges = np.flatnonzero(np.diff(rank)) + 1
        for r, part in zip(rank[np.r_[0, edges]].tolist(), np.split(positions, edges)):
            if r not in index:
                heapq.heappush(active, r)
            index[r].append(part)

    add(np.arange(total, dtype=np.int32))
    while active:
        r = heapq.heappop(active)
        lists = index.pop(r)
        left, right, made = vocab.merges[r]
        at = lists[0] if len(lists) == 1 else np.concatenate(lists)
        at = at[(symbol[at] == left) & (symbol[after[at]] == right)]
        if len(at) > 1 and (len(lists) > 1 or left == right):
            at = np.unique(at)
            if left == right:
                at = _without_overlap(at, after)
        if not len(at):
            continue
        gone = after[at]
        behind = after[gone]
        symbol[at] = made
        symbol[gone] = _GONE
        after[at] = behind
        before[behind] = at
        before[total] = after[total] = total
        ahead = before[at]
        add(np.concatenate((ahead[ahead < total], at)))
    alive = symbol[:total] >= 0
    return symbol[:total][alive], np.concatenate(([0], np.cumsum(alive)))[starts]


def _without_overlap(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of sorted positions whose pairs may share a symbol: the first of each run, and every second one after."""
    touches = np.concatenate(([False], after[at[:-1]] == at[1:]))
    number = np.arange(len(at))
    first = np.maximum.accumulate(np.where(touches, 0, number))
    return at[(number - first) % 2 == 0]


class Encoder:
    """Encodes batches of texts: (ids, first index of each text).

    Cuts at spaces first: a space after a character that is no white space always begins a piece, so
    a stretch ("unit") from there to the next space can be looked up as a whole.  A text with white
    space beside a space is cut by the pattern alone.
    """

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        import pyarrow as pa
        import pyarrow.compute as pc

        plain = np.array([self._plain(t) for t in texts], dtype=bool)
        stretches = pc.split_pattern(pa.array([t for t, p in zip(texts, plain) if p], type=pa.large_string()), " ")
        coded = stretches.flatten().dictionary_encode()
        starts = stretches.offsets.to_numpy()
        # A unit is a str for " " + str, ("", s) for s itself, ("\0", s) for a special token.
        units: list = coded.dictionary.to_pylist()
        row = coded.indices.to_numpy().astype(np.int64)
        heads = stretches.flatten().take(pa.array(starts[:-1])).to_pylist() if len(starts) > 1 else []
        row[starts[:-1]] = len(units) + np.arange(len(heads))
        units += [("", h) for h in heads]
        counts, rows = np.zeros(len(texts), dtype=np.int64), [row]
        counts[plain] = np.diff(starts)
        del stretches, coded  # the units stand for them from here on
        for i in np.flatnonzero(~plain).tolist():
            own = self._odd(texts[i])
            rows.append(len(units) + np.arange(len(own)))
            units += own
            counts[i] = len(own)
        ids, at = self._units(units)
        # The odd texts' rows follow the plain ones'.
        order = np.concatenate(rows)
        first = np.zeros(len(texts), dtype=np.int64)
        for part, offset in ((plain, 0), (~plain, len(row))):
            first[part] = offset + np.cumsum(counts[part]) - counts[part]
        if not plain.all():
            order, _ = spread(order, *_as_slices(first, counts))
        flat, starts = spread(ids, at, order)
        return flat, starts[np.concatenate(([0], np.cumsum(counts)))]

    def _plain(self, text: str) -> bool:
        return not (any(s in text for s in self.vocab.special) or _blank_beside_space(text))

    def _odd(self, text: str) -> list:
        """Units of a text with special tokens, or white space beside a space: cut by the pattern."""
        parts = self.vocab.special_cut.split(text) if self.vocab.special_cut else [text]
        return [u for k, part in enumerate(parts) for u in
                ([("\0", part)] if k % 2 else [("", p) for p in self.vocab.pieces.findall(part)])]

    def _units(self, units: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every unit, in one array, and where each unit's begin."""
        vocab, cut = self.vocab, self.vocab.pieces.findall
        pieces: dict[str, int] = defaultdict()
        pieces.default_factory = pieces.__len__
        order, counts = [], []
        for unit in units:
            if type(unit) is tuple and unit[0]:
                found = [-1 - vocab.special[unit[1]]]
            elif type(unit) is tuple:
                found = [pieces[p] for p in cut(unit[1])]
            elif unit.isalpha():  # letters alone are one piece with the space before them
                found = (pieces[" " + unit],)
            elif unit[-1:] in _MARKS and unit[:-1].isalpha():
                found = (pieces[" " + unit[:-1]], pieces[unit[-1]])
            else:
                found = [pieces[p] for p in cut(" " + unit)]
            order += found
            counts.append(len(found))
        pieces.default_factory = None  # it refers to the dict: else all pieces stay until the garbage collector runs
        ids, at = merge_pieces(vocab, [p.encode() for p in pieces])
        order = np.array(order, dtype=np.int64)
        # Special tokens follow the pieces, one id each.
        ids = np.concatenate((ids, np.arange(vocab.size, dtype=np.int32)))
        at = np.concatenate((at, at[-1] + 1 + np.arange(vocab.size)))
        order = np.where(order < 0, len(pieces) - 1 - order, order)
        flat, starts = spread(ids, at, order)
        return flat, starts[np.concatenate(([0], np.cumsum(counts))).astype(np.int64)]


_MARKS = frozenset(",.;:!?")
# Everything that str or the pattern takes for white space, but the space itself.
_BLANKS = [c for c in map(chr, range(0x3001)) if c != " " and (c.isspace() or regex.match(r"\s", c))]


def _blank_beside_space(part: str) -> bool:
    return "  " in part or part[-1:] == " " or any(c + " " in part or " " + c in part for c in _BLANKS if c in part)


def _as_slices(first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices [first, first + count) as the (at, order) that ``spread`` takes."""
    at = np.empty(2 * len(first), dtype=np.int64)
    at[0::2], at[1::2] = first, first + counts
    return at, np.arange(0, 2 * len(first), 2)


def spread(values: np.ndarray, at: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the slices values[at[i]:at[i + 1]] for i in order; also the first index of each."""
    starts = np.concatenate(([0], np.cumsum((at[1:] - at[:-1])[order])))
    flat = np.empty(starts[-1], dtype=values.dtype)
    for a in range(0, len(flat), BLOCK):
        b = min(a + BLOCK, len(flat))
        # The slices that lie in flat[a:b], the first and the last perhaps in part.
        i, j = np.searchsorted(starts, a, "right") - 1, np.searchsorted(starts, b, "left")
        shift = np.repeat(at[order[i:j]] - starts[i:j], np.diff(np.clip(starts[i:j + 1], a, b)))
        flat[a:b] = values[np.arange(a, b) + shift]
    return flat, starts


_READ: dict[int, Vocabulary] = {}


def vocabulary(content: bytes) -> Vocabulary:
    """The vocabulary of a file's content, read once per Python worker."""
    key = hash(content)
    if key not in _READ:
        _READ.clear()
        _READ[key] = Vocabulary(content)
    return _READ[key]
