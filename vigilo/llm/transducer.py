"""A byte-level BPE tokenizer compiled to finite-state transducers.

Two machines, both deterministic, with outputs on their transitions:

* `Splitter` reads a text's bytes as character classes and marks where a pre-token begins. It has
  eight states, so what a chunk of bytes does is a map of eight states to eight states. All chunks of a
  slice are run at once from all states, the maps are composed by a parallel prefix scan, and a second
  run from the then known states emits the marks.
* `Merger` reads the bytes of a pre-token; each transition carries the change in the number of tokens.
  Its states are made when first reached and kept: a state holds, for every suffix that begins a
  vocabulary entry and can grow, the place in the vocabulary's trie, the token before it and the count there. The
  chunk map of a whole pre-token, from and to the start state, is one number, kept by its hash.

Character classes are asked of the tokenizer itself, a character at a time, so its own Unicode tables hold.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

from . import scan

CHUNK = 64
MAX_KEPT = 1_500_000      # pre-tokens remembered by a task; then it starts afresh, with the same results
MAX_STATES = 400_000      # transitions kept, likewise

_END, _L, _N, _O, _S, _P, _C1, _C2 = range(8)
(_LETTER, _NUMBER, _OTHER, _SPACE_MID, _SPACE_LAST, _WHITE_MID, _WHITE_LAST, _APOS2, _APOS3, _INSIDE) = range(10)
_RESET = 10


def _splitter_tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state and begins-a-token flag, at [symbol * 8 + state]; symbols from _RESET on forget the state."""
    go, cut = np.zeros((20, 8), np.uint8), np.zeros((20, 8), bool)
    for sym in range(10):
        for state in range(8):
            if sym == _INSIDE:
                go[sym, state] = state
            elif state == _C2:
                go[sym, state] = _C1
            elif state == _C1:
                go[sym, state] = _END
            elif sym in (_LETTER, _NUMBER, _OTHER):
                own = (_L, _N, _O)[sym]
                go[sym, state], cut[sym, state] = own, state not in (own, _P)
            elif sym in (_APOS2, _APOS3):
                joins = state in (_O, _P)
                go[sym, state], cut[sym, state] = _O if joins else _C1 if sym == _APOS2 else _C2, not joins
            elif sym in (_SPACE_MID, _WHITE_MID):
                go[sym, state], cut[sym, state] = _S, state != _S
            else:
                go[sym, state], cut[sym, state] = _P if sym == _SPACE_LAST else _END, True
        go[sym + _RESET], cut[sym + _RESET] = go[sym, _END], cut[sym, _END]
    cut[_INSIDE + _RESET] = True
    return go.ravel(), cut.ravel()


class Splitter:
    """Marks pre-tokens of all texts of a slice."""

    def __init__(self, tokenizer, special: list[str]):
        self._pieces = tokenizer.pre_tokenizer.pre_tokenize_str
        self.special = sorted((s.encode() for s in special), key=lambda s: (-len(s), s))
        self._go, self._cut = _splitter_tables()
        self._ascii = np.array([self._class_of(c) for c in range(128)], np.uint8)
        self._other: dict[int, int] = {}

    def _class_of(self, code: int) -> int:
        c = chr(code)
        for kind, probe in ((_LETTER, "a"), (_NUMBER, "1"), (_OTHER, "!")):
            if len(self._pieces(probe + c)) == 1:
                return kind
        return _SPACE_MID if c == " " else _WHITE_MID

    def _symbols(self, part: scan.Slice) -> np.ndarray:
        buf = part.buf
        sym = np.full(len(buf) + CHUNK, _INSIDE, np.uint8)
        n = len(buf)
        ascii_at = buf < 128
        sym[:n] = np.where(ascii_at, self._ascii[buf & 127], _INSIDE)
        lead = np.flatnonzero(buf >= 0xC0)
        length = None
        if len(lead):
            b = np.concatenate([buf, np.zeros(4, np.uint8)]).astype(np.int64)
            b0, b1, b2, b3 = (b[lead + k] for k in range(4))
            code = np.where(b0 < 0xE0, (b0 & 31) << 6 | b1 & 63,
                            np.where(b0 < 0xF0, (b0 & 15) << 12 | (b1 & 63) << 6 | b2 & 63,
                                     (b0 & 7) << 18 | (b1 & 63) << 12 | (b2 & 63) << 6 | b3 & 63))
            distinct, which = np.unique(code, return_inverse=True)
            for c in distinct.tolist():
                if c not in self._other:
                    self._other[c] = self._class_of(c)
            sym[lead] = np.array([self._other[c] for c in distinct.tolist()], np.uint8)[which]
            length = np.ones(n, np.int64)
            length[lead] = np.where(b0 < 0xE0, 2, np.where(b0 < 0xF0, 3, 4))
        white = (sym == _SPACE_MID) | (sym == _WHITE_MID)
        stops = white.copy()
        stops[part.ends] = True
        begins = np.zeros(len(sym), bool)
        begins[part.starts] = True
        begins[part.ends] = True
        if self.special:
            raw = buf.tobytes()
            for s, e in self.special_spans(raw):
                sym[s] = _OTHER
                sym[s + 1: e] = _INSIDE
                begins[[s, e]] = True
                stops[s] = True
        at = np.flatnonzero(white)
        after = at + (1 if length is None else length[np.minimum(at, n - 1)])
        sym[at[~stops[np.minimum(after, len(stops) - 1)]]] += 1
        quotes = np.flatnonzero(buf[: n - 1] == 0x27) if n else np.zeros(0, np.int64)
        if len(quotes):
            padded = np.concatenate([buf, np.zeros(4, np.uint8)])
            b1, b2 = padded[quotes + 1], padded[quotes + 2]
            sym[quotes[np.isin(b1, list(b"stmd"))]] = _APOS2
            three = np.isin(b1, list(b"rv")) & (b2 == ord("e")) | (b1 == ord("l")) & (b2 == ord("l"))
            sym[quotes[three]] = _APOS3
        sym[part.ends] = _OTHER
        sym[begins] += _RESET
        return sym[: -(-n // CHUNK) * CHUNK]

    def special_spans(self, raw: bytes):
        at = 0
        while True:
            found = [(p, -len(s), s) for s in self.special if (p := raw.find(s, at)) >= 0]
            if not found:
                return
            p, _, s = min(found)
            yield p, p + len(s)
            at = p + len(s)

    def split(self, part: scan.Slice) -> np.ndarray:
        """Where pre-tokens begin in part.buf; the separator after each text begins one too."""
        if not len(part.buf):
            return np.zeros(0, np.int64)
        sym = np.ascontiguousarray((self._symbols(part) * np.uint8(8)).reshape(-1, CHUNK).T)
        chunks = sym.shape[1]
        maps = np.tile(np.arange(8, dtype=np.uint8), (chunks, 1))
        for row in sym:
            maps = self._go.take(row[:, None] + maps)
        step = 1
        while step < chunks:                      # prefix scan: maps[i] becomes the map of all chunks up to i
            maps[step:] = np.take_along_axis(maps[step:], maps[:-step].astype(np.intp), axis=1)
            step *= 2
        state = np.concatenate(([np.uint8(_END)], maps[:-1, _END]))
        marks = np.empty((CHUNK, chunks), bool)
        for j, row in enumerate(sym):
            at = row + state
            marks[j] = self._cut.take(at)
            state = self._go.take(at)
        return np.flatnonzero(marks.T.ravel()[: len(part.buf)])


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: a byte's own character where it is visible, else 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merger:
    """Counts the BPE tokens of a pre-token's bytes, a transition a byte."""

    def __init__(self, model: dict):
        stand_in = byte_symbols()
        entries = {bytes(stand_in[c] for c in token): i for token, i in model["vocab"].items()}
        self._merge, self._parts = {}, {}
        for rank, pair in enumerate(model["merges"]):
            a, b = (bytes(stand_in[c] for c in x) for x in (pair if isinstance(pair, list) else pair.split(" ")))
            self._merge[entries[a], entries[b]] = rank
            self._parts.setdefault(entries[a + b], (rank, entries[a], entries[b]))
        self._child: list[dict[int, int]] = [{}]
        self._token: list[int] = [-1]
        for entry, i in entries.items():
            if len(entry) > 1 and i not in self._parts:
                continue
            node = 0
            for c in entry:
                nxt = self._child[node].get(c)
                if nxt is None:
                    nxt = self._child[node][c] = len(self._child)
                    self._child.append({})
                    self._token.append(-1)
                node = nxt
            self._token[node] = i
        self._right, self._left = {}, {}
        self.forget()

    def forget(self) -> None:
        start = (self._entry(0, -1, 0),)
        self._names = {start: 0}
        self._state = [start]
        self._stands: dict[tuple[int, int], bool] = {}
        self._go: dict[int, int] = {}

    @staticmethod
    def _entry(node: int, before: int, count: int) -> int:
        """A place in the trie, the token before its suffix (-1: none) and the count there, less the state's own count."""
        return (node << 32 | before + 1) << 8 | count + 128

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The symbols that touch one side of a token while it is made, first to last, and the rank that ends each."""
        kept = self._right if side == 2 else self._left
        if token not in kept:
            chain, ended, at = [], float("inf"), token
            while True:
                chain.append((at, ended))
                if at not in self._parts:
                    break
                ended, at = self._parts[at][0], self._parts[at][side]
            kept[token] = chain[::-1]
        return kept[token]

    def _stay_apart(self, a: int, b: int) -> bool:
        """Whether no merge crosses from a to b when their bytes stand together."""
        known = self._stands.get((a, b))
        if known is None:
            left, right, i, j, known = self._edge(a, 2), self._edge(b, 1), 0, 0, True
            while True:
                (x, x_ends), (y, y_ends) = left[i], right[j]
                rank = self._merge.get((x, y))
                if rank is not None and rank < x_ends and rank <= y_ends:
                    known = False
                    break
                if x_ends == y_ends == float("inf"):
                    break
                if x_ends <= y_ends:
                    i += 1
                else:
                    j += 1
            self._stands[a, b] = known
        return known

    def _compile(self, state: int, byte: int) -> int:
        """The transition, made when first taken: next state and change of the count in one number."""
        moved, token, delta = [], -1, 0
        for entry in self._state[state]:
            node = self._child[entry >> 40].get(byte)
            if node is None:
                continue
            before, count = (entry >> 8 & 0xFFFFFFFF) - 1, (entry & 255) - 128
            moved.append((node, before, count))
            if token < 0 and self._token[node] >= 0 and (before < 0 or self._stay_apart(before, self._token[node])):
                token, delta = self._token[node], count + 1
        key = (*(self._entry(node, before, count - delta) for node, before, count in moved if self._child[node]),
               self._entry(0, token, 0))
        name = self._names.setdefault(key, len(self._state))
        if name == len(self._state):
            self._state.append(key)
        step = self._go[state << 8 | byte] = name << 8 | delta + 128
        return step

    def count(self, piece: bytes) -> int:
        if len(self._go) > MAX_STATES:
            self.forget()
        state, total, go = 0, 0, self._go
        for byte in piece:
            step = go.get(state << 8 | byte)
            if step is None:
                step = self._compile(state, byte)
            state = step >> 8
            total += (step & 255) - 128
        return total


class Kept:
    """64-bit hash -> small integer, as an open-addressed table that whole arrays are looked up in."""

    def __init__(self, bits: int = 18):
        self.bits, self.n = bits, 0
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int64)

    def get(self, h: np.ndarray) -> np.ndarray:
        """Values; -1 where a key is missing."""
        out, todo = np.full(len(h), -1, np.int64), np.arange(len(h))
        at, mask = (h >> np.uint64(64 - self.bits)).astype(np.int64), len(self.keys) - 1
        while len(todo):
            found = self.values[at]
            same = (self.keys[at] == h[todo]) & (found >= 0)
            out[todo[same]] = found[same]
            go_on = ~same & (found >= 0)
            todo, at = todo[go_on], (at[go_on] + 1) & mask
        return out

    def put(self, h: np.ndarray, v: np.ndarray) -> None:
        """New, distinct keys."""
        if 2 * (self.n + len(h)) > len(self.keys):
            held = self.values >= 0
            old = self.keys[held], self.values[held]
            self.__init__(max(self.bits + 1, int(2 * (self.n + len(h))).bit_length()))
            self.put(*old)
        self.n += len(h)
        at, mask = (h >> np.uint64(64 - self.bits)).astype(np.int64), len(self.keys) - 1
        while len(h):
            free = self.values[at] < 0
            self.keys[at[free]] = h[free]                   # of several at a free place, one stays
            own = free & (self.keys[at] == h)
            self.values[at[own]] = v[own]
            h, v, at = h[~own], v[~own], (at[~own] + 1) & mask


def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


@lru_cache(maxsize=4)
def open_tokenizer(path: str):
    """(library's tokenizer, Splitter) of a byte-level BPE file, once per worker process."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    spec = _spec(path)
    pre = spec.get("pre_tokenizer") or {}
    if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
        raise ValueError(f"{path}: only byte-level BPE without a normaliser or a prefix space is compiled")
    tokenizer = Tokenizer.from_file(path)
    return tokenizer, Splitter(tokenizer, [t["content"] for t in spec["added_tokens"]])


@lru_cache(maxsize=4)
def open_merger(path: str) -> Merger:
    return Merger(_spec(path)["model"])


@lru_cache(maxsize=4)
def kept_counts(path: str) -> Kept:
    return Kept()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
