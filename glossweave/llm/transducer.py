"""Byte-pair encoding as a finite-state transducer that is determinised lazily.

The merges of a public vocabulary are compiled into a transducer over bytes.  A state is
what the past leaves undecided: the last token emitted and the bytes behind it that no token
has been decided for.  Reading a byte leads to a state and emits every token that no later
byte can change any more (bounded lookahead: a token is decided once all tokenisations that
a longer vocabulary entry could still lead to agree on it).  States and transitions are made
when first met and kept, so the machine grows only where the corpus goes.

Whether two tokens may stand side by side is decided by the merges alone: exactly if merging
their joined bytes gives the two back.  A sequence whose neighbours all may is the encoding.

``StreamDecoder`` is the way back: ids to text, byte by byte through a UTF-8 state machine,
so that a character may be split over ids and over calls.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from array import array
from functools import lru_cache

#: Sizes at which the grown parts are dropped and grown anew; only speed depends on them.
MAX_STATES = 150_000
MAX_PIECES = 200_000
MAX_PAIRS = 500_000
#: Longer pieces always go through the machine, so that what is kept stays small.
MAX_KEPT = 64


class Transducer:
    """The machine of one vocabulary: ``ranks`` maps each token's bytes to its id, lower ids merge first."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.prefixes = {t[:n] for t in ranks for n in range(1, len(t))}
        self._pair: dict[tuple[int, int], bool] = {}
        self._whole: dict[bytes, int | None] = {}
        self.reset()

    def reset(self) -> None:
        """Forget all states but the start."""
        self.number = {(-1, b""): 0}
        self.states: list[tuple[int, bytes]] = [(-1, b"")]
        self.arcs: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]
        self.ends: list[tuple[int, ...] | None] = [()]

    def merged(self, data: bytes) -> list[int]:
        """The merges applied to ``data`` from scratch, lowest rank first (the definition)."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def usable(self, piece: bytes) -> int | None:
        """The id of ``piece`` if it is a token that the merges make of its own bytes."""
        got = self._whole.get(piece, -1)
        if got == -1:
            if len(self._whole) > MAX_PAIRS:
                self._whole.clear()
            i = self.ranks.get(piece)
            got = self._whole[piece] = i if i is not None and (len(piece) == 1 or self.merged(piece) == [i]) else None
        return got

    def neighbours(self, a: int, b: int) -> bool:
        """Whether the encoding may hold ``a`` directly before ``b``."""
        if a < 0:
            return True
        got = self._pair.get((a, b))
        if got is None:
            if len(self._pair) > MAX_PAIRS:
                self._pair.clear()
            got = self._pair[a, b] = self.merged(self.token[a] + self.token[b]) == [a, b]
        return got

    def _last_tokens(self, before: int, data: bytes) -> list[tuple[int, int] | None]:
        """For each prefix of ``data``: start and id of the last token of its encoding behind ``before``."""
        last: list[tuple[int, int] | None] = [None] * (len(data) + 1)
        for end in range(1, len(data) + 1):
            for start in range(max(0, end - self.longest), end):
                if start and last[start] is None:
                    continue
                i = self.usable(data[start:end])
                if i is not None and self.neighbours(last[start][1] if start else before, i):
                    last[end] = (start, i)
                    break
        return last

    @staticmethod
    def _path(last: list, end: int) -> list[tuple[int, int]]:
        """Tokens up to ``end`` as (end, id)."""
        out = []
        while end:
            start, i = last[end]
            out.append((end, i))
            end = start
        return out[::-1]

    def _state(self, before: int, data: bytes) -> int:
        key = (before, data)
        n = self.number.get(key)
        if n is None:
            n = self.number[key] = len(self.states)
            self.states.append(key)
            self.arcs.append({})
            self.ends.append(None)
        return n

    def step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The transition of ``state`` on ``byte``: next state and the tokens decided by it."""
        got = self.arcs[state].get(byte)
        if got is not None:
            return got
        before, data = self.states[state]
        data += bytes((byte,))
        last = self._last_tokens(before, data)
        open_ends = [p for p in range(len(data)) if (p == 0 or last[p]) and data[p:] in self.prefixes]
        paths = [self._path(last, p) for p in open_ends]
        if last[len(data)]:
            paths.append(self._path(last, len(data)))
        agreed = []
        for tokens in zip(*paths):
            if any(t != tokens[0] for t in tokens):
                break
            agreed.append(tokens[0])
        if agreed:
            before, data = agreed[-1][1], data[agreed[-1][0] :]
        got = self.arcs[state][byte] = (self._state(before, data), tuple(i for _, i in agreed))
        return got

    def end(self, state: int) -> tuple[int, ...]:
        """The tokens of what ``state`` still holds when the input ends."""
        got = self.ends[state]
        if got is None:
            before, data = self.states[state]
            got = self.ends[state] = tuple(i for _, i in self._path(self._last_tokens(before, data), len(data)))
        return got

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one piece of text; a full machine is emptied wherever in the piece that happens."""
        arcs, state, out = self.arcs, 0, []
        for byte in piece:
            arc = arcs[state].get(byte)
            if arc is None:
                if len(self.states) > MAX_STATES:
                    here = self.states[state]
                    self.reset()
                    arcs, state = self.arcs, self._state(*here)
                arc = self.step(state, byte)
            state = arc[0]
            if arc[1]:
                out += arc[1]
        out += self.end(state)
        return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _class(kind: str) -> str:
    """The characters of a general category as the inside of a character class."""
    out, start = [], None
    for cp in range(0x110001):
        inside = cp < 0x110000 and unicodedata.category(chr(cp))[0] == kind
        if inside and start is None:
            start = cp
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}" if cp - 1 == start else f"\\U{start:08x}-\\U{cp - 1:08x}")
            start = None
    return "".join(out)


WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


@lru_cache(maxsize=4)
def splitter(pattern: str):
    """The vocabulary's split pattern for ``re``: categories and white space spelled out, once for ASCII and once for all text."""

    def build(letters: str, numbers: str, white: str):
        p = pattern
        for name, chars in (("\\p{L}", letters), ("\\p{N}", numbers)):
            p = re.sub(rf"\[(\^?[^\]]*){re.escape(name)}", lambda m: f"[{m[1]}{chars}", p) if "[" in p else p
            while (m := re.search(rf"\[[^\]]*{re.escape(name)}", p)):
                p = p[: m.end() - len(name)] + chars + p[m.end() :]
            p = p.replace(name, f"[{chars}]")
        p = re.sub(r"\[(\^?)\\s", lambda m: f"[{m[1]}{white}", p)
        p = p.replace("\\S", f"[^{white}]").replace("\\s", f"[{white}]")
        return re.compile(p).findall

    return build("A-Za-z", "0-9", "\\t-\\r "), build(_class("L"), _class("N"), WHITE)


class Encoder(dict):
    """Text to ids; as a dict it keeps the ids of pieces already sent through the machine."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        self.machine = Transducer(read_ranks(path))
        self.ascii, self.any = splitter(pattern)

    def __missing__(self, piece: str) -> array:
        ids = array("i", self.machine.encode(piece.encode("utf-8", "surrogatepass")))
        if len(piece) <= MAX_KEPT:
            if len(self) > MAX_PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def into(self, text: str | None, out: array) -> None:
        """Append the ids of a text; a null or empty text has none."""
        if text:
            for piece in (self.ascii if text.isascii() else self.any)(text):
                out += self[piece]

    def count(self, text: str | None) -> int:
        return sum(map(len, map(self.__getitem__, (self.ascii if text.isascii() else self.any)(text)))) if text else 0


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    """The process's encoder of a vocabulary."""
    return Encoder(path, pattern)


class Utf8Machine:
    """Incremental UTF-8: states are how many continuation bytes are due and the range of the next one."""

    def __init__(self):
        self.due, self.low, self.high, self.value = 0, 0x80, 0xBF, 0

    def feed(self, byte: int) -> str:
        """The characters completed by a byte; a malformed sequence gives U+FFFD and the byte starts anew."""
        if self.due:
            if self.low <= byte <= self.high:
                self.value = self.value << 6 | byte & 0x3F
                self.due, self.low, self.high = self.due - 1, 0x80, 0xBF
                return "" if self.due else chr(self.value)
            self.due, self.low, self.high = 0, 0x80, 0xBF
            return "�" + self.feed(byte)
        if byte < 0x80:
            return chr(byte)
        if 0xC2 <= byte <= 0xDF:
            self.due, self.value = 1, byte & 0x1F
        elif 0xE0 <= byte <= 0xEF:
            self.due, self.value = 2, byte & 0x0F
            self.low, self.high = (0xA0 if byte == 0xE0 else 0x80), (0x9F if byte == 0xED else 0xBF)
        elif 0xF0 <= byte <= 0xF4:
            self.due, self.value = 3, byte & 0x07
            self.low, self.high = (0x90 if byte == 0xF0 else 0x80), (0x8F if byte == 0xF4 else 0xBF)
        else:
            return "�"
        return ""

    def close(self) -> str:
        """What an unfinished character at the end gives."""
        left, self.due, self.low, self.high = self.due, 0, 0x80, 0xBF
        return "�" if left else ""


class StreamDecoder:
    """Ids to text, call by call."""

    def __init__(self, token: dict[int, bytes]):
        self.token, self.machine = token, Utf8Machine()

    def feed(self, ids) -> str:
        whole = b"".join(self.token[i] for i in ids)
        if not self.machine.due and whole.isascii():
            return whole.decode("ascii")
        return "".join(map(self.machine.feed, whole))

    def close(self) -> str:
        return self.machine.close()
