"""Byte-level BPE encoding and decoding by a lazily determinised transducer.

The merges of a rank table are compiled as a trie of tokens plus one fact about pairs: tokens a, b may stand side by
side in an encoding only if encoding their joined bytes gives back a, b. The encoding of every prefix of a piece then
ends in exactly one token, so one pass over the bytes suffices. At each byte the trie nodes still open are those that
spell a suffix of the prefix; the longest one determines the others, so it names the state of the determinised
automaton. States and transitions are made when first met (a lazy subset construction), each with the tokens that may
end there, longest first; there are at most as many states as trie nodes. A register holds the token in which each
recent prefix ends: the longest token that may follow what ends before it.

Whatever follows, the final encoding passes through one of the open positions, which lie within a token's length of
the head: once all of them agree on the tokens before, those are emitted (bounded lookahead).

Decoding maps ids to bytes and passes them through an incremental UTF-8 state machine.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ._common import Recent, append_columns, resident

_NEVER = 1 << 60
#: Bytes of a piece between two emissions.
_BLOCK = 512


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class BpeTransducer:
    """Encodes one piece of bytes at a time; `max_states` and `max_pairs` bound what is remembered."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 1_000_000, max_pairs: int = 1_000_000):
        self.ranks, self.max_states, self.max_pairs = ranks, max_states, max_pairs
        self.tokens = {i: t for t, i in ranks.items()}
        self.size = {i: len(t) for t, i in ranks.items()}
        self.longest = max(self.size.values())
        #: The token before the first one, which every token may follow.
        self.before_all = max(self.size) + 1
        #: The token before a position that is behind the emitted tokens; none may follow.
        self.blocked = self.before_all + 1
        self.child: dict[int, int] = {}  # node << 8 | byte -> node; node 0 is the root
        self.spelt: list[bytes] = [b""]  # the bytes of each node
        for token in ranks:
            node = 0
            for k, byte in enumerate(token):
                node = self.child.setdefault(node << 8 | byte, len(self.spelt))
                if node == len(self.spelt):
                    self.spelt.append(token[: k + 1])
        self.pairs: dict[int, bool] = {}  # token before << 32 | token -> whether they may be neighbours
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.edges: tuple[dict[int, list[int]], dict[int, list[int]]] = ({}, {})
        self.ends: dict[int, tuple[tuple[int, int], ...]] = {}  # node -> (size, token) of tokens that may end there
        self.steps: dict[int, tuple[int, tuple]] = {}  # node << 8 | byte -> node << 8, its ends

    def merge(self, piece: bytes) -> list[int]:
        """Plain BPE by rank: joins the leftmost pair of lowest rank until none is left. Defines what is right."""
        parts = [piece[k : k + 1] for k in range(len(piece))]
        while len(parts) > 1:
            low, k = min((self.ranks.get(parts[k] + parts[k + 1], _NEVER), k) for k in range(len(parts) - 1))
            if low == _NEVER:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [self.ranks[p] for p in parts]

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte or if merging does not give the token."""
        if token not in self.halves:
            parts, ranks = [bytes([b]) for b in self.tokens[token]], self.ranks
            while len(parts) > 2:
                low, k = min((ranks.get(parts[k] + parts[k + 1], _NEVER), k) for k in range(len(parts) - 1))
                if low == _NEVER:
                    break
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            self.halves[token] = (ranks[parts[0]], ranks[parts[1]]) if len(parts) == 2 else None
        return self.halves[token]

    def _possible(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token."""
        return self.size[token] == 1 or self._halves(token) is not None

    def _edge(self, token: int, side: int) -> list[int]:
        """The tokens that stand at an end (side 0: left, 1: right) of a token while it is merged, from byte to token."""
        found = self.edges[side].get(token)
        if found is None:
            found, at = [token], self._halves(token)
            while at is not None:
                found.append(at[side])
                at = self._halves(at[side])
            found = self.edges[side][token] = found[::-1]
        return found

    def _neighbours(self, a: int, b: int) -> bool:
        """Whether no merge crosses the boundary of a and b when their joined bytes are encoded.

        A token's rank exceeds its halves', so the tokens next to the boundary grow in the order of their ranks; a
        crossing merge happens if it comes before the next growth on either side, on equal rank the left one first.
        """
        left, right = self._edge(a, 1), self._edge(b, 0)
        i = j = 0
        while True:
            grow_left = left[i + 1] if i + 1 < len(left) else _NEVER
            grow_right = right[j + 1] if j + 1 < len(right) else _NEVER
            crossing = self.ranks.get(self.tokens[left[i]] + self.tokens[right[j]], _NEVER)
            if crossing < grow_left and crossing <= grow_right and crossing != _NEVER:
                return False
            if grow_left == grow_right == _NEVER:
                return True
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1

    def _learn_pair(self, pair: int) -> bool:
        before, token = pair >> 32, pair & 0xFFFFFFFF
        if len(self.pairs) >= self.max_pairs:
            self.pairs.clear()
        sentinel = before >= self.before_all
        found = self.pairs[pair] = before == self.before_all if sentinel else self._neighbours(before, token)
        return found

    def _step(self, at: int) -> tuple[int, tuple]:
        """Makes a transition (node << 8 | byte): the longest open node after the byte, and the tokens that may end there."""
        spelt, child, node = self.spelt[at >> 8] + bytes([at & 255]), self.child, at >> 8
        found = child.get(at)
        while found is None:  # drop bytes in front until what is left is spelt by a node
            spelt = spelt[1:]
            if not spelt:
                raise ValueError("the ranks lack a single byte")
            node = 0
            for byte in spelt[:-1]:
                node = child.get(node << 8 | byte)
                if node is None:
                    break
            found = None if node is None else child.get(node << 8 | spelt[-1])
        ends = self.ends.get(found)
        if ends is None:
            suffixes = (self.ranks.get(self.spelt[found][k:]) for k in range(len(self.spelt[found])))
            ends = tuple((self.size[t], t) for t in suffixes if t is not None and self._possible(t))
            self.ends[found] = ends
        if len(self.steps) >= self.max_states:
            self.steps.clear()
        made = self.steps[at] = found << 8, ends
        return made

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one piece; a piece that is a token as a whole is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        state, base, out = 0, 0, []
        last = [self.before_all]  # by position: the token in which the prefix ends there
        steps, pairs, add = self.steps, self.pairs, last.append
        for start in range(0, len(piece), _BLOCK):
            if start:
                base = self._emit(last, base, out)
            for byte in piece[start : start + _BLOCK]:
                try:
                    state, ends = steps[state | byte]
                except KeyError:
                    state, ends = self._step(state | byte)
                for size, token in ends:
                    pair = last[-size] << 32 | token
                    try:
                        fits = pairs[pair]
                    except KeyError:
                        fits = self._learn_pair(pair)
                    if fits:
                        break
                else:
                    raise ValueError("the ranks are no BPE merges")
                add(token)
        return out + self._trace(last, base, len(last) - 1)

    def _trace(self, last: list[int], base: int, end: int) -> list[int]:
        """The tokens from position base to end."""
        found, size = [], self.size
        while end > base:
            token = last[end]
            found.append(token)
            end -= size[token]
        return found[::-1]

    def _emit(self, last: list[int], base: int, out: list[int]) -> int:
        """Moves the tokens after position base that the open positions agree on from last to out; returns the new base.

        All open positions lie within a token's length of the head; so does the furthest point where paths may part.
        In front of the base the register is blocked: no token reaches across it.
        """
        heads = range(len(last) - 1, max(base, len(last) - 1 - self.longest), -1)
        agreed = []
        for column in zip(*[self._trace(last, base, head) for head in heads], strict=False):
            if any(t != column[0] for t in column):
                break
            agreed.append(column[0])
        if not agreed:
            return base
        out += agreed
        base += sum(self.size[t] for t in agreed)
        last[:base] = [self.blocked] * self.longest
        return self.longest


_ATOM = regex.compile(r"\[\^?\]?(?:\\.|[^\]\\])*\]|\\[pP]\{[^}]*\}|\\.|\(\?[=!<][^()]*\)|[^\\()|]", regex.DOTALL)
_TIMES = regex.compile(r"(?:[?*+]|\{\d*,?\d*\})[?+]?")
_BLANKS = {r"\s", r"[\r\n]", r"\r", r"\n"}


def space_starts_match(pattern: str) -> bool:
    """Whether the pattern's text proves that a space between two characters that are no white space begins a match, and
    that what comes before such a space is matched alike whatever follows it.

    Every alternative must be of plain atoms in a row. In one of white space only, the space is a match of its own. In
    any other no atom but the first may match a space, the first one at most once if it can match other characters, and
    nothing may look around. Groups, but those of letters as (?i:'s|'t), and all else that isn't understood prove nothing.
    """
    plain = regex.sub(r"\(\?i?:[^()\\\[\]\s.]*\)", "x", pattern)  # groups of literals without white space
    rest = regex.sub(r"\(\?[=!<][^()]*\)", "", plain)
    if "(" in rest or ")" in rest:
        return False
    for alternative in regex.split(r"\|(?![^\[]*\])", plain):
        atoms, at = [], 0
        while at < len(alternative):
            atom = _ATOM.match(alternative, at)
            if atom is None:
                return False
            times = _TIMES.match(alternative, atom.end())
            atoms.append((atom[0], times[0] if times else ""))
            at = times.end() if times else atom.end()
        looks = [a.startswith("(") for a, _ in atoms]
        if all(a in _BLANKS or look for (a, _), look in zip(atoms, looks, strict=True)):
            continue
        if any(looks):
            return False
        for k, (a, times) in enumerate(atoms):
            try:
                takes = regex.compile(a).match(" ") is not None
                others = regex.compile(a).match("a") or regex.compile(a).match("1") or regex.compile(a).match("-") or regex.compile(a).match("\u00e9")
            except regex.error:
                return False
            if takes and (k or others and times not in ("", "?", "?+")):
                return False
    return True


class TextEncoder:
    """Encodes texts split by a pattern, each match on its own.

    Remembers the packed ids of recent stretches between single spaces, a bounded number. Where the pattern proves that a
    space between two characters that are no white space always starts a match, such stretches are independent, and all
    that a text has anew are split in one go; texts with other spacing, and all texts of other patterns, are split as a
    whole.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int = 400_000):
        self.transducer, self.by_stretch = BpeTransducer(ranks), space_starts_match(pattern)
        compiled = regex.compile(pattern)
        self.find = (lambda text: [m[0] for m in compiled.finditer(text)]) if compiled.groups else compiled.findall
        self.memo: Recent = Recent(memo)

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        packed = array("I", ids)
        if sys.byteorder != "little":
            packed.byteswap()
        return packed.tobytes()

    def _pieces(self, text: str) -> bytes:
        ids, encode = [], self.transducer.encode
        for piece in self.find(text):
            ids += encode(piece.encode())
        return self._packed(ids)

    def _learn(self, stretches: list[str]) -> None:
        """Remembers the packed ids of a space and each stretch; all begin and end in characters that are no white space."""
        ids, encode, found = [], self.transducer.encode, []
        for piece in self.find(" " + " ".join(stretches)):
            if piece[0] == " ":  # only the first match of a stretch starts with a space
                ids = []
                found.append(ids)
            ids += encode(piece.encode())
        self.memo.update(zip(stretches, map(self._packed, found), strict=True))

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not self.by_stretch:
            return self._pieces(text)
        first, *rest = text.split(" ")
        if not rest or not first or first[-1].isspace():
            return self._pieces(text)
        found, missing = self.memo.look(rest)
        if missing:
            if any(not s or s[0].isspace() or s[-1].isspace() for s in missing):
                return self._pieces(text)
            self._learn(missing)
            found = [self.memo.new[s] if f is None else f for s, f in zip(rest, found, strict=True)]
        return self._pieces(first) + b"".join(found)


def _encoder(path: str, pattern: str) -> TextEncoder:
    """One encoder a worker process: what it has learnt serves all tasks of the operator that the process runs."""
    return resident(_load_encoder, path, pattern)


def _load_encoder(path: str, pattern: str) -> TextEncoder:
    return TextEncoder(load_ranks(path), pattern)


def _decoder(path: str) -> TokenDecoder:
    return resident(_load_decoder, path)


def _load_decoder(path: str) -> TokenDecoder:
    return TokenDecoder(load_ranks(path))


class Utf8Decoder:
    """Incremental UTF-8: feed() gives the text of all characters completed so far, finish() what is left.

    The state is the bytes of an unfinished character, at most three. Bytes that cannot be UTF-8 become U+FFFD.
    """

    #: Length of a character by its first byte; 0: not a first byte.
    _LENGTH = [1 if b < 0x80 else 2 if 0xC2 <= b < 0xE0 else 3 if 0xE0 <= b < 0xF0 else 4 if 0xF0 <= b < 0xF5 else 0 for b in range(256)]

    def __init__(self):
        self.pending = b""

    def feed(self, chunk: bytes) -> str:
        data = self.pending + chunk
        end = len(data)
        for back in range(1, min(3, len(data)) + 1):
            need = self._LENGTH[data[-back]]
            if need:
                end -= back if need > back else 0
                break
            if data[-back] & 0xC0 != 0x80:
                break
        self.pending = data[end:]
        return data[:end].decode("utf-8", "replace")

    def finish(self) -> str:
        left, self.pending = self.pending, b""
        return left.decode("utf-8", "replace")


class TokenDecoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.table = {i: t for t, i in ranks.items()}

    def chunks(self, ids: bytes, chunk: int = 65536):
        """Bytes of packed ids, chunk by chunk; a chunk may end within a character."""
        look, numbers = self.table.__getitem__, np.frombuffer(ids, dtype="<u4")
        for start in range(0, len(numbers), chunk):
            yield b"".join(map(look, numbers[start : start + chunk].tolist()))

    def stream(self, ids: bytes, chunk: int = 65536):
        """Text of packed ids, chunk by chunk: whole characters only."""
        machine = Utf8Decoder()
        for part in self.chunks(ids, chunk):
            yield machine.feed(part)
        yield machine.finish()


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """docs with ids (binary: little-endian unsigned 32-bit) and n_tokens. Whole texts; null and empty: no ids.

    Columns of these names are replaced; repeated rows stay. The rank file is read once a worker process, at a path that
    all machines have.
    """

    def make():
        encoder = _encoder(ranks_path, pattern)

        def each(texts: list[str]):
            ids = [encoder.encode(t) for t in texts]
            return [pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())]

        return each

    return append_columns(docs, text_col, make, "ids binary, n_tokens bigint")


def encode_checked(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """As encode, and decodes: whether the ids, decoded in the same pass, give the text again."""

    def make():
        encoder, decoder = _encoder(ranks_path, pattern), _decoder(ranks_path)

        def each(texts: list[str]):
            ids = [encoder.encode(t) for t in texts]
            same = ["".join(decoder.stream(i)) == t for i, t in zip(ids, texts)]
            return [pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(same, pa.bool_())]

        return each

    return append_columns(docs, text_col, make, "ids binary, n_tokens bigint, decodes boolean")


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """encoded with the text of its ids; null ids give empty text."""

    def make():
        decoder = _decoder(ranks_path)
        return lambda rows: [pa.array(["".join(decoder.stream(r or b"")) for r in rows], pa.string())]

    return append_columns(encoded, ids_col, make, f"{out_col} string")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """docs with n_tokens, ids_sha256 and decoded_sha256: each text is encoded, and its ids are decoded again.

    One pass, so that neither the ids nor the decoded texts leave the task.
    """

    def make():
        encoder, decoder = _encoder(ranks_path, pattern), _decoder(ranks_path)

        def each(texts: list[str]):
            n, a, b = [], [], []
            for t in texts:
                ids = encoder.encode(t)
                n.append(len(ids) // 4)
                a.append(hashlib.sha256(ids).hexdigest())
                digest = hashlib.sha256()
                for part in decoder.stream(ids):
                    digest.update(part.encode())
                b.append(digest.hexdigest())
            return [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]

        return each

    return append_columns(docs, text_col, make, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
