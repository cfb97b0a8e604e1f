"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

Encoding. The tokens of a piece are found left to right. Byte-pair merging has the local
property that a token sequence is the encoding of its bytes exactly if every two neighbours
are: so each prefix of a piece has one last token, and a token may follow another only if the
pair survives merging on its own. A state of the transducer holds the hypotheses still alive:
for every open start position, the tokens decided since the last emitted one and the node of
the vocabulary trie that the bytes since then have reached. Reading a byte advances all nodes,
closes the one token that may end here, and emits whatever all hypotheses have in common.
A hypothesis dies after the longest token at the latest, so the lookahead is bounded. States
and transitions are built when they are met often and are shared by all pieces; the rest is
read by an automaton over all suffixes of the trie, which is determinised as lazily. The table
is dropped when it reaches ``MAX_MOVES``, which changes no result.

Decoding. Token bytes are joined chunk by chunk; ``Utf8Machine`` keeps an unfinished sequence
between chunks, so text leaves as soon as its code points are complete.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator

import regex
from pyspark.sql import DataFrame

from flowlens.llm.common import mapped, texts_of

#: Moves kept before the table of the transducer is started anew, and requests that make one.
MAX_MOVES, ASKED = 500_000, 16
#: Pieces in a generation whose ids are remembered (two are kept), and the longest such piece in characters.
MAX_PIECES, MAX_PIECE_CHARS = 400_000, 48
#: Pairs of tokens whose compatibility is remembered.
MAX_PAIRS = 1_000_000
#: Ids that are decoded at a time.
DECODE_CHUNK = 8_192
NEVER = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines)
        return {base64.b64decode(p[0]): int(p[1]) for p in pairs if p}


class Merges:
    """Merge ranks, and which tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self._halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        self._edges: tuple[dict, dict] = ({}, {})

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes ``token``; None for a token that no merge makes."""
        if token not in self._halves:
            parts = [token[i:i + 1] for i in range(len(token))]
            while len(parts) > 2:
                joined = [(self.ranks.get(a + b, NEVER), i)
                          for i, (a, b) in enumerate(zip(parts, parts[1:]))]
                rank, i = min(joined)
                if rank == NEVER:
                    break
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """What stands at one end of ``token`` while it is built, each with the rank that ends it."""
        known = self._edges[side].get(token)
        if known is None:
            halves = self.halves(token)
            grown = [] if halves is None else [*self.edge(halves[side], side)]
            if grown:
                grown[-1] = (grown[-1][0], self.ranks[token])
            known = self._edges[side][token] = [*grown, (token, NEVER)]
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of the two tokens gives back just these two."""
        return self._seam_holds(self.bytes_of[left], self.bytes_of[right])

    def _seam_holds(self, left: bytes, right: bytes) -> bool:
        """Replay both sides of the seam in merge order.

        A merge over the seam happens if it ranks before the merge that takes its left part
        away, and not after the one that takes its right part away: of equal ranks the
        leftmost merges first.
        """
        a, b = self.edge(left, 1), self.edge(right, 0)
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = a[i], b[j]
            rank = self.ranks.get(x + y, NEVER)
            if rank < x_until and rank <= y_until and rank != NEVER:
                return False
            if x_until == y_until == NEVER:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1


class Node:
    """A node of the vocabulary trie, which is also an automaton over all suffixes.

    ``kids`` are its children by byte, ``token`` is what ends here (or -1). ``fail`` is the node
    of its longest proper suffix in the trie, ``ends`` the longest suffix (itself included) that
    is a token; ``go`` holds the moves of the automaton that were met, ``after`` whether a token
    may stand before this one.
    """

    __slots__ = ("kids", "token", "depth", "fail", "ends", "go", "after")

    def __init__(self, depth: int = 0):
        self.kids: dict[int, Node] = {}
        self.token, self.depth, self.fail, self.ends = -1, depth, None, None
        self.go: dict[int, Node] = {}
        self.after: dict[int, bool] = {}

    def move(self, byte: int) -> Node:
        """The longest suffix in the trie after one more byte."""
        node = self
        while byte not in node.kids and node.fail is not None:
            node = node.fail
        self.go[byte] = node.kids.get(byte, node)
        return self.go[byte]


class State:
    """Last emitted token and live hypotheses; ``moves`` gives by byte the next state and output,
    or how often a move that is not made yet was asked for."""

    __slots__ = ("last", "live", "moves")

    def __init__(self, last: int, live: tuple):
        self.last, self.live, self.moves = last, live, {}


class Transducer:
    """Bytes of one piece in, token ids out."""

    def __init__(self, ranks: dict[bytes, int]):
        self.merges = Merges(ranks)
        self.root, self.pairs = Node(), []
        #: The hypothesis that nothing is pending, alone.
        self.alone = (((), self.root),)
        for word, rank in ranks.items():
            node = self.root
            for byte in word:
                nxt = node.kids.get(byte)
                if nxt is None:
                    nxt = node.kids[byte] = Node(node.depth + 1)
                node = nxt
            node.token = rank
        level = [self.root]
        while level:  # by depth, as each suffix is shorter than its node
            for node in level:
                for byte, kid in node.kids.items():
                    kid.fail = node.fail.move(byte) if node.fail else self.root
                    kid.ends = kid if kid.token >= 0 else kid.fail.ends
            level = [kid for node in level for kid in node.kids.values()]
        self._reset()

    def _reset(self) -> None:
        self.states: dict[tuple, State] = {}
        self.made = 0
        self.start = self._state((-1, self.alone))

    def _state(self, key: tuple) -> State:
        state = self.states.get(key)
        if state is None:
            state = self.states[key] = State(*key)
        return state

    def _fits(self, left: int, node: Node) -> bool:
        """Whether the token of ``node`` may follow ``left``; remembered at the node."""
        known = node.after.get(left)
        if known is None:
            if len(self.pairs) >= MAX_PAIRS:
                for other in self.pairs:
                    other.after.clear()
                self.pairs.clear()
            self.pairs.append(node)
            known = node.after[left] = self.merges.compatible(left, node.token)
        return known

    def _build(self, state: State, byte: int) -> tuple[State, tuple[int, ...]]:
        """The move from ``state`` on ``byte``: next state and the tokens now certain."""
        last = state.last
        alive, closed = [], None
        for pending, node in state.live:
            nxt = node.kids.get(byte)
            if nxt is None:
                continue
            if closed is None and nxt.token >= 0:
                before = pending[-1] if pending else last
                if before < 0 or self._fits(before, nxt):
                    closed = (*pending, nxt.token)
            if nxt.kids:
                alive.append((pending, nxt))
        if closed is None:
            raise ValueError("the vocabulary has no token for some byte")
        if not alive:
            out, key = closed, (closed[-1], self.alone)
        else:
            shared, oldest = 0, alive[0][0]  # the oldest hypothesis has the least pending
            while shared < len(oldest):
                token = closed[shared]
                if any(len(p) <= shared or p[shared] != token for p, _ in alive):
                    break
                shared += 1
            out = closed[:shared]
            if shared:
                key = (out[-1], (*[(p[shared:], node) for p, node in alive],
                                 (closed[shared:], self.root)))
            else:
                key = (last, (*alive, (closed, self.root)))
        move = state.moves[byte] = (self._state(key), out)
        return move

    def _rest(self, state: State, rest: bytes) -> list[int]:
        """What is left to emit if the piece goes on with ``rest`` and ends, making no states.

        Each end has one last token: the longest one here that may follow the last token where
        it starts. ``last`` holds them, from the start of the oldest hypothesis on.
        """
        told, live = state.last, state.live
        node = live[0][1]
        base = node.depth
        last = [-1] * (base + 1)
        for pending, start in live:
            last[base - start.depth] = pending[-1] if pending else told
        fits, end = self._fits, base
        for byte in rest:
            end += 1
            node = node.go.get(byte) or node.move(byte)
            word = node.ends
            while word is not None:
                left = last[end - word.depth]
                if left < 0 or word.after.get(left) or fits(left, word):
                    break
                word = word.fail.ends
            else:
                raise ValueError("the vocabulary has no token for some byte")
            last.append(word.token)
        out, bytes_of = [], self.merges.bytes_of
        while end > base:
            out.append(last[end])
            end -= len(bytes_of[last[end]])
        pending = next(p for p, start in live if start.depth == base - end)
        return [*pending, *reversed(out)]

    def encode(self, piece: bytes) -> list[int]:
        """A move is made once it was asked for ``ASKED`` times; until then the rest of the piece
        is read end by end, since most ways of rare pieces are never met again."""
        if self.made > MAX_MOVES:
            self._reset()
        state, out = self.start, []
        for i, byte in enumerate(piece):
            move = state.moves.get(byte, 0)
            if move.__class__ is int:
                if move < ASKED:
                    self.made += not move
                    state.moves[byte] = move + 1
                    return out + self._rest(state, piece[i:])
                move = self._build(state, byte)
            state, told = move
            if told:
                out += told
        out += state.live[-1][0]
        return out


#: The usual pattern of byte-level vocabularies, and the same with the frequent case first. No
#: two of its first three kinds start alike, so their order does not matter; this one is faster.
SAME_PATTERN = {
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+":
    r" ?\p{L}+|'(?:s|t|re|ve|m|ll|d)| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"}


class Encoder:
    """Whole texts to ids: pieces by ``pattern``, each through the transducer."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks)
        #: Token bytes by id; ids without a token hold none.
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.pieces = regex.compile(SAME_PATTERN.get(pattern, pattern)).findall
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the full generation before; what is met again stays

    def _piece(self, piece: str) -> bytes:
        out = self.older.get(piece)
        if out is None:
            out = array("I", self.transducer.encode(piece.encode())).tobytes()
        if len(piece) <= MAX_PIECE_CHARS:
            if len(self.known) >= MAX_PIECES:
                self.known, self.older = {}, self.known
            self.known[piece] = out
        return out

    def packed(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers (native order of the usual hosts)."""
        known, missing = self.known.get, self._piece  # a generation that ends within is still read
        return b"".join([known(p) or missing(p) for p in self.pieces(text)])

    def encode(self, text: str) -> list[int]:
        return array("I", self.packed(text)).tolist()


class Utf8Machine:
    """Incremental UTF-8: bytes in any cuts in, complete text out, unfinished bytes kept.

    States are the bounds of the next byte and how many follow. Bytes that cannot continue a
    sequence become U+FFFD, one for each maximal broken part.
    """

    #: Lead bytes: first, last, bounds of the second byte, bytes that follow (fixed by UTF-8).
    LEADS = [(0xC2, 0xDF, 0x80, 0xBF, 1), (0xE0, 0xE0, 0xA0, 0xBF, 2), (0xE1, 0xEC, 0x80, 0xBF, 2),
             (0xED, 0xED, 0x80, 0x9F, 2), (0xEE, 0xEF, 0x80, 0xBF, 2), (0xF0, 0xF0, 0x90, 0xBF, 3),
             (0xF1, 0xF3, 0x80, 0xBF, 3), (0xF4, 0xF4, 0x80, 0x8F, 3)]
    START = {b: (lo, hi, n) for first, last, lo, hi, n in LEADS for b in range(first, last + 1)}

    def __init__(self):
        self.kept, self.state = b"", None

    def feed(self, raw: bytes) -> str:
        """The text that is complete with these bytes."""
        data, cut = self.kept + raw, len(self.kept) + len(raw)
        for back in range(1, min(4, len(data)) + 1):  # only the last lead byte can be unfinished
            lead = self.START.get(data[-back])
            if lead:
                if back <= lead[2]:
                    cut = len(data) - back
                break
            if data[-back] < 0x80:
                break
        body, tail = data[:cut], data[cut:]
        try:
            text = body.decode()
        except UnicodeDecodeError:
            text = self._walk(body)
        self.kept, broken = b"", ""
        if tail:
            lo, hi, _ = self.START[tail[0]]
            if len(tail) == 1 or lo <= tail[1] <= hi and all(0x80 <= b <= 0xBF for b in tail[2:]):
                self.kept = tail
            else:
                broken = self._walk(tail)
        return text + broken

    def finish(self) -> str:
        left, self.kept = self.kept, b""
        return "�" if left else ""

    def _walk(self, data: bytes) -> str:
        """Byte by byte, for input that is not valid as a whole."""
        out, at = [], 0
        while at < len(data):
            byte = data[at]
            lo, hi, more = self.START.get(byte, (0, 0, 0))
            end = at + 1
            while more and end < len(data) and lo <= data[end] <= hi:
                end, lo, hi, more = end + 1, 0x80, 0xBF, more - 1
            good = byte < 0x80 or byte in self.START and not more
            out.append(data[at:end].decode() if good else "�")
            at = end
        return "".join(out)


def decode_bytes(ids: Iterable[int], bytes_of: dict[int, bytes] | list[bytes]) -> Iterator[bytes]:
    """The bytes of the ids, a chunk at a time."""
    ids = ids if isinstance(ids, array | list) else list(ids)
    for at in range(0, len(ids), DECODE_CHUNK):
        yield b"".join(map(bytes_of.__getitem__, ids[at:at + DECODE_CHUNK]))


def decode_stream(ids: Iterable[int], bytes_of: dict[int, bytes] | list[bytes]) -> Iterator[str]:
    """Text as it becomes complete."""
    machine = Utf8Machine()
    for raw in decode_bytes(ids, bytes_of):
        yield machine.feed(raw)
    yield machine.finish()


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder for each worker process, vocabulary and pattern."""
    key = (path, pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(read_ranks(path), pattern)
    return _ENCODERS[key]


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` array<int>: the ids of every whole text.

    Null text counts as empty and an empty text has no ids; repeated rows and null ids stay as
    they are; other columns are left out. ``ranks_path`` must be readable on every executor.
    """
    def run(batch):
        enc = encoder(ranks_path, pattern)
        return {id_col: batch.column(0),
                "ids": [enc.encode(t) for t in texts_of(batch.column(1))]}

    kind = docs.schema[id_col].dataType.simpleString()
    return mapped(docs.select(id_col, text_col), f"`{id_col}` {kind}, ids array<int>", run)


def decode_ids(rows: DataFrame, ranks_path: str, id_col: str = "doc_id",
               ids_col: str = "ids") -> DataFrame:
    """``id_col``, ``text``: decoded text; broken UTF-8 becomes U+FFFD, null ids an empty text."""
    def run(batch):
        bytes_of = encoder(ranks_path, "").transducer.merges.bytes_of
        return {id_col: batch.column(0),
                "text": ["".join(decode_stream(ids or [], bytes_of))
                         for ids in batch.column(1).to_pylist()]}

    kind = rows.schema[id_col].dataType.simpleString()
    return mapped(rows.select(id_col, ids_col), f"`{id_col}` {kind}, text string", run)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Digests of the ids of each text, and of what the streaming decoder makes of them.

    One pass over the rows without a shuffle; a row's ids never leave its task.
    """
    def run(batch):
        enc = encoder(ranks_path, pattern)
        bytes_of = enc.tokens
        n, ids_sha, text_sha = [], [], []
        for text in texts_of(batch.column(1)):
            packed = enc.packed(text)
            ids = array("I", packed)
            decoded = hashlib.sha256()
            for part in decode_stream(ids, bytes_of):
                decoded.update(part.encode())
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(packed).hexdigest())
            text_sha.append(decoded.hexdigest())
        return {"doc_id": batch.column(0), "n_tokens": n, "ids_sha256": ids_sha,
                "decoded_sha256": text_sha}

    return mapped(docs.select("doc_id", "text"), "doc_id bigint, n_tokens bigint, "
                  "ids_sha256 string, decoded_sha256 string", run)
