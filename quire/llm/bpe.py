"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decode.

A sequence of tokens is the BPE encoding of its bytes exactly if every two
neighbours are: merging their bytes alone gives the two again. A pre-token is
therefore read by a nondeterministic transducer whose states are pairs (last token,
place in the vocabulary's trie): a byte moves down the trie, and where a token ends
that may follow the last one, a new pair begins. Every boundary has one encoding at
most, so a set of pairs has one member per start still open, as many as the longest
token has bytes at most. Sets are numbered as they are met and moves kept in a flat
table; a move gives the one token that may end at its byte. The encodings of all open
starts meet at a boundary a little way back, and tokens before it are settled: every
``LOOK`` bytes they are given out and forgotten, so a pre-token of any length is read
as a stream. Whether two tokens may be neighbours is settled by the merge ranks when
first asked. All tables have budgets and begin anew beyond them.

Texts are cut into pre-tokens by the vocabulary's pattern. Before that they are cut at
single spaces between two non-space characters, where a pre-token always begins;
pieces are short and recur, so their ids are kept in two tables of bounded bytes: a full one
gives way to an empty one and serves it until that is full too, so what recurs stays.

Decoding maps ids to bytes; text is given out as a stream by an incremental UTF-8
state machine that holds at most three bytes back, and puts U+FFFD for what is no UTF-8.

Defined cases. Null text: empty, no ids. Very long texts and texts without spaces are
encoded whole. Rows stand for themselves, repeated or not; ids and order pass through.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import leave_small, mix64

#: A single space between characters that no engine counts as white space.
_CUT = re.compile(r" (?<=\S )(?=\S)")
MOVES, PIECE_CHARS, IN_STEP, LOOK, DECODED = 1_500_000, 48, 256, 64, 4096
SLICE, SLICE_BYTES = 1024, 1 << 20
PIECES_BYTES, PIECE_BYTES = 48 << 20, 180  # of both tables of pieces; of an entry besides its characters and ids
_BITS = 24  # of a token's number
_TOKEN = (1 << _BITS) - 1


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Table:
    """Integers by 64-bit key, as two sorted arrays."""

    def __init__(self, key: np.ndarray | None = None, value: np.ndarray | None = None):
        self.key = np.empty(0, np.int64) if key is None else key
        self.value = np.empty(0, np.int32) if value is None else value

    def get(self, key: np.ndarray, lack: int) -> np.ndarray:
        if not len(self.key):
            return np.full(len(key), lack, np.int32)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.value[at], lack)

    def add(self, key: np.ndarray, value: np.ndarray) -> None:
        """Keys that the table does not hold, each once."""
        order = np.argsort(key)
        at = np.searchsorted(self.key, key[order])
        self.key = np.insert(self.key, at, key[order])
        self.value = np.insert(self.value, at, value[order].astype(np.int32))


class Transducer:
    """Encodes pre-tokens, many in step. Its tables are flat arrays."""

    def __init__(self, ranks: dict[bytes, int], limit: int = MOVES):
        self.ranks, self.limit = ranks, limit
        top = max(ranks.values())
        if top >= _TOKEN:
            raise ValueError(f"a vocabulary has less than {_TOKEN} tokens")
        self.bytes_of = [b""] * (top + 1)
        child: dict[int, int] = {}  # node << 8 | byte -> node
        depth, token_at = array("i", [0]), array("i", [-1])
        joins: dict[int, int] = {}  # two tokens -> the token of their bytes
        for word, rank in ranks.items():
            self.bytes_of[rank] = word
            node = 0
            for b in word:
                key = node << 8 | b
                node = child.setdefault(key, len(depth))
                if node == len(depth):
                    depth.append(depth[key >> 8] + 1)
                    token_at.append(-1)
            token_at[node] = rank
            for i in range(1, len(word)):
                left = ranks.get(word[:i])
                if left is not None and (right := ranks.get(word[i:])) is not None:
                    joins[left << _BITS | right] = rank
        self.depth, self.token_at = np.array(depth), np.array(token_at)
        self.child, self.joins = (Table() for _ in range(2))
        for t, d in ((self.child, child), (self.joins, joins)):
            t.add(np.fromiter(d, np.int64, len(d)), np.fromiter(d.values(), np.int64, len(d)))
        self.size = np.array([len(w) for w in self.bytes_of], np.int32)
        self.left, self.right = np.full(top + 1, -1, np.int32), np.full(top + 1, -1, np.int32)
        for rank, word in enumerate(self.bytes_of):
            if len(word) > 1 and (parts := self._parts(word)):
                self.left[rank], self.right[rank] = parts
        self.never = (self.size > 1) & (self.left < 0)  # tokens that merging their own bytes never makes
        self._reset()

    def _reset(self) -> None:
        # a member is last token + 1 << 32 | trie node; a move's key is state << 8 | byte
        self.members, self.first = np.zeros(1, np.int64), np.array([0, 1], np.int64)
        self.number = Table(_set_hash(np.zeros(1, np.int64), np.zeros(1, np.int64), 1), np.zeros(1, np.int32))
        self.key, self.to, self.token = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)

    def _parts(self, word: bytes) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for what merging never makes."""
        own = self.ranks[word]
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if best == 1 << 60 or best == own and len(parts) > 2:
                return None
            if len(parts) == 2:
                return self.ranks[parts[0]], self.ranks[parts[1]]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return None

    def follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging keeps the boundary between two tokens.

        Merges are undone on both sides of it, the later one first. The boundary goes if
        at some time its two neighbours merge earlier than what was undone last; of equal
        ranks the left one merges first.
        """
        out = ~self.never[a] & ~self.never[b]
        left = np.flatnonzero(out)
        a, b = a[left].astype(np.int64), b[left].astype(np.int64)
        before = np.full(len(left), _TOKEN, np.int64)
        while len(left):
            across = self.joins.get(a << _BITS | b, _TOKEN)
            gone = across < before
            out[left[gone]] = False
            in_a, in_b = self.right[a], self.left[b]
            go = ~gone & ((in_a >= 0) | (in_b >= 0))
            left, a, b, in_a, in_b = left[go], a[go], b[go], in_a[go], in_b[go]
            undo_a = (in_b < 0) | (in_a >= 0) & (a > b)
            before = np.where(undo_a, a, b + 1)
            a, b = np.where(undo_a, in_a, a), np.where(undo_a, b, in_b)
        return out

    def _determinise(self, key: np.ndarray) -> None:
        """Adds the moves of distinct keys: the next state, and the token that ends there (-1: none may).

        Members of a state are (last token, trie node), one for each start still open."""
        state, byte = key >> 8, key & 0xFF
        n = self.first[state + 1] - self.first[state]
        of = np.repeat(np.arange(len(key)), n)
        member = self.members[np.arange(len(of)) + np.repeat(self.first[state] - (np.cumsum(n) - n), n)]
        to = self.child.get((member & 0xFFFFFFFF) << 8 | byte[of], -1)
        of, last, to = of[to >= 0], (member >> 32)[to >= 0] - 1, to[to >= 0]
        token = self.token_at[to]
        may = np.flatnonzero(token >= 0)
        ok = ~self.never[token[may]]
        after = last[may] >= 0
        ok[after] &= self.follows(last[may][after], token[may][after])
        ended = np.full(len(key), -1, np.int32)
        ended[of[may[ok]]] = token[may[ok]]
        new = np.flatnonzero(ended >= 0)
        of = np.r_[of, new]
        member = np.r_[last + 1 << 32 | to, ended[new].astype(np.int64) + 1 << 32]
        order = np.argsort(of, kind="stable")
        of, member = of[order], member[order]
        hashed = _set_hash(member, of, len(key))
        number = self.number.get(hashed, -1).astype(np.int64)
        fresh, where = np.unique(hashed[number < 0], return_index=True)
        if len(fresh):
            which = np.flatnonzero(number < 0)[where]  # a key that leads to each new state
            number_of = len(self.first) - 1 + np.arange(len(which))
            lo, hi = np.searchsorted(of, which), np.searchsorted(of, which, "right")
            size = hi - lo
            at = np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)
            self.members = np.r_[self.members, member[at]]
            self.first = np.r_[self.first, self.first[-1] + np.cumsum(size)]
            self.number.add(fresh, number_of)
            number = self.number.get(hashed, -1)
        at = np.searchsorted(self.key, key)
        self.key, self.to, self.token = (np.insert(x, at, v.astype(x.dtype)) for x, v in ((self.key, key), (self.to, number), (self.token, ended)))

    def _move(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = state << 8 | byte
        at = np.searchsorted(self.key, key)
        if len(self.key):
            at = np.minimum(at, len(self.key) - 1)
            lack = self.key[at] != key
        else:
            lack = np.ones(len(key), bool)
        if lack.any():
            self._determinise(np.unique(key[lack]))
            at = np.searchsorted(self.key, key)
        return self.to[at].astype(np.int64), self.token[at]

    def encode_all(self, words: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens, as little-endian unsigned 32-bit integers."""
        if len(self.key) > self.limit:
            self._reset()
        n = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-n, kind="stable")
        order = order[(n[order] <= IN_STEP) & (n[order] > 0)]
        short = n[order]
        data = np.frombuffer(b"".join([words[i] for i in order.tolist()]), np.uint8).astype(np.int64)
        start = np.cumsum(short) - short
        ends = np.empty(len(data), np.int32)
        state = np.zeros(len(order), np.int64)
        for i in range(int(short[0]) if len(order) else 0):
            go = int(np.searchsorted(-short, -i))  # words of more than i bytes
            state, ends[start[:go] + i] = self._move(state[:go], data[start[:go] + i])
        tokens = self._back(ends, start, short)
        out = [b""] * len(words)
        flat, cuts = tokens[0].tobytes(), (4 * tokens[1]).tolist()
        for i, a, b in zip(order.tolist(), cuts, cuts[1:]):
            out[i] = flat[a:b]
        for i in np.flatnonzero(n > IN_STEP).tolist():
            out[i] = b"".join(self.stream(words[i]))
        return out

    def _back(self, ends: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of each word, found from its last byte backwards, and where each word's begin."""
        steps, who, at = [], np.arange(len(start)), length.copy()
        who = who[at > 0]
        while len(who):
            token = ends[start[who] + at[who] - 1]
            if (token < 0).any():
                raise ValueError("no encoding: a byte is missing from the vocabulary")
            steps.append((who, token))
            at[who] -= self.size[token]
            who = who[at[who] > 0]
        count = np.zeros(len(start) + 1, np.int64)
        for who, _ in steps:
            count[who + 1] += 1
        first = np.cumsum(count)
        out, place = np.empty(int(first[-1]), "<u4"), first[1:].copy()
        for who, token in steps:
            place[who] -= 1
            out[place[who]] = token
        return out, first

    def stream(self, word: bytes) -> Iterator[bytes]:
        """Ids of a pre-token of any length, given out as they are settled: all open starts agree on them."""
        ends, state = np.empty(0, np.int32), np.zeros(1, np.int64)
        for at in range(0, len(word), LOOK):
            if at:
                member = self.members[self.first[state[0]] : self.first[state[0] + 1]]
                open_ = set((len(ends) - self.depth[member & 0xFFFFFFFF]).tolist()) or {0}
                while len(open_) > 1:
                    last = max(open_)
                    open_.remove(last)
                    open_.add(last - int(self.size[ends[last - 1]]))
                cut = np.array([open_.pop()])
                yield self._back(ends, np.zeros(1, np.int64), cut)[0].tobytes()
                ends = ends[cut[0] :]
            new = []
            for b in word[at : at + LOOK]:
                state, token = self._move(state, np.array([b]))
                new.append(token)
            ends = np.concatenate([ends, *new])
        yield self._back(ends, np.zeros(1, np.int64), np.array([len(ends)]))[0].tobytes()

    def encode(self, word: bytes) -> list[int]:
        return np.frombuffer(self.encode_all([word])[0], "<u4").tolist()


def _set_hash(member: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each of ``n`` sets of members; ``of`` ascends."""
    h = mix64(member.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    sums = np.r_[np.uint64(0), np.cumsum(h, dtype=np.uint64)]
    cuts = np.searchsorted(of, np.arange(n + 1))
    return (sums[cuts[1:]] - sums[cuts[:-1]]).view(np.int64)


class Utf8Stream:
    """Incremental UTF-8 decoder; invalid sequences become U+FFFD, one for each maximal valid start.

    Its state is the start of a character whose rest has not come yet: three bytes at most."""

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data) - self._open(data)
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    @staticmethod
    def _open(data: bytes) -> int:
        """How many bytes at the end begin a character that is not complete."""
        for n in range(1, min(3, len(data)) + 1):
            b = data[-n]
            if 0x80 <= b <= 0xBF:
                continue
            need = 0 if not 0xC2 <= b <= 0xF4 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
            if need <= n:
                return 0
            low = {0xE0: 0xA0, 0xF0: 0x90}.get(b, 0x80)
            high = {0xED: 0x9F, 0xF4: 0x8F}.get(b, 0xBF)
            return n if n == 1 or low <= data[1 - n] <= high else 0
        return 0

    def close(self) -> str:
        out = "\ufffd" if self.held else ""
        self.held = b""
        return out


class Codec:
    """Encoder and decoder of one vocabulary file (rank per line) and pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.transducer = Transducer(load_ranks(path))
        self.find = regex.compile(pattern).findall
        self.token = self.transducer.bytes_of
        self.forget()

    def forget(self) -> None:
        """Begins both tables of pieces anew."""
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.used = 0

    def _new(self, words: set[str]) -> dict[str, bytes]:
        """Ids of pre-tokens."""
        ranks, raw = self.transducer.ranks, {w: w.encode() for w in words}
        whole = {w: ranks[r].to_bytes(4, "little") for w, r in raw.items() if r in ranks}
        rest = [w for w in raw if w not in whole]
        whole.update(zip(rest, self.transducer.encode_all([raw[w] for w in rest])))
        return whole

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [_CUT.split(t) for t in texts]
        begins = [c.pop(0) for c in cut]
        if self.used > PIECES_BYTES // 2:  # what recurs moves on from the older table
            self.older, self.pieces, self.used = self.pieces, {}, 0
        pieces, older, find = self.pieces, self.older, self.find
        lack = set(chain.from_iterable(cut)).difference(pieces)
        found = {p: older[p] for p in lack if p in older}
        new = {p: find(" " + p) for p in lack.difference(found)}
        first = [find(t) for t in begins]
        ids = self._new(set(chain.from_iterable(new.values())).union(*first))
        found.update((p, b"".join(map(ids.__getitem__, w))) for p, w in new.items())
        pieces.update(found)
        out = [b"".join([*map(ids.__getitem__, f), *map(pieces.__getitem__, c)]) for f, c in zip(first, cut)]
        for p, v in found.items():
            if len(p) > PIECE_CHARS:
                del pieces[p]
            else:
                self.used += len(p) + len(v) + PIECE_BYTES
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode_stream(self, ids: Iterable[int], block: int = 1) -> Iterator[str]:
        """Text as it becomes known, ``block`` ids at a time."""
        stream, token = Utf8Stream(), self.token
        ids = iter(ids)
        while some := list(islice(ids, block)):
            if got := stream.feed(b"".join([token[i] for i in some])):
                yield got
        if got := stream.close():
            yield got

    def digests(self, ids: bytes) -> tuple[str, str]:
        """SHA-256 of the ids, and of the text that the streaming decoder gives out for them."""
        text = hashlib.sha256()
        for part in self.decode_stream(np.frombuffer(ids, "<u4").tolist(), DECODED):
            text.update(part.encode())
        return hashlib.sha256(ids).hexdigest(), text.hexdigest()


@lru_cache(maxsize=1)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def _slices(b: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch of at most SLICE rows and of about SLICE_BYTES with their texts (column 1)."""
    size = pc.cumulative_sum(pc.fill_null(pc.binary_length(b.column(1)), 0).cast(pa.int64())).to_numpy(zero_copy_only=False)
    at = 0
    while at < b.num_rows:
        end = int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE_BYTES, "right"))
        part = b.slice(at, min(max(end - at, 1), SLICE))
        yield part, [t or "" for t in part.column(1).to_pylist()]
        at += part.num_rows


def encoded(documents: DataFrame, vocabulary: str | None = None, pattern: str | None = None, keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, with ``keep_ids``, ids (binary, 4 bytes each)
    for every row. ``vocabulary`` is a path on every worker; None: that of the installed package."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, form = (vocabulary, pattern) if vocabulary else default_vocabulary()
        c = codec(path, form)
        for b in batches:
            for part, texts in _slices(b):
                ids = c.encode_all(texts)
                shas = [c.digests(x) for x in ids]
                columns = {
                    "doc_id": part.column(0),
                    "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                    "ids_sha256": pa.array([a for a, _ in shas], pa.string()),
                    "decoded_sha256": pa.array([b for _, b in shas], pa.string()),
                }
                if keep_ids:
                    columns["ids"] = pa.array(ids, pa.binary())
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
        c.forget()  # the worker outlives the task, and idle ones add up

    kind = documents.schema["doc_id"].dataType.simpleString()
    form = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids
    return documents.select("doc_id", "text").mapInArrow(leave_small(run), form)


def decoded(tokens: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, text of every row of ``encoded``'s result, by the streaming decoder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, form = (vocabulary, pattern) if vocabulary else default_vocabulary()
        c = codec(path, form)
        for b in batches:
            text = ["".join(c.decode_stream(np.frombuffer(x or b"", "<u4").tolist())) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string())], ["doc_id", "text"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")
