"""Token counts by a compiled tokenizer (operator 11): a deterministic transducer over bytes.

**Machine.**  A byte-level BPE first splits a text into words; within a word
the encoding of a prefix ends with one token, and removing that token leaves
the encoding of a shorter prefix.  A token u extends a prefix that ends with
token t exactly if t and u stay apart when their bytes are encoded alone.  So
all that later bytes can depend on is, for every earlier cut whose following
bytes are still the beginning of some token: that vocabulary-trie node, the
token before the cut, and the number of tokens before it, relative to now.
These finitely many tuples are the states; reading a byte moves every entry
down the trie, and the transition carries the change of the token count of
the text read so far.  The changes of a text add up to its token count.

States and transitions are made when first reached (a lazily compiled
automaton) and kept per worker in flat hash arrays; above ``MAX_STATES`` the
machine starts anew, which changes no result.

**Resets.**  The word splitter is a sliding-window machine: four characters
decide if a word starts (classes of letters, numbers, white space, other).
Where a word starts, or where no token contains the two adjacent bytes, the
state is the start state whatever came before.

**Chunks.**  A text stream is cut into chunks of fixed size that run side by
side, one array lane each.  Every chunk is a state map.  With a reset inside,
its map is constant and runs from the reset on at once; the bytes before it
wait for the entry state.  Maps compose from left to right: a chunk without
a reset is evaluated at the exit of its predecessor, all such chunks at once,
again while an entry changes, so that the scan ends with every map applied to
its true entry (two rounds as a rule, since the machine forgets quickly).

Strings of special tokens count as the one token the library makes of them by
default.  Defined cases: null and empty texts have no bytes and no tokens; a
text of any length is counted whole, in windows cut before white space;
repeated rows and ids are counted each; a null id stays null; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, map_stream, per_worker, text_col
from .tokens import (LETTER, NUMBER, OTHER, SPACE, UNKNOWN, Splitter, char_classes, default_tokenizer,  # noqa: F401
                     groups_of, library_class, load, text_slices)

CHUNK, WINDOW = 128, 1 << 19
MAX_STATES = 250_000
_BITS, _ITEM = 20, (1 << 20) - 1     # bits of a trie node and of a token in a state's entry
_START = 1                           # state 0 is a lane at rest


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Tokens as bytes, merge ranks, and the trie of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        added = spec.get("added_tokens") or []
        plain = not any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] for a in added)
        if (model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
                or not pre.get("use_regex", True) or spec["normalizer"] or model.get("ignore_merges") or not plain):
            raise ValueError(f"{path}: only plain byte-level BPE files can be compiled")
        letters = byte_letters()
        special = {a["content"] for a in added}
        self.special = special
        self.bytes_of = {i: bytes(letters[c] for c in w) for w, i in model["vocab"].items() if w not in special}
        self.id_of = {w: i for i, w in self.bytes_of.items()}
        ids = model["vocab"]
        self.merges = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merges[ids[a], ids[b]] = (rank, ids[a + b])
        # trie: child[node << 8 | byte] -> node; token[node] -> id or -1
        self.child: dict[int, int] = {}
        self.token = [-1]
        for word, i in self.id_of.items():
            node = 0
            for c in word:
                nxt = self.child.get(node << 8 | c)
                if nxt is None:
                    nxt = self.child[node << 8 | c] = len(self.token)
                    self.token.append(-1)
                node = nxt
            if self.merged(word) == [i]:
                self.token[node] = i
        self.inner = {k >> 8 for k in self.child}      # nodes that go on
        self.adjacent = np.zeros(65_536, bool)         # byte pairs inside some token
        for word in self.id_of:
            w = np.frombuffer(word, np.uint8).astype(np.int64)
            self.adjacent[w[:-1] << 8 | w[1:]] = True
        self.apart: dict[int, bool] = {}

    def merged(self, word: bytes) -> list[int]:
        """The encoding of a word: the merge of least rank first, the leftmost of equal ones."""
        parts = [self.id_of[word[k:k + 1]] for k in range(len(word))]
        while True:
            ranks = [(m[0], k, m[1]) for k, p in enumerate(zip(parts, parts[1:])) if (m := self.merges.get(p))]
            if not ranks:
                return parts
            _, k, made = min(ranks)
            parts[k:k + 2] = [made]

    def stay_apart(self, t: int, u: int) -> bool:
        """Do tokens t, u follow each other in an encoding?  ``t`` < 0 is the start of a word."""
        if t < 0:
            return True
        got = self.apart.get(t << _BITS | u)
        if got is None:
            got = self.merged(self.bytes_of[t] + self.bytes_of[u]) == [t, u]
            self.apart[t << _BITS | u] = got
        return got


class Transducer:
    """The lazily compiled machine: states, and transitions in open-addressing arrays."""

    def __init__(self, vocab: Vocabulary, max_states: int = MAX_STATES):
        self.vocab, self.max_states = vocab, max_states
        self.clear()

    def clear(self) -> None:
        # An entry: tokens since the cut << 2 * _BITS | trie node << _BITS | last token + 1.
        self.entries: list[bytes] = [b"", np.zeros(1, np.int64).tobytes()]
        self.number = {self.entries[_START]: _START}
        self.size, self.used = 1 << 16, 0
        self.keys, self.values = np.full(self.size, -1, np.int64), np.zeros(self.size, np.int64)
        self.vocab.apart.clear()
        self._store(np.arange(256), np.full(256, 128))        # at rest: stay, no change

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(U64) * U64(0x9E3779B97F4A7C15)) >> U64(65 - self.size.bit_length())).astype(np.int64)

    def _store(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add new keys (distinct)."""
        if 2 * (self.used + len(keys)) > self.size:
            held = self.keys >= 0
            keys, values = np.concatenate([self.keys[held], keys]), np.concatenate([self.values[held], values])
            while 2 * len(keys) > self.size:
                self.size *= 2
            self.keys, self.values = np.full(self.size, -1, np.int64), np.zeros(self.size, np.int64)
            self.used = 0
        self.used += len(keys)
        slot = self._slots(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]
            mine = free & (self.keys[slot] == keys)
            self.values[slot[mine]] = values[mine]
            keys, values, slot = keys[~mine], values[~mine], (slot[~mine] + 1) & (self.size - 1)

    def _make(self, key: int) -> int:
        """The transition of (state << 8 | byte): next state << 8 | change of the count + 128."""
        vocab, byte = self.vocab, key & 255
        kept, last, change = [], None, 0
        for e in np.frombuffer(self.entries[key >> 8], np.int64).tolist():
            node = vocab.child.get((e >> _BITS & _ITEM) << 8 | byte)
            if node is None:
                continue
            since, before = e >> 2 * _BITS, (e & _ITEM) - 1
            token = vocab.token[node]
            if last is None and token >= 0 and vocab.stay_apart(before, token):
                last, change = token, 1 - since
            if node in vocab.inner:
                kept.append((since, node, before))
        entries = sorted([(since + change) << 2 * _BITS | node << _BITS | before + 1 for since, node, before in kept]
                         + [last + 1])
        state = np.asarray(entries, np.int64).tobytes()
        number = self.number.get(state)
        if number is None:
            number = self.number[state] = len(self.entries)
            self.entries.append(state)
        return number << 8 | change + 128

    def step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and count changes of all lanes."""
        key = state << 8 | byte
        slot = self._slots(key)
        found = self.keys[slot]
        lost = np.flatnonzero(found != key)
        while len(lost):
            unknown = found[lost] < 0
            if unknown.any():
                new = np.unique(key[lost[unknown]])
                self._store(new, np.fromiter(map(self._make, new.tolist()), np.int64, len(new)))
                slot[lost] = self._slots(key[lost])
            else:
                slot[lost] = (slot[lost] + 1) & (self.size - 1)
            found[lost] = self.keys[slot[lost]]
            lost = lost[found[lost] != key[lost]]
            if unknown.any() and len(lost):     # the table may have grown: look all up again
                slot, found = self._slots(key), None
                found = self.keys[slot]
                lost = np.flatnonzero(found != key)
        value = self.values[slot]
        return value >> 8, (value & 255) - 128


class Counter:
    """``counts(texts)`` -> token counts, by the machine over chunks of the joined texts."""

    def __init__(self, path: str, chunk: int = CHUNK, window: int = WINDOW, max_states: int = MAX_STATES):
        self.vocab = Vocabulary(path)
        self.split = Splitter(load(path).pre_tokenizer, self.vocab.special, window)
        self.machine = Transducer(self.vocab, max_states)
        self.chunk, self.window = chunk, window

    def changes(self, data: np.ndarray, reset: np.ndarray) -> np.ndarray:
        """Change of the token count at every byte; ``reset`` marks bytes read from the start state."""
        size, step = self.chunk, self.machine.step
        lanes = -(-len(data) // size)
        byte, fresh = np.zeros(lanes * size, np.int64), np.zeros(lanes * size, bool)
        byte[:len(data)], fresh[:len(data)] = data, reset
        fresh[len(data):] = True
        byte, fresh = np.ascontiguousarray(byte.reshape(lanes, size).T), fresh.reshape(lanes, size).T.copy()
        first = np.where(fresh.any(axis=0), fresh.argmax(axis=0), size)
        out = np.zeros((size, lanes), np.int16)
        # constant part of every map: from its first reset to its end
        state = np.zeros(lanes, np.int64)
        for j in range(size):
            state = np.where(fresh[j], _START, state)
            state, out[j] = step(state, byte[j])
        leave = state

        def head(which: np.ndarray, entry: np.ndarray) -> np.ndarray:
            """Run the bytes before the first reset of some chunks; returns their states there."""
            now, most = entry.copy(), first[which]
            for j in range(int(most.max(initial=0))):
                run = np.flatnonzero(most > j)
                now[run], out[j, which[run]] = step(now[run], byte[j, which[run]])
            return now

        # maps without a reset: evaluated at their predecessors' exits until no entry changes
        whole = np.flatnonzero(first == size)
        entry = np.full(len(whole), -1, np.int64)
        leave[whole] = _START
        todo = np.arange(len(whole))
        while len(todo):
            entry[todo] = leave[whole[todo] - 1]
            leave[whole[todo]] = head(whole[todo], entry[todo])
            todo = np.flatnonzero(entry != leave[whole - 1])
        rest = np.flatnonzero((first > 0) & (first < size))
        head(rest, leave[rest - 1])
        return out.T.reshape(-1)[:len(data)]

    def _window(self, parts: list[str]) -> np.ndarray:
        """Token counts of parts, none of them empty."""
        text = "".join(parts)
        chars = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        data = np.frombuffer(text.encode(), np.uint8).astype(np.int64)
        lens = np.fromiter(map(len, parts), np.int64, len(parts))
        begins = np.zeros(len(chars), bool)
        begins[np.cumsum(lens) - lens] = True
        width = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
        offset = np.cumsum(width) - width
        reset = np.zeros(len(data), bool)
        reset[1:] = ~self.vocab.adjacent[data[:-1] << 8 | data[1:]]
        reset[offset[self.split.word_starts(chars, begins)]] = True
        got = np.add.reduceat(self.changes(data, reset).astype(np.int64), offset[begins])
        if len(self.machine.entries) > self.machine.max_states:
            self.machine.clear()
        return got

    def counts(self, texts: list[str]) -> list[int]:
        parts, owner, out = [], [], np.zeros(len(texts), np.int64)
        for k, t in enumerate(texts):
            for special, p in self.split.parts(t):
                if special:
                    out[k] += 1
                else:
                    parts.append(p)
                    owner.append(k)
        for lo, hi in groups_of(list(map(len, parts)), self.window):
            np.add.at(out, owner[lo:hi], self._window(parts[lo:hi]))
        return out.tolist()


def counter(path: str) -> Counter:
    return per_worker(("counter", path), lambda: Counter(path))


def token_counts(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes (UTF-8), n_tokens, without added special tokens."""
    path = tokenizer or default_tokenizer()
    rows = docs.select(F.col(id_col).cast("long").alias("d"), text_col(text).alias("t"))

    def run(batches):
        for b in batches:
            for part in text_slices(b, 1):
                texts = part.column(1).to_pylist()
                yield {"doc_id": part.column(0).to_pylist(), "n_bytes": [len(t.encode()) for t in texts],
                       "n_tokens": counter(path).counts(texts)}

    return map_stream(rows, run, "doc_id long, n_bytes long, n_tokens long")
