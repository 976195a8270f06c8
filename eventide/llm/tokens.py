"""Token ids by a tokenizer file of the ``tokenizers`` library, with a word cache.

A byte-level BPE splits a text into words and encodes each alone.  The words
of many texts are found at once, by character classes in numpy arrays, and
numbered by Arrow; every distinct word is encoded by the library's model once
while the cache holds it, and the ids of the texts are gathered from the
distinct words' ids.  Other kinds of tokenizers go through the whole library.

Special tokens' strings inside texts get the one id that the library gives
them by default; what lies between them is encoded alone.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from .common import per_worker

OTHER, LETTER, NUMBER, SPACE, UNKNOWN = 0, 1, 2, 3, 4
# White space as the splitter's pattern has it (the Unicode property).
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# The splitter starts a word here, whatever follows.
_CUT = re.compile(r"(?<=\S)[ \n]")
# No byte-level letter, so it parts words.
_PART = "\u0200"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def load(path: str):
    """The tokenizer with the library's defaults."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def cuttable(tok) -> bool:
    """True for byte-level tokenizers without a normaliser, the kind the cut is safe for."""
    pre = tok.pre_tokenizer
    plain = not any(t.normalized or t.lstrip or t.rstrip or t.single_word or " " in t.content
                    for t in tok.get_added_tokens_decoder().values())
    return (tok.normalizer is None and type(pre).__name__ == "ByteLevel" and plain
            and not pre.add_prefix_space and pre.use_regex)


def letter_of_byte() -> dict[int, str]:
    """The letter a byte-level vocabulary writes for every byte: itself if printable, else numbered from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def char_classes() -> np.ndarray:
    """Letter, number, white space or other for every code point; unknown where Python's tables have none."""
    kind = {"Cn": UNKNOWN, "L": LETTER, "N": NUMBER}
    of = lambda c: kind.get(c, kind.get(c[0], OTHER))       # noqa: E731
    out = np.fromiter((of(unicodedata.category(chr(c))) for c in range(0x110000)), np.uint8, 0x110000)
    out[_WHITE] = SPACE
    return out


def library_class(splitter, char: str) -> int:
    """The class that the library's own splitter gives a character newer than Python's tables."""
    spans = [span for _, span in splitter.pre_tokenize_str("a" + char + "1")]
    return LETTER if (0, 2) in spans else NUMBER if (1, 3) in spans else OTHER


class Splitter:
    """Where a byte-level splitter starts words, for many texts at once."""

    def __init__(self, splitter, special: Iterable[str], window: int):
        self.splitter, self.classes, self.window = splitter, char_classes(), window
        longest = sorted(special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None

    def parts(self, text: str) -> Iterator[tuple[bool, str]]:
        """Pieces of a text that are encoded alone: special tokens (True), and windows of what lies between."""
        for k, piece in enumerate(self.special.split(text) if self.special else [text]):
            lo = 0
            while k % 2 == 0 and len(piece) - lo > self.window:
                cut = _CUT.search(piece, lo + self.window)
                if cut is None:
                    break
                yield False, piece[lo:cut.start()]
                lo = cut.start()
            if lo < len(piece):
                yield k % 2 == 1, piece[lo:]

    def word_starts(self, chars: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """True where the splitter starts a word; ``begins`` is true at the first character of a part."""
        kind, n = self.classes[chars], len(chars)
        if (kind == UNKNOWN).any():
            for c in np.unique(chars[kind == UNKNOWN]).tolist():
                self.classes[c] = library_class(self.splitter, chr(c))
            kind = self.classes[chars]
        before, before_char = np.roll(kind, 1), np.roll(chars, 1)
        goes_on = np.append(~begins[1:], False)                     # the part has a next character
        white, was_white = kind == SPACE, before == SPACE
        next_solid = np.append(kind[1:] != SPACE, False) & goes_on
        start = np.where(was_white, np.where(white, next_solid, before_char != 32), white | (kind != before)) | begins
        # 's 't 'm 'd 're 've 'll where the apostrophe starts a word
        at = np.flatnonzero((chars == 39) & start & (begins | (before_char != 32)) & goes_on)
        if len(at):
            one = chars[at + 1]
            pair = np.where((at + 2 < n) & goes_on[np.minimum(at + 1, n - 1)], chars[np.minimum(at + 2, n - 1)], 0)
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = ((one == ord("r")) & (pair == ord("e"))) | ((one == ord("v")) & (pair == ord("e"))) | (
                (one == ord("l")) & (pair == ord("l")))
            at, size = at[short | long], np.where(short, 2, 3)[short | long]
            start[at + 1] = False
            after = at + size
            start[after[after < n]] = True
        return start


def byte_offsets(chars: np.ndarray) -> np.ndarray:
    """Where each character starts in UTF-8, and the end."""
    width = 1 + (chars >= 0x80).view(np.int8) + (chars >= 0x800) + (chars >= 0x10000)
    return np.concatenate([[0], np.cumsum(width, dtype=np.int64)])


class Encoder:
    """``encode(texts)`` -> one ``bytes`` of little-endian unsigned 32-bit ids per text.

    The cache has two generations of at most ``max_bytes`` / 2 each (words,
    ids and what Python needs to hold them): words in use move to the young
    one, the old one is dropped when the young one is full.  A word that was
    dropped is encoded again, with the same ids.
    """

    ENTRY = 180        # bytes of a cache entry beside its bytes and ids
    WINDOW = 1 << 20   # characters that are looked at together, but for longer stretches without a cut

    def __init__(self, path: str, max_bytes: int = 256 << 20):
        self.tok = load(path)
        self.cut = cuttable(self.tok)
        self.max_bytes, self.used = max_bytes, 0
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.model, self.letters = self.tok.model, str.maketrans(letter_of_byte())
        self.special = {t.content.encode(): array("I", [i]).tobytes()
                        for i, t in self.tok.get_added_tokens_decoder().items()}
        self.split = Splitter(self.tok.pre_tokenizer, [w.decode() for w in self.special], self.WINDOW)

    def _raw(self, texts: list[str], step: int = 2048) -> list[bytes]:
        # in slices: the library's results are far larger than the ids
        return [array("I", e.ids).tobytes() for lo in range(0, len(texts), step)
                for e in self.tok.encode_batch_fast(texts[lo:lo + step], add_special_tokens=False)]

    def _hold(self, words: list[bytes], ids: list[bytes]) -> None:
        self.young.update(zip(words, ids))
        self.used += self.ENTRY * len(words) + sum(map(len, words)) + sum(map(len, ids))

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words."""
        got = list(map(self.young.get, words))
        lost = [k for k, ids in enumerate(got) if ids is None]
        if lost:
            wanted = [words[k] for k in lost]
            ids = list(map(self.old.get, wanted))
            new = [k for k, x in enumerate(ids) if x is None]
            letters = _PART.join([wanted[k].decode("latin-1") for k in new]).translate(self.letters).split(_PART)
            special, tokenize = self.special, self.model.tokenize
            for k, w in zip(new, letters):
                ids[k] = special.get(wanted[k]) or array("I", [t.id for t in tokenize(w)]).tobytes()
            self._hold(wanted, ids)
            for k, x in zip(lost, ids):
                got[k] = x
        return got

    def _window(self, parts: list[tuple[bool, str]]) -> list[bytes]:
        """The ids of parts, none of them empty."""
        text = "".join([p for _, p in parts])
        chars = np.frombuffer(text.encode("utf-32-le"), np.uint32).view(np.int32)
        sizes = np.fromiter((len(p) for _, p in parts), np.int64, len(parts))
        ends = np.cumsum(sizes)
        begins = np.zeros(len(chars), bool)
        begins[ends - sizes] = True
        starts = self.split.word_starts(chars, begins)
        for k in np.flatnonzero(np.fromiter((s for s, _ in parts), bool, len(parts))).tolist():
            starts[ends[k] - sizes[k] + 1:ends[k]] = False        # a special string is one word
        at = np.flatnonzero(starts)
        offsets = byte_offsets(chars)[np.append(at, len(chars))]
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [
            None, pa.py_buffer(offsets), pa.py_buffer(text.encode())]).dictionary_encode()
        _, bounds, data = words.dictionary.buffers()
        bounds, data = np.frombuffer(bounds, np.int64, len(words.dictionary) + 1).tolist(), data.to_pybytes()
        ids = self._ids([data[lo:hi] for lo, hi in zip(bounds, bounds[1:])])
        flat, lens = np.frombuffer(b"".join(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        which = words.indices.to_numpy()
        per = lens[which]
        done = np.cumsum(per)
        out = flat[np.repeat((np.cumsum(lens) - lens)[which] - (done - per), per) + np.arange(done[-1])]
        cuts = done[np.searchsorted(at, ends) - 1].tolist()
        raw = memoryview(out.tobytes())
        return [bytes(raw[4 * lo:4 * hi]) for lo, hi in zip([0, *cuts], cuts)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.cut:
            return self._raw(texts)
        parts, owner = [], []
        for k, t in enumerate(texts):
            for p in self.split.parts(t):
                parts.append(p)
                owner.append(k)
        out: list[list[bytes]] = [[] for _ in texts]
        for lo, hi in groups_of([len(p) for _, p in parts], self.WINDOW):
            for k, ids in zip(owner[lo:hi], self._window(parts[lo:hi])):
                out[k].append(ids)
            if 2 * self.used > self.max_bytes:
                self.young, self.old, self.used = {}, self.young, 0
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]


def encoder(path: str, max_bytes: int = 256 << 20) -> Encoder:
    return per_worker(("encoder", path, max_bytes), lambda: Encoder(path, max_bytes))


def groups_of(sizes: list[int], most: int):
    """(lo, hi) slices whose sizes add up to ``most`` or that hold one item."""
    lo = total = 0
    for i, s in enumerate(sizes):
        if i > lo and total + s > most:
            yield lo, i
            lo, total = i, 0
        total += s
    if lo < len(sizes):
        yield lo, len(sizes)


def text_slices(batch, column: int, most: int = 1_000_000):
    """Slices of a record batch with about ``most`` bytes of text each, so that few texts are Python objects at once."""
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for lo, hi in groups_of(sizes, most):
        yield batch.slice(lo, hi - lo)
