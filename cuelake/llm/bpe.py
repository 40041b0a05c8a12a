"""Byte-level BPE by traversing a prefix tree of distinct words.

In BPE the tokens of a prefix are those of a shorter prefix and one more, its
last token. A token t is the last one of prefix p exactly if p ends with t and
the pair (last token of p without t, t) stays as it is when the merges run over
those two alone. So one state for each prefix, its last token, gives every
encoding: the distinct words are put in a tree, the states are carried down it
depth first, and a prefix that many words share is worked out once. The tree is
held as sorted words with the lengths of their common prefixes: going through
them in order, and cutting the stack of states back to the common prefix, is the
depth-first walk.

Results are those of the tokenizers library, added tokens in texts included.
Null texts count as empty; an empty text has no tokens. Repeated rows give
repeated results. Columns other than those named are not read.
"""

from __future__ import annotations

import functools
import gc
import hashlib
import json
import struct
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cuelake.llm import kernels as K

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

#: The public pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Distinct words from which on a task lets those go that it has not met for as many, and the longest that it keeps at all.
KEPT_WORDS, KEPT_LENGTH = 150_000, 64
#: Pairs of tokens of which a worker knows whether they stay.
KEPT_PAIRS = 500_000
#: Characters whose words are looked up together, and bytes of ids that are decoded together. Longer texts are encoded in portions of as many.
BATCH_CHARS, DECODED_AT_ONCE = 2 << 20, 1 << 18
#: Words at the end of a portion that what follows may still change: a contraction needs two ("'", "r" before "e").
UNSETTLED = 2
#: Bytes of a word from which on states are kept as 32-bit integers, which is slower and takes less.
LONG_WORD = 1 << 18

#: A character of each class (letter, number, space, other) that all Unicode versions agree on.
_STANDS_FOR = {"L": "é", "N": "²", "S": " ", "O": "§"}
_CLASSES = (("L", regex.compile(r"\p{L}")), ("N", regex.compile(r"\p{N}")), ("S", regex.compile(r"\s")))


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Encodes and decodes with the vocabulary, merges and added tokens of a tokenizers file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        self._split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.id_of = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items() if all(c in alphabet for c in token)}
        self.bytes_of = {i: token for token, i in self.id_of.items()}
        self._rank: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = (bytes(alphabet[c] for c in x) for x in (left, right))
            self._rank[self.id_of[a], self.id_of[b]] = (rank, self.id_of[a + b])
        self._parts = {whole: (*pair, rank) for pair, (rank, whole) in self._rank.items()}
        self._spines: dict[int, tuple[list, list]] = {}
        self._suffixes()
        added = spec.get("added_tokens") or []
        if any(x.get(flag) for x in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens that strip or need whole words are not supported")
        self._added = {x["content"]: x["id"] for x in added}
        for text, i in self._added.items():
            self.bytes_of.setdefault(i, text.encode())
        self._added_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self._added, key=len, reverse=True))) + ")") if added else None
        self._pattern = regex.compile(PATTERN)
        self._odd: dict[int, str] = {}
        self._seen: set[str] = set(map(chr, range(128)))
        self._stays: dict[int, bool] = {}
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        # the bytes of all tokens one after the other, by id
        self._length = np.zeros(max(self.bytes_of, default=0) + 1, np.int64)
        for i, token in self.bytes_of.items():
            self._length[i] = len(token)
        self._start = np.concatenate([[0], np.cumsum(self._length)[:-1]])
        self._raw = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(len(self._length))), np.uint8)

    def _suffixes(self) -> None:
        """An automaton over the reversed question "which tokens end here": `_next[state][byte]` is the state after a byte, `_ending[state]` the (token, length) pairs that end there, longest first."""
        self._next: list[dict[int, int]] = [{}]
        own: list[int | None] = [None]
        depth = [0]
        for token, i in self.id_of.items():
            state = 0
            for byte in token:
                if (after := self._next[state].get(byte)) is None:
                    after = self._next[state][byte] = len(own)
                    self._next.append({})
                    own.append(None)
                    depth.append(depth[state] + 1)
                state = after
            own[state] = i
        self._fallback = [0] * len(own)
        self._ending: list[tuple] = [()] * len(own)
        queue = [0]
        for state in queue:
            for byte, after in self._next[state].items():
                if state:
                    self._fallback[after] = self._step(self._fallback[state], byte)
                shorter = self._ending[self._fallback[after]]
                self._ending[after] = ((own[after], depth[after]), *shorter) if own[after] is not None else shorter
                queue.append(after)
        self._steps: dict[int, int] = {}

    def _step(self, state: int, byte: int) -> int:
        while (after := self._next[state].get(byte)) is None:
            if not state:
                return 0
            state = self._fallback[state]
        return after

    def _spine(self, token: int) -> tuple[list, list]:
        """The tokens that stand at the right and at the left edge of a token while its merges run, each with the rank of the merge that replaces it."""
        if (known := self._spines.get(token)) is None:
            right, left = [], []
            for side, out in ((1, right), (0, left)):
                at, until = token, float("inf")
                while True:
                    out.append((at, until))
                    if at not in self._parts:
                        break
                    until = self._parts[at][2]
                    at = self._parts[at][side]
                out.reverse()
            known = self._spines[token] = (right, left)
        return known

    def stays(self, left: int, right: int) -> bool:
        """Whether BPE over the bytes of both tokens gives just these two: no merge across the border comes before the next merge at either side of it. Of equal ranks the leftmost comes first."""
        a, b = self._spine(left)[0], self._spine(right)[1]
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = a[i], b[j]
            if (across := self._rank.get((x, y))) is not None and across[0] < x_until and across[0] <= y_until:
                return False
            if x_until == y_until == float("inf"):
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def encode_words(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """(word, ids) for distinct words, in sorted order: the walk over their prefix tree."""
        words = sorted(words)
        long = max(map(len, words), default=0) >= LONG_WORD
        last, states, widths = (array("i", [x]) if long else [x] for x in (-1, 0, 0))
        before = b""
        steps, ending, known = self._steps, self._ending, self._stays
        if len(known) > KEPT_PAIRS:
            known.clear()
        for word in words:
            shared = _common(before, word)
            del last[shared + 1 :], states[shared + 1 :], widths[shared + 1 :]
            state = states[shared]
            for depth in range(shared, len(word)):
                key = state << 8 | word[depth]
                state = steps.get(key, -1)
                if state < 0:
                    state = steps[key] = self._step(key >> 8, key & 255)
                states.append(state)
                for token, width in ending[state]:
                    if width > depth:
                        break
                    pair = last[depth + 1 - width] << 32 | token
                    fits = known.get(pair)
                    if fits is None:
                        fits = known[pair] = self.stays(pair >> 32, token)
                    if fits:
                        break
                else:
                    raise ValueError("the vocabulary has a token that its merges do not make")
                last.append(token)
                widths.append(width)
            before, at, ids = word, len(word), []
            while at:
                ids.append(last[at])
                at -= widths[at]
            yield word, ids[::-1]

    def _class(self, c: str) -> str:
        """The class that the library gives a character: what it is split from."""
        if len(self._split(f"a{c}")) == 1:
            return "L"
        if len(self._split(f"1{c}")) == 1:
            return "N"
        return "O" if len(self._split(f"!{c}")) == 1 else "S"

    def _learn(self, text: str) -> None:
        """Unicode grows, and two libraries may know different versions of it: finds characters that the pattern would class otherwise."""
        for c in set(text) - self._seen:
            self._seen.add(c)
            mine = next((k for k, p in _CLASSES if p.match(c)), "O")
            if (theirs := self._class(c)) != mine:
                self._odd[ord(c)] = _STANDS_FOR[theirs]

    def split(self, text: str) -> list[str]:
        if not text.isascii():
            self._learn(text)
            if self._odd and (plain := text.translate(self._odd)) != text:
                return [text[m.start() : m.end()] for m in self._pattern.finditer(plain)]
        return self._pattern.findall(text)

    def pieces(self, text: str) -> list[str]:
        """The words of a text; added tokens stand for themselves."""
        if self._added_pattern is None or not self._added_pattern.search(text):
            return self.split(text)
        out: list[str] = []
        for at, part in enumerate(self._added_pattern.split(text)):
            out += [part] if at % 2 else self.split(part)
        return out

    def portions(self, text: str) -> Iterator[list[str]]:
        """The words of a text, BATCH_CHARS or so of it at a time.

        A portion ends between two words of its characters, the first not of spaces, so that
        these words don't depend on what follows, and never in an added token.
        A word that fills a portion makes it twice as long.
        """
        at, width = 0, BATCH_CHARS
        while len(text) - at > width:
            words = self.pieces(text[at : at + width])
            k = max(0, len(words) - UNSETTLED)
            end = at + sum(map(len, words[:k]))
            while k > 0 and (words[k - 1][-1].isspace() or self._inside_added(text, end)):
                k -= 1
                end -= len(words[k])
            if k > 0:
                yield words[:k]
                at, width = end, BATCH_CHARS
            else:
                width *= 2
        yield self.pieces(text[at:])

    def _inside_added(self, text: str, at: int) -> bool:
        """Whether an added token stands across a place of the text."""
        return any(text.find(x, max(0, at - len(x) + 1), at + len(x) - 1) >= 0 for x in self._added)

    def encode_long(self, text: str) -> tuple[int, bytes, bytes]:
        """What `encode_texts` gives for one text, worked out portion by portion."""
        ids, raw = bytearray(), bytearray()
        for words in self.portions(text):
            for _, part, decoded in self._encode_split([words]):
                ids += part
                raw += decoded
        return len(ids) // 4, bytes(ids), bytes(raw)

    def encode_texts(self, texts: list[str]) -> Iterator[tuple[int, bytes, bytes]]:
        """(number of ids, ids as little-endian 32-bit integers, decoded bytes) of each text."""
        return self._encode_split([self.pieces(t) for t in texts])

    def _encode_split(self, split: list[list[str]]) -> Iterator[tuple[int, bytes, bytes]]:
        if len(self._known) > KEPT_WORDS:  # words that were met since the last time stay a while longer
            self._older, self._known = self._known, {}
        known, older = self._known, self._older
        for text, i in self._added.items():
            known[text] = struct.pack("<I", i)
        new, passing = {}, []
        for word in set().union(*split).difference(known):
            if (ids := older.get(word)) is not None:
                known[word] = ids
            else:
                new[word.encode()] = word
                if len(word) > KEPT_LENGTH:
                    passing.append(word)
        for word, ids in self.encode_words(new):
            known[new[word]] = struct.pack(f"<{len(ids)}I", *ids)
        encoded = [b"".join(map(known.__getitem__, words)) for words in split]
        for word in passing:
            del known[word]
        at = 0
        while at < len(encoded):
            upto, size = at, 0
            while upto < len(encoded) and (size < DECODED_AT_ONCE or upto == at):
                size += len(encoded[upto])
                upto += 1
            for ids, raw in zip(encoded[at:upto], self.decode(encoded[at:upto]), strict=True):
                yield len(ids) // 4, ids, raw
            at = upto

    def decode(self, encoded: list[bytes]) -> list[bytes]:
        """The bytes of the tokens of each text's ids."""
        ids = np.frombuffer(b"".join(encoded), "<u4")
        length = self._length[ids]
        raw = self._raw[K.ranges(self._start[ids], length)]
        ends = np.concatenate([[0], np.cumsum(length)])[np.cumsum([0, *(len(e) // 4 for e in encoded)])].tolist()
        return [raw[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return n - ((int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])).bit_length() + 7) // 8


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary in a worker, kept through a task."""
    return Encoder(path)


def decoded_text(raw: bytes) -> str:
    """What decoding gives for the bytes of the tokens."""
    return raw.decode("utf-8", errors="replace")


def encode_documents(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row for each document: (doc_id, n_tokens, ids binary, decoded string); ids are little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, made in _encoded(batches, path):
            yield pa.RecordBatch.from_arrays([keys, pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.binary()), pa.array([decoded_text(m[2]) for m in made], pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select(key, text).mapInArrow(K.releasing(run), "doc_id long, n_tokens long, ids binary, decoded string")


def encode_digests(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The same with digests of the ids and of the decoded text in their place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, made in _encoded(batches, path):
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array([m[0] for m in made], pa.int64()), pa.array([hashlib.sha256(m[1]).hexdigest() for m in made], pa.string()), pa.array([hashlib.sha256(decoded_text(m[2]).encode()).hexdigest() for m in made], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(key, text).mapInArrow(K.releasing(run), SCHEMA)


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.Array, list]]:
    own = encoder(path)
    gc.disable()  # millions of short strings and no cycles: collecting would only walk them again and again
    try:
        for batch in batches:
            keys, texts, at = batch.column(0).cast(pa.int64()), batch.column(1), 0
            while at < len(keys):
                part, size, upto, long = [], 0, at, None
                while upto < len(keys) and size < BATCH_CHARS and long is None:
                    text = texts[upto].as_py() or ""
                    if len(text) > BATCH_CHARS:
                        long = text
                    else:
                        part.append(text)
                        size += len(text)
                    upto += 1
                if part:
                    yield keys.slice(at, len(part)), list(own.encode_texts(part))
                if long is not None:
                    yield keys.slice(upto - 1, 1), [own.encode_long(long)]
                at = upto
    finally:
        encoder.cache_clear()  # so that an idle worker holds nothing; the next task takes half a second to read the vocabulary
        gc.enable()
