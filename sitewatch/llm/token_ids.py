"""Byte-level BPE encoding inside tasks: batches by bytes, cuts at safe boundaries.

A cut before a single space between two characters that are not white space never
lies inside a pre-token, so the pieces' ids joined are the whole text's ids. Each
worker remembers a bounded number of words (with the space before them) and their
ids; each group of texts looks every different word up once. A word met for the first
time goes to the library: its BPE model directly where all its characters are ones
whose class is beyond doubt (ASCII, Latin and Cyrillic letters), which saves the
library's costly splitting, else its whole encoder. A text with white space beside a
space is cut only at the safe places left and encoded by the library's whole encoder.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

IDS = np.dtype("<u4")     # the type of ids as bytes
GROUP_BYTES = 1 << 18     # text given to the library in one call
GROUP_TEXT = 4 << 20      # text whose words are told apart at once
MEMORY_WORDS = 200_000    # words of a generation remembered per worker and mode
SAFE = re.compile(r"(?<=\S)(?= \S)")

# Letters beyond doubt: ASCII, Latin-1, Latin Extended-A and -B, Cyrillic.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u0481\u048a-\u052f"
PLAIN = re.compile(f"[\t\n!-~{_LETTERS}]+")
# Fixed value: the split of byte-level BPE, for plain characters.
SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+"
                   rf"| ?[^\s0-9{_LETTERS}]+|\s+(?!\S)|\s+")


def byte_alphabet() -> dict[int, str]:
    """Byte -> its character in byte-level vocabularies: printable Latin-1 bytes stand
    for themselves, the others for code points from 256 on, in order."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


_ALPHABET = byte_alphabet()


def _strings(texts: pa.Array) -> list[str]:
    """Python strings by way of an object array, several times faster than one by one."""
    return texts.to_numpy(zero_copy_only=False).tolist()


class Unsafe(Exception):
    """A word with white space at an end: its text can't be cut beside it."""


class Words(dict):
    """word -> value of the word with a space before it, worked out when first met.

    At most two generations of MEMORY_WORDS words are held: when one is full it
    becomes the older one, from which words still in use are taken over.
    """

    def __init__(self, encoder: "Encoder"):
        super().__init__()
        self.encoder = encoder
        self.older: dict = {}
        self.parts: dict = {}

    def _keep(self, word: str, value):
        if len(self) >= MEMORY_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = value
        return value

    def _part(self, part: str):
        """Value of one pre-token of plain characters."""
        text = part.encode().decode("latin-1").translate(_ALPHABET)
        tokens = self.encoder.model.tokenize(text)
        return self.encoder.value([t.id for t in tokens]) if self.encoder.ids else len(tokens)

    def _inner(self, part: str):
        """Value of a pre-token without a space before it: mostly punctuation."""
        value = self.parts.get(part)
        if value is None:
            if len(self.parts) >= MEMORY_WORDS:
                self.parts.clear()
            value = self.parts[part] = self._part(part)
        return value

    def _letters(self, word: str):
        """Value of a word of plain letters alone."""
        found = self.get(word)
        if found is None:
            found = self.older.get(word)
            found = self._keep(word, self._part(" " + word) if found is None else found)
        return found

    def __missing__(self, word: str):
        found = self.older.get(word)
        if found is not None:
            return self._keep(word, found)
        if not word or word[0].isspace() or word[-1].isspace():
            raise Unsafe
        enc = self.encoder
        plain = word.isascii() and word.isprintable() or PLAIN.fullmatch(word) is not None
        if plain and word.isalpha() and enc.letters_are_safe:
            return self._letters(word)
        if plain and not any(t in word for t in enc.specials):
            core, last = word[:-1], word[-1]
            if last in ",." and core.isalpha() and enc.letters_are_safe:
                found = enc.join((self._letters(core), self._inner(last)))
            else:
                first, *rest = SPLIT.findall(" " + word)
                head = first[1:]
                value = self._letters(head) if head.isalpha() and enc.letters_are_safe \
                    else self._part(first)
                found = enc.join([value, *map(self._inner, rest)])
        else:
            found = enc.whole([" " + word])[0]
        return self._keep(word, found)


class Encoder:
    """``ids=True`` yields each text's ids as bytes, else only their number."""

    def __init__(self, path: str, ids: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.ids = ids
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        self.specials = [t["content"] for t in added]
        self.letters_are_safe = not any(t.isalpha() for t in self.specials)
        # the cuts and the split above hold for plain byte-level BPE only
        self.by_words = (
            kind.get("type") == "ByteLevel" and kind.get("use_regex", True)
            and not kind.get("add_prefix_space") and not spec.get("normalizer")
            and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word")
                        or " " in t["content"] for t in added))
        self.words = Words(self)

    def value(self, ids):
        return pack(f"<{len(ids)}I", *ids) if self.ids else len(ids)

    def join(self, values):
        return b"".join(values) if self.ids else sum(values)

    def whole(self, texts: list[str]) -> list:
        """By the library's whole encoder."""
        return [self.value(e.ids) for e in
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def direct(self, text: str):
        """A text in safe pieces of about GROUP_BYTES, each encoded by the library."""
        pieces, parts, size = [], [], 0
        for part in (SAFE.split(text) if self.by_words else [text]):
            parts.append(part)
            size += len(part)
            if size >= GROUP_BYTES:
                pieces.append("".join(parts))
                parts, size = [], 0
        pieces.append("".join(parts))
        return self.join(self.whole(pieces))

    def _by_words(self, texts: pa.Array):
        """(ids of all texts in a row, tokens per text, texts that can't be cut safely).

        Without ``ids`` the first is None. An unsafe text counts as what its safe words
        give; the caller does it over.
        """
        lists = pc.split_pattern(texts, " ")
        bounds = lists.offsets.to_numpy().astype(np.int64)
        starts, flat = bounds[:-1], lists.flatten()
        # what stands before the first space has none before it
        head_words = _strings(flat.take(pa.array(starts)))
        heads = self.whole(head_words)
        coded = flat.dictionary_encode()
        codes = coded.indices.to_numpy()
        get = self.words.__getitem__
        values, bad = [], []
        for i, word in enumerate(_strings(coded.dictionary)):
            try:
                values.append(get(word))
            except Unsafe:
                values.append(self.value([]))
                bad.append(i)
        n = len(values)
        codes = codes.astype(np.int64)
        unsafe = np.zeros(n + len(heads), dtype=bool)
        unsafe[bad] = True
        for i, word in enumerate(head_words):
            alone = bounds[i + 1] - bounds[i] == 1
            unsafe[n + i] = not alone and (not word or word[-1].isspace())
        codes[starts] = n + np.arange(len(heads))
        values += heads
        if self.ids:
            sizes = np.fromiter(map(len, values), np.int64, len(values)) // IDS.itemsize
        else:
            sizes = np.array(values, dtype=np.int64)
        lengths = sizes[codes]
        counts = np.add.reduceat(lengths, starts)
        odd = np.flatnonzero(np.logical_or.reduceat(unsafe[codes], starts))
        if not self.ids:
            return None, counts, odd
        pool = np.frombuffer(b"".join(values), dtype=IDS)
        begin = np.cumsum(sizes) - sizes
        before = np.cumsum(lengths) - lengths
        place = np.repeat(begin[codes] - before, lengths) + np.arange(lengths.sum())
        return pool[place], counts, odd

    def encode(self, texts) -> list:
        """One value per text: its number of tokens, or the bytes of its ids."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        out: list = []
        for group in by_bytes(texts):
            if not self.by_words:
                out += [self.direct(t) for t in group.to_pylist()]
                continue
            ids, counts, odd = self._by_words(group)
            if self.ids:
                raw, ends = ids.tobytes(), IDS.itemsize * np.cumsum(counts)
                found = [raw[e - IDS.itemsize * n:e] for e, n in zip(ends.tolist(), counts.tolist())]
            else:
                found = counts.tolist()
            for i in odd.tolist():
                found[i] = self.direct(group[i].as_py())
            out += found
        pa.default_memory_pool().release_unused()
        return out


@lru_cache(maxsize=4)
def encoder(path: str, ids: bool) -> Encoder:
    return Encoder(path, ids)


def by_bytes(texts: pa.Array, limit: int = GROUP_TEXT):
    """Slices of ``texts`` (no NULLs) of about ``limit`` bytes, one text at least."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield texts.slice(start, stop - start)
        start = stop
