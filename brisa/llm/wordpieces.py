"""Whole-text tokenisation through a per-worker cache of space-separated chunks.

Both public vocabularies split a text into pre-tokens that never cross certain
spaces, so the ids of a text are the ids of its chunks in order. Each distinct
chunk is encoded once per worker and kept, as packed 16- or 32-bit ids, in a
bounded dictionary.

Lower-cased word vocabulary: white space is dropped before splitting, so any
space or newline is a boundary. Byte vocabulary: a single space belongs to the
word after it, so a boundary lies before each space that touches no other
white space; texts with other runs go through the vocabulary's own rule for
runs (all but the last character of a run form one token).
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

# White space as the vocabulary's own pattern knows it.
_WS = r"\t-\r \x85\xa0  -     　"
_RUNS = re.compile(rf"[{_WS}]+(?![^{_WS}])| ?[^{_WS}]+|[{_WS}]+")
_TOUCHING = re.compile(r"\s | \s")
_TAIL = re.compile(r"[a-zA-Z][.,]+\Z")
CACHE_WORDS = 1_000_000
# A kept chunk takes 150 to 200 bytes, so two generations of this size stay under 100 MB.
SMALL_CACHE_WORDS = 250_000
LONGEST_KEPT = 64


class _Cache(dict):
    """Chunk -> packed ids. Misses call ``encode``.

    When full it becomes the older generation, whose chunks come back when they
    occur again, and the generation before that goes: frequent chunks stay.
    """

    def __init__(self, encode: Callable[[str], bytes], most: int):
        super().__init__()
        self.encode, self.most, self.older = encode, most, {}

    def __missing__(self, chunk: str) -> bytes:
        packed = self.older.get(chunk)
        if packed is None:
            packed = self.encode(chunk)
        if len(chunk) <= LONGEST_KEPT:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[chunk] = packed
        return packed


class TextEncoder:
    """Ids of whole texts, equal to ``tokenizer.encode(text, add_special_tokens=False)``.

    ``encode_chunk`` gives the ids of one chunk; ``spaced`` says whether a space
    is part of the chunk after it (byte vocabulary) or dropped (word vocabulary);
    ``special`` lists strings that the vocabulary maps to one id wherever they
    occur, so texts are cut around them first. Each of two generations of the
    cache keeps up to ``most`` chunks.
    """

    def __init__(
        self,
        encode_chunk: Callable[[str], list[int]],
        spaced: bool,
        special: dict[str, int],
        size: int,
        most: int = CACHE_WORDS,
    ):
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self._chunk, self.spaced, self.special = encode_chunk, spaced, special
        self._any_special = re.compile("|".join(map(re.escape, special))) if special else None
        self._whole = _Cache(lambda c: self._pack(encode_chunk(c)), most)
        self._after_space = _Cache(lambda c: self._pack(encode_chunk(" " + c)), most)

    def _pack(self, ids) -> bytes:
        return np.asarray(ids, dtype=self.dtype).tobytes()

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.spaced:
            return b"".join(map(self._whole.__getitem__, filter(None, text.replace("\n", " ").split(" "))))
        if _TOUCHING.search(text):
            return b"".join(map(self._whole.__getitem__, _RUNS.findall(text)))
        first, *rest = text.split(" ")
        head = self._whole[first] if first else b""
        return head + b"".join(map(self._after_space.__getitem__, rest))

    def packed(self, text: str) -> bytes:
        """Little-endian ids of ``text`` in the encoder's own width."""
        if self._any_special is None or "<|" not in text:
            return self._plain(text)
        out, at = [], 0
        for m in self._any_special.finditer(text):
            out += [self._plain(text[at : m.start()]), self._pack([self.special[m.group()]])]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.packed(text), self.dtype)


def library_encoder(path: str, most: int = CACHE_WORDS) -> TextEncoder:
    """A :class:`TextEncoder` over the ``tokenizers`` library and a vocabulary file."""
    import json
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    model = tok.model
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    lower = spec["normalizer"] is not None
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    parts: dict[str, list[int]] = {}
    letters = re.compile(r"[a-z]+\Z" if lower else r" ?[a-zA-Z]+\Z")

    def piece(text: str) -> list[int]:
        # A run of plain letters is one pre-token: the model alone encodes it.
        if letters.match(text):
            return [t.id for t in model.tokenize(text if lower else text.replace(" ", "Ġ"))]
        return tok.encode(text, add_special_tokens=False).ids

    def kept(text: str) -> list[int]:
        ids = parts.get(text)
        if ids is None:
            if len(parts) >= most // 10:
                parts.clear()
            ids = parts[text] = piece(text)
        return ids

    def chunk(text: str) -> list[int]:
        if lower and text.isascii():
            text = text.lower()
        m = _TAIL.search(text)
        if m is None or "'" in text:
            return piece(text)
        cut = m.start() + 1
        return kept(text[:cut]) + kept(text[cut:])

    return TextEncoder(chunk, not lower, special, tok.get_vocab_size(), most)


def small_library_encoder(path: str) -> TextEncoder:
    """With a small cache: slower, for executors whose memory other stages fill."""
    return library_encoder(path, SMALL_CACHE_WORDS)


class RankEncoder:
    """Ids of whole texts under a byte-level vocabulary file, by the installed ``tiktoken`` library.

    The vocabulary's ids must grow with the order of its merges, so that they
    serve as ranks. Equal to the ``tokenizers`` library without special tokens
    added, at several times its speed and without a cache. With ``plain`` the
    strings of special tokens are ordinary text. Runs of white space too long
    for its pattern matcher are left to the ``tokenizers`` library.
    """

    def __init__(self, path: str, plain: bool = False):
        import json

        import public_tokenizers
        import tiktoken

        from brisa.llm.backtrack_bpe import byte_alphabet

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        raw = {t: bytes(alphabet[c] for c in t) for t in spec["model"]["vocab"] if t not in special}
        ids = spec["model"]["vocab"]
        merged = [ids["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError("ids of the vocabulary do not follow its merges")
        self.size = max([*ids.values(), *special.values()]) + 1
        self.tokens = [b""] * self.size
        for t, i in ids.items():
            self.tokens[i] = raw.get(t, t.encode())
        for t, i in special.items():
            self.tokens[i] = t.encode()
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        ranks = {b: ids[t] for t, b in raw.items()}
        self._path, self._plain, self._library = path, plain, None
        self._encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={} if plain else special)

    def ids(self, text: str) -> np.ndarray:
        try:
            return self._encoding.encode_to_numpy(text, allowed_special="all", disallowed_special=()).astype(self.dtype)
        except ValueError:
            return np.array(self._by_library(text), dtype=self.dtype)

    def _by_library(self, text: str) -> list[int]:
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._path)
            self._library.no_truncation()
            self._library.no_padding()
            self._library.encode_special_tokens = self._plain
        return self._library.encode(text, add_special_tokens=False).ids

    def packed(self, text: str) -> bytes:
        """Little-endian ids of ``text`` in the encoder's own width."""
        return self.ids(text).tobytes()


def plain_rank_encoder(path: str) -> RankEncoder:
    return RankEncoder(path, plain=True)


_ENCODERS: dict[tuple, TextEncoder | RankEncoder] = {}


def worker_encoder(make: Callable[[str], TextEncoder | RankEncoder], path: str) -> TextEncoder | RankEncoder:
    """One encoder per Python worker, vocabulary and kind."""
    key = (make.__module__, make.__qualname__, path)
    if key not in _ENCODERS:
        _ENCODERS[key] = make(path)
    return _ENCODERS[key]
