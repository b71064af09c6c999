"""Byte-pair encoding by backtracking over longest matches, and table decoding.

A token sequence is the greedy-merge encoding of its bytes exactly if every
pair of neighbours is compatible: merging their bytes by rank would never join
across the boundary. So the encoder walks a pre-token left to right, takes the
longest vocabulary match that Aho-Corasick found there, and keeps it if it is
compatible with the token before; otherwise it tries the next shorter token of
the same start, and steps back one token when none is left. A bit per byte
position remembers starts already proved hopeless, which bounds the walk by
the text length times the longest token. Compatibility is a property of two
ids alone and is kept in a table that fills as pairs occur.

Decoding gathers bytes from one flat table by (offset, length) of each id.

Pre-tokens follow the vocabulary's published splitting pattern; distinct
chunks are encoded once per worker (see ``wordpieces``). The vocabulary file
must be of the byte-level kind with one merge for each token of two or more
bytes.

Scale: map-only, no shuffle, bounded caches; very long pre-tokens are linear.

Edge cases: null and empty texts have no ids and decode to the empty string; a
special token's string inside a text is that one id; repeated rows repeat;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from brisa.llm import store
from brisa.llm.wordpieces import TextEncoder, worker_encoder

SCHEMA = "doc_id long, n_tokens long, ids binary, decoded string"
DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

# Fixed value: the published splitting pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PAIRS_KEPT = 500_000
CHUNKS_KEPT = 500_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files: printable Latin-1
    characters stand for themselves, the other bytes for 256, 257, ... in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Token bytes, merge ranks and halves, numbered by rank internally.

    Internal numbers: 0-255 for bytes, then merges in order of rank. A token
    with a smaller number is therefore always joined earlier.
    """

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        text: list[bytes] = [bytes([b]) for b in range(256)]
        number = {t: i for i, t in enumerate(text)}
        self.halves: list[tuple[int, int]] = [(b, b) for b in range(256)]
        self.joined: dict[tuple[int, int], int] = {}
        for merge in spec["model"]["merges"]:
            left, right = (bytes(alphabet[c] for c in part) for part in (merge.split(" ") if isinstance(merge, str) else merge))
            pair = (number[left], number[right])
            whole = left + right
            if whole in number:
                raise ValueError("two merges make one token")
            number[whole] = self.joined[pair] = len(text)
            self.halves.append(pair)
            text.append(whole)
        self.out = [0] * len(text)
        for token, i in ids.items():
            raw = bytes(alphabet[c] for c in token)
            if raw in number:
                self.out[number[raw]] = i
        self.text, self.number = text, number
        self.automaton = ahocorasick.Automaton()
        for raw, i in number.items():
            self.automaton.add_word(raw.decode("latin-1"), (len(raw), i))
        self.automaton.make_automaton()
        # The longest proper prefix of each token that is a token too.
        self.shorter = [self._shorter(t) for t in text]
        self._fits: dict[tuple[int, int], bool] = {}
        # Decoding: flat bytes and offsets by public id.
        size = max([*ids.values(), *self.special.values()]) + 1
        by_id = [b""] * size
        for i, raw in zip(self.out, text, strict=True):
            by_id[i] = raw
        for s, i in self.special.items():
            by_id[i] = s.encode()
        self.size = size
        self.lengths = np.array([len(x) for x in by_id], dtype=np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(by_id), dtype=np.uint8)

    def _shorter(self, raw: bytes) -> int:
        for n in range(len(raw) - 1, 0, -1):
            if raw[:n] in self.number:
                return self.number[raw[:n]]
        return -1

    def compatible(self, left: int, right: int) -> bool:
        """Whether greedy merging keeps the boundary between two tokens.

        Undo both tokens' last merges, newest first. At each step the facing
        parts could join by some merge; if that merge ranks before the one that
        was just undone on either side, it would have happened and swallowed
        the boundary.
        """
        key = (left, right)
        known = self._fits.get(key)
        if known is not None:
            return known
        if len(self._fits) >= PAIRS_KEPT:
            self._fits.clear()
        a, b, answer = left, right, True
        # Joins that rank at or after `limit` come too late; of two equal ranks the left one is first.
        limit = len(self.text) + 1
        while True:
            join = self.joined.get((a, b))
            if join is not None and join < limit:
                answer = False
                break
            if a < 256 and b < 256:
                break
            if a > b:
                limit = a
                a = self.halves[a][1]
            else:
                limit = b + 1
                b = self.halves[b][0]
        self._fits[key] = answer
        return answer

    def encode_pretoken(self, raw: bytes) -> list[int]:
        """Public ids of one pre-token."""
        whole = self.number.get(raw)
        if whole is not None and self._reachable(whole):
            return [self.out[whole]]
        n = len(raw)
        longest = [0] * n
        for end, (size, i) in self.automaton.iter(raw.decode("latin-1")):
            longest[end - size + 1] = i  # ends come in order, so the last one is the longest
        text, shorter, compatible = self.text, self.shorter, self.compatible
        hopeless = bytearray(n + 1)
        tokens: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            end = at + len(text[token])
            if not hopeless[end] and (not tokens or compatible(tokens[-1], token)) and (tokens or self._reachable(token)):
                tokens.append(token)
                at = end
                token = longest[at] if at < n else -1
                continue
            while shorter[token] < 0:
                # Nothing fits at this start: it is hopeless; step back one token.
                hopeless[at] = 1
                token = tokens.pop()
                at -= len(text[token])
            token = shorter[token]
        return [self.out[t] for t in tokens]

    def _reachable(self, token: int) -> bool:
        """Whether the token's own bytes encode to it: both halves must be compatible up to its own merge."""
        if token < 256:
            return True
        a, b = self.halves[token]
        if not (self._reachable(a) and self._reachable(b)):
            return False
        limit = token
        while not (a < 256 and b < 256):
            if a > b:
                limit = min(limit, a)
                a = self.halves[a][1]
            else:
                limit = min(limit, b + 1)
                b = self.halves[b][0]
            join = self.joined.get((a, b))
            if join is not None and join < limit:
                return False
        return True

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of an id sequence through the offset table."""
        if not len(ids):
            return b""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        index = np.arange(int(ends[-1])) + np.repeat(self.offsets[ids] - (ends - lengths), lengths)
        return self.flat[index].tobytes()


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def backtracking_encoder(path: str) -> TextEncoder:
    """A :class:`TextEncoder` that uses this module's encoder."""
    import regex

    v = vocabulary(path)
    split = regex.compile(PATTERN)
    kept: dict[str, list[int]] = {}

    def chunk(text: str) -> list[int]:
        out: list[int] = []
        for piece in split.findall(text):
            ids = kept.get(piece)
            if ids is None:
                ids = v.encode_pretoken(piece.encode())
                if len(piece) <= 32:
                    if len(kept) >= 100_000:
                        kept.clear()
                    kept[piece] = ids
            out += ids
        return out

    return TextEncoder(chunk, True, v.special, v.size, CHUNKS_KEPT)


def encode_decode(
    docs: DataFrame, path: str, digests: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Ids (packed little-endian uint32) and the decoded text of every row.

    With ``digests`` the ids and texts leave as lowercase-hex SHA-256 (of decimal
    ids joined by commas, and of the decoded UTF-8) instead of whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        encoder = worker_encoder(backtracking_encoder, path)
        decimal = [str(i) for i in range(v.size)]
        for batch in batches:
            counts, ids_out, texts = [], [], []
            for text in batch.column(1):
                ids = encoder.ids(text.as_py())
                raw = v.decode(ids)
                counts.append(len(ids))
                if digests:
                    ids_out.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids.tolist())).encode()).hexdigest())
                    texts.append(hashlib.sha256(raw.decode("utf-8", "replace").encode()).hexdigest())
                else:
                    ids_out.append(ids.astype("<u4").tobytes())
                    texts.append(raw.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(ids_out, pa.string() if digests else pa.binary()),
                    pa.array(texts, pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256" if digests else "ids", "decoded_sha256" if digests else "decoded"],
            )

    return store.documents(docs, id_col, text_col).mapInArrow(run, DIGEST_SCHEMA if digests else SCHEMA)
