"""Token ids of text columns with public tokenizer files (never trained here).

A text is cut where the tokenizer's own pre-splitting pattern always cuts and
where the ids on the right do not depend on the left; every distinct piece is
encoded once and its ids are gathered.  The ids are those of encoding the whole
text; `tests/llm/test_tokens.py` compares both.  Texts that contain the string
of one of the tokenizer's added tokens are encoded whole.
"""

from __future__ import annotations

import functools
import json
import re
from array import array

import numpy as np
import pyarrow as pa

from .blocks import LOWER, Texts, byte_table, distinct, ragged, span_hashes

#: pieces kept per worker before the store is emptied; bounds its memory
STORE_LIMIT = 600_000
_LETTER = byte_table(bytes([*range(0x41, 0x5B), *range(0x61, 0x7B)]))
_ASCII = byte_table(bytes(range(0x80)))
_GRAPHIC = byte_table(bytes(range(0x21, 0x7F)))
_PUNCT = _GRAPHIC & ~_LETTER & ~byte_table(b"0123456789'")
#: second bytes of À-ÿ but × and ÷, behind 0xC3
_LATIN = byte_table(bytes(b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)))
_BREAK = byte_table(b"\t\n\v\f\r")
#: one run of letters that no normalisation changes but lower-casing
_PLAIN = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+\Z")


def _byte_characters() -> dict[int, str]:
    """Byte-level BPE's printable character for each byte: printable ones are themselves, the rest follow from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


def tokenizer_path(name: str) -> str:
    """A file path as it is, else the path of a public tokenizer of that name, on the machine that asks."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    def __init__(self, name: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        path = tokenizer_path(name)
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = json.dumps([spec.get("normalizer"), spec.get("pre_tokenizer")])
        self.lower = '"Lowercase"' in kinds
        level = '"ByteLevel"' in kinds and spec["model"]["type"] == "BPE" and '"add_prefix_space": false' in kinds
        byte_mode = level and spec.get("normalizer") is None and spec["pre_tokenizer"]["type"] == "ByteLevel" and spec["pre_tokenizer"].get("use_regex", True)
        word_mode = level and self.lower and r"\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+" in kinds and "\\\\s+" in kinds
        self.cuttable = byte_mode or word_mode
        self.drops_space = bool(word_mode)
        self.characters = str.maketrans({chr(b): c for b, c in _byte_characters().items()})
        self.added = [t["content"].encode() for t in spec.get("added_tokens", [])]
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.clear()

    def clear(self) -> None:
        self.slot: dict[int, int] = {}
        self.start, self.length, self.ids = array("q"), array("q"), array("I")

    def add(self, key: int, ids: list[int]) -> int:
        slot = self.slot[key] = len(self.start)
        self.start.append(len(self.ids))
        self.length.append(len(ids))
        self.ids.extend(ids)
        return slot

    def plain(self, piece: str) -> list[int]:
        """Ids of one run of letters."""
        if self.drops_space:
            piece = piece.lstrip(" ")
        return [t.id for t in self.tokenizer.model.tokenize(piece.encode().decode("latin-1").translate(self.characters))]

    def with_added(self, texts: Texts) -> np.ndarray:
        """Rows that contain the string of an added token, in any case of A-Z."""
        raw, rows = LOWER[texts.data].tobytes(), set()
        for token in {t.lower() for t in self.added if t}:
            at = raw.find(token)
            while at >= 0:
                rows.add(int(np.searchsorted(texts.off, at, "right")) - 1)
                at = raw.find(token, at + 1)
        return np.array(sorted(rows), np.int64)

    def whole(self, texts: list[bytes]) -> list[np.ndarray]:
        said = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in said]

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and the number of ids of each text."""
        if not self.cuttable:
            out = self.whole(texts.array.to_pylist())
            return np.concatenate(out or [np.zeros(0, np.uint32)]), np.array([len(ids) for ids in out], np.int64)
        ids, counts = self.pieces(texts)
        odd = self.with_added(texts)
        if not len(odd):
            return ids, counts
        rows = np.split(ids, np.cumsum(counts)[:-1])
        for i, own in zip(odd.tolist(), self.whole([texts.array[i].as_py() for i in odd.tolist()]), strict=True):
            rows[i] = own
        return np.concatenate(rows), np.array([len(x) for x in rows], np.int64)

    def pieces(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids as `encode` gives them, for texts without the string of an added token."""
        rows = len(texts)
        data, n = texts.data, len(texts.data)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(rows, np.int64)
        letter, plain = _LETTER[data], _ASCII[data]
        pair = np.flatnonzero((data[:-1] == 0xC3) & _LATIN[data[1:]])  # a letter of two bytes
        letter[pair] = letter[pair + 1] = True
        graphic = _GRAPHIC[data] | letter
        cut = np.zeros(n, bool)
        cut[1:] = (letter[:-1] & (plain & ~letter)[1:]) | (graphic[:-1] & (data[1:] == 0x20)) | (_PUNCT[data[:-1]] & letter[1:])
        cut[2:] |= graphic[:-2] & _BREAK[data[1:-1]] & letter[2:]
        cut[texts.off[:-1][texts.off[:-1] < n]] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], n)
        if self.lower:
            data = LOWER[data]
        own = start + (data[start] == 0x20) if self.drops_space else start
        # a lone space keeps one byte, so that it differs from nothing
        own = np.where(own < end, own, start)
        code, first = distinct(span_hashes(data, own, end))
        slots = self.slots(data, own[first], end[first])
        start_of, length_of, ids = (np.frombuffer(x, t) if len(x) else np.zeros(0, t) for x, t in ((self.start, np.int64), (self.length, np.int64), (self.ids, np.uint32)))
        length = length_of[slots][code]
        out = ids[ragged(length, start_of[slots][code])]
        total = np.append(0, np.cumsum(length))
        del start_of, length_of, ids  # the stores must not be held while they grow
        return out, np.diff(total[np.searchsorted(start, texts.off)])

    def slots(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if len(self.slot) + len(start) > STORE_LIMIT and len(self.slot) > STORE_LIMIT // 2:
            self.clear()
        keys = span_hashes(data, start, end).tolist()
        get = self.slot.get
        out = [get(k, -1) for k in keys]
        raw, odd = data.tobytes(), []
        for i in [i for i, s in enumerate(out) if s < 0]:
            piece = raw[start[i] : end[i]].decode("utf-8", "replace")
            if _PLAIN.match(piece):
                out[i] = self.add(keys[i], self.plain(piece.lower() if self.lower else piece))
            else:
                odd.append((i, piece))
        if odd:
            for (i, _), e in zip(odd, self.tokenizer.encode_batch_fast([p for _, p in odd], add_special_tokens=False), strict=True):
                out[i] = self.add(keys[i], e.ids)
        return np.array(out, np.int64)


@functools.cache
def encoder(name: str) -> Encoder:
    """The worker's encoder; tasks that follow in the same worker use its store again."""
    return Encoder(name)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append one id to each text's ids."""
    to = np.cumsum(counts)
    return np.insert(ids, to, end_id), counts + 1


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Texts:
    return Texts(batch.column(column))
