"""Token ids of whole text columns: each distinct pre-token is encoded once per piece."""

from __future__ import annotations

import json
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa

from tillwise.llm.words import Texts

OTHER, LETTER, NUMBER, SPACE, UNKNOWN = range(5)
#: The characters with the property White_Space in the Unicode standard.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
#: The endings after an apostrophe that byte-level BPE keeps as tokens.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Words remembered by a task.
REMEMBERED = 150_000


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable Latin-1
    characters stand for themselves, the other bytes for the characters from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


def merge_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a byte-level BPE file of the tokenizers library by their bytes. Their ids
    must follow the order of the merges, so that ids are ranks too."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"][a + b] for a, b in merges]
    if made != sorted(made):
        raise ValueError(f"{path}: ids do not follow the merges")
    letters = byte_letters()
    singles = {t: i for t, i in model["vocab"].items() if len(t) == 1}
    tokens = singles | {a + b: model["vocab"][a + b] for a, b in merges}
    return {bytes(letters[c] for c in t): i for t, i in tokens.items()}


def added_tokens(path: str) -> dict[str, int]:
    """The ids of the file's added tokens, which texts are split at wherever they stand."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file)["added_tokens"]
    if any(t[k] for t in tokens for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{path}: added tokens that depend on what is around them")
    return {t["content"]: t["id"] for t in tokens}


class Tokenizer:
    """Token ids by a byte-level BPE file of the tokenizers library.

    Texts are split into pre-tokens as the file's pattern does (letters, numbers or other
    characters, each with the blank before them; white space; apostrophe endings), in numpy
    over whole pieces; only distinct pre-tokens are merged, by tiktoken, which does so much
    faster and gives the same ids (a test compares them). Before that, texts are split at the
    file's added tokens, special ones too, as the library does by default.
    """

    def __init__(self, path: str):
        import tiktoken

        self.merged = tiktoken.Encoding(
            "pieces", pat_str=r"(?s).+", mergeable_ranks=merge_ranks(path), special_tokens={}
        ).encode_ordinary
        self.added = added_tokens(path)
        longest = sorted((t.encode() for t in self.added), key=len, reverse=True)
        self.marks = re.compile(b"|".join(map(re.escape, longest))) if longest else None
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        self.classes[list(WHITE_SPACE)] = SPACE
        self.known: dict[str, bytes] = {}

    def class_of(self, points: np.ndarray) -> np.ndarray:
        found = self.classes[points]
        if (new := points[found == UNKNOWN]).size:
            for p in np.unique(new).tolist():
                kind = unicodedata.category(chr(p))[0]
                self.classes[p] = {"L": LETTER, "N": NUMBER}.get(kind, OTHER)
            found = self.classes[points]
        return found

    def pretokens(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Byte offsets of the pre-tokens, which cover all bytes, and the number of the
        first one of each text."""
        data = texts.data
        if not len(data):
            return np.zeros(1, np.int64), np.zeros(len(texts) + 1, np.int64)
        begin = np.flatnonzero((data & 0xC0) != 0x80)
        lead = data[begin].astype(np.int32)
        points = lead.copy()
        wide = np.flatnonzero(lead >= 0xC0)
        if len(wide):
            follow = [data[np.minimum(begin[wide] + k, len(data) - 1)].astype(np.int32) & 0x3F for k in (1, 2, 3)]
            b = lead[wide]
            points[wide] = np.where(
                b < 0xE0, (b & 0x1F) << 6 | follow[0],
                np.where(b < 0xF0, (b & 0x0F) << 12 | follow[0] << 6 | follow[1],
                         (b & 0x07) << 18 | follow[0] << 12 | follow[1] << 6 | follow[2]),
            )
        kinds = self.class_of(points)
        n = len(begin)
        head = np.zeros(n + 1, bool)  # first character of a text, or the end
        head[np.searchsorted(begin, texts.offsets)] = True
        start = head[:n].copy()
        start[1:] |= kinds[1:] != kinds[:-1]
        run = np.flatnonzero(start)
        # Runs that follow a character of the same text.
        inner = run[~head[run]]
        content = inner[kinds[inner] != SPACE]
        after_blank = content[points[content - 1] == 0x20]
        after_other = content[(kinds[content - 1] == SPACE) & (points[content - 1] != 0x20)]
        start[after_blank] = False
        start[after_blank - 1] = True
        start[after_other - 1] = True
        self._endings(points, kinds, head, start)
        offsets = np.append(begin[start], len(data))
        return offsets, np.searchsorted(offsets[:-1], texts.offsets)

    @staticmethod
    def _endings(points, kinds, head, start) -> None:
        n = len(points)
        marks = np.flatnonzero(start & (points == 0x27))
        marks = marks[(marks + 1 < n)]
        marks = marks[~head[marks + 1]]
        for mark in marks[kinds[marks + 1] == LETTER].tolist():
            for ending in ENDINGS:
                stop = mark + 1 + len(ending)
                if stop <= n and not head[mark + 1 : stop].any() and "".join(map(chr, points[mark + 1 : stop])) == ending:
                    start[mark + 1] = False
                    if stop < n and (kinds[stop] == LETTER or head[stop]):
                        start[stop] = True
                    break

    def split(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """``pretokens``, where added tokens are pre-tokens and the text ends before and after them."""
        data = texts.data.tobytes()
        if not self.marks or not self.marks.search(data):
            return self.pretokens(texts)
        found = [
            m.span() for low, high in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), strict=True)
            for m in self.marks.finditer(data, low, high)
        ]
        starts, ends = np.array(found, np.int64).reshape(-1, 2).T
        parts = Texts(texts.data, np.unique(np.concatenate((texts.offsets, starts, ends))), texts.first)
        offsets, _ = self.pretokens(parts)
        offsets = offsets[np.searchsorted(starts, offsets, side="left") == np.searchsorted(ends, offsets, side="right")]
        return offsets, np.searchsorted(offsets[:-1], texts.offsets)

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's ids begin."""
        offsets, first = self.split(texts)
        strings = pa.LargeStringArray.from_buffers(
            len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(texts.data))
        )
        coded = strings.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = distinct
        for word in new:
            ids = [self.added[word]] if word in self.added else self.merged(word)
            self.known[word] = array("I", ids).tobytes()
        codes = [self.known[w] for w in distinct]
        lengths = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        flat = np.frombuffer(b"".join(codes), np.uint32)
        begin = np.cumsum(lengths) - lengths
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        each = lengths[at]
        upto = np.concatenate(([0], np.cumsum(each)))
        ids = flat[np.arange(upto[-1]) + np.repeat(begin[at] - upto[:-1], each)]
        return ids, upto[first]
