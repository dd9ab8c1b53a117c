"""Token ids by the tokenizers library, with caches of pieces.

A tokenizer whose pieces never cross a single space between two non-space
characters gives the same ids for a text as for its parts; those parts repeat
a lot, so each is encoded once and then looked up.  Parts with characters
beyond U+024F, or of a tokenizer of another kind, go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The pre-tokenizers' patterns that the fast path knows.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_MARK = "\x01"
_CUTS = ((r"([A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}])([.,;:!?])", rf"\1 {_MARK}\2"),
         (r"([^\s\x0b\x1c-\x1f\x{85}\p{Z}])\n([^\s\x0b\x1c-\x1f\x{85}\p{Z}])", rf"\1 {_MARK}" "\n" rf" {_MARK}\2"))
_ODD_SPACE = r"\x01|^ | $| [\s\x0b\x1c-\x1f\x{85}\p{Z}]|[\s\x0b\x1c-\x1f\x{85}\p{Z}] "
_CUT = re.compile(r"(?<=\S) (?=\S)")
_FAR = re.compile("[^\x00-\u012f\u0131-\u024f]")  # the capital I with a dot becomes two code points


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others
    for the code points from 256 on."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in keep else chr(next(rest)) for b in range(256)}


class _Cache(dict):
    """Made on demand; emptied when it has ``limit`` entries."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


class Encoder:
    """Ids of whole texts, one by one or by the batch."""

    def __init__(self, path: str, limit: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        spec = json.loads(self.tokenizer.to_str())
        self.kind = self._kind(spec.get("normalizer"), spec.get("pre_tokenizer"))
        if self.kind:
            self.find = regex.compile(WORD_PATTERN if self.kind == "word" else BYTE_PATTERN).findall
            self.letters = _byte_letters()
            self.space, self.lead = self.letters[32], " " if self.kind == "byte" else ""
            self.model = self.tokenizer.model
            self.parts = _Cache(self._part, limit)

    @staticmethod
    def _kind(normalizer, pre) -> str:
        if not pre:
            return ""
        if (pre["type"], pre.get("add_prefix_space"), pre.get("use_regex"), normalizer) == ("ByteLevel", False, True, None):
            return "byte"
        steps = pre.get("pretokenizers", [])
        if len(steps) == 2 and steps[0].get("pattern") == {"Regex": WORD_PATTERN} and steps[0].get("invert") \
                and steps[0].get("behavior") == "Removed" and not steps[1].get("use_regex") \
                and [x["type"] for x in (normalizer or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
            return "word"
        return ""

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _part(self, part: str) -> bytes:
        body = part[1:] if part[0] == " " else part
        if not (body.isascii() and body.isalnum()):
            part = part.encode().decode("latin-1").translate(self.letters)
        elif body is not part:
            part = self.space + body
        return array("I", [t.id for t in self.model.tokenize(part)]).tobytes()

    def _piece(self, piece: str, lead: str | None = None) -> bytes:
        """A piece after a space, or after ``lead``."""
        lead = self.lead if lead is None else lead
        if piece.isalpha() and (piece.isascii() or not _FAR.search(piece)):
            return self.parts[piece.lower() if self.kind == "word" else lead + piece]
        if piece[:1] == _MARK:
            return self._piece(piece[1:], "")
        if _FAR.search(piece):
            return self._whole(lead + piece)
        return b"".join(map(self.parts.__getitem__, self.find(piece.lower() if self.kind == "word" else lead + piece)))

    def ids(self, text: str) -> bytes:
        """One text's ids as little-endian unsigned 32-bit integers."""
        if not self.kind or not text or _MARK in text:
            return self._whole(text)
        pieces = _CUT.split(text)
        return self._piece(pieces[0], "") + b"".join(map(self._piece, pieces[1:]))

    def batch(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of every text, ``end_id`` after each.

        The texts are cut at single spaces, and between a letter and a stop
        and around a single line end (a mark tells that no space was there);
        each distinct piece is encoded once and the ids are gathered by
        number.  A text with other white space beside a space is one piece."""
        n = len(texts)
        odd = pc.match_substring_regex(texts, _ODD_SPACE) if self.kind else pa.array(np.ones(n, bool))
        whole = pc.if_else(odd, "", texts)
        for pattern, put in _CUTS:
            whole = pc.replace_substring_regex(whole, pattern, put)
        cut = pc.split_pattern(whole, " ")
        named = cut.values.slice(cut.offsets[0].as_py(), cut.offsets[-1].as_py() - cut.offsets[0].as_py()).dictionary_encode()
        codes, ends = named.indices.to_numpy(), cut.offsets.to_numpy().astype(np.int64)
        starts = ends[:-1] - ends[0]
        pieces = named.dictionary.to_pylist()
        blobs = list(map(self._piece, pieces)) if self.kind else [b""] * len(pieces)
        odd = odd.to_numpy(zero_copy_only=False)
        blobs += [self.ids(texts[i].as_py()) if odd[i] else self._piece(pieces[codes[k]], "") for i, k in enumerate(starts.tolist())]
        blobs.append(array("I", [end_id]).tobytes())
        numbers = np.insert(codes.astype(np.int32), (ends[1:] - ends[0]), len(blobs) - 1)
        numbers[starts + np.arange(n)] = len(pieces) + np.arange(n)
        sizes = np.fromiter(map(len, blobs), np.int32, len(blobs)) // 4
        flat, at = np.frombuffer(b"".join(blobs), "<u4"), np.cumsum(sizes) - sizes
        per = sizes[numbers]
        upto = np.cumsum(per)
        where = np.repeat((at[numbers] - upto + per).astype(np.int32), per)
        where += np.arange(len(where), dtype=np.int32)
        offsets = np.zeros(n + 1, np.int64)
        offsets[1:] = upto[ends[1:] - ends[0] + np.arange(n)]
        return flat[where], offsets


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20):
    """Row ranges of a batch whose texts have about ``limit`` bytes each."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    low = 0
    while low < batch.num_rows:
        done = sizes[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(sizes, done + limit, side="right")))
        yield batch.slice(low, high - low)
        low = high


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file, its caches kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
