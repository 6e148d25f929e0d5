"""Token ids of texts, as the tokenizers library gives them, at a fraction of its time.

A text is encoded piece by piece and pieces are remembered, as most words come again and again. That
gives the library's own ids because its normalizer, pre-tokenizer and model never look beyond a piece,
and every new piece goes through them; only for plain ASCII and Latin-1 letters, where these two steps
are a lower case and a pattern, are they done here.

* ``words``: the pre-tokenizer drops white space, so nothing reaches across it. Pieces are the runs
  between ASCII white space; a text of plain characters alone is cut into words and signs at once.
* ``spaced``: byte-level pieces with the space before them, or runs of white space; the pattern
  below cuts where the pre-tokenizer's own pattern always cuts.
* Texts that hold a special token's string, and tokenizers of any other build, go to the library whole.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import sys
from array import array
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from cellrecon.llm import memos

#: A worker remembers so many pieces at most; rare ones met later are encoded each time.
REMEMBERED = 400_000

# The pattern of the tokenizer file, and patterns for plain characters.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(" ?[!-~À-ÖØ-öø-ÿ]+")
_PLAIN_TEXT = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
#: The parts of plain small text that are not letters; what is left between them and white space is words.
_SIGNS = r"('(?:s|t|re|ve|m|ll|d)|[0-9]|[^\t-\r a-zß-öø-ÿ0-9]+)"
_SIGNS_HERE = re.compile(_SIGNS)
_SPACED_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+")
#: Bytes as the characters that stand for them in byte-level models: those that don't print get a number from 256 on.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_LEVEL = "".join(chr(256 + _HIDDEN.index(b) if b in _HIDDEN else b) for b in range(256))

_SPACED = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: White space for Python but not for the tokenizer's pattern.
_SEPARATORS = re.compile("[\x1c-\x1f]")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Memo(dict):
    """Keeps a value from the second time its key is asked for: most of what comes once never comes again."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most
        # By hash; another key with the same one is merely kept at once.
        self.asked = bytearray(1 << 22)

    def __missing__(self, key):
        value = self.make(key)
        if len(self) < self.most:
            at = hash(key) & 0x3FFFFF
            if self.asked[at]:
                self[key] = value
            else:
                self.asked[at] = 1
        return value


class Encoder:
    """Ids or counts for whole texts, without added special tokens, truncation or padding."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        described = json.loads(Path(path).read_text())
        self.tokenizer, self.kind = tokenizer, _kind(described)
        self.special = [t["content"] for t in described.get("added_tokens") or []]
        self._ids = _Memo(self._piece_ids, remembered)
        self._count = _Memo(lambda piece: len(self._piece_ids(piece)) // 4, remembered)
        self._model = _Memo(self._part_ids, remembered)
        self._tokenize = tokenizer.model.tokenize

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self._whole(text):
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(found, "<u4").tobytes()
        if self.kind == "words" and _PLAIN_TEXT.fullmatch(text):
            return b"".join(map(self._model.__getitem__, self._plain_parts(text)))
        return b"".join(map(self._ids.__getitem__, self._pieces(text)))

    def ids_of_all(self, texts: list[str]) -> list[bytes]:
        """``ids`` of each text. Of plain texts some two million characters at a time look up each of their words once."""
        found, group, size = [b""] * len(texts), [], 0
        for i, text in enumerate(texts):
            if self.kind != "words" or not _PLAIN_TEXT.fullmatch(text) or self._whole(text):
                found[i] = self.ids(text)
                continue
            if group and size + len(text) > 1 << 21:
                self._together(texts, group, found)
                group, size = [], 0
            group.append(i)
            size += len(text)
        if group:
            self._together(texts, group, found)
        return found

    def _together(self, texts: list[str], group: list[int], found: list[bytes]) -> None:
        small = pa.array([texts[i].lower() for i in group], pa.large_string())
        split = pc.ascii_split_whitespace(pc.replace_substring_regex(small, _SIGNS, r" \1 "))
        parts = pc.dictionary_encode(split.flatten())
        known = list(map(self._model.__getitem__, parts.dictionary.to_numpy(zero_copy_only=False)))
        values = np.frombuffer(b"".join(known), "<u4")
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // 4
        at = parts.indices.to_numpy()
        n = lengths[at]
        ends = np.cumsum(n)
        shift = (np.cumsum(lengths) - lengths)[at] - (ends - n)
        raw = values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(shift, n)].tobytes()
        bounds = 4 * np.concatenate([[0], ends])[split.offsets.to_numpy()]
        for i, a, b in zip(group, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            found[i] = raw[a:b]

    def count(self, text: str) -> int:
        if self._whole(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return sum(map(self._count.__getitem__, self._pieces(text)))

    def _whole(self, text: str) -> bool:
        return (
            self.kind == "whole"
            or any(s in text for s in self.special)
            or (self.kind == "spaced" and _SEPARATORS.search(text) is not None)
        )

    def _pieces(self, text: str) -> list:
        return text.encode().split() if self.kind == "words" else _SPACED.findall(text)

    def _plain_parts(self, text: str) -> list[str]:
        return _SIGNS_HERE.sub(r" \1 ", text.lower()).split() if self.kind == "words" else _SPACED_PARTS.findall(text)

    def _piece_ids(self, piece: bytes | str) -> bytes:
        words = self.kind == "words"
        text = piece.decode() if words else piece
        if _PLAIN.fullmatch(text):
            known = self._plain_parts(text)
        else:
            if words:
                text = self.tokenizer.normalizer.normalize_str(text)
            known = [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return b"".join([self._model[p] for p in known])

    def _part_ids(self, part: str) -> bytes:
        """Of a plain part as it stands, of others with the characters for their bytes: any that are not plain leave some there."""
        if _PLAIN.fullmatch(part):
            part = codecs.charmap_decode(part.encode(), "strict", _LEVEL)[0]
        found = array("I", [t.id for t in self._tokenize(part)])
        if sys.byteorder == "big":
            found.byteswap()
        return found.tobytes()


def _kind(described: dict) -> str:
    """Which of the builds above a tokenizer file has."""
    if described["model"]["type"] != "BPE":
        return "whole"
    normalizer, splitter = described.get("normalizer"), described.get("pre_tokenizer") or {}
    if normalizer is None and splitter.get("type") == "ByteLevel":
        plain = splitter.get("use_regex") and not splitter.get("add_prefix_space")
        return "spaced" if plain else "whole"
    steps = [s["type"] for s in splitter.get("pretokenizers", [])]
    cleaned = [s["type"] for s in (normalizer or {}).get("normalizers", [])]
    if steps == ["Split", "ByteLevel"] and cleaned == ["NFC", "Replace", "Lowercase"]:
        split, level = splitter["pretokenizers"]
        drops = split["behavior"] == "Removed" and split["invert"]
        if drops and split["pattern"].get("Regex") == _WORD_PATTERN and not level["use_regex"]:
            return "words"
    return "whole"


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """One for each worker, file and bound, with what it remembers (some 300 bytes a piece)."""
    memos.start(f"tokens of {path}, {remembered}")
    return memos.held("encoder", lambda: Encoder(path, remembered))
