"""Token ids of whole batches of texts, with a public tokenizer.

A tokenizer that drops white space gives a text the ids of its words one after
another. One that puts a space to the word after it gives it the ids of pieces
that begin where a space follows a character that is none. Marks after a word
are units of their own. Units repeat, so each is encoded once a batch, and the
ids of those that come again are kept; a batch then costs a few array
operations. Other tokenizers get whole texts.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from tokenizers import Tokenizer

from lakeweir.llm.common import give_back
from lakeweir.llm.words import LOWER, SPACE, separators, text_bytes

#: Units that came again, whose ids a worker keeps: at most twice so many.
KEPT_UNITS = 200_000
#: Bytes of text that are encoded at a time: the more, the more units are the same.
ENCODE_BYTES = 4 << 20

#: The form of a tokenizer whose words can be encoded one by one.
_BY_WORD = {
    "normalizer": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
    "splits": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
}
#: Fixed value: how the tokenizers library splits text for byte-level models.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The last two bytes of each character beyond ASCII that is white space.
_WIDE_SPACE = [(0xC2, 0x85), (0xC2, 0xA0), (0x9A, 0x80), *((0x80, b) for b in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)), (0x81, 0x9F), (0x80, 0x80)]
_WIDE_SPACE_PAIRS = np.unique(np.array([(a << 8) | b for a, b in _WIDE_SPACE], np.uint16))
#: Words of these characters alone take the direct way; all others go through the tokenizer as they are.
#: Libraries differ in what they take for a letter among newer characters, so only old blocks count.
_PLAIN = regex.compile(r"(?:[\x21-\x7e]|(?=[\p{L}\p{N}])[\u00c0-\u024f\u0370-\u03ff\u0400-\u04ff])+")


#: Latin letters that are composed already and have one lower-case letter each.
_LATIN = re.compile("[A-Za-z\u00c0-\u012f\u0131-\u024f]+")
#: Marks that are a part of their own after a letter or digit.
_MARK, _ALNUM = separators(*((ord(c), ord(c)) for c in ".,;:!?")), separators((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: printable bytes for themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Ids of texts by one tokenizer; ``source`` is the text of its file."""

    def __init__(self, source: str):
        self.tokenizer = Tokenizer.from_str(source)
        self.model = self.tokenizer.model
        spec = json.loads(source)
        before = spec.get("pre_tokenizer") or {}
        splits = before.get("pretokenizers", [{}])
        self.by_word = (
            (spec.get("normalizer") or {}).get("normalizers") == _BY_WORD["normalizer"]
            and splits[0].get("pattern") == {"Regex": _BY_WORD["splits"]}
            and splits[0].get("behavior") == "Removed"
            and spec["model"].get("end_of_word_suffix") is not None
        )
        added = spec.get("added_tokens", [])
        self.by_piece = (
            spec.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space")
            and before.get("use_regex", True)
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in added)
        )
        self.splits = regex.compile(_BY_WORD["splits"] if self.by_word else _BYTE_LEVEL)
        self.special = [t["content"] for t in added]
        self.letters = _byte_letters()
        self.bulk, self.borders = self._together(spec)
        self.forget()

    def forget(self):
        """Empty the memory of units."""
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.new: dict[str, bytes] = {}

    def ids_of(self, unit: str) -> list[int]:
        """The ids of a unit that is more than a word of ASCII letters."""
        bare = unit.replace(" ", "")
        if self.by_word:
            plain = _LATIN.fullmatch(bare) or (_PLAIN.fullmatch(bare) and unicodedata.is_normalized("NFC", bare))
        else:
            plain = _PLAIN.fullmatch(bare)
        if not plain or any(s in unit for s in self.special):
            return self.tokenizer.encode(unit, add_special_tokens=False).ids
        if self.by_word and unit.isalpha() and _LATIN.fullmatch(unit):
            return [t.id for t in self.model.tokenize(unit.lower().encode().decode("latin-1").translate(self.letters))]
        if self.by_word:
            unit = "".join(c.lower() for c in unit)
        out = []
        for part in self.splits.findall(unit):
            # The model's vocabulary has a letter for each byte, and another one for a space.
            out += [t.id for t in self.model.tokenize(part.encode().decode("latin-1").translate(self.letters))]
        return out

    def encoded(self, units: list[str]) -> list[bytes]:
        """The ids of units that nothing is known of, as 32-bit integers."""
        out: list[bytes] = [b""] * len(units)
        plain = [i for i, unit in enumerate(units) if self._is_plain(unit)] if self.bulk else []
        if plain:
            if self.by_word:
                low = [units[i].lower() for i in plain]
                text = "".join([w[:-1] + w[-1].upper() for w in low])
            else:
                text = "".join([units[i] for i in plain])
            ids = np.array(self.bulk.encode_ordinary(text), "<u4")
            at = np.flatnonzero(self.borders[ids])
            cuts = np.append(0, at + 1) if self.by_word else np.append(at, len(ids))
            blob, cuts = ids.tobytes(), (4 * cuts).tolist()
            for i, a, b in zip(plain, cuts[:-1], cuts[1:], strict=True):
                out[i] = blob[a:b]
        for i, known in enumerate(out):
            if not known:
                out[i] = array("I", self.ids_of(units[i])).tobytes()
        return out

    def _is_plain(self, unit: str) -> bool:
        """Whether a unit is one word of letters that go together in one call."""
        if self.by_word:
            return unit.isascii() and unit.isalpha()
        word = unit[1:]
        return unit[0] == " " and word.isalpha() and (word.isascii() or _LATIN.fullmatch(word) is not None)

    def _together(self, spec: dict):
        """A coder that takes many words of letters in one call, where the vocabulary allows it; else none.

        Its tokens are merged in the order of their ids, so the model's merges have to be in that order as well.
        Words are written so that they part again: where a last letter has tokens of its own it is
        upper case, else the space before a word is part of it.
        """
        vocab = spec["model"]["vocab"]
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        order = [vocab.get(token, -1) for token in merged]
        if not order or order != sorted(set(order)) or order[0] < 0 or not (self.by_word or self.by_piece):
            return None, None
        ranks, borders = {}, np.zeros(max(vocab.values()) + 1, bool)
        if self.by_word:
            end = spec["model"]["end_of_word_suffix"]
            for token, number in vocab.items():
                body, last = token.removesuffix(end), token.endswith(end)
                if body.isascii() and body.isalpha() and body.islower():
                    ranks[(body[:-1] + body[-1].upper() if last else body).encode()] = number
                    borders[number] = last
            return tiktoken.Encoding("words", pat_str="[a-z]*[A-Z]", mergeable_ranks=ranks, special_tokens={}), borders
        byte_of = {letter: byte for byte, letter in self.letters.items()}
        for token, number in vocab.items():
            if all(c in byte_of for c in token) and token not in self.special:
                raw = bytes(byte_of[c] for c in token)
                ranks[raw] = number
                borders[number] = raw[:1] == b" "
        return tiktoken.Encoding("pieces", pat_str=r" \p{L}+", mergeable_ranks=ranks, special_tokens={}), borders

    def units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, starts)`` of distinct units.

        Units that the batch before had as well are kept, as are those that have been of use
        since as many others came; the rest is held for one batch.
        """
        out = list(map(self.kept.get, units))
        missing = [i for i, known in enumerate(out) if known is None]
        unknown = []
        for i in missing:
            unit = units[i]
            known = self.new.get(unit) or self.older.get(unit)
            if known is None:
                unknown.append(i)
            else:
                out[i] = self.kept[unit] = known
        self.new = {}
        for i, ids in zip(unknown, self.encoded([units[i] for i in unknown]), strict=True):
            out[i] = self.new[units[i]] = ids
        if len(self.kept) > KEPT_UNITS:
            self.older, self.kept = self.kept, {}
        starts = np.concatenate(([0], np.cumsum(np.fromiter(map(len, out), np.int64, len(out)) // 4)))
        return np.frombuffer(b"".join(out), "<u4"), starts

    def _units(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All units of all texts, and where each text's begin."""
        raw, bounds = text_bytes(texts)
        firsts = bounds[:-1][np.diff(bounds) > 0]
        cut = np.zeros(len(raw) + 1, bool)
        # Marks after an ASCII letter or digit.
        cut[1:-1] = _MARK[raw[1:]] & _ALNUM[raw[:-1]]
        cut[firsts] = True
        if self.by_word:
            low = LOWER[raw]
            if not any(s.lower().encode() in low.tobytes() for s in self.special):
                raw = low
            inside = ~SPACE[raw]
            cut[:-1] &= inside
            cut[1:-1] |= inside[1:] & ~inside[:-1]
            # A text's first word may come after white space.
            starts = np.flatnonzero(cut)
            offsets = np.searchsorted(starts, bounds)
            ends = np.append(np.concatenate(([0], np.cumsum(inside)))[starts], inside.sum())
            raw = raw[inside]
        else:
            at = np.flatnonzero(raw[1:] == 32) + 1
            before = raw[at - 1]
            good = (before > 32) & (before < 127)
            wide = np.flatnonzero(before >= 128)
            pair = (raw[np.maximum(at[wide] - 2, 0)].astype(np.uint16) << 8) | before[wide]
            good[wide[~np.isin(pair, _WIDE_SPACE_PAIRS)]] = True
            cut[at[good]] = True
            starts = np.flatnonzero(cut)
            offsets = np.searchsorted(starts, bounds)
            ends = np.append(starts, len(raw))
        units = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(raw)])
        return units, offsets

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, starts)``: text ``i`` has the ids from ``starts[i]`` to ``starts[i + 1]``.

        A null text has none but ``end``, which is appended to each where given.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        extra = int(end is not None)
        if not (self.by_word or self.by_piece):
            each = [e.ids for e in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            each = [[*ids, end] if extra else ids for ids in each]
            starts = np.concatenate(([0], np.cumsum([len(e) for e in each], dtype=np.int64)))
            return np.array([i for e in each for i in e], np.uint32), starts
        found, offsets = self._units(texts)
        found = found.dictionary_encode()
        known, bounds = self.units(found.dictionary.to_numpy(zero_copy_only=False).tolist())
        of = found.indices.to_numpy(zero_copy_only=False)
        first, length = bounds[of], np.diff(bounds)[of]
        sums = np.concatenate(([0], np.cumsum(length)))
        starts = sums[offsets] + np.arange(len(texts) + 1) * extra
        out = np.full(starts[-1], end or 0, np.uint32)
        own = np.ones(len(out), bool)
        if extra:
            own[starts[1:] - 1] = False
        out[own] = known[np.arange(sums[-1]) + np.repeat(first - sums[:-1], length)]
        return out, starts


_ENCODERS: dict[int, Encoder] = {}


@contextmanager
def encoder(source: str) -> Iterator[Encoder]:
    """This worker's encoder, made once. What it remembers of units goes when the task is done."""
    key = hash(source)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(source)
    try:
        yield _ENCODERS[key]
    finally:
        _ENCODERS[key].forget()
        give_back()


def tokenizer_source(path: str) -> str:
    """The tokenizer file, read where the job starts; tasks get its text."""
    return Path(path).read_text(encoding="utf-8")
