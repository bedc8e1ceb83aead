"""Token ids of whole texts by a public tokenizer, with the ids of each distinct word remembered."""

from __future__ import annotations

import json
import os
import re
import struct
import threading

import numpy as np

from tidemark.llm.shared import give_back

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: ASCII punctuation without the apostrophe, so that no contraction can be formed.
_PUNCT = re.escape("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: White space or separators on which Python and the tokenizers may differ.
_ODD = re.compile("[" + "".join(map(chr, (*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200E), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF))) + "]")
_SIMPLE = re.compile(f"( ?)([{_LETTERS}]*)([{_PUNCT}]*)")
_SIGNS = re.compile("[!-/:-@\\[-`{-~]+")
_UNITS = re.compile(r" ?[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+(?![^ \t\n\r\x0b\x0c])|[ \t\n\r\x0b\x0c]")


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 stands for itself, other bytes follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in table:
            table[b], extra = chr(extra), extra + 1
    return table


class TokenEncoder(dict):
    """Encodes whole texts exactly as ``Tokenizer.encode(text, add_special_tokens=False)`` does.

    Pre-tokenization never crosses white space in the two supported layouts (lower-cased words with word ends;
    byte-level pieces that own one leading space), so a text is cut there and each distinct unit is encoded once.
    Units of plain letters and punctuation go straight to the vocabulary model; all others, texts with unusual
    white space or with what may be an added token's string, and tokenizers of any other layout go through the whole
    pipeline of the library. The memory is bounded by ``most_units``; it starts anew when full.
    """

    def __init__(self, path: str, most_units: int = 700_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.tok = Tokenizer.from_file(path)
        self.model, self.most_units = self.tok.model, most_units
        self.size = self.tok.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self._letters, self._code = _byte_letters(), "H" if self.dtype.itemsize == 2 else "I"
        spec = json.loads(self.tok.to_str())
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        steps = [x["type"] for x in (norm or {}).get("normalizers", [])]
        inner = [x["type"] for x in pre.get("pretokenizers", [])]
        self.layout = "whole"
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
            self.layout = "byte"
        elif steps == ["NFC", "Replace", "Lowercase"] and inner == ["Split", "ByteLevel"] and pre["pretokenizers"][0].get("behavior") == "Removed":
            self.layout = "word"
        # normalizers leave ASCII signs as they are, so an added token can only be where its signs are
        signs = [max(_SIGNS.findall(x["content"]), key=len, default="") for x in spec.get("added_tokens") or []]
        self._marks = sorted({x for x in signs if x})
        if not all(signs):
            self.layout = "whole"

    def _pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self._code}", *ids)

    def _mapped(self, piece: str) -> str:
        return piece.replace(" ", self._letters[32]) if piece.isascii() else "".join(map(self._letters.__getitem__, piece.encode()))

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= self.most_units:
            self.clear()
        if m := _SIMPLE.fullmatch(unit):
            space, letters, rest = m.groups()
            head = letters.lower() if self.layout == "word" else space + letters
            if letters and (rest or head != unit):  # known parts under other punctuation or capitals
                out = self[unit] = self[head] + (self[rest] if rest else b"")
                return out
            ids = [t.id for t in self.model.tokenize(self._mapped(unit))]
        else:
            ids = self.tok.encode(unit, add_special_tokens=False).ids
        out = self[unit] = self._pack(ids)
        return out

    def encode_bytes(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian integers of ``dtype``; null counts as empty."""
        if not text:
            return b""
        if self.layout == "whole" or _ODD.search(text) or any(m in text for m in self._marks):
            return self._pack(self.tok.encode(text, add_special_tokens=False).ids)
        units = text.split() if self.layout == "word" else _UNITS.findall(text)
        return b"".join(map(self.__getitem__, units))


_ENCODERS: dict[str, TokenEncoder] = {}
_IDLE: list[threading.Timer] = []


def encoder(path: str) -> TokenEncoder:
    """One encoder per tokenizer and worker process; later tasks in the same worker use its memory."""
    while _IDLE:
        _IDLE.pop().cancel()
    if path not in _ENCODERS:
        _ENCODERS[path] = TokenEncoder(path)
    return _ENCODERS[path]


def forget() -> None:
    """Give the remembered units' memory back."""
    for e in _ENCODERS.values():
        e.clear()
    give_back()


def idle(seconds: float = 8.0) -> None:
    """Called when a task ends: a worker that gets no other encoding task soon must not hold its memory under other stages."""
    timer = threading.Timer(seconds, forget)
    timer.daemon = True
    _IDLE.append(timer)
    timer.start()
