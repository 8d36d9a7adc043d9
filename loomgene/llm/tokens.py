"""A byte-level BPE tokenizer file (the tokenizers library's JSON) inside Spark tasks.

The driver reads the file and broadcasts its text (a vocabulary, not data). In tasks, texts
of plain Latin characters go through tiktoken built from the same merges, which gives the
same ids several times faster; all others (rare scripts, control characters) go through the
library itself. Strings of special tokens are cut out first, and long texts are walked in
parts, because the library takes about 165 bytes for each byte that it is given at once.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np

_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters on which the libraries' tables of letters, numbers and spaces can differ.
_ODD = re.compile(r"[^\t\n\x20-\x7E¡-ɏ‐-‧]")
#: Characters of a part, and where pre-tokens always end: between anything but space and a space, and, where a text has none for
#: a whole part, between letters of these scripts and digits or punctuation.
PART = 1 << 18
_SPACE = re.compile(r"\S(?=[ \n])")
_CLASS = re.compile("[A-Za-zÀ-ÖØ-öø-ɏа-яА-Яぁ-ゖァ-ヺ一-鿿가-힣](?=[0-9.,;:!?。，、；：！？])")
_TOP = 1 << 16
_ASTRAL = re.compile("[\U00010000-\U0010ffff]")
#: For each kind of character (letter, number, sign, space) one of the Basic Multilingual Plane that stands for it.
_KINDS = {"letter": "a", "number": "1", "sign": "!", "space": "\n"}


class Splitter:
    """Pre-tokens of any text, by the kinds that the library itself gives to characters.

    The library splits a few long strings in which each character of the plane stands behind
    a letter, a number and a sign; which one it joins is its kind. From these ranges comes one
    pattern for the re module. Characters beyond the plane are replaced by one of their kind
    before the text is split; they are asked for one by one. The pattern of another splitter may be given.
    """

    def __init__(self, library, pattern: str | None = None):
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.kind: dict[int, str] = {}
        self.pattern = re.compile(pattern or self._pattern())

    def _pattern(self) -> str:
        points = [c for c in range(_TOP) if not 0xD800 <= c < 0xE000]
        kinds = np.full(_TOP, "space", object)
        for kind in ("letter", "number", "sign"):
            kinds[self._joined(points, _KINDS[kind])] = kind
        ranges = {k: _ranges(np.flatnonzero(kinds == k)) for k in ("letter", "number", "space")}
        letter, number, space = ranges["letter"], ranges["number"], ranges["space"]
        return f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"

    def _joined(self, points: list[int], before: str) -> list[int]:
        """The characters that are one pre-token with this one before them."""
        out = []
        for a in range(0, len(points), 8192):
            own = points[a : a + 8192]
            text = "".join(f"{before}{chr(c)}\n" for c in own)
            spans = {x for _, x in self.split(text)}
            out += [c for i, c in enumerate(own) if (3 * i, 3 * i + 2) in spans]
        return out

    def _stand_in(self, c: str) -> str:
        if ord(c) not in self.kind:
            joined = [k for k in ("letter", "number", "sign") if len(self.split(_KINDS[k] + c)) == 1]
            self.kind[ord(c)] = _KINDS[joined[0] if joined else "space"]
        return self.kind[ord(c)]

    def __call__(self, text: str) -> list[str]:
        if not _ASTRAL.search(text):
            return self.pattern.findall(text)
        plain = _ASTRAL.sub(lambda m: self._stand_in(m[0]), text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(plain)]


def parts(text: str, size: int = 0) -> Iterator[str]:
    """The text in parts of about `size` (PART) characters whose pre-tokens are those of the text; what has no break stays whole."""
    size, at = size or PART, 0
    while len(text) - at > size:
        near = at + size, at + 2 * size
        cut = _SPACE.search(text, *near) or _CLASS.search(text, *near) or _SPACE.search(text, near[1]) or _CLASS.search(text, near[1])
        if cut is None:
            break
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:] if at else text


def _ranges(points: np.ndarray) -> str:
    """Code points as ranges of a character class."""
    if not len(points):
        return ""
    last = np.append(np.flatnonzero(np.diff(points) > 1), len(points) - 1)
    first = np.append(0, last[:-1] + 1)
    return "".join(f"\\u{a:04x}-\\u{z:04x}" for a, z in zip(points[first].tolist(), points[last].tolist(), strict=True))


def byte_chars() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes: themselves if visible in Latin-1, else the next free characters from U+0100."""
    seen = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b}
    spare = iter(range(256, 512))
    return {chr(b if b in seen else next(spare)): b for b in range(256)}


class Bpe:
    """One tokenizer, made in a task (or on the driver) from the JSON text."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        data = json.loads(spec)
        added = data.get("added_tokens", ())
        self.special = {t["content"]: t["id"] for t in added}
        plain = not any(t.get(k) for t in added for k in ("lstrip", "rstrip", "single_word"))
        longest = sorted(self.special, key=len, reverse=True)
        #: What cuts special tokens out of a text; None if they take more than their own string.
        self.cuts = re.compile("|".join(map(re.escape, longest)) if longest else "(?!)") if plain else None
        self.fast = self._tiktoken(data)

    def _tiktoken(self, data: dict):
        import tiktoken

        model, pre = data["model"], data.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or data.get("normalizer") or model.get("ignore_merges") or model.get("dropout"):
            return None
        to_byte, vocab = byte_chars(), model["vocab"]
        raw = lambda t: bytes(to_byte[c] for c in t)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if any(vocab[a + b] != 256 + i for i, (a, b) in enumerate(merges)):
            return None  # ids are not in the order of the merges
        ranks = {raw(t): i for t, i in vocab.items() if t not in self.special}
        return tiktoken.Encoding("from_json", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def segments(self, text: str) -> Iterator[str | int]:
        """What lies between special tokens, in parts, and the ids of these. Only for a byte-level tokenizer (fast)."""
        at = 0
        if any(x in text for x in self.special):
            for m in self.cuts.finditer(text):
                if m.start() > at:
                    yield from parts(text[at : m.start()])
                yield self.special[m[0]]
                at = m.end()
        if at < len(text):
            yield from parts(text[at:] if at else text)

    @property
    def walks(self) -> bool:
        """Whether texts may be taken in segments."""
        return self.fast is not None and self.cuts is not None

    def ids(self, text: str) -> np.ndarray:
        if not self.walks:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")
        out = bytearray()
        for x in self.segments(text):
            out += np.array([x] if isinstance(x, int) else self._part(x), dtype="<u4").data
        return np.frombuffer(out, "<u4")

    def _part(self, text: str):
        if _ODD.search(text):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.fast.encode_to_numpy(text, disallowed_special=())


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()
