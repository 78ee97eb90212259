"""Pre-splitting of texts as the public tokenizer files ask for, with a cache of white-space delimited chunks.

A tokenizer of these files never joins across a pre-token, so a text is the sequence of its chunks' pre-tokens. Chunks of
plain Latin characters are split here; any other chunk is split by the library's own normalizer and pre-tokenizer, whose
Unicode tables decide. Strings of special tokens inside a text are cut out first, as the library does by default.
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Callable

from tokenizers import Tokenizer

# Characters that the library counts as white space, and those that only Python does.
SPACES = "".join(map(chr, (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
NO_SPACES = "\x1c\x1d\x1e\x1f"
LATIN = "a-z\xc0-\xd6\xd8-\xf6\xf8-\xff"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class Bounded(dict):
    """A cache that is emptied when it is full; ``make`` gives the value of a key."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


class PreSplit:
    """Pre-tokens, in byte letters, of texts under a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.vocab: dict[str, int] = self.spec["model"]["vocab"]
        self.merges: list[tuple[str, str]] = [
            tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in self.spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self.suffix = self.spec["model"].get("end_of_word_suffix") or ""
        self._cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._mark = min(self.special, key=len)[:2] if self.special else ""
        self._letters = "".join(byte_letters())
        # Only the file that drops white space may be cut at every white space.
        self.drops_space = bool(self.suffix)
        if self.drops_space:
            self._plain = re.compile("[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+").fullmatch
            self._words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN}]+|[0-9]|[^{SPACES}{LATIN}0-9]+").findall
        else:
            self._plain = re.compile("[\t-\r -~\xc0-\xd6\xd8-\xf6\xf8-\xff]+").fullmatch
            both = "A-Z" + LATIN
            self._words = re.compile(
                f"'s|'t|'re|'ve|'m|'ll|'d| ?[{both}]+| ?[0-9]+| ?[^{SPACES}{both}0-9]+"
                f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+").findall
        self._odd = re.compile(f" [{SPACES}{NO_SPACES}]| $").search
        self._split = re.compile(f"[{SPACES}]+").split

    def words(self, chunk: str) -> list[str]:
        """Pre-tokens of a chunk, or of a whole text without special strings."""
        if self._plain(chunk):
            text = chunk.lower() if self.drops_space else chunk
            # Letters alone are one pre-token.
            found = [text] if text.isalpha() else self._words(text)
            if self.drops_space and text.isascii():
                return found
            return [codecs.charmap_decode(w.encode(), "strict", self._letters)[0] for w in found]
        if self.library.normalizer is not None:
            chunk = self.library.normalizer.normalize_str(chunk)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(chunk)]

    def chunks(self, text: str) -> list[str]:
        """Chunks whose pre-tokens, in order, are those of the text; the text holds no special string."""
        if self.drops_space:
            if any(c in text for c in NO_SPACES):
                return [c for c in self._split(text) if c]
            return text.split()
        if self._odd(text):
            return [text]
        first, *rest = text.split(" ")
        return [first, *(" " + c for c in rest)] if first else [" " + c for c in rest]

    def parts(self, text: str) -> list[tuple[str, int | None]]:
        """The text cut at strings of special tokens: (piece, None) or (string, id)."""
        if self._cut is None or self._mark not in text:
            return [(text, None)] if text else []
        return [(p, self.special.get(p)) for p in self._cut.split(text) if p]
