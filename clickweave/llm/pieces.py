"""Words of a stored word-piece tokenizer: special strings, normalisation, pre-tokens.

The file's own normaliser and pre-token pattern decide. Texts whose characters all lie below
U+0250 take a quick path (lower case by Python, one compiled pattern over explicit character
classes); the classes are read off the library's pre-tokenizer when the file is loaded, and a
character whose lower case the library sees differently is kept off the quick path. Any other
text is normalised and split by the library itself.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

from tokenizers import Tokenizer

LIMIT = 0x250


def byte_letters() -> list[str]:
    """The printable letter of each byte value in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others follow from U+0100 on.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    letters = {b: chr(b) for b in own}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(own)))
    return [letters[b] for b in range(256)]


class WordPieces:
    """Vocabulary, merges and word splitting of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        model = spec["model"]
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        #: rank of a pair of ids, and the id that a rank makes
        self.ranks = {self.vocab[a] << 32 | self.vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [self.vocab[a + b] for a, b in pairs]
        letters = byte_letters()
        self.inner = [self.vocab[c] for c in letters]
        self.last = [self.vocab[c + self.suffix] for c in letters]
        self._special_at = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self._quick, self._other = self._compile()

    def _kind(self, c: str) -> str:
        """Class of one character, read off the library: letter, number, space, other or unsure."""
        if self.library.normalizer.normalize_str(c) != c.lower():
            return "space" if c.isspace() and not self._split(c) else "unsure"
        low = c.lower()
        if not self._split(low):
            return "space"
        if self._split(low + low) == [low + low] and self._split("a" + low) == ["a" + low]:
            return "letter"
        if self._split("!" + low) == ["!" + low]:
            return "other"
        return "number" if self._split(low + low) == [low, low] else "unsure"

    def _split(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _compile(self) -> tuple[re.Pattern, re.Pattern]:
        kinds: dict[str, list[str]] = {}
        for i in range(LIMIT):
            kinds.setdefault(self._kind(chr(i)), []).append(chr(i))
        group = {k: "".join(map(re.escape, v)) for k, v in kinds.items()}
        letter, number, space = (group.get(k, "") for k in ("letter", "number", "space"))
        quick = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{space}{letter}{number}]+"  # the file's pattern
        )
        sure = "".join(re.escape(chr(i)) for i in range(LIMIT) if chr(i) not in kinds.get("unsure", []))
        return quick, re.compile(f"[^{sure}]")

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings, normalised."""
        if not self._other.search(text):
            return self._quick.findall(text.lower())
        return self._split(self.library.normalizer.normalize_str(text))

    def segments(self, text: str) -> Iterator[tuple[str, int | None]]:
        """(text, None) and (special string, id) in order; special strings are matched in the raw text."""
        if "<|" not in text and not any(s in text for s in self.special):
            yield text, None
            return
        for part in self._special_at.split(text):
            if part:
                yield part, self.special.get(part)

    def symbols(self, word: str) -> list[int]:
        """Start symbols of a word: its UTF-8 bytes, the last one with the end of word."""
        b = word.encode()
        return [self.inner[x] for x in b[:-1]] + [self.last[b[-1]]]


@lru_cache(maxsize=4)
def load(path: str) -> WordPieces:
    """One copy in each Python worker."""
    return WordPieces(path)


def stored(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
