"""Encoding with the tokenizers library, one model call per distinct word.

A byte-level BPE file with the usual split pattern and no normaliser never
joins text across a single space that stands between two other non-space
characters: the pattern ends before such a space and starts anew at it.  So
a text is cut there, and each distinct piece (a word with its space) is
encoded once per Python worker and remembered.  The ids are those of the
whole text.  Files with another pre-tokeniser are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import struct
from functools import lru_cache

# Python's \s holds every space of the split pattern (and a few more, which
# only makes longer pieces)
_TWO_SPACES = re.compile(r"\s\s")
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_AFTER_LATIN = "\u0250"


def split_pieces(text: str) -> list[str]:
    """Pieces whose join with single spaces is ``text``; all but the first
    are encoded with the space before them."""
    if _TWO_SPACES.search(text):
        return _LONE_SPACE.split(text)
    return text.split(" ")


def cuts_at_spaces(tokenizer) -> bool:
    """Whether ``split_pieces`` may be used for this tokenizer."""
    spec = json.loads(tokenizer.to_str())
    pre = spec.get("pre_tokenizer") or {}
    added = tokenizer.get_added_tokens_decoder().values()
    return (spec.get("normalizer") is None and spec.get("truncation") is None and spec.get("padding") is None
            and pre.get("type") == "ByteLevel" and pre.get("use_regex", False)
            and not pre.get("add_prefix_space", True)
            and not any(a.lstrip or a.rstrip or a.single_word or a.normalized or re.search(r"\s", a.content)
                        for a in added))


class _Memo(dict):
    """What ``make`` gives for a text, remembered up to ``limit`` bytes.

    When a generation is full, the next one begins; the full one is still
    asked once for each text and then dropped.  Texts beyond ``LONGEST``
    characters are made anew each time."""

    LONGEST = 128

    def __init__(self, make, limit: int):
        super().__init__()
        self._make, self._limit, self._older, self._bytes = make, limit // 2, {}, 0

    def __missing__(self, text: str):
        found = self._older.get(text)
        if found is None:
            found = self._make(text)
            if len(text) > self.LONGEST:
                return found
        self[text] = found
        # two objects with their headers, their contents, and a place in the table
        self._bytes += 200 + 2 * len(text) + (len(found) if isinstance(found, bytes) else 0)
        if self._bytes > self._limit:
            self._older, self._bytes = dict(self), 0
            self.clear()
        return found


class PieceEncoder:
    """Token ids of texts as bytes (unsigned integers, little endian).

    A piece is made of words of the library's split pattern; where all its
    characters are Latin (``_AFTER_LATIN``), whose classes are asked of the
    library once, the split is done here and only words reach the library's
    model.  Pieces and words are remembered, ``limit`` bytes of each.
    """

    def __init__(self, path: str, dtype: str = "<u4", limit: int = 256 << 20):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the parallelism
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._piecewise = cuts_at_spaces(self._tokenizer)
        self._split, self._model = self._tokenizer.pre_tokenizer, self._tokenizer.model
        added = [re.escape(a.content) for a in self._tokenizer.get_added_tokens_decoder().values()]
        self._special = re.compile("|".join(added)) if added else None
        # without one of these characters there is no added token
        self._mark = {a.content[0] for a in self._tokenizer.get_added_tokens_decoder().values()}
        self._code = {"<u2": "H", "<u4": "I"}[dtype]
        self._words = _Memo(self._word, limit)
        self._pieces = _Memo(self._piece, limit)
        self._plain = False
        if self._piecewise:
            self._learn_latin()

    def _learn_latin(self) -> None:
        """The library's byte alphabet and classes of the Latin characters."""
        split = self._split.pre_tokenize_str
        latin = [chr(c) for c in range(ord(_AFTER_LATIN))]
        self._alphabet = {ord(c): "".join(w for w, _ in split(c)) for c in latin}
        kinds: dict[str, set[str]] = {"letter": set(), "number": set(), "space": set(), "other": set()}
        for c in latin:
            if len(split(f"a{c}")) == 1:
                kind = "letter"
            elif len(split(f"1{c}")) == 1:
                kind = "number"
            else:  # only another space takes the space before it away from the word behind
                kind = "other" if len(split(f"!{c}")) == 1 else "space"
            kinds[kind].add(c)
        letter, number, space = ("".join(map(re.escape, sorted(kinds[k]))) for k in ("letter", "number", "space"))
        self._plain = all(c.isalpha() == (c in kinds["letter"]) for c in latin)
        self._marks = {c: self._pack(self.ids(c)) for c in ".,"}
        self._pattern = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
                                   f"|[{space}]+(?![^{space}])|[{space}]+")

    def ids(self, text: str) -> list[int]:
        """Ids of one piece, by the library's own splitter and model."""
        if not self._piecewise or self._special is not None and self._special.search(text):
            return self._tokenizer.encode(text, add_special_tokens=False).ids
        out: list[int] = []
        for word, _ in self._split.pre_tokenize_str(text):
            out += [t.id for t in self._model.tokenize(word)]
        return out

    def _pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self._code}", *ids)

    def _word(self, word: str) -> bytes:
        """Bytes of one Latin word of the split pattern."""
        return self._pack([t.id for t in self._model.tokenize(word.translate(self._alphabet))])

    def _text(self, text: str) -> bytes:
        """Bytes of a text with all its spaces."""
        if self._piecewise and (text.isascii() or max(text) < _AFTER_LATIN) and self._mark.isdisjoint(text):
            return self._join(map(self._words.__getitem__, self._pattern.findall(text)))
        return self._pack(self.ids(text))

    def _piece(self, piece: str) -> bytes:
        """Bytes of " " + piece.  Letters are one word, and a full stop or
        comma behind them another: most pieces need no split."""
        if self._plain:
            mark = self._marks.get(piece[-1:])
            letters = piece if mark is None else piece[:-1]
            if letters.isalpha() and self._mark.isdisjoint(piece) and (piece.isascii() or max(piece) < _AFTER_LATIN):
                if mark is not None:
                    return self._pieces[letters] + mark
                plain = piece if piece.isascii() else piece.translate(self._alphabet)
                return self._pack([t.id for t in self._model.tokenize(self._alphabet[32] + plain)])
        return self._text(" " + piece)

    def _join(self, coded) -> bytes:
        return b"".join(coded)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, without added special tokens; null counts as empty."""
        if not self._piecewise:
            return [self._pack(self.ids(t or "")) for t in texts]
        find, out = self._pieces.__getitem__, []
        for text in texts:
            head, *rest = split_pieces(text or "")
            out.append((self._text(head) if head else b"") + b"".join(map(find, rest)))
        return out


@lru_cache(2)
def shared_encoder(path: str, dtype: str = "<u4") -> PieceEncoder:
    """One encoder per Python worker: its memo serves all the worker's tasks."""
    return PieceEncoder(path, dtype)
