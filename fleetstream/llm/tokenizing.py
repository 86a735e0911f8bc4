"""Token ids of whole texts, from a tokenizer file that is given as a path.

The tokenizers split a text at white space before they merge anything, so what lies
between gets the same ids in every text (with a blank before it or without). Such pieces
repeat: their ids are kept in a bounded table per Python worker, and only pieces that are
not in it go through the library. Texts for which the split could depend on a
neighbouring piece are encoded whole.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array

import numpy as np

from fleetstream.llm.storage import KEPT

# The characters that the tokenizers' patterns take as white space.
WHITE = (
    "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_PIECES = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_UNUSUAL = re.compile(f"[{WHITE.replace(' ', '').replace(chr(10), '')}]")
_RUNS = ("  ", " \n", "\n ", "\n\n")
#: Before the key of a piece that has no blank in front, twice if it is white space.
_BARE = "\0"
#: As byte-level tokens have a blank.
_BLANK = "\u0120"
_LINE_END = _BARE + _BARE + "\n"
#: A capital whose lower case is a letter and a mark, which can join the next piece.
_SPLITTING_CAPITAL = "İ"
#: Marks after a word, which no token joins to it.
_ENDS = frozenset(".,!?;:")


class TextTokenizer:
    """packed(texts) as ``tokenizers`` gives the ids, adding no special tokens.

    ``remembered`` bounds the table of known pieces: two generations of that many. Each begins
    with the pieces that an earlier one has met again first, ``close_by`` of them.
    """

    def __init__(self, path: str, remembered: int = 600_000, close_by: int = 50_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # The library finds these strings in a text before it splits the rest.
        added = self._tokenizer.get_added_tokens_decoder()
        self._between = self._separator(added)
        self._added = [t.content.lower() for t in added.values()]
        self._marks = {t[0] for t in self._added}
        self._normalizes = self._tokenizer.normalizer is not None
        self._border, self._at_end = self._borders()
        # A blank between two pieces could make such a token.
        self._blank_added = any(c in WHITE for t in added.values() for c in t.content)
        self._remembered = remembered
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._again: dict[str, bytes] = {}
        self._close_by = min(close_by, remembered // 4)
        self._ends = {end: self._encoded([end])[0] for end in _ENDS}

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    @staticmethod
    def _separator(added: dict) -> tuple[str, int] | None:
        """An added token and its id, which the library finds wherever it is put between two
        pieces, and which with neither makes up another added token."""
        for found, token in added.items():
            text, others = token.content, [t.content for t in added.values()]
            if not (
                token.normalized or token.lstrip or token.rstrip or token.single_word
                or any(text[0] in x[1:] or x[0] in text[1:] for x in others)
            ):
                return text, found
        return None

    def _borders(self) -> tuple[np.ndarray, bool]:
        """Per id whether its token begins with a blank, or ends a word if the file marks these
        (then the second value is true)."""
        end = getattr(self._tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self._tokenizer.get_vocab()
        border = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        border[
            [i for t, i in vocabulary.items() if (t.endswith(end) if end else t[:1] == _BLANK)]
        ] = True
        return border, bool(end)

    def _encoded_beside(self, words: list[str], others: list[str]) -> list[bytes]:
        """As ``_encoded``, of both in one call. ``words`` are pieces with a blank before them,
        which are put next to each other and split where a piece must begin or end. If that
        doesn't give each of them its ids, they are encoded apart."""
        if not words or self._blank_added:
            return self._encoded_apart(words + others)
        first, *rest = self._encoded_apart(["".join(words), *others])
        ids = np.frombuffer(first, dtype=np.uint32)
        at = np.flatnonzero(self._border[ids])
        at = np.append(0, at + 1) if self._at_end else np.append(at, len(ids))
        if len(at) != len(words) + 1 or at[0] != 0 or at[-1] != len(ids):
            return self._encoded_apart(words) + rest
        cuts = (4 * at).tolist()
        return [first[i:j] for i, j in zip(cuts, cuts[1:])] + rest

    def _encoded_apart(self, pieces: list[str]) -> list[bytes]:
        """As ``_encoded``, of pieces without added tokens: in one call, since the library takes
        longer for a call's frame than for a piece."""
        if not self._between or not pieces:
            return self._encoded(pieces)
        between, mark = self._between
        ids = np.frombuffer(self._encoded([between.join(pieces)])[0], dtype=np.uint32)
        at = np.flatnonzero(ids == mark)
        if len(at) != len(pieces) - 1:
            return self._encoded(pieces)
        raw, cuts = ids.tobytes(), (4 * at).tolist()
        return [raw[i:j] for i, j in zip([0, *[c + 4 for c in cuts]], [*cuts, len(raw)])]

    def _keys(self, text: str) -> list[str]:
        """Of single blanks and line ends between pieces.

        A key with ``_BARE`` stands for itself, any other for itself with a blank before.
        """
        if self._normalizes:
            # White space is dropped, and case does not matter where it is plain.
            lower = text.lower()
            if text.isascii() or "Σ" not in text and unicodedata.is_normalized("NFC", lower):
                text = lower
            return text.replace("\n", " ").split(" ")
        keys = text.split(" ") if "\n" not in text else []
        for line in text.split("\n") if not keys else ():
            begin = len(keys)
            keys += line.split(" ")
            keys[begin] = _BARE + keys[begin]
            keys.append(_LINE_END)
        if keys[-1] == _LINE_END:
            keys.pop()
        else:
            keys[0] = _BARE + keys[0]
        return keys

    @staticmethod
    def _plain(text: str) -> bool:
        """Whether white space is one blank or line end between two pieces everywhere."""
        return not (
            text[0] in WHITE
            or text[-1] in WHITE
            or any(run in text for run in _RUNS)
            or _UNUSUAL.search(text)
        )

    def _odd_keys(self, text: str) -> list[str]:
        """Of any white space: its last character is split off before a piece."""
        keys = []
        for piece in _PIECES.findall(text):
            word = piece.lstrip(WHITE)
            space = piece[: len(piece) - len(word)]
            if self._normalizes or not word:
                keys.append(_BARE + word if word else _BARE + _BARE + space)
                continue
            last = space[-1:]
            if len(space) > 1:
                keys.append(_BARE + _BARE + space[:-1])
            if last == " ":
                keys.append(word)
            else:
                keys += [_BARE + _BARE + last, _BARE + word] if last else [_BARE + word]
        return keys

    def _learn(self, keys: list[str]) -> None:
        """Make every key known, or its part before a closing mark."""
        new, old, again, unseen, odd = self._new, self._old, self._again, [], []
        for key in dict.fromkeys(
            [k[:-1] if k[-1] in _ENDS and k[1:-1].isalpha() else k for k in keys]
        ):
            if key in new:
                continue
            known = old.get(key)
            if known is not None:
                new[key] = known
                if len(again) < self._close_by:
                    again[key] = known
            elif key.isalpha() if self._at_end else key[0] != _BARE:
                unseen.append(key)
            else:
                odd.append(key)
        words = [" " + k for k in unseen]
        others = [k.lstrip(_BARE) if k[0] == _BARE else " " + k for k in odd]
        new.update(zip(unseen + odd, self._encoded_beside(words, others)))

    def rest(self) -> None:
        """Forget the older pieces, at the end of a task."""
        self._old = {}

    def _has_added(self, text: str) -> bool:
        """Whether a token stands in the text as such, in any case."""
        if not any(mark in text for mark in self._marks):
            return False
        lower = text.lower()
        return any(token in lower for token in self._added)

    def packed(self, texts: list[str | None]) -> list[bytes]:
        """Per text the ids as little-endian unsigned 32-bit integers; null is empty."""
        if len(self._new) > self._remembered:
            self._old, self._new = self._new, dict(self._again)
        known, ends = self._new, self._ends
        out: list[bytes] = [b""] * len(texts)
        found: dict[int, list] = {}
        missing: list[tuple[list, int, str]] = []
        for i, text in enumerate(texts):
            if not text:
                continue
            if self._has_added(text):
                out[i] = self._encoded([text])[0]
                continue
            if _BARE in text or self._normalizes and (
                _SPLITTING_CAPITAL in text
                or not (text.isascii() or unicodedata.is_normalized("NFC", text))
            ):
                out[i] = self._encoded([text])[0]
                continue
            keys = self._keys(text) if self._plain(text) else self._odd_keys(text)
            ids = found[i] = list(map(known.get, keys))
            if None in ids:
                missing += [(ids, k, keys[k]) for k, x in enumerate(ids) if x is None]
        self._learn([key for _, _, key in missing])
        for ids, k, key in missing:
            x = known.get(key)
            if x is None:
                x = known[key] = known[key[:-1]] + ends[key[-1]]
            ids[k] = x
        for i, ids in found.items():
            out[i] = b"".join(ids)
        return out


def tokenizer(path: str) -> TextTokenizer:
    """One tokenizer and one table per Python worker and file, until the worker has a task
    of another kind."""
    if path not in KEPT:
        KEPT[path] = TextTokenizer(path)
    return KEPT[path]
