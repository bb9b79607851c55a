"""Token ids of whole texts with a public tokenizer, by pieces that are encoded once.

Both vocabularies here split a text before merging, and always at a single space or line feed, so a
text's ids are the ids of its pieces in order: what follows a space, and the line feed with what
follows it. A worker encodes each distinct piece once and joins the stored ids. Words of letters alone are learned
TOGETHER at a time, as one text, and told apart by the tokens that begin or end a word; words with signs of TAIL
after them are the ids of the word and those of the signs. Memory is bounded: of two generations of pieces the older is
forgotten when the newer has PIECES of them.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable

import numpy as np

PIECES = 800_000
TOGETHER = 4096
TAILS = 10_000
# Fixed value: signs after words.
TAIL = ".,;:!?\"')]}"
# In texts with other white space than single spaces and line feeds between words, a piece begins
# at a space before a word.
_CUT = re.compile(r" (?=\S)")


def largest_id(path: str) -> int:
    """The largest id of a vocabulary file, added tokens included; -1 without any."""
    from tokenizers import Tokenizer
    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values(), default=-1)


class PieceEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, keeps_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.lead = " " if keeps_space else ""
        # How tokens that begin with a space, and those at the end of a word, are spelled.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.border = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
        self.border[[i for t, i in vocabulary.items() if (t.startswith("\u0120") if keeps_space else t.endswith("</w>"))]] = True
        self.tails: dict[str, bytes] = {}
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> None:
        words, tailed, others = set(), [], []
        for piece in pieces:
            ids = self.old.get(piece)
            if ids is not None:
                self.new[piece] = ids
                continue
            word = piece.rstrip(TAIL)
            if word.isalpha() and (word == piece or max(word) < "\u0300"):
                if word not in self.new:
                    words.add(word)
                if word != piece:
                    tailed.append((piece, word))
            else:
                others.append(piece)
        for some, encoded in ((list(words), self._together), (others, self._plain)):
            for i in range(0, len(some), TOGETHER):
                part = some[i:i + TOGETHER]
                self.new.update(zip(part, encoded([p if p[:1] == "\n" else self.lead + p for p in part])))
        for piece, word in tailed:
            self.new[piece] = self.new[word] + self._tail(piece[len(word):])

    def _tail(self, signs: str) -> bytes:
        if signs not in self.tails:
            if len(self.tails) >= TAILS:
                self.tails = {}
            self.tails[signs], = self._plain([signs])
        return self.tails[signs]

    def _plain(self, texts: list[str]) -> list[bytes]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return [struct.pack(f"<{len(i)}I", *i) for i in ids]

    def _together(self, words: list[str]) -> list[bytes]:
        """As `_plain`, of words of letters; one by one where a vocabulary sees more than one word in some."""
        joined, = self.tokenizer.encode_batch_fast([("" if self.lead else " ").join(words)], add_special_tokens=False)
        ids = np.array(joined.ids, "<u4")
        at = np.flatnonzero(self.border[ids])
        cuts = np.r_[at, len(ids)] if self.lead else np.r_[0, at + 1]
        if len(cuts) != len(words) + 1 or cuts[0] or cuts[-1] != len(ids):
            return self._plain(words)
        data, cuts = ids.tobytes(), (4 * cuts).tolist()
        return [data[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def encode(self, text: str, end: int) -> bytes:
        even = " ".join(text.split()) == text.replace("\n", " ")
        pieces = text.replace("\n", " \n").split(" ") if even else _CUT.split(text)
        # The first piece has no space before it.
        head = self._plain([pieces.pop(0)]) if self.lead else []
        if len(self.new) > PIECES:
            self.old, self.new = self.new, {}
        unknown = set(pieces).difference(self.new)
        if unknown:
            self._learn(unknown)
        return b"".join([*head, *map(self.new.__getitem__, pieces), int(end).to_bytes(4, "little")])


_encoders: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, keeps_space: bool) -> PieceEncoder:
    """The worker's own encoder; it is kept from task to task."""
    key = (path, keeps_space)
    if key not in _encoders:
        _encoders[key] = PieceEncoder(path, keeps_space)
    return _encoders[key]


def encode_all(texts: Iterable[str | None], path: str, keeps_space: bool, end: int) -> Iterable[bytes]:
    own = encoder(path, keeps_space)
    for text in texts:
        yield own.encode(text or "", end)
