"""Token ids from the public ``tokenizers`` files, inside Arrow tasks."""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

#: White space besides the blank and the line feed, in the widest reading of any engine.
_OTHER_WHITE = re.compile(r"[^\S \n]")
#: Latin letters, which no normalizer joins or parts, before a word's end or the characters of ``_MARKS`` up to there.
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]++"
#: ASCII characters that are neither letters, digits, white space nor the apostrophe.
_MARKS = r"[!-&(-/:-@\[-`{-~]"
_WORD = rf"{_LETTERS}(?={_MARKS}*+(?:[ \n]|\Z))"
#: A line feed between other characters; or a run of blanks and line feeds and the letters or the characters up to the next one.
_WITH_WHITE = re.compile(rf"\n(?=[^ \n])|[ \n]*{_WORD}|[ \n]*[^ \n]+|[ \n]+")
_WITHOUT_WHITE = re.compile(rf"{_WORD}|[^ \n]+")
#: A blank and then no white space: after another such cutting it is read as it is alone.
_AFTER_BLANK = re.compile(r" \S+")
_ONE_WORD = re.compile(_LETTERS)
_CAPITALS = "".join(chr(c) for c in range(256) if chr(c) != chr(c).lower())


def _latin(text: str) -> bool:
    return text.isascii() or len(text.encode("latin-1", "ignore")) == len(text)


class Encoder:
    """Whole texts to ids, each as the bytes of little-endian unsigned 32-bit numbers.

    Neither kind of tokenizer lets a token reach over the start of a white-space run, so a text is cut
    there, and between Latin letters and the marks that end a word, which no token holds together either, and every
    distinct cutting is encoded once by the library and remembered:

    - ``blanks="kept"`` (byte-level BPE): a cutting starts with its white space. A text with
      white space other than blanks and line feeds is encoded in one piece instead, because a
      mixed run is read as one.
    - ``blanks="dropped"`` (word BPE): cuttings are the runs between blanks and line feeds. Texts of Latin-1
      characters are lower-cased before, if the tokenizer does that itself.

    The memory has two generations of about ``most`` cuttings: when the young one is full, it becomes the
    old one, from which cuttings in use come back. Results don't depend on it.
    Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str, blanks: str, most: int = 300_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # cores are Spark's to share out
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.blanks, self.most = blanks, most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        normal = self.tokenizer.normalizer
        self.lower = blanks == "dropped" and normal is not None and normal.normalize_str(_CAPITALS) == _CAPITALS.lower()
        known = self.tokenizer.get_vocab()
        #: How many bytes, or ends of words, each id stands for.
        self.weight = np.zeros(1 + max(known.values()), np.int64)
        self.weight[list(known.values())] = [len(t) if blanks == "kept" else t.endswith("</w>") for t in known]

    def cuttings(self, text: str) -> list[str]:
        if self.blanks == "dropped":
            return _WITHOUT_WHITE.findall(text.lower() if self.lower and _latin(text) else text)
        if _OTHER_WHITE.search(text):
            return [text]
        return _WITH_WHITE.findall(text)

    def together(self, joined: str, weights: list[int]) -> list[bytes] | None:
        """The ids of a text, cut after each of ``weights``; None if no id ends there."""
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        upto, wanted = np.cumsum(self.weight[ids]), np.cumsum(weights)
        if not len(ids) or upto[-1] != wanted[-1]:
            return None
        after = np.searchsorted(upto, wanted) + 1
        if (upto[after - 1] != wanted).any():
            return None
        data, places = ids.tobytes(), (4 * after).tolist()
        return [data[a:b] for a, b in zip([0, *places], places, strict=False)]

    def each(self, cuttings: list[str]) -> list[bytes]:
        """The ids of each cutting. The library is given many in one text, and they are told apart by the bytes that ids
        stand for, or by the ids that end words; other words by a digit between them that none of them has: a token of
        its own, so the words' ids lie between its places."""
        out: dict[str, bytes] = {}
        if self.blanks == "kept":
            plain = [c for c in cuttings if _AFTER_BLANK.fullmatch(c)]
            found = self.together("".join(plain), [len(c.encode()) for c in plain]) if plain else None
        else:
            plain = [c for c in cuttings if _ONE_WORD.fullmatch(c)]
            found = self.together(" ".join(plain), [1] * len(plain)) if plain else None
        if found:
            out = dict(zip(plain, found, strict=True))
        lone = [c for c in cuttings if c not in out]
        if self.blanks == "dropped":
            joined = [c for c in lone if "0" not in c]
            mark = self.tokenizer.encode("0", add_special_tokens=False).ids
            ids = np.array(self.tokenizer.encode_batch_fast([" 0 ".join(joined)], add_special_tokens=False)[0].ids, "<u4")
            places = 4 * np.flatnonzero(ids == mark[0])
            if len(mark) == 1 and len(places) == len(joined) - 1:
                data = ids.tobytes()
                spans = zip([0, *(places + 4).tolist()], [*places.tolist(), len(data)], strict=True)
                out |= {c: data[a:b] for c, (a, b) in zip(joined, spans, strict=True)}
                lone = [c for c in lone if c not in out]
        for c, e in zip(lone, self.tokenizer.encode_batch_fast(lone, add_special_tokens=False), strict=True):
            out[c] = np.array(e.ids, "<u4").tobytes()
        return [out[c] for c in cuttings]

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.cuttings(t) for t in texts]
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        unseen = []
        for c in set().union(*cut).difference(young):
            if c in old:
                young[c] = old[c]
            else:
                unseen.append(c)
        for at in range(0, len(unseen), 1024):
            some = unseen[at : at + 1024]
            young.update(zip(some, self.each(some), strict=True))
        return [b"".join(map(young.__getitem__, cuts)) for cuts in cut]


@lru_cache(maxsize=4)
def encoder(path: str, blanks: str) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(path, blanks)
