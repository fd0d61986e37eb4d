"""Encoding whole texts with a tokenizer file, segment by segment.

Both vocabularies in use split a text at white space, and between letters and
punctuation, before any merge, so a text's ids are the ids of its segments in a
row.  Segments repeat: each worker keeps a bounded table of their ids and asks
the tokenizer only for new ones.  Vocabularies without a known rule encode whole
texts, and so is a text that holds the string of a special token, which is cut out
before anything else.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable
from itertools import chain

import numpy as np

#: The characters with the Unicode property White_Space.
WHITE_SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
LATIN = "A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff"
#: A run of letters before white space, ASCII punctuation (the apostrophe apart) or the end is a segment.
_LETTERS = rf"[{LATIN}]++(?![^{WHITE_SPACE}!-&(-/:-@\[-`{{-~])"
#: Segments of a generation that a worker remembers, and the longest of them in characters.  When a generation is
#: full it becomes the old one, from which segments that are met again are taken over; the one before goes.  A
#: generation is about 80 MB, of which a worker holds at most two, also while other stages use them.
KEPT_SEGMENTS, KEPT_LENGTH = 500_000, 40
#: Segments encoded in one call, with a separator between them.
JOINED = 512


class Encoder:
    """Ids of whole texts; subclasses say how a text may be cut."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.kept: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ask(self, segments: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(segments, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as unsigned 32-bit integers in native byte order."""
        return self._ask(texts)


class SegmentEncoder(Encoder):
    cut: Callable[[str], list[str]]
    #: Stands between segments that are encoded together, and gives an id that no segment without it has.
    separator: str

    def __init__(self, path: str):
        super().__init__(path)
        self.separator_id = self.tokenizer.encode(f"a{self.separator}b", add_special_tokens=False).ids[1]

    def _alone(self, segment: str) -> bool:
        return self.separator in segment

    def _learn(self, segments: list[str]) -> dict[str, bytes]:
        """Ids of new segments; those too long to keep are returned."""
        long: dict[str, bytes] = {}
        alone = [s for s in segments if len(s) > KEPT_LENGTH or self._alone(s)]
        if alone:
            for s, ids in zip(alone, self._ask(alone), strict=True):
                (self.kept if len(s) <= KEPT_LENGTH else long)[s] = ids
            skip = set(alone)
            segments = [s for s in segments if s not in skip]
        for at in range(0, len(segments), JOINED):
            some = segments[at:at + JOINED]
            ids = np.array(self.tokenizer.encode_batch_fast([self.separator.join(some)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(ids == self.separator_id)
            if len(ends) + 1 != len(some):  # not cut as expected: ask for each
                self.kept.update(zip(some, self._ask(some), strict=True))
                continue
            raw, from_ = ids.tobytes(), [0, *(4 * ends + 4).tolist()]
            to = [*(4 * ends).tolist(), len(raw)]
            self.kept.update(zip(some, [raw[a:b] for a, b in zip(from_, to, strict=True)], strict=True))
        return long

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.kept) > KEPT_SEGMENTS:
            self.old, self.kept = self.kept, {}
        whole = [i for i, text in enumerate(texts) if any(s in text for s in self.special)]
        if whole:
            out = self.encode([text for i, text in enumerate(texts) if i not in set(whole)])
            for i, ids in zip(whole, self._ask([texts[i] for i in whole]), strict=True):
                out.insert(i, ids)
            return out
        rows = [self.cut(text) for text in texts]
        new = set(chain.from_iterable(rows)).difference(self.kept)
        if self.old:
            again = new & self.old.keys()
            self.kept.update({s: self.old[s] for s in again})
            new -= again
        long = self._learn(sorted(new)) if new else {}
        get = self.kept.__getitem__
        if long:
            kept = self.kept
            return [b"".join([kept[s] if s in kept else long[s] for s in row]) for row in rows]
        return [b"".join(map(get, row)) for row in rows]


class WordEncoder(SegmentEncoder):
    """White space is dropped: words, and the marks after them, are the segments."""

    separator = " \x01 "
    cut = staticmethod(re.compile(f"{_LETTERS}|[^{WHITE_SPACE}]+").findall)

    def _alone(self, segment: str) -> bool:
        return "\x01" in segment


class SpacedEncoder(SegmentEncoder):
    """Words carry one leading space; other white space stands alone, but for a last space before a word."""

    separator = "\n"
    cut = staticmethod(re.compile(f" ?{_LETTERS}| ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+").findall)

    def _alone(self, segment: str) -> bool:
        return segment.isspace()


#: How texts may be cut, by vocabulary file.
ENCODERS: dict[str, type[Encoder]] = {"word_bpe_49k.json": WordEncoder, "byte_bpe_50k.json": SpacedEncoder}

_made: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file, kept between tasks."""
    if path not in _made:
        _made[path] = ENCODERS.get(os.path.basename(path), Encoder)(path)
    return _made[path]


def encode(path: str, texts: list[str], end_id: int) -> list[np.ndarray]:
    """The ids of each text, followed by ``end_id``."""
    end = array("I", [end_id]).tobytes()
    return [np.frombuffer(ids + end, np.uint32) for ids in encoder(path).encode(texts)]
