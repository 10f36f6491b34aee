"""Token ids of whole texts through tables of distinct words."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable

# Entries a worker's table holds before it starts anew: a bound on memory, not on what is encoded.
TABLE_ENTRIES = 600_000

_STEM = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]*)")
_ADDED = b"<|"


def _unseen(table: dict, words: Iterable[bytes]) -> list[bytes]:
    """The words that ``table`` lacks; a full table is emptied first."""
    if len(table) > TABLE_ENTRIES:
        table.clear()
    return [w for w in words if w not in table]


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


class WordTable:
    """Ids of words, as little-endian 32-bit bytes, for a word-level BPE that drops white space.

    Such a tokenizer never joins anything across white space, so a text's ids are
    those of its words. ASCII letters are lowered first, as the tokenizer does it,
    unless the text may hold an added token, which is matched before lowering.
    """

    _open: dict[str, WordTable] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.stems: dict[bytes, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    @classmethod
    def of(cls, path: str) -> WordTable:
        """The table of this worker."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _stem(self, stem: bytes) -> bytes:
        """Lower-case Latin letters are one word to the model; nothing is left to normalize."""
        return _packed([t.id for t in self.model.tokenize(stem.decode("latin-1").translate(self.letters))])

    def _fill(self, words: set[bytes]) -> None:
        new = _unseen(self.words, words)
        # letters and the marks after them are separate tokens, most words share both
        cut = [(w, m[1], m[2]) for w in new if (m := _STEM.fullmatch(w))]
        for stem in _unseen(self.stems, {c[1] for c in cut}):
            self.stems[stem] = self._stem(stem)
        plain = [*(set(new) - {c[0] for c in cut}), *_unseen(self.words, {c[2] for c in cut if c[2]})]
        encoded = self.tokenizer.encode_batch([w.decode() for w in plain], add_special_tokens=False)
        self.words.update(zip(plain, (_packed(e.ids) for e in encoded), strict=True))
        for word, stem, marks in cut:
            self.words[word] = self.stems[stem] + self.words[marks] if marks else self.stems[stem]

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text."""
        split = [(t if _ADDED in t else t.lower()).split() for t in texts]
        self._fill(set().union(*split))
        table = self.words.__getitem__
        return [b"".join(map(table, words)) for words in split]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class PieceTable:
    """Distinct marked words of a sentencepiece model: their ids and what the ids decode to.

    No piece of the model has a white-space marker after another character, so
    no piece crosses into the next marked word. A marked word is a run of
    markers with the characters up to the next marker.
    """

    _open: dict[str, PieceTable] = {}
    _WORD = re.compile(" *[^ ]+| +$")

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece of this model crosses a white-space marker")
        self.end = b"%d" % self.model.eos_id()
        # ids and decoded text of each word, emptied together
        self.known: dict[bytes, tuple[bytes, bytes]] = {}

    @classmethod
    def of(cls, path: str) -> PieceTable:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def words(self, text: bytes) -> list[bytes]:
        """The marked words, each without its first marker; markers are blanks."""
        if b"\xe2\x96\x81" in text:
            text = text.replace(b"\xe2\x96\x81", b" ")
        if not text:
            return []
        if b"  " in text or text[:1] == b" " or text[-1:] == b" ":
            return [w[1:].encode() for w in self._WORD.findall(" " + text.decode())]
        return text.split(b" ")

    def _fill(self, words: set[bytes]) -> None:
        new = _unseen(self.known, words)
        if not self.known:
            # a marker that ends a text stands alone
            self.known[b""] = b"%d" % self.model.piece_to_id("▁"), b""
            # a table that was emptied lacks the words it had
            new = [w for w in words if w]
        if new:
            found = self.model.encode([w.decode() for w in new], num_threads=1)
            back = self.model.decode(found, num_threads=1)
            ids = (b" ".join([b"%d" % i for i in one]) for one in found)
            self.known.update(zip(new, zip(ids, (t.encode() for t in back), strict=True), strict=True))

    def texts(self, texts: list[bytes]) -> list[tuple[bytes, bytes]]:
        """Of each text: decimal ids joined by a blank, the end id last; and the text that they decode to."""
        split = [self.words(t) for t in texts]
        self._fill(set().union(*split))
        out = []
        for words in split:
            both = [self.known[w] for w in words]
            out.append((b" ".join([*(b[0] for b in both), self.end]), b" ".join([b[1] for b in both])))
        return out
