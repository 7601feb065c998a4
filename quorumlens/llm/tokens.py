"""Tokenizer files of the tokenizers library inside tasks: pieces of text encoded once per worker.

A pre-tokenizer cuts a text into pieces that are encoded independently of each other.  ``pieces`` makes the
same cuts for plain texts (Latin letters, digits, common punctuation, blanks and line ends), and each distinct
piece goes to the library once per worker process.  A text with any other character is given to the library
whole, so results are the library's own in either case.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces in a worker's young generation; when it is full it becomes the old one, and the old one is forgotten.
REMEMBERED = 380_000
#: Characters on which this module and the library might cut differently: such texts go to the library whole.
UNUSUAL = re.compile("[\x00-\x08\x0b-\x1f\x7f-\xa0\xb2\xb3\xb9\xbc-\xbeİɐ-\U0010ffff]")
#: The cuts of the two tokenizer families, for the characters let through by UNUSUAL.
BYTE_LEVEL = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: A full stop or comma next to another mark: there they belong to one piece with it.
MARK_RUN = re.compile(r"[.,](?:[^\w\s]|_)|(?:[^\w\s]|_)[.,]")
OTHER_MARK = re.compile(r"[^\w\s.,]|_")
#: ASCII characters as MARK_RUN tells them apart: full stops and commas, other marks, and the rest.
MARKS = bytes(46 if chr(c) in ".," else 45 if c < 128 and OTHER_MARK.match(chr(c)) else 32 for c in range(256))
WORD_TAIL = re.compile(r"([^\W\d_]+)((?:[^\w\s']|_)+)\Z")

_LOADED: dict[str, "Pieces"] = {}


def load(path: str) -> "Pieces":
    """The worker's encoder for a tokenizer file, loaded once per process."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


class Pieces(dict):
    """piece -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.lowers = self.tokenizer.normalizer is not None
        self.ends = None
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.age()
        if piece in self.old:
            self[piece] = found = self.old[piece]
            return found
        tail = WORD_TAIL.match(piece) if self.lowers else None
        if tail:  # letters and the marks after them are cut apart anyway
            found = self[tail[1]] + self[tail[2]]
        else:
            found = self.by_library(piece)
        self[piece] = found
        return found

    def age(self) -> None:
        self.old = dict(self)
        self.clear()

    def by_library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def plain(self, text: str) -> bool:
        return not (UNUSUAL.search(text) or any(s in text for s in self.special))

    def encode_words(self, texts: list[str]) -> list[bytes]:
        """For a tokenizer that lowers case, drops white space and marks word ends: words are independent.

        The new words of these texts go to the library as one text, whose ids are cut again at word ends.
        """
        plain = [self.plain(t) for t in texts]
        split = pc.ascii_split_whitespace(
            pa.array([self.spaced(t) if ok else "" for t, ok in zip(texts, plain)], pa.string())
        )
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [w for w in distinct if w not in self]
        unknown = [w for w in new if w not in self.old]
        cores = {m[1] if not w.isalpha() and (m := WORD_TAIL.match(w)) else w for w in unknown}
        cores = [w for w in cores if w.isalpha() and w not in self and w not in self.old]
        if len(self) + len(new) + len(cores) >= REMEMBERED:
            self.age()
        self.update({w: self.old[w] for w in new if w in self.old})
        if cores:
            if self.ends is None:
                self.ends = np.array(
                    [self.tokenizer.id_to_token(i).endswith("</w>") for i in range(self.tokenizer.get_vocab_size())]
                )
            ids = np.array(self.tokenizer.encode(" ".join(cores), add_special_tokens=False).ids, "<u4")
            at = [0, *(np.flatnonzero(self.ends[ids]) + 1).tolist()]
            if len(at) == len(cores) + 1:
                raw = ids.tobytes()
                for w, a, b in zip(cores, at, at[1:]):
                    self[w] = raw[4 * a : 4 * b]
        # Each distinct word is looked up once; its ids are then laid out wherever it stands.
        found = list(map(self.__getitem__, distinct))
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        word = coded.indices.to_numpy(zero_copy_only=False)
        n = size[word]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat((np.cumsum(size) - size)[word] - ends[:-1], n) + np.arange(ends[-1])]
        cut = ends[split.offsets.to_numpy()].tolist()
        return [
            ids[a:b].tobytes() if ok else self.by_library(t) for t, ok, a, b in zip(texts, plain, cut, cut[1:])
        ]

    @staticmethod
    def spaced(text: str) -> str:
        """A plain text in lower case with blanks between its words."""
        text = text.lower()
        if text.isascii():
            marks = text.encode().translate(MARKS)
            runs = b".." in marks or b".-" in marks or b"-." in marks
        elif OTHER_MARK.search(text):
            runs = MARK_RUN.search(text)
        else:
            runs = ".." in text or ",," in text or ".," in text or ",." in text
        if not runs:  # marks that stand alone are pieces of their own
            text = text.replace(".", " . ").replace(",", " , ")
        return text

    def byte_table(self) -> list[bytes]:
        """id -> the bytes that it stands for (byte-level vocabularies)."""
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        back = {chr(b): b for b in keep} | {chr(256 + n): b for n, b in enumerate(sorted({*range(256)} - {*keep}))}
        table = []
        for i in range(self.tokenizer.get_vocab_size()):
            token = self.tokenizer.id_to_token(i)
            known = all(c in back for c in token)
            table.append(bytes(back[c] for c in token) if known else token.encode())
        return table
