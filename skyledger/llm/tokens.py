"""Token ids of whole texts by a public tokenizer file, inside Arrow batches.

Encoding cost is per word not met before, and words repeat. A text is cut at single spaces and single line breaks between two
characters that aren't white space; the tokenizers used here never join characters across such
a cut, so the ids of a text are the ids of its parts in order (the tests compare with whole
texts). A text that spells a control token is encoded whole, as the library looks for those before anything else.

Each Python worker keeps the words it has met with their ids, in two generations: when the newer one is full it becomes the older
one, and what was in the older one and not met since is forgotten. So frequent words stay, however much text goes by.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words in a generation; two of them take about 200 MB.
REMEMBERED = 500_000
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: A run of letters, then punctuation that every tokenizer here splits from it and keeps in one piece.
#: Ids put in their places at once.
AT_ONCE = 1 << 20
#: Bytes of text to encode at once: the more, the more often a word repeats; a hundred MB are held for these.
TEXT_AT_ONCE = 8_000_000
_MARKS = "-.,;:!?%&$*#|"
_WORD = re.compile(rf"([^\W\d_]+)([{_MARKS}]*)")
#: Ids of a part that begins or ends with white space and so isn't one to cut at.
_UNCUT = b"-"
_ENCODERS: dict[str, Encoder] = {}


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if it can be seen, else the next free one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    unseen = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(unseen)}


class Encoder:
    """Ids of texts as bytes, four little-endian bytes an id; those of the library's plain ``encode`` without special tokens."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a worker for each core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.controls = [token.content for token in self.model.get_added_tokens_decoder().values()]
        self.merge = self.model.model.tokenize
        self.words: dict[str, bytes] = {}  # of letters only
        self.older: dict[str, bytes] = {}
        self.others: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}
        self.letters = byte_letters()
        self.prefix = self._prefix()
        self.newline = self.ids("x\ny")[len(self.ids("x")) : -len(self.ids("y"))]
        self.normalize = self.model.normalizer.normalize_str if self.model.normalizer else None

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def ids(self, text: str) -> bytes:
        return array("I", self.model.encode(text, add_special_tokens=False).ids).tobytes()

    def _prefix(self) -> str:
        """What the vocabulary writes for the space before a word."""
        joined = "".join(self.model.encode(" zq", add_special_tokens=False).tokens)
        return joined[: joined.index("zq")]

    def _word(self, letters: str, led: str) -> bytes | None:
        """Ids of ``led`` (a space or nothing) and letters: the model's merges alone, on the vocabulary's spelling.

        None if the spelling holds more than letters, as that of a dotted capital I does: what follows may belong to it.
        """
        plain = letters
        if self.normalize is not None:
            plain = letters.lower() if letters.isascii() else self.normalize(letters)
        if not plain.isascii():
            if not plain.isalpha():
                return None
            plain = plain.encode().decode("latin-1").translate(self.letters)
        return array("I", [token.id for token in self.merge(self.prefix + plain if led else plain)]).tobytes()

    def _marks(self, marks: str) -> bytes:
        """Ids of punctuation after letters."""
        found = self.marks.get(marks)
        if found is None:
            found = self.marks[marks] = self.ids("x" + marks)[len(self.ids("x")) :]
        return found

    def _known(self, part: str, led: str) -> bytes:
        """Ids of a part after a space (``led``) or at a line's start, or the mark that the part isn't one to cut at.

        Words are remembered by their letters alone, those at a line's start with a space before them; punctuation after
        them is put on each time, as most words with punctuation come once.
        """
        if led and "\n" in part:
            return self._lines(part, led)
        word = _WORD.fullmatch(part)
        if word is not None:
            letters = word[1] if led else " " + word[1]
            ids = self.words.get(letters)
            if ids is None:
                ids = self.older.get(letters)
                ids = self._word(word[1], led) if ids is None else ids
                if ids is not None:
                    self.words[letters] = ids
            if ids is not None:
                return ids + self._marks(word[2]) if word[2] else ids
        key = led + part
        ids = self.others.get(key)
        if ids is None:
            ids = self.ids(key) if part and not part[0].isspace() and not part[-1].isspace() else _UNCUT
            self.others[key] = ids
        return ids

    def _lines(self, part: str, led: str) -> bytes:
        """Ids of a part with line breaks in it, which is seldom met again as a whole."""
        pieces = part.split("\n")
        found = [self._known(pieces[0], led), *[self._known(piece, "") for piece in pieces[1:]]]
        if _UNCUT not in found:
            return self.newline.join(found)
        return _UNCUT if not part or part[0].isspace() or part[-1].isspace() else self.ids(led + part)

    def __call__(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Ids of each text; null is empty."""
        ids, offsets = self.batch(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's begin.

        Each different part is looked up once in the batch; numpy puts the ids in the order of the parts.
        """
        if len(self.words) > REMEMBERED:
            self.words, self.older = {}, self.words
        if len(self.others) > REMEMBERED // 4:
            self.others = {}
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        texts = texts.fill_null("")
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        encoded = lists.flatten().dictionary_encode()
        codes, parts = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary.to_pylist()
        found = self._parts(parts)
        uncut = np.fromiter((ids is _UNCUT for ids in found), bool, len(found))
        begins = offsets[:-1]
        firsts = [parts[c] for c in codes[begins].tolist()]
        codes[begins] = len(found) + np.arange(len(texts))  # a first part has no space before it: an entry for each text
        slow = np.logical_or.reduceat(np.append(uncut, np.zeros(len(texts), bool))[codes], begins)
        slow |= np.fromiter((not first or first[-1].isspace() for first in firsts), bool, len(texts))
        for control in self.controls:
            slow |= pc.match_substring(texts, control).to_numpy(zero_copy_only=False)
        nothing = len(found) + len(texts)
        for i in np.flatnonzero(slow).tolist():
            firsts[i] = self._slow(texts[i].as_py())
            codes[offsets[i] + 1 : offsets[i + 1]] = nothing
        found = [b"" if ids is _UNCUT else ids for ids in found]
        found += [first if type(first) is bytes else self._first(first) for first in firsts]
        found.append(b"")
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(lengths) - lengths
        ends = np.append(0, np.cumsum(lengths[codes])[offsets[1:] - 1])
        pool, ids = np.frombuffer(b"".join(found), "<u4"), np.empty(ends[-1], "<u4")
        stop = 0
        while stop < len(texts):  # a part of the texts at a time, as the places of the ids take more room than they do
            start, stop = stop, max(stop + 1, int(np.searchsorted(ends, ends[stop] + AT_ONCE, side="right")) - 1)
            some = codes[offsets[start] : offsets[stop]]
            of_part = lengths[some]
            at = np.repeat(starts[some] - np.cumsum(of_part) + of_part, of_part)
            at += np.arange(len(at))
            ids[ends[start] : ends[stop]] = pool[at]
        return ids, ends

    def _parts(self, parts: list[str]) -> list[bytes]:
        """Ids of different parts, each after a space."""
        words, older, marks = self.words, self.older, self.marks
        found = list(map(words.get, parts))
        for i, ids in enumerate(found):
            if ids is None:
                part = parts[i]
                letters = part.rstrip(_MARKS)
                marked = letters is not part
                if marked:
                    ids = words.get(letters)
                if ids is None:
                    ids = older.get(letters)
                    if ids is None:
                        found[i] = self._known(part, " ")
                        continue
                    words[letters] = ids
                found[i] = ids + self._marks(part[len(letters) :]) if marked else ids
        return found

    def _slow(self, text: str) -> bytes:
        """Ids of a text that spells a control token, or has white space beside a space: cut only where neither neighbour is any."""
        if not text or any(control in text for control in self.controls):
            return self.ids(text)
        first, *parts = _CUT.split(text)
        return self._first(first) + b"".join([self._whole(part) for part in parts])

    def _first(self, part: str) -> bytes:
        ids = self._lines(part, "") if "\n" in part else self._known(part, "")
        return self.ids(part) if ids == _UNCUT else ids

    def _whole(self, part: str) -> bytes:
        ids = self._known(part, " ")
        return self.ids(" " + part) if ids == _UNCUT else ids


def small_batches(batches: Iterator[pa.RecordBatch], column: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of ``column`` at the most, one row at the least."""
    for batch in batches:
        sizes = pc.binary_length(batch[column]).fill_null(0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)
