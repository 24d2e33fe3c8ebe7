"""Toxicity by a support vector machine over a gapped subsequence string kernel with Nyström landmarks.

The kernel of two words counts their common three-letter subsequences. One that spans ``s``
letters weighs ``DECAY ** s``, so letters put between those of an insult lower the kernel little by
little instead of hiding it. The kernel is normalized and raised to a power, which is again a
kernel, and is summed over the words of two sentences. Many letters put in make subsequences of their own, which
weigh the kernel down. So a word that has all letters of a landmark in their order counts with it by the
share of letters put in (``read_as``), where that is more than the kernel, and letters set apart by blanks are joined where that makes a word near a landmark. Landmarks are words that go with the
label; a sentence becomes the vector of its kernels with them, whitened by the landmarks' own
kernel matrix (Nyström), on which a linear support vector machine is trained.

Labels are given by document and insults stand in single sentences. So a document counts as its
highest sentence, which is chosen anew after each fit, and its margin becomes a probability. Every
training document counts again with one letter, with three letters and with one in every gap put into each word that is near a
landmark, so that the machine learns how far a spoilt insult may stray.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import arrow_map, hash_key
from skyledger.llm.tokens import small_batches
from skyledger.session import write_and_reread

DECAY = 0.8
#: Three letters of a subsequence lie within this many positions of the first.
SPAN = 7
POWER = 4
#: Kernels and readings below this count as zero, which spares most words.
FLOOR = 0.5**POWER
#: What a landmark's reading is worth in a word with as many letters put in as it has itself.
READING = 0.55
#: Letters put into the words of the training copies; one in every gap if there are fewer gaps.
COPIES = (1, 3, 10**6)
_STOPS = (b".", b"!", b"?")
#: Second UTF-8 bytes, after C3, of accented Latin letters, each with the plain letter; the first byte goes.
_ACCENTS = {"a": range(0xA0, 0xA6), "c": [0xA7], "e": range(0xA8, 0xAC), "i": range(0xAC, 0xB0), "n": [0xB1], "o": range(0xB2, 0xB7), "u": range(0xB9, 0xBD), "s": [0x9F]}
_PLAIN = {b - shift: ord(letter) for letter, found in _ACCENTS.items() for b in found for shift in (0, 0x20) if b != 0x9F or not shift}
_LIKE = dict(zip(b"0134@57", b"oieaast", strict=True))
#: Letters of the kernel's alphabet that are no Latin letters, and bytes that never stand in UTF-8 to write them with meanwhile.
OTHERS = b"{|}~\x7f"
_PLAIN |= {0xF8 + i: c for i, c in enumerate(OTHERS)}
_FOLD = bytes(_LIKE.get(c, c) if c < 128 else _PLAIN.get(c, ord("{")) for c in range(256))
_DROP = bytes(c for c in range(128) if not chr(c).isalpha() and chr(c) not in " \t\n\r\v\f0134@57") + b"\xc3"
#: Characters in UTF-8 that aren't ASCII and don't begin with C3, and what tells quickly that a text has one.
_SOME_OTHER = re.compile(rb"[\xc2\xc4-\xf4]")
_OTHER = re.compile(rb"[\xc2\xc4-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")


@lru_cache(maxsize=100_000)
def _other(character: bytes) -> bytes:
    """A Latin letter without its accent, two of ``OTHERS`` for a letter of another script, a blank for a blank, nothing for a mark."""
    text = character.decode()
    if text.isspace():
        return b" "
    plain = unicodedata.normalize("NFD", text.lower())[0]
    if plain.isascii() and plain.isalpha():
        return plain.encode()
    if not text.isalpha():
        return b""
    number = zlib.crc32(plain.encode())
    return bytes([0xF8 + number % len(OTHERS), 0xF8 + number // len(OTHERS) % len(OTHERS)])


def fold(data: bytes) -> bytes:
    """Lower-case letters and white space only: accents and marks go, look-alike digits become letters.

    A letter of another script becomes two of five more letters by a hash of its code point, so that words of that script
    have subsequences of their own.
    """
    if not data.isascii() and _SOME_OTHER.search(data):
        data = _OTHER.sub(lambda found: _other(found[0]), data)
    return data.lower().translate(_FOLD, _DROP)


def sentences(text: str) -> list[list[bytes]]:
    """Folded words of each sentence. A stop inside a word ends none, so ``i.d.i.o.t`` stays one word."""
    data = text.encode()
    for stop in _STOPS:
        data = data.replace(stop + b" ", stop + b"\n")
    return [fold(line).split() for line in data.split(b"\n")]


#: Neighbouring words of one or two letters, three at least.
_APART = re.compile(rb"(?<!\S)\S\S?(?:\s+\S\S?(?!\S)){2,}")
#: Places in a run at which joined words start that are looked up at once.
_STARTS = 10_000


def apart(line: bytes) -> list[list[bytes]]:
    """Runs of neighbouring words of one or two letters in a folded text, three words at least."""
    return [run.split() for run in _APART.findall(line)]


def are_letters(words: list[bytes]) -> bool:
    """Whether neighbouring words are rather one word's letters: three at least, single ones twice as many as pairs."""
    pairs = sum(len(w) > 1 for w in words)
    return len(words) > 2 and 2 * pairs <= len(words) - pairs


def subsequences(word: bytes) -> dict[tuple[int, int, int], float]:
    """Weight of each three-letter subsequence of a word."""
    out: dict[tuple[int, int, int], float] = {}
    n = len(word)
    for i in range(n - 2):
        for k in range(i + 2, min(n, i + SPAN + 1)):
            weight = DECAY ** (k - i + 1)
            for j in range(i + 1, k):
                key = word[i], word[j], word[k]
                out[key] = out.get(key, 0.0) + weight
    return out


def spoil(word: bytes, letters: int = 1) -> bytes:
    """The word with letters put in at even distances, one into its middle, at most one into each gap."""
    n = max(1, min(letters, len(word) - 1))
    cuts = [0, *(len(word) * (i + 1) // (n + 1) for i in range(n)), len(word)]
    salt = zlib.crc32(word)
    return b"".join(word[a:b] + bytes([97 + (salt + 7 * i) % 26] if i < n else b"") for i, (a, b) in enumerate(zip(cuts, cuts[1:])))


def read_as(word: bytes, landmark: bytes) -> float:
    """``READING`` to the power of the share of letters put in; 0 if the word isn't the landmark with letters put in."""
    place = -1
    for c in landmark:
        place = word.find(c, place + 1)
        if place < 0:
            return 0.0
    value = READING ** (len(word) / len(landmark) - 1)
    return value if len(word) > len(landmark) and value >= FLOOR else 0.0


def kernel(a: bytes, b: bytes) -> float:
    """The normalized kernel of two words, to the power."""
    x, y = subsequences(a), subsequences(b)
    both = sum(v * y[k] for k, v in x.items() if k in y)
    norm = math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
    return (both / norm) ** POWER if norm else 0.0


def _codes(data: bytes) -> np.ndarray:
    """a-z as 1 to 26, ``OTHERS`` as 27 to 31, separators as 0."""
    raw = np.frombuffer(data, dtype=np.uint8).astype(np.int32)
    return np.where(raw >= 97, raw - 96, 0)


def _letters(word: bytes) -> int:
    """The set of a word's letters as bits."""
    out = 0
    for c in set(word):
        out |= 1 << (c - 96 & 31)
    return out


@dataclass
class Landmarks:
    """Kernels of many words with the landmarks at once."""

    words: list[bytes]
    active: dict[bytes, np.ndarray | None] = field(default_factory=dict, repr=False)
    readings: dict[bytes, np.ndarray] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        self.masks = np.array([_letters(w) for w in self.words], dtype=np.int64)
        maps = [subsequences(w) for w in self.words]
        self.norms = np.array([math.sqrt(sum(v * v for v in m.values())) for m in maps])
        triples = sorted({t for m in maps for t in m})
        self.triple = np.full(32768, -1, dtype=np.int32)
        owners: list[int] = []
        weights: list[float] = []
        self.starts = np.zeros(len(triples) + 1, dtype=np.int64)
        for number, t in enumerate(triples):
            a, b, c = (x - 96 for x in t)
            self.triple[a * 1024 + b * 32 + c] = number
            for owner, m in enumerate(maps):
                if t in m:
                    owners.append(owner)
                    weights.append(m[t])
            self.starts[number + 1] = len(owners)
        self.owners, self.weights = np.array(owners, dtype=np.int64), np.array(weights)

    def __getstate__(self) -> dict:
        return {"words": self.words}

    def __setstate__(self, state: dict) -> None:
        self.words, self.active, self.readings = state["words"], {}, {}
        self.__post_init__()

    def raw(self, words: list[bytes]) -> np.ndarray:
        """Kernels before normalizing, a row for each word."""
        m = len(self.words)
        codes = _codes(b"\0".join(words) + b"\0" * (SPAN + 1))
        word = np.cumsum(codes == 0) - (codes == 0)
        first, second = codes * 1024, codes * 32
        n = len(codes) - SPAN
        out = np.zeros(len(words) * m)
        for c in range(2, SPAN + 1):
            ends = first[:n] + codes[c : c + n]
            for b in range(1, c):
                number = self.triple[ends + second[b : b + n]]
                at = np.flatnonzero(number >= 0)
                at = at[word[at] == word[at + c]]
                if not len(at):
                    continue
                number = number[at]
                size = self.starts[number + 1] - self.starts[number]
                pick = np.arange(size.sum()) + np.repeat(self.starts[number] - (np.cumsum(size) - size), size)
                slot = np.repeat(word[at], size) * m + self.owners[pick]
                out += np.bincount(slot, self.weights[pick] * DECAY ** (c + 1), minlength=len(out))
        return out.reshape(len(words), m)

    def learn(self, words: set[bytes]) -> None:
        """Find the kernels of words not met before; remember only those with one above the floor."""
        if len(self.active) > 500_000:
            self.active.clear()
            self.readings.clear()
        new = [w for w in words if w not in self.active and len(w) > 2]
        if not self.words:
            return
        least = FLOOR ** (1 / POWER)
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            raw = self.raw(some) / self.norms
            length = np.array([len(w) for w in some])
            bound = np.zeros(len(some))  # least square norm that a word of the length can have
            for c in range(2, SPAN + 1):
                bound += np.maximum(0, length - c) * (c - 1) * DECAY ** (2 * (c + 1))
            near = set(np.flatnonzero(raw.max(axis=1, initial=0.0) >= least * np.sqrt(bound)).tolist())
            for i, w in enumerate(some):
                self.active[w] = None
                if i in near:
                    value = (raw[i] / math.sqrt(sum(v * v for v in subsequences(w).values()))) ** POWER
                    value[value < FLOOR] = 0.0
                    if value.any():
                        self.active[w] = value
            self.read(some, length)

    def read(self, words: list[bytes], length: np.ndarray) -> None:
        """Remember the words that are landmarks with letters put in."""
        masks = np.array([_letters(w) for w in words], dtype=np.int64)
        most = math.log(FLOOR) / math.log(READING) + 1
        for m, landmark in enumerate(self.words):
            fits = (self.masks[m] & ~masks == 0) & (length > len(landmark)) & (length <= most * len(landmark) + 1)
            for i in np.flatnonzero(fits):
                value = read_as(words[i], landmark)
                if value:
                    self.readings.setdefault(words[i], np.zeros(len(self.words)))[m] = value

    def value(self, word: bytes) -> np.ndarray | None:
        """A learnt word's kernels or readings, whichever is more; None if all are zero."""
        kernels, readings = self.active.get(word), self.readings.get(word)
        if kernels is None or readings is None:
            return kernels if readings is None else readings
        return np.maximum(kernels, readings)

    def joined(self, run: list[bytes]) -> list[bytes]:
        """Words that letters of a run make up, each letter in the one nearest to a landmark, or in two at the edges of ``_STARTS``."""
        longest = 2 * max(map(len, self.words), default=0)
        out = []
        for start in range(0, len(run), _STARTS):
            cuts = []
            for i in range(start, min(start + _STARTS, len(run))):
                size = pairs = 0
                for end in range(i, len(run)):
                    size += len(run[end])
                    pairs += len(run[end]) > 1
                    if size > longest:
                        break
                    if end > i + 1 and 3 * pairs <= end + 1 - i:
                        cuts.append((i, end + 1))
            made = [b"".join(run[a:b]) for a, b in cuts]
            self.learn(set(made))
            worth = {w: float(v.max()) for w in set(made) if (v := self.value(w)) is not None}
            taken: set[int] = set()
            for word, (a, b) in sorted(((w, c) for w, c in zip(made, cuts, strict=True) if w in worth), key=lambda x: (-worth[x[0]], x[1])):
                if taken.isdisjoint(range(a, b)):
                    taken.update(range(a, b))
                    out.append(word)
        return out

    def vectors(self, texts: list[str | None], spoilt: int = 0) -> list[np.ndarray]:
        """For each text the kernel sums of its sentences that are not all zero; duplicates of a sentence once.

        Letters set apart by blanks, line ends or stops make sentences of one word each.
        With ``spoilt``, so many letters have been put into each word that is near a landmark.
        """
        lines = [fold(t.encode()) if t else b"" for t in texts]
        words = [line.split() for line in lines]
        self.learn(set().union(*words))
        get = self.value
        near = {w for w in set().union(*words) if get(w) is not None}
        out = []
        for text, line, own in zip(texts, lines, words, strict=True):
            found: dict[tuple[bytes, ...], None] = {}
            if not near.isdisjoint(own):
                for sentence in sentences(text):
                    hit = tuple(w for w in sentence if w in near)
                    if hit:
                        found[hit] = None
            for run in apart(line):
                found.update(dict.fromkeys((w,) for w in self.joined(run)))
            out.append(list(found))
        if spoilt:
            out = [[tuple(spoil(w, spoilt) for w in hit) for hit in found] for found in out]
        self.learn({w for found in out for hit in found for w in hit})
        nothing = np.zeros(len(self.words))
        rows = [[sum((v for w in hit if (v := get(w)) is not None), nothing) for hit in found] for found in out]
        return [np.array(r).reshape(len(r), len(self.words)) for r in rows]


def whitening(landmarks: list[bytes]) -> np.ndarray:
    """Inverse square root of the landmarks' kernel matrix; null directions are left out."""
    matrix = np.array([[kernel(a, b) for b in landmarks] for a in landmarks])
    values, vectors = np.linalg.eigh(matrix)
    return vectors @ np.diag([v**-0.5 if v > 1e-6 else 0.0 for v in values]) @ vectors.T


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float, steps: int = 50) -> np.ndarray:
    """Linear support vector machine with squared hinge loss, by Newton steps; the last entry is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag(np.r_[np.ones(x.shape[1] - 1), 1e-6])
    beta, before = np.zeros(x.shape[1]), None
    for _ in range(steps):
        inside = y * (x @ beta) < 1
        if before is not None and np.array_equal(inside, before):
            break
        before = inside
        scaled = x[inside] * (cost * weight[inside])[:, None]
        beta = np.linalg.solve(ridge + scaled.T @ x[inside], scaled.T @ y[inside])
    return beta


def fit_probability(margin: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margin to probability; the slope isn't negative."""
    toxic, clean = (y > 0).sum(), (y <= 0).sum()
    goal = np.where(y > 0, (toxic + 1) / (toxic + 2), 1 / (clean + 2))
    a, b = 0.0, math.log((toxic + 1) / (clean + 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - goal) * margin).sum() + 1e-6 * a, (p - goal).sum()])
        w = p * (1 - p) + 1e-9
        h = np.array([[(w * margin**2).sum() + 1e-6, (w * margin).sum()], [(w * margin).sum(), w.sum()]])
        step = np.linalg.solve(h, g)
        size = 1.0
        a, b = a - size * step[0], b - size * step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(0.0, float(a)), float(b)


@dataclass
class Model:
    """What scoring needs; a few dozen words and numbers."""

    landmarks: Landmarks
    beta: np.ndarray
    bias: float
    slope: float
    offset: float

    @classmethod
    def constant(cls, share: float) -> Model:
        """Scores every text the same, for want of examples of both classes."""
        share = min(max(share, 1e-9), 1 - 1e-9)
        return cls(Landmarks([]), np.zeros(0), 0.0, 0.0, math.log(share / (1 - share)))

    def margins(self, vectors: list[np.ndarray]) -> np.ndarray:
        """Highest margin of each document's sentences; a sentence far from all landmarks has the bias."""
        return np.array([max(self.bias, float((v @ self.beta).max()) + self.bias) if len(v) else self.bias for v in vectors])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        margin = self.margins(self.landmarks.vectors(texts))
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def highest(margin: np.ndarray, sizes: np.ndarray, other: float) -> tuple[np.ndarray, np.ndarray]:
    """Highest margin of each document and where it stands; ``other`` and -1 if no sentence has a higher one."""
    place = np.full(len(sizes), -1)
    some = np.flatnonzero(sizes)
    if len(some):
        starts = (np.cumsum(sizes) - sizes)[some]
        order = np.lexsort((np.arange(len(margin)), -margin, np.repeat(np.arange(len(some)), sizes[some])))
        place[some] = order[starts]
    best = np.where(place >= 0, margin[place] if len(margin) else other, other)
    return np.maximum(best, other), np.where(best > other, place, -1)


def fit(landmarks: Landmarks, x: np.ndarray, sizes: np.ndarray, toxic: np.ndarray, n: int, cost: float = 10.0, rounds: int = 6) -> Model:
    """Train on documents: ``x`` has their sentences' vectors one after the other, ``sizes`` how many each has.

    Every document also has a sentence that is far from all landmarks. The first ``n`` documents are those as written,
    by which margins become probabilities.
    """
    white = whitening(landmarks.words)
    y = np.where(toxic, 1.0, -1.0)
    weight = np.where(toxic, len(y) / 2 / max(1, toxic.sum()), len(y) / 2 / max(1, (~toxic).sum()))
    beta, bias = np.ones(len(landmarks.words)), 0.0
    chosen = np.zeros((len(y), len(landmarks.words)))
    for _ in range(rounds):
        _, place = highest(x @ beta, sizes, 0.0)
        chosen[:] = 0.0
        chosen[place >= 0] = x[place[place >= 0]]
        found = fit_svm(chosen @ white, y, weight, cost)
        beta, bias = white @ found[:-1], float(found[-1])
    margin, _ = highest(x @ beta, sizes, 0.0)
    slope, offset = fit_probability(margin[:n] + bias, y[:n])
    return Model(landmarks, beta, bias, slope, offset)


def held_out(folds: int = 5) -> Column:
    """True for documents whose label is never learnt from; those without an id have none."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, sample: int = 8000, landmarks: int = 64, folds: int = 5) -> Model:
    """Train on at most ``sample`` labelled documents, those first in hash order and not held out.

    ``labels`` has ``doc_id, toxic``. Null labels and ids aren't used, a document labelled twice counts as
    toxic if it is so once, and of documents that share an id one is used. The landmarks are the
    words whose presence is most unevenly spread over the classes (chi squared).
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(folds))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(hash_key(F.lit("toxic"), F.col("doc_id")), "doc_id").limit(sample)
    chosen = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most ``sample`` rows
    rows = write_and_reread(chosen.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")), "toxic-sample")
    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    clean = n - toxic
    if not toxic or not clean:
        return Model.constant(toxic / n if n else 0.0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found: tuple[Counter, Counter] = Counter(), Counter()
            for text, label in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
                line = fold((text or "").encode())
                whole = {b"".join(run) for run in apart(line) if are_letters(run)}
                found[bool(label)].update({w for w in line.split() if len(w) > 2} | whole)
            words = sorted(found[0].keys() | found[1].keys())
            columns = [[w.decode("ascii") for w in words], [found[1][w] for w in words], [found[0][w] for w in words]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], ["word", "p", "q"]
            )

    words = arrow_map(rows, count, "word string, p long, q long").groupBy("word").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    uneven = F.expr(f"pow(p * {clean - 0.0} - q * {toxic - 0.0}, 2) / ((p + q) * ({n - 0.0} - p - q + 1))")
    top = words.filter(F.col("p") * clean > F.col("q") * toxic).orderBy(uneven.desc(), "word").limit(landmarks).collect()
    if not top:
        return Model.constant(toxic / n)
    names = [r["word"].encode() for r in top]

    names_of = [f"copy{i}" for i in range(len(COPIES) + 1)]

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = Landmarks(names)
        for batch in small_batches(batches, "text"):
            texts = batch["text"].to_pylist()
            flat = [[v.ravel().astype(np.float32) for v in near.vectors(texts, spoilt)] for spoilt in (0, *COPIES)]
            kinds = pa.list_(pa.float32())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["toxic"], *(pa.array(f, kinds) for f in flat)], ["doc_id", "toxic", *names_of])

    kinds = dict(rows.dtypes)
    schema = f"doc_id {kinds['doc_id']}, toxic {kinds['toxic']}, " + ", ".join(f"{c} array<float>" for c in names_of)
    found = arrow_map(rows, embed, schema).orderBy("doc_id").toArrow()
    lists = [found[c].combine_chunks() for c in names_of]
    x = np.concatenate([v.flatten().to_numpy().reshape(-1, len(names)) for v in lists])
    sizes = np.concatenate([np.diff(v.offsets.to_numpy()) for v in lists]) // len(names)
    toxic_rows = found["toxic"].to_numpy() > 0
    return fit(Landmarks(names), x, sizes, np.tile(toxic_rows, len(names_of)), len(toxic_rows))


def scored(docs: DataFrame, model: Model, with_rows: bool = False) -> DataFrame:
    """``doc_id, score`` and on request the whole ``row`` of each row of ``docs(doc_id, text)``."""
    wanted = docs.select("doc_id", "text", *([F.struct(*[F.col(c) for c in docs.columns]).alias("row")] if with_rows else []))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            columns = [batch["doc_id"], pa.array(model.scores(batch["text"].to_pylist())), *([batch["row"]] if with_rows else [])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "row"][: len(columns)])

    kinds = {f.name: f.dataType.simpleString() for f in wanted.schema}
    return arrow_map(wanted, score, f"doc_id {kinds['doc_id']}, score double" + (f", row {kinds['row']}" if with_rows else ""))


def toxicity_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs(doc_id, text)``.

    ``score`` is the probability of a toxic label, ``predicted`` 1 from 0.5 on. A null or empty text
    scores like any text that is far from all landmarks; a null ``doc_id`` is held out; repeated
    rows score alike. Without labels of both classes the score is their share. An empty table gives an empty result.
    """
    found = scored(docs, train(docs, labels, **options))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return found.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, most: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` that score below ``most``."""
    return scored(docs, train(docs, labels, **options), with_rows=True).filter(F.col("score") < most).select("row.*")
