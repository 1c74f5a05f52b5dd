"""Token ids of whole texts, with every distinct word encoded once per worker.

Encoding a word costs far more than finding it again, and the two vocabulary
families handled here never merge across a space between words. A batch of texts
is therefore cut at spaces by Arrow, its distinct words are looked up in a table
that the worker keeps, and only words not seen before reach the tokenizer. Texts
whose spacing makes the cut unsafe, and vocabularies of another kind, are encoded
whole by the tokenizer; the ids are the same either way.
"""

from __future__ import annotations

import array
import itertools
import json
import re
import sys
import types
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

CHUNK_CHARS = 4_000_000
WORDS_KEPT = 1_000_000
# Words of these letters form one unit of either family, whatever surrounds them.
PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
# Signs behind a letter and before a space are a unit of their own in both families, whatever
# stands around them; ``SIGNS`` marks them as a word without a space before it.
SIGNS = "\x02"
ENDS = "([A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?]+)( |$)"
# Marks the first word of a text, which has no space before it.
FIRST = "\x01"
# Runs of blanks longer than one, where a cut could separate characters of one unit.
RUNS = ("  ", "\n\n", " \n", "\n ", FIRST, SIGNS)


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins that byte-level vocabularies use for single bytes."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(0x100) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class TokenEncoder:
    """Encodes batches of texts to the ids of one tokenizer file."""

    def __init__(self, path: str, words_kept: int = WORDS_KEPT):
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        letters = _byte_letters()
        self.space = letters[0x20]
        # A line end stands between words here, and within none.
        self.letters = {b: c for b, c in letters.items() if b != 0x0A}
        self.words_kept = words_kept
        self.family = self._family(parts)
        self._clear()

    @staticmethod
    def _family(parts: dict) -> str:
        before, cut = parts.get("normalizer"), parts.get("pre_tokenizer") or {}
        if before is None and cut.get("type") == "ByteLevel":
            if cut.get("use_regex") and not cut.get("add_prefix_space"):
                return "spaced"
        if (parts.get("model") or {}).get("end_of_word_suffix") and before:
            steps = [s.get("type") for s in before.get("normalizers", [])]
            split = (cut.get("pretokenizers") or [{}])[0]
            if steps == ["NFC", "Replace", "Lowercase"] and split.get("behavior") == "Removed":
                return "ended"
        return "other"

    def _clear(self) -> None:
        self.slots: dict[str, int] = {}
        self.flat = array.array("I")
        self.begin = array.array("q")
        self.count = array.array("q")

    def _whole(self, texts: Sequence[str]) -> list[list[int]]:
        return [
            e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ]

    def _surface(self, word: str) -> str:
        """The characters of the text that a word of the cut stands for."""
        if word[:1] == SIGNS:
            return word[1:]
        if self.family == "ended" or word[:1] == "\n":
            return word
        return word[1:] if word[:1] == FIRST else " " + word

    def _units(self, words: list[str]) -> list[list[int]]:
        """Ids of words that are one unit each."""
        joined = "\n".join(words)
        if self.family == "ended":
            joined = joined.lower()
        shown = joined.encode().decode("latin-1").translate(self.letters)
        start = self.space if self.family == "spaced" else ""
        return [
            [t.id for t in self.model.tokenize(w)] for w in (start + shown.replace("\n", "\n" + start)).split("\n")
        ]

    def _keep(self, words: list[str], found: list[list[int]]) -> None:
        first, before = len(self.begin), len(self.flat)
        self.slots.update(zip(words, range(first, first + len(words)), strict=True))
        counts = np.fromiter(map(len, found), "int64", len(found))
        self.count.frombytes(counts.tobytes())
        self.begin.frombytes((before + np.cumsum(counts) - counts).tobytes())
        self.flat.extend(itertools.chain.from_iterable(found))

    def _learn(self, words: list[str]) -> None:
        """Add words that the table does not hold."""
        plain = [w for w in words if w.isalpha() and PLAIN.fullmatch(w)]
        if plain:
            self._keep(plain, self._units(plain))
        if len(plain) < len(words):
            other = list(set(words).difference(plain))
            self._keep(other, self._whole([self._surface(w) for w in other]))

    def _slots_of(self, words: list[str]) -> np.ndarray:
        slots = list(map(self.slots.get, words))
        new = [w for w, s in zip(words, slots, strict=True) if s is None]
        if new:
            if len(self.slots) + len(new) > self.words_kept:
                self._clear()
                new = words
            self._learn(new)
            slots = list(map(self.slots.__getitem__, words))
        return np.array(slots, dtype="int64")

    def _cut(self, text: str) -> str:
        if self.family == "ended":
            return text.replace("\n", " ")
        return FIRST + text.replace("\n", " \n")

    def _chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.family == "other":
            odd = set(range(len(texts)))
        elif self.family == "spaced":
            odd = {i for i, t in enumerate(texts) if any(r in t for r in RUNS)}
        else:
            odd = {i for i, t in enumerate(texts) if SIGNS in t}
        if len(odd) == len(texts):
            ids, lengths = np.zeros(0, "uint32"), np.zeros(len(texts), "int64")
        else:
            cut = ["" if i in odd else self._cut(t) for i, t in enumerate(texts)]
            signs = pc.replace_substring_regex(pa.array(cut, pa.large_string()), ENDS, f"\\1 {SIGNS}\\2\\3")
            lists = pc.split_pattern(signs, " ")
            coded = lists.flatten().dictionary_encode()
            slots = self._slots_of(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
            counts = np.frombuffer(self.count, "int64")[slots]
            ends = np.concatenate([[0], np.cumsum(counts)])
            begins = np.frombuffer(self.begin, "int64")[slots]
            where = np.repeat(begins - ends[:-1], counts) + np.arange(ends[-1])
            ids = np.frombuffer(self.flat, "uint32")[where] if len(where) else np.zeros(0, "uint32")
            lengths = np.diff(ends[np.asarray(lists.offsets) - lists.offsets[0].as_py()])
        if odd:
            # Words of the blank stand-ins are dropped, the whole encodings put in place.
            pieces = np.split(ids, np.cumsum(lengths)[:-1]) if len(texts) else []
            places = sorted(odd)
            for i, own in zip(places, self._whole([texts[i] for i in places]), strict=True):
                pieces[i] = np.array(own, "uint32")
            lengths = np.array([len(p) for p in pieces], "int64")
            ids = np.concatenate([np.zeros(0, "uint32"), *pieces]).astype("uint32")
        return ids, lengths

    def encode(self, texts: Sequence[str | None], end_id: int | None = None):
        """Ids of all texts in a row, and the number of each text.

        A null text is empty. ``end_id`` is appended to every text.
        """
        ids, lengths, held, size = [], [], [], 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size >= CHUNK_CHARS:
                own = self._chunk(held)
                ids.append(own[0])
                lengths.append(own[1])
                held, size = [], 0
        if held:
            own = self._chunk(held)
            ids.append(own[0])
            lengths.append(own[1])
        flat = np.concatenate([np.zeros(0, "uint32"), *ids]).astype("uint32", copy=False)
        counts = np.concatenate([np.zeros(0, "int64"), *lengths]).astype("int64", copy=False)
        if end_id is not None:
            flat = np.insert(flat, np.cumsum(counts), np.uint32(end_id))
            counts = counts + 1
        return flat, counts


def encoder(path: str, words_kept: int = WORDS_KEPT) -> TokenEncoder:
    """The encoder of this worker process, which goes on from task to task.

    Task code travels with the job and is loaded anew for every task, so what a
    worker keeps hangs on a module of its own.
    """
    home = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker"))
    kept = home.__dict__.setdefault("encoders", {})
    if (path, words_kept) not in kept:
        kept[path, words_kept] = TokenEncoder(path, words_kept)
    return kept[path, words_kept]


def crc_of(ids: np.ndarray, crc: int = 0) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").data.cast("B"), crc) if len(ids) else crc
