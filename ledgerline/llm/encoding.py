"""Token ids of whole texts with a public tokenizer, word by word from a bounded cache."""

from __future__ import annotations

import codecs
import ctypes
import re
import struct
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words kept per Python worker, and words after line ends, runs of white space with the
#: word after them, and ends of words.
MAX_WORDS = 800_000
MAX_OTHERS = 50_000
#: Longer words are encoded each time.
MAX_WORD_CHARS = 64
#: Texts of more characters are cut into words one at a time.
LONG_TEXT = 1_000_000
#: Bytes of texts whose words are looked up together, and new words of which the ids are
#: asked for at once.
TOGETHER = 8 << 20
AT_ONCE = 8

_WORD = re.compile(r"[^ \n\t\r]+")
_SPACED_WORD = re.compile(r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")
_EDGES = " \n\t\r"
_MEETING = ("  ", "\n\n", " \n", "\n ")
#: A Latin letter or a digit, then signs up to the end: both parts are encoded alone.
_SIGNS = ".,;:!?#$%&*|"
_STEM = re.compile(f"(.*[0-9A-Za-zÀ-ÖØ-öø-ɏ])([{_SIGNS}]+)", re.DOTALL)


#: Latin letters that stay one character in lower case.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ɏ]+")


def _byte_characters() -> str:
    """The characters by which byte-level tokenizers write bytes: visible ones stand for
    themselves, the others for those from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return "".join(chr(b if b in visible else next(hidden)) for b in range(256))


_BYTE_CHARACTERS = _byte_characters()


class _SpacesMeet(Exception):
    """White space at the edge of a word may be one with what stands before or after."""


class _Kept(dict):
    """Bounded memory of a function of a string. When it is full, its entries become the
    old ones, of which those that are still asked for come back."""

    def __init__(self, function: Callable[[str], bytes], most: int) -> None:
        super().__init__()
        self.function = function
        self.most = most // 2
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        value = self.old.get(word)
        if value is None:
            value = self.function(word)
        if len(word) <= MAX_WORD_CHARS:
            if len(self) >= self.most:
                self._age()
            self[word] = value
        return value

    def keep(self, values: dict[str, bytes]) -> None:
        if len(self) >= self.most:
            self._age()
        self.update(values)

    def _age(self) -> None:
        self.old = dict(self)
        self.clear()


class Encoder:
    """Ids as little-endian unsigned 32-bit integers.

    The tokenizers split at white space before they merge, so a text's ids are those of
    its words one after the other. ``spaces_dropped``: the tokenizer drops white space
    and lower-cases; otherwise the white space before a word belongs to it. Texts are cut
    at single blanks and line ends; where other white space stands next to them, at runs
    of white space; and where that is of a kind the tokenizer might join with them, not at
    all. ``special``: the strings of special tokens are one id each, as the library has it;
    a text with one is encoded whole. Otherwise they are ordinary text.
    """

    def __init__(self, path: str, spaces_dropped: bool, special: bool = False, words: int = MAX_WORDS) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = None
        if special:
            added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
            self.special = re.compile("|".join(added), re.IGNORECASE) if added else None
        else:
            self.tokenizer.encode_special_tokens = True
        self.spaces_dropped = spaces_dropped
        self.pattern = _WORD if spaces_dropped else _SPACED_WORD
        self.before = "" if spaces_dropped else " "
        self.model = self.tokenizer.model
        self.line_end = self._plain("\n")
        self.words = _Kept(self._word, words)
        self.openings = _Kept(self._opening, MAX_OTHERS)
        self.runs = _Kept(self._run, MAX_OTHERS)
        self.tails = _Kept(self._plain, MAX_OTHERS)
        self.units = _Kept(self._unit, words)

    def encode(self, text: str) -> bytes:
        try:
            if not text:
                return b""
            if self.special and self.special.search(text):
                return self._plain(text)
            if len(text) > LONG_TEXT:
                return b"".join(self.runs[m[0]] for m in self.pattern.finditer(text))
            word = self.words.__getitem__
            if self.spaces_dropped:
                for space in "\n\t\r":
                    text = text.replace(space, " ")
                return b"".join(map(word, text.split(" ")))
            first, *lines = text.split("\n")
            start, *others = first.split(" ")
            found = [self._opening(start)[len(self.line_end):], *map(word, others)]
            for line in lines:
                start, *others = line.split(" ")
                found.append(self.openings[start])
                found.extend(map(word, others))
            return b"".join(found)
        except _SpacesMeet:
            try:
                return b"".join(map(self.runs.__getitem__, self.pattern.findall(text)))
            except _SpacesMeet:
                return self._plain(text)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """What ``encode`` gives for each text, with each word looked up once for all texts
        and new words of letters several at once. Little is gained on few texts."""
        alone = [len(t) > LONG_TEXT or bool(self.special and self.special.search(t)) for t in texts]
        if not self.spaces_dropped:  # no need to look words up where spaces meet
            alone = [a or any(two in t for two in _MEETING) for a, t in zip(alone, texts)]
        short = ["" if a else t for a, t in zip(alone, texts)]
        if self.spaces_dropped:
            for space in "\n\t\r":
                short = [t.replace(space, " ") for t in short]
        else:  # a word after a line end has it before it, and so has a text's first word
            short = ["\n" + t.replace("\n", " \n") for t in short]
        lists = pc.split_pattern(pa.array(short, pa.string()), " ")
        words = lists.flatten().dictionary_encode()
        which, bounds = words.indices.to_numpy(), lists.offsets.to_numpy()
        found = self._found(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        meet = np.array([f is None for f in found], bool)
        if meet.any():
            found = [f or b"" for f in found]
            before = np.append(0, np.cumsum(meet[which]))[bounds]
            alone = [a or m > 0 for a, m in zip(alone, np.diff(before).tolist())]
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(lengths) - lengths
        n = lengths[which]
        ends = np.cumsum(n)
        places = np.repeat(starts[which] - ends + n, n)
        places += np.arange(len(places))
        ids = np.frombuffer(b"".join(found), "<u4")[places].tobytes()
        edges = (4 * np.append(0, ends)[bounds]).tolist()
        first = 0 if self.spaces_dropped else len(self.line_end)
        return [
            self.encode(text) if a or not text else ids[start + first : end]
            for text, a, start, end in zip(texts, alone, edges, edges[1:])
        ]

    def _found(self, units: list[str]) -> list[bytes | None]:
        """Ids of words, some with a line end before them; none where spaces may meet."""
        kept = self.units
        found = list(map(kept.get, units))
        places, stems, tails, new = [], [], [], {}
        for k in [k for k, f in enumerate(found) if f is None]:
            unit = units[k]
            stem = unit.rstrip(_SIGNS)
            if stem.isalpha() if stem.isascii() else _LETTERS.fullmatch(stem):
                tail = self.tails[unit[len(stem) :]] if len(stem) < len(unit) else b""
                if len(stem) <= MAX_WORD_CHARS and stem not in kept and stem not in kept.old:
                    new[stem] = None
            else:
                line = "\n" if unit.startswith("\n") else ""
                try:
                    stem, tail = self._parted(unit[len(line) :])
                except _SpacesMeet:
                    continue
                stem = line + stem
            places.append(k)
            stems.append(stem)
            tails.append(tail)
        if self.opens is not None:
            self._learn(list(new))
        for k, ids, tail in zip(places, map(kept.__getitem__, stems), tails):
            found[k] = ids + tail
        return found

    def _unit(self, stem: str) -> bytes:
        """A word without signs, with the blank or the line end before it."""
        if stem.startswith("\n"):
            return self.line_end + self._piece(stem[1:])
        return self._piece(self.before + stem)

    @cached_property
    def opens(self) -> np.ndarray | None:
        """For each id, whether it begins with a blank; none if the model does more than
        merge, or if words have no blank before them."""
        more = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        if self.spaces_dropped or type(self.model).__name__ != "BPE" or any(getattr(self.model, k) for k in more):
            return None
        opens = np.zeros(max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1, bool)
        known = self.tokenizer.get_vocab(with_added_tokens=False)
        opens[[i for token, i in known.items() if token.startswith(_BYTE_CHARACTERS[ord(" ")])]] = True
        return opens

    def _learn(self, words: list[str]) -> None:
        """Keep the ids of words of letters, each with the blank before it. If no id goes
        across a blank, and so each blank begins an id, merges of one word do not touch
        those of another, and the ids are those of each word alone."""
        for start in range(0, len(words), 8192):
            part = words[start : start + 8192]
            ids: list[int] = []
            for k in range(0, len(part), AT_ONCE):
                text = " " + " ".join(part[k : k + AT_ONCE])
                characters, _ = codecs.charmap_decode(text.encode(), "strict", _BYTE_CHARACTERS)
                ids += [token.id for token in self.model.tokenize(characters)]
            edges = (4 * np.flatnonzero(self.opens[ids])).tolist()
            if len(edges) == len(part):  # otherwise they are asked for one by one
                raw = np.array(ids, "<u4").tobytes()
                self.units.keep({w: raw[a:b] for w, a, b in zip(part, edges, [*edges[1:], len(raw)])})

    def _parted(self, word: str) -> tuple[str, bytes]:
        """A word without the signs at its end, and their ids."""
        if not self.spaces_dropped and (not word or word[0].isspace() or word[-1].isspace()):
            raise _SpacesMeet
        parts = None if word.isalpha() else _STEM.fullmatch(word)
        return (parts[1], self.tails[parts[2]]) if parts else (word, b"")

    def _word(self, word: str) -> bytes:
        """A word with the blank before it, where blanks count."""
        if word.isalpha():
            return self._piece(self.before + word)
        stem, tail = self._parted(word)
        return self.words[stem] + tail if tail else self._piece(self.before + stem)

    def _opening(self, word: str) -> bytes:
        """A line end and the first word after it."""
        stem, tail = self._parted(word)
        return self.line_end + self._piece(stem) + tail

    def _run(self, word: str) -> bytes:
        """A word with all the white space before it, or white space alone."""
        inner = word.strip(_EDGES)
        if not self.spaces_dropped and inner and (inner[0].isspace() or inner[-1].isspace()):
            raise _SpacesMeet
        return self._plain(word)

    def _piece(self, word: str) -> bytes:
        """Letters with at most a blank before them are one piece to the tokenizers, so
        their merges are asked for directly, which is several times faster."""
        letters = word[1:] if word.startswith(" ") else word
        if not (letters.isalpha() if letters.isascii() else _LETTERS.fullmatch(letters)):
            return self._plain(word)
        if self.spaces_dropped:
            word = word.lower()
        characters, _ = codecs.charmap_decode(word.encode(), "strict", _BYTE_CHARACTERS)
        ids = [token.id for token in self.model.tokenize(characters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=4)
def encoder(path: str, spaces_dropped: bool, words: int = MAX_WORDS) -> Encoder:
    """One per Python worker, whichever tasks it runs."""
    return Encoder(path, spaces_dropped, special=True, words=words)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[list[tuple]]:
    """The rows of Arrow batches, few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield list(zip(*[c.to_pylist() for c in part.columns]))
    give_back()


def together(batches: Iterator[pa.RecordBatch], text: str, size: int = TOGETHER) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches, as many at a time as have texts of ``size`` bytes."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            most = size + (ends[start - 1] if start else 0)
            end = max(start + 1, int(np.searchsorted(ends, most, "right")))
            yield batch.slice(start, end - start)
            start = end
    give_back()


def give_back() -> None:
    """At the end of a task, return what it no longer uses to the operating system: a
    Python worker lives on and may be idle while other tasks need the memory."""
    pa.default_memory_pool().release_unused()
    trim = _libc().get("malloc_trim")
    if trim is not None:
        trim(0)


@lru_cache(maxsize=1)
def _libc() -> dict:
    """The functions of the C library by name, as far as it has them."""
    try:
        library = ctypes.CDLL(None)
        return {"malloc_trim": library.malloc_trim}
    except (OSError, AttributeError):
        return {}


