"""Token ids of whole texts by the tokenizers library, remembering the ids of pieces.

Most of a tokenizer's time goes into merging the pieces of words it has met
before.  A text is therefore cut where the tokenizer itself always starts a new
piece, at a single space between two characters that are not white space, and
the ids of each such unit are kept.  What the library returns for the unit is
what it returns for that part of the text, so the joined ids are those of
encoding the text at once.  Texts that hold one of the tokenizer's special
tokens are encoded at once.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Only cut where white space in anyone's reading is on neither side.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: How byte-level vocabularies write a space, how many plain words are encoded together, and how many
#: texts go to the library at once: it returns far more than the ids of each.
SPACE_MARK, RUN, CALL = "Ġ", 256, 2048
#: Units kept, and words of one generation (a worker keeps two); the longest unit kept.
MOST_UNITS, LONGEST_UNIT = 200_000, 48
#: Marks that form a piece of their own after a letter or digit; the part before them is looked up alone.
MARKS = ".,!?;:$%&*#"
#: A word of letters that normalization leaves alone but for their case, and the marks after it.  (The dotted capital I
#: has two letters for a lower case.)
_LETTER = "[A-Za-zÀ-ÖØ-öø-įı-ɏ]"
_MARKED = f"^(?P<word>{_LETTER}+)(?P<marks>[{MARKS}]*)$"
#: Characters handled at a time; longer texts are cut on the way.
AT_ONCE = 1 << 22

_LOADED: dict[str, "UnitEncoder"] = {}


def encoder(path: str) -> "UnitEncoder":
    """This worker's encoder of a vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = UnitEncoder(path)
    return _LOADED[path]


def _spans(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of all spans one after the other."""
    before = np.cumsum(size) - size
    places = np.arange(int(size.sum()))
    places += np.repeat(begin - before, size)
    return places


class UnitEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: two bytes hold the ids of a small vocabulary
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        # a token that ends a word, or begins one with its space, tells the words of a run of plain words apart
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.closes = bool(suffix)
        self.bound = np.array([n.endswith(suffix) if suffix else n.startswith(SPACE_MARK) for n in names])
        # texts that normalization makes equal have equal ids
        self.normal = normal = self.tokenizer.normalizer.normalize_str if self.tokenizer.normalizer else str
        letters = " " + "".join(map(chr, (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x250))))
        letters = "".join(re.findall(f" |{_LETTER}", letters))
        self.lowers = normal(letters) == letters.lower() != letters
        # words that normalization would leave as they are need not go through it
        self.plain = self.tokenizer
        if self.tokenizer.normalizer and normal(letters) == (letters.lower() if self.lowers else letters):
            self.plain = Tokenizer.from_file(path)
            self.plain.normalizer = None
        self.collapses = normal("a\nb") == normal("a b") and normal("a\n \nb") == normal("a   b")
        #: ids of words and other units, by the word; two generations
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: units with what follows the word: where their ids begin in the store, how many (-1: may not be cut off), groups of texts that held one
        self.units = pa.array([], pa.string())
        self.begin, self.size, self.groups = (np.zeros(0, np.int64) for _ in range(3))
        self.store = np.zeros(0, self.dtype)

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for at in range(0, len(texts), CALL)
                for e in self.tokenizer.encode_batch_fast(texts[at:at + CALL], add_special_tokens=False)]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of each of some plain words, as they are after a space; many words go through the library at a time."""
        runs = [words[i:i + RUN] for i in range(0, len(words), RUN)]
        out: list[bytes] = []
        size = self.dtype.itemsize
        several = max(1, CALL // RUN)
        found = (e for at in range(0, len(runs), several) for e in self.plain.encode_batch_fast(
            ["".join([" " + w for w in run]) for run in runs[at:at + several]], add_special_tokens=False))
        for run, e in zip(runs, found):
            ids = np.array(e.ids, self.dtype)
            at = np.flatnonzero(self.bound[ids])
            if len(at) != len(run):   # another kind of vocabulary
                out += self._ids([" " + w for w in run])
                continue
            cuts = [0, *((at + 1) * size).tolist()] if self.closes else [*(at * size).tolist(), len(ids) * size]
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian, ``dtype`` wide."""
        out: list[bytes] = []
        group: list[str] = []
        held = 0
        for text in texts:
            if len(text) > AT_ONCE:
                out += self._group(group)
                out.append(self._long(text))
                group, held = [], 0
                continue
            if held + len(text) > AT_ONCE:
                out += self._group(group)
                group, held = [], 0
            group.append(text)
            held += len(text)
        return out + self._group(group)

    def _long(self, text: str) -> bytes:
        """Ids of a very long text, part by part."""
        if self.special.search(text):
            return self._ids([text])[0]
        parts, at = [], 0
        while at < len(text):
            cut = _CUT.search(text, min(len(text), at + AT_ONCE // 2))
            end = cut.start() if cut else len(text)
            part = text[at:end]
            parts.append(self._group([part])[0] if at == 0 else self._rest(part[1:]))
            at = end
        return b"".join(parts)

    def _rest(self, text: str) -> bytes:
        """Ids of a part of a text that follows a cut."""
        ids = self._columns([text], headed=False)[0]
        if ids is None:
            parts = _CUT.split(text)
            known = dict(zip(new := list(set(parts)), self._ids([" " + p for p in new])))
            return b"".join([known[p] for p in parts])
        return ids

    def _known(self, units: list[str], ids_of: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """Ids of distinct words or other units as they are after a space, remembered or from the library."""
        if len(self.words) > MOST_UNITS:
            self.older, self.words = self.words, {}
        words, older = self.words, self.older
        unknown = [u for u in units if u not in words]
        words.update((u, older[u]) for u in unknown if u in older)
        unknown = [u for u in unknown if u not in older]
        words.update(zip(unknown, ids_of(unknown)))
        return [words[u] for u in units]

    def _learn(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct units as they are after a space, one after the other, and how many each has (-1: may not be cut off)."""
        size = np.full(len(new), -1, np.int64)
        begin = np.zeros((len(new), 2), np.int64)   # of the word and of the marks after it
        each = np.zeros((len(new), 2), np.int64)
        pool: list[bytes] = []
        held = 0

        def pooled(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            nonlocal held
            sizes = np.array([len(x) // self.dtype.itemsize for x in ids], np.int64)
            begins = held + np.cumsum(sizes) - sizes
            held += int(sizes.sum())
            pool.extend(ids)
            return begins, sizes

        def put(at: np.ndarray, part: int, coded: pa.DictionaryArray, ids: list[bytes]) -> None:
            begins, sizes = pooled(ids)
            index = coded.indices.to_numpy()
            begin[at, part], each[at, part] = begins[index], sizes[index]

        short = pc.less_equal(pc.utf8_length(new), LONGEST_UNIT)
        marked = pc.extract_regex(new, _MARKED)
        plain = pc.and_(short, marked.is_valid())
        at = np.flatnonzero(plain.to_numpy(zero_copy_only=False))
        marked = marked.filter(plain)
        word, tail = marked.field(0), marked.field(1).dictionary_encode()
        word = (pc.utf8_lower(word) if self.lowers else word).dictionary_encode()
        put(at, 0, word, self._known(word.dictionary.to_pylist(), self._word_ids))
        put(at, 1, tail, self._ids(tail.dictionary.to_pylist()))
        size[at] = each[at].sum(1)

        places = np.flatnonzero(pc.and_not(short, plain).to_numpy(zero_copy_only=False))
        units = new.take(pa.array(places)).to_pylist()
        even = [bool(u) and not u[0].isspace() and not u[-1].isspace() for u in units]
        places, units = places[even], [u for u, e in zip(units, even) if e]
        # a letter may become one with a combining mark, which the marks after it would join
        cores = [c if c != u and c and c[-1].isalnum() and self.normal(c)[-1].isalnum() else u for u, c in ((u, u.rstrip(MARKS)) for u in units)]
        word = pa.array(cores, pa.string()).dictionary_encode()
        tail = pa.array([u[len(c):] for u, c in zip(units, cores)], pa.string()).dictionary_encode()
        put(places, 0, word, self._known(word.dictionary.to_pylist(), lambda odd: self._ids([" " + u for u in odd])))
        put(places, 1, tail, self._ids(tail.dictionary.to_pylist()))
        size[places] = each[places].sum(1)
        ids = np.frombuffer(b"".join(pool), self.dtype)[_spans(begin.ravel(), each.ravel())]
        return ids, size

    def _numbers(self, units: pa.Array) -> np.ndarray:
        """Numbers of distinct units in the store; new ones are learned."""
        if len(self.units) > MOST_UNITS:
            # the units that most groups held stay
            keep = np.argsort(-self.groups, kind="stable")[:MOST_UNITS // 2]
            size, begin = np.maximum(self.size[keep], 0), self.begin[keep]
            self.store = self.store[_spans(begin, size)]
            self.units, self.size, self.groups = self.units.take(pa.array(keep)), self.size[keep], self.groups[keep] // 2
            self.begin = np.cumsum(size) - size
        found = pc.index_in(units, value_set=self.units)
        unknown = found.is_null()
        numbers = found.fill_null(0).to_numpy()
        fresh = units.filter(unknown)
        if len(fresh):
            ids, size = self._learn(fresh)
            kept = np.maximum(size, 0)
            numbers = numbers.copy()
            numbers[unknown.to_numpy(zero_copy_only=False)] = len(self.units) + np.arange(len(fresh))
            self.units = pa.concat_arrays([self.units, fresh])
            self.begin = np.concatenate((self.begin, len(self.store) + np.cumsum(kept) - kept))
            self.store = np.concatenate((self.store, ids))
            self.size = np.concatenate((self.size, size))
            self.groups = np.concatenate((self.groups, np.zeros(len(fresh), np.int64)))
        self.groups[numbers] += 1
        return numbers

    def _columns(self, texts: list[str], headed: bool = True) -> list[bytes | None]:
        """Ids of texts cut at their spaces, None for a text with a unit that may not be cut off.

        The first unit of a headed text has no space before it.
        """
        if self.collapses:
            texts = [t.replace("\n", " ") for t in texts]
        cut = pc.split_pattern(pa.array(texts, pa.string()), " ")
        first = cut.offsets.to_numpy()
        coded = cut.values.dictionary_encode()
        unit = self._numbers(coded.dictionary)[coded.indices.to_numpy()]
        size, begin, store = self.size[unit], self.begin[unit], self.store
        if headed:
            heads = cut.values.take(pa.array(first[:-1])).to_pylist()
            ids = self._ids([h if h and not h[0].isspace() and not h[-1].isspace() else "" for h in heads])
            sizes = np.array([len(x) // self.dtype.itemsize for x in ids], np.int64)
            begin[first[:-1]] = len(store) + np.cumsum(sizes) - sizes
            size[first[:-1]] = np.where([bool(h) and not h[0].isspace() and not h[-1].isspace() for h in heads], sizes, -1)
            store = np.concatenate((store, np.frombuffer(b"".join(ids), self.dtype)))
        uneven = np.minimum.reduceat(size, first[:-1]) < 0
        size = np.maximum(size, 0)
        raw = store[_spans(begin, size)].tobytes()
        ends = (np.concatenate(([0], np.cumsum(size)))[first] * self.dtype.itemsize).tolist()
        return [None if bad else raw[a:b] for a, b, bad in zip(ends, ends[1:], uneven.tolist())]

    def _group(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        out = []
        for text, ids in zip(texts, self._columns(texts)):
            if not text:
                out.append(b"")
            elif self.special.search(text):
                out.append(self._ids([text])[0])
            else:
                out.append(self._uneven(text) if ids is None else ids)
        return out

    def _uneven(self, text: str) -> bytes:
        """Ids of a text with other white space beside its spaces: cut only where that is safe."""
        head, *parts = _CUT.split(text)
        new = list(set(parts))
        known = {p: self.words.get(p) for p in new}
        fresh = [p for p in new if known[p] is None]
        known.update(zip(fresh, self._ids([" " + p for p in fresh])))
        return self._ids([head])[0] + b"".join([known[p] for p in parts])
