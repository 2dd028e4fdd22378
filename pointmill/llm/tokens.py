"""Token ids of whole texts by the tokenizers library, each distinct word encoded once for many texts."""

import gc
import itertools
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: In a text with longer white space: a line end between words, a word with one blank before it, longer white space with the word after it.
_PIECES = re.compile(r"\n(?=[^ \n])| ?[^ \n]+|[ \n]+[^ \n]*")
#: A word of plain letters with at most one mark after it, which every vocabulary here splits the same way.
_PLAIN = re.compile(r"([\n\t]?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)")
#: Between the words of a text handed to Arrow; texts with controls are encoded whole.
_CUT = "\0"
#: Texts of about so many characters are cut into words together: the more, the more seldom a word is looked up again.
_CHARACTERS = 6_000_000


def _odd(text: str) -> bool:
    """Whether there is white space or control other than blanks and line ends."""
    return not text.replace("\n", "").isprintable()


def _wide(text: str) -> bool:
    """Whether white space is more than one blank or line end between two words."""
    return text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write bytes as letters: visible Latin-1 as itself, others as the letters from U+0100 in order."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in visible)}


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts have about as many bytes as the encoder takes together."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(ends // _CHARACTERS)) + 1).tolist(), batch.num_rows]
    for low, high in itertools.pairwise(cuts):
        if high > low:
            yield batch.slice(low, high - low)


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    """The array with room for size numbers at least; it doubles, so that all growing costs no more than the last copy."""
    if len(array) >= size:
        return array
    larger = np.zeros(max(size, 2 * len(array)), array.dtype)
    larger[: len(array)] = array
    return larger


class Encoder:
    """encode(texts) gives (ids, lengths): the ids of all texts in a row as uint32, and how many each has.

    Both kinds of vocabulary used here split a text at blanks and line ends before anything else,
    so the ids of a text are those of its words, each with the blank before it. Words of plain letters go
    straight to the library's model, letters and mark apart, others through its whole pipeline. Texts with
    other white space or controls, or with the content of an added token, are encoded whole: there the
    library turns the content into the added token, as it does for anyone who calls it. Holds about limit words.
    """

    def __init__(self, path: str, limit: int = 600_000):
        # Tasks already run side by side.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.splitter = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.size, self.limit = self.tokenizer.get_vocab_size(), limit
        # A special token, which text is never turned into, tells the words of one call apart.
        added = self.splitter.get_added_tokens_decoder()
        self.mark_id, mark = next(iter(added.items()))
        self.mark, self.added = mark.content, [t.content for t in added.values()]
        probe = self._whole(["a\nb", "a b", " b", "a", "\n", "b"])
        if probe[0] != probe[3] + probe[4] + probe[5] or probe[1] != probe[3] + probe[2]:
            raise ValueError("this vocabulary does not encode words apart")
        self.line_end = probe[4]
        self.letters = _byte_letters()
        tries = ["The", "straße", "ÉCOLE", "onhablein", "x", "été."]
        for self.blank, self.lower in ((self.letters[32], False), ("", True)):  # noqa: B020
            self.marks = {mark: [t.id for t in self.model.tokenize(mark)] for mark in ".,;:!?"}
            if self._plain(tries) == self._whole([" " + w for w in tries]):
                self.plain = True
                break
        else:
            self.plain = False
        self.numbers, self.uses = {}, np.zeros(0, np.int64)
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _thin(self) -> None:
        """Forget the less used half of the words."""
        kept = np.sort(np.argsort(-self.uses, kind="stable")[: self.limit // 2])
        words, sizes = list(self.numbers), np.diff(self.ends[: len(self.numbers) + 1])[kept]
        ends = np.cumsum(sizes)
        self.ids = self.ids[np.repeat(self.ends[kept] - (ends - sizes), sizes) + np.arange(ends[-1])]
        self.ends, self.uses = np.concatenate([[0], ends]), self.uses[kept] // 2
        self.numbers = {words[old]: new for new, old in enumerate(kept.tolist())}

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, words: list[str]) -> list[list[int] | None]:
        """The ids of each plain word: for itself after a blank, after a line end, or, marked by a tab, for itself alone."""
        tokenize, lower, blank, line_end, match, each = self.model.tokenize, self.lower, self.blank, self.line_end, _PLAIN.fullmatch, []
        for word in words:
            found = match(word)
            if found is None:
                each.append(None)
                continue
            marker, letters, after = found.groups()
            if lower:
                letters = letters.lower()
            if not letters.isascii():
                letters = letters.encode().decode("latin-1").translate(self.letters)
            ids = [t.id for t in tokenize(letters if marker else blank + letters)]
            if marker == "\n":
                ids = line_end + ids
            if after:
                ids += self.marks[after]
            each.append(ids)
        return each

    def _learn(self, words: list[str]) -> None:
        each = self._plain(words) if self.plain else [None] * len(words)
        rest = [k for k, ids in enumerate(each) if ids is None]
        texts = [words[k][1:] if words[k][:1] == "\t" else words[k] if words[k][:1] == "\n" else " " + words[k] for k in rest]
        # No word holds an added token: such texts are encoded whole.
        joined = [self.mark.join(texts[k : k + 1000]) + self.mark for k in range(0, len(texts), 1000)]
        flat = np.fromiter(itertools.chain.from_iterable(x.ids for x in self.splitter.encode_batch_fast(joined, add_special_tokens=False)), np.uint32)
        found = np.split(flat, np.flatnonzero(flat == self.mark_id) + 1)[:-1]
        found = [x[:-1] for x in found]
        for k, ids in zip(rest, found, strict=True):
            each[k] = ids
        sizes = np.fromiter(map(len, each), np.int64, len(each))
        known, at = len(self.numbers) - len(words), int(self.ends[len(self.numbers) - len(words)])
        ends = at + np.cumsum(sizes)
        self.ids = _grown(self.ids, int(ends[-1]))
        self.ids[at : ends[-1]] = np.fromiter(itertools.chain.from_iterable(each), np.uint32, int(sizes.sum()))
        self.ends = _grown(self.ends, len(self.numbers) + 1)
        self.ends[known + 1 : len(self.numbers) + 1] = ends

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        # Learning makes millions of small objects and no cycles, which the collector would walk again and again.
        collecting = gc.isenabled()
        gc.disable()
        try:
            sizes = np.cumsum([len(t) if t else 0 for t in texts])
            cuts = [0, *(np.flatnonzero(np.diff(sizes // _CHARACTERS)) + 1).tolist(), len(texts)]
            parts = [self._encode(texts[low:high]) for low, high in itertools.pairwise(cuts) if high > low]
        finally:
            if collecting:
                gc.enable()
        return (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])) if parts else (np.zeros(0, np.uint32), np.zeros(0, np.int64))

    @staticmethod
    def _cut(text: str) -> str:
        """The words of a text, cuts between them."""
        if not _wide(text):
            return ("\t" + text).replace("\n", " \n").replace(" ", _CUT)
        return _CUT.join(p[1:] if p[0] == " " and len(p) > 1 and p[1] not in " \n" else "\t" + p for p in _PIECES.findall(text))

    def _number(self, words: list[str]) -> np.ndarray:
        """The numbers of words, each given once; those that are met first are learnt."""
        found = np.fromiter(map(self.numbers.get, words, itertools.repeat(-1)), np.int64, len(words))
        unmet = np.flatnonzero(found < 0)
        if len(unmet):
            known, new = len(self.numbers), [words[k] for k in unmet.tolist()]
            found[unmet] = np.arange(known, known + len(new))
            self.numbers.update(zip(new, range(known, known + len(new))))
            self._learn(new)
        return found

    def _encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        odd = {k: t for k, t in enumerate(texts) if t and (_odd(t) or any(a in t for a in self.added))}
        split = pc.split_pattern(pa.array([None if not t or k in odd else self._cut(t) for k, t in enumerate(texts)], pa.large_string()), _CUT)
        counts = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False)
        coded = split.flatten().dictionary_encode()
        if len(self.numbers) > self.limit:
            self._thin()
        which = self._number(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        uses = np.bincount(which, minlength=len(self.numbers))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        first = self.ends[which]
        sizes = self.ends[which + 1] - first
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        lengths = np.diff(bounds)
        if odd:
            runs = np.split(ids, bounds[1:-1])
            for k, x in zip(odd, self._whole(list(odd.values())), strict=True):
                runs[k], lengths[k] = np.array(x, np.uint32), len(x)
            ids = np.concatenate(runs)
        return ids, lengths


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for all tasks that a worker runs: what it has learnt stays right for every text."""
    return Encoder(path)
