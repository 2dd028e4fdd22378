"""Spelling variants: words that one edit turns into a much more frequent word, by search schemes on FM-indexes.

Two words one edit apart share the first or the second half of either exactly. A search anchors at the
end of a word, reads one half exactly, and goes on over the other half allowing one error: at each place a
letter may be replaced, left out or put in. What has been read so far is an interval of suffix ranks in an
index of the delimited vocabulary, and a step to the next letter is two counts. Searches from the right
end use an index of the words, those from the left end one of the words reversed: the two directions of a
bidirectional index. A half decides where its words are indexed and asked for, so an index holds the
words of some halves only; a half that too many words share is indexed in several parts, and all are asked.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointmill.llm.common import LOWER, parallelism, saved

_QUERIES = 20_000
_HELD = 300_000


@dataclass(frozen=True)
class Settings:
    """least_chars, least_count: of a word. factor: a form is so many times as frequent. every: one run in so many loses a letter. cell_words: words of one index at most, about."""

    least_chars: int = 6
    least_count: int = 5
    factor: int = 5
    every: int = 199
    cell_words: int = 200_000


def count_words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", settings: Settings | None = None) -> DataFrame:
    """(word, n) of the words with enough letters and occurrences in all texts.

    Words are runs of letters of ASCII and U+00C0 to U+00FF, A-Z lowered; if the crc32 of id, colon and run is a multiple of
    settings.every, the run loses the letter at that crc32 modulo its length. A NULL id is written as an empty string. NULL texts
    hold no words; repeated rows count each.
    """
    settings = settings or Settings()
    # A maximal run of fewer letters can never become a word.
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{settings.least_chars},}}")
    least, every = settings.least_chars, settings.every

    def table(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                for name, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    head = zlib.crc32(f"{name}:".encode())
                    for run, n in Counter(runs.findall(text.translate(LOWER).decode())).items():
                        crc = zlib.crc32(run.encode(), head)
                        if crc % every:
                            counts[run] += n
                        elif len(run) > least:
                            at = crc % len(run)
                            counts[run[:at] + run[at + 1 :]] += n
                    if len(counts) >= _HELD:
                        yield table(counts)
                        counts.clear()
        if counts:
            yield table(counts)

    texts = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= settings.least_count)


class SuffixRanks:
    """FM-index of the circle of words, a delimiter before each. An interval [low, high) holds the ranks of the suffixes that begin with what has been read."""

    def __init__(self, words: list[str]):
        text = np.frombuffer("".join("\0" + w for w in words).encode("utf-32-le"), np.uint32)
        self.alphabet, codes = np.unique(text, return_inverse=True)
        self.size, self.letters = len(text), len(self.alphabet)
        order = self._sorted(codes.astype(np.int64), max(map(len, words), default=0) + 3)
        self.before = codes[order - 1]
        #: Sorted pairs (letter before a suffix, its rank) as numbers: a place among them is the rank after a step.
        self.steps = np.sort(self.before.astype(np.int64) * (self.size + 1) + np.arange(self.size))
        self.words = np.full(self.size, -1)
        ends = codes[order] == 0
        self.words[ends] = np.cumsum(codes == 0)[order[ends]] - 1

    @staticmethod
    def _sorted(codes: np.ndarray, depth: int) -> np.ndarray:
        """Places ordered by their next depth letters, the text taken as a circle; no search reads further."""
        rank, known = codes, 1
        while True:
            both = rank * (len(codes) + 1) + np.roll(rank, -known)
            order = np.argsort(both, kind="stable")
            ordered = both[order]
            new = np.concatenate([[False], ordered[1:] != ordered[:-1]])
            rank = np.empty_like(codes)
            rank[order] = np.cumsum(new)
            known *= 2
            if known >= depth or rank[order[-1]] == len(codes) - 1:
                return order

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all letters, and where each word begins. An unknown letter is never found."""
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        codes = np.minimum(np.searchsorted(self.alphabet, letters), self.letters - 1)
        return np.where(self.alphabet[codes] == letters, codes, self.letters), np.cumsum([0, *map(len, words)])

    def step(self, letter: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = letter * (self.size + 1)
        return np.searchsorted(self.steps, base + low), np.searchsorted(self.steps, base + high)

    def children(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(interval, letter, low, high) of every step by a letter that leads somewhere; narrow intervals look at their own letters only."""
        width = high - low
        narrow, wide = np.flatnonzero(width < self.letters), np.flatnonzero(width >= self.letters)
        sizes = width[narrow]
        ranks = np.repeat(low[narrow] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        own = np.unique(np.repeat(narrow, sizes) * self.letters + self.before[ranks])
        own = np.concatenate([own, np.repeat(wide, self.letters) * self.letters + np.tile(np.arange(self.letters), len(wide))])
        parent, letter = own // self.letters, own % self.letters
        parent, letter = parent[letter > 0], letter[letter > 0]
        new_low, new_high = self.step(letter, low[parent], high[parent])
        there = new_low < new_high
        return parent[there], letter[there], new_low[there], new_high[there]

    def one_error(self, words: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number in words, number in the index) of words one edit apart, the last exact letters of the first untouched."""
        flat, starts = self.encode(words)
        query = np.arange(len(words))
        left = np.diff(starts)
        stop = left - exact
        low, high = np.zeros(len(words), np.int64), np.full(len(words), np.searchsorted(self.steps, self.size + 1))
        done = []
        while len(query):
            ready = left == stop[query]
            done.append((query[ready], left[ready], low[ready], high[ready]))
            query, left, low, high = query[~ready], left[~ready] - 1, low[~ready], high[~ready]
            low, high = self.step(flat[starts[query] + left], low, high)
            there = low < high
            query, left, low, high = query[there], left[there], low[there], high[there]
        query, left, low, high = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (query, left, low, high)
        off = [np.zeros(0, np.int64)] * 4
        found = []
        while len(query) or len(off[0]):
            parent, letter, new_low, new_high = self.children(low, high)
            some = left > 0
            own = np.where(some, flat[np.minimum(starts[query] + np.maximum(left, 1) - 1, max(len(flat) - 1, 0))], -1) if len(query) else query
            other = some[parent] & (letter != own[parent])
            put_in = (query[parent], left[parent], new_low, new_high)
            replaced = (query[parent][other], left[parent][other] - 1, new_low[other], new_high[other])
            left_out = (query[some], left[some] - 1, low[some], high[some])
            # What has had its error reads the rest exactly, and a delimiter at last.
            q, rest, a, b = off
            a, b = self.step(np.where(rest > 0, flat[starts[q] + np.maximum(rest, 1) - 1], 0), a, b) if len(q) else (a, b)
            there, end = a < b, rest == 0
            found.append((q[there & end], self.words[a[there & end]]))
            going = there & ~end
            off = [np.concatenate(x) for x in zip((q[going], rest[going] - 1, a[going], b[going]), put_in, replaced, left_out, strict=True)]
            query, left, low, high = query[some], left[some] - 1, low[some], high[some]
            low, high = self.step(own[some], low, high)
            there = low < high
            query, left, low, high = query[there], left[there], low[there], high[there]
        pairs = np.unique(np.concatenate([q * (self.size + 1) + w for q, w in found])) if found else np.zeros(0, np.int64)
        return pairs // (self.size + 1), pairs % (self.size + 1)


def _exact(length: int, backward: bool) -> int:
    """Letters of the half read exactly: the second half from the right, the first one from the left."""
    return length // 2 if backward else length - length // 2


_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("least", pa.int64()), ("best", pa.string())])


def _search(cell: pa.Table) -> pa.Table:
    """Of each word that asks in one cell: how many near words the cell's index has, and the best of them (least is its -n)."""
    backward = cell.column("backward")[0].as_py()
    rows = zip(*(cell.column(c).to_pylist() for c in ("word", "n", "indexed", "asks")), strict=True)
    indexed, asking = {}, set()
    for word, n, there, asks in rows:
        if there:
            indexed[word] = n
        if asks:
            asking.add(word)
    words, asking = sorted(indexed), sorted(asking)
    if not words or not asking:
        return _NEAR.empty_table()
    turn = (lambda w: w[::-1]) if backward else (lambda w: w)
    index = SuffixRanks([turn(w) for w in words])
    counts = np.array([indexed[w] for w in words], np.int64)
    out = []
    for start in range(0, len(asking), _QUERIES):
        part = asking[start : start + _QUERIES]
        asked, near = index.one_error([turn(w) for w in part], np.array([_exact(len(w), backward) for w in part]))
        if backward:
            # With the second half untouched too, the search from the right has it.
            halves = [w[len(w) // 2 :] for w in part]
            fresh = np.array([not words[b].endswith(halves[a]) for a, b in zip(asked.tolist(), near.tolist(), strict=True)], bool)
            asked, near = asked[fresh], near[fresh]
        order = np.lexsort((near, -counts[near], asked))
        asked, near = asked[order], near[order]
        each, first, sizes = np.unique(asked, return_index=True, return_counts=True)
        best = near[first]
        out.append(pa.table([[part[k] for k in each], sizes, -counts[best], [words[k] for k in best]], schema=_NEAR))
    return pa.concat_tables(out)


def near_words(words: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(word, n_near, least, best) of each word of (word, n), words distinct, that has near words: one edit apart.

    best has the largest n, of several the smallest in code-point order; least is its -n.
    """
    settings = settings or Settings()
    spark = words.sparkSession
    size = F.length("word")
    sides = []
    for backward, part, rounded in ((False, "right", F.ceil), (True, "left", F.floor)):
        # A word is met by queries of its own length and of one more or less.
        halves = F.array_distinct(F.array(*[rounded((size + k) / 2).cast("int") for k in (-1, 0, 1)]))
        side = words.select("word", "n", rounded(size / 2).cast("int").alias("own"), F.explode(halves).alias("half"))
        sides.append(side.select(F.lit(backward).alias("backward"), "word", "n", F.expr(f"xxhash64(half, {part}(word, half))").alias("half"), F.expr("half = own").alias("asks")))
    copies = sides[0].unionAll(sides[1])
    cells = max(parallelism(spark), -(-4 * words.count() // settings.cell_words))
    hot = copies.groupBy("backward", "half").agg(F.count("*").alias("size")).where(F.col("size") > settings.cell_words)
    hot = saved(hot.select("backward", "half", F.ceil(F.col("size") / settings.cell_words).cast("int").alias("split")), "hot_halves")
    marked = copies.join(hot, ["backward", "half"], "left")
    usual = marked.where("split IS NULL").select("backward", F.pmod("half", F.lit(cells)).alias("cell"), F.lit(-1).alias("sub"), "word", "n", F.lit(True).alias("indexed"), "asks")
    # A hot half has cells of its own; who asks does so in all of them.
    mine = F.pmod(F.xxhash64("word"), F.col("split"))
    subs = F.when(F.col("asks"), F.sequence(F.lit(0), F.col("split") - 1)).otherwise(F.array(mine.cast("int")))
    split = marked.where("split IS NOT NULL").select("backward", F.col("half").alias("cell"), F.explode(subs).alias("sub"), "word", "n", mine.alias("mine"), "asks")
    split = split.select("backward", "cell", "sub", "word", "n", (F.col("sub") == F.col("mine")).alias("indexed"), "asks")
    found = usual.unionAll(split).groupBy("backward", "cell", "sub").applyInArrow(_search, "word string, n_near long, least long, best string")
    best = F.min(F.struct("least", "best")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", "best.least", "best.best")


def variant_groups(words: DataFrame, settings: Settings | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n of each row of (word, n), words distinct.

    form is the best near word if that is settings.factor times as frequent at least; root is where the forms lead to, the word
    itself if it has none. An empty table gives an empty result.
    """
    settings = settings or Settings()
    words = saved(words, "words")
    near = words.join(near_words(words, settings), "word", "left")
    formed = F.col("least") <= F.col("n") * -settings.factor
    near = saved(
        near.select("word", F.when(formed, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, -F.col("least")).alias("form_n")), "near_words"
    )
    links = near.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # Frequencies grow by the factor at each form, so a chain is short; every round doubles what it has gone through.
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = saved(links.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if links.where("moved").isEmpty():
            break
        links = links.drop("moved")
    return near.join(links.drop("moved"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", settings: Settings | None = None) -> DataFrame:
    """One row per word of all texts (see count_words and variant_groups): word, form, root, n, n_near, form_n. Other columns are ignored."""
    return variant_groups(count_words(docs, id_column, text_column, settings), settings)
