"""Numbers of word pieces by a linear longest-match automaton.

The pieces of a vocabulary form a trie; pieces that continue a word hang below a second root. A word
is read with the vocabulary's mark for the start of a word before it, which is a piece by itself too.
Where the trie has no edge for the next character, the longest piece read so far is complete:
the failure link leads to the state that has read what is left of the characters after it, and
how many pieces are complete on the way is stored with the link. Every character is read once,
and only the numbers of pieces are kept, never the pieces.
"""

from collections import deque
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointmill.llm.common import Numbered

#: Marks the start of a word in a vocabulary of pieces.
WORD_START = "▁"
_NONE = -1


class Automaton:
    """count(word): the pieces of greedy longest match.

    spare gives the pieces of a character that no piece covers; without it such a word is one (the unknown piece).
    """

    def __init__(self, starts: set[str], continues: set[str], spare: Callable[[str], int] | None = None):
        self.spare = spare
        # With spare, every character of a piece can stand alone, so what is left of a piece can always be read.
        alone = {c for piece in starts | continues for c in piece} - continues if spare else set()
        first = {piece[0] for piece in starts if piece} - starts if spare else set()
        self.edges: list[dict[str, int]] = [{}, {}]
        # How many pieces end here; 0 where none does.
        final = [0, 0]
        self.depth = [0, 0]
        for root, pieces in ((0, starts | first), (1, continues | alone)):
            spared = (first, alone)[root]
            for piece in pieces:
                at = root
                for c in piece:
                    to = self.edges[at].get(c)
                    if to is None:
                        to = self.edges[at][c] = len(self.edges)
                        self.edges.append({})
                        final.append(0)
                        self.depth.append(self.depth[at] + 1)
                    at = to
                if at > 1:
                    final[at] = spare(piece) if piece in spared else 1
        size = len(self.edges)
        self.fail, self.popped = [_NONE] * size, [0] * size
        queue = deque((parent, c, child) for parent in (0, 1) for c, child in self.edges[parent].items())
        while queue:
            parent, c, child = queue.popleft()
            if final[child]:
                self.fail[child], self.popped[child] = 1, final[child]
            else:
                # What the parent has left over, then c, popping further pieces until c can follow.
                at, popped = self.fail[parent], self.popped[parent]
                while at != _NONE and c not in self.edges[at]:
                    popped += self.popped[at]
                    at = self.fail[at]
                if at != _NONE:
                    self.fail[child], self.popped[child] = self.edges[at][c], popped
            queue.extend((child, d, grandchild) for d, grandchild in self.edges[child].items())

    def count(self, word: str) -> int:
        edges, fail, popped = self.edges, self.fail, self.popped
        at, pieces = 0, 0
        for c in word:
            while c not in edges[at]:
                pieces += popped[at]
                at = fail[at]
                if at == _NONE:
                    if self.spare is None:
                        return 1
                    pieces += self.spare(c)
                    at = 1
                    break
            else:
                at = edges[at][c]
        # The end of the word completes what is left.
        while at != 1:
            if at == _NONE:
                return 1
            pieces += popped[at]
            at = fail[at]
        return pieces


def _model(model_file: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_file)


def pieces_of(model_file: str) -> tuple[set[str], set[str]]:
    """Pieces that start a marked word, the mark alone too, and pieces that may follow, of a sentence-piece vocabulary without its special and byte pieces."""
    model = _model(model_file)
    ids = [k for k in range(model.vocab_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))]
    pieces = {model.id_to_piece(k) for k in ids}
    return {p for p in pieces if p.startswith(WORD_START)}, pieces


def spare_of(model_file: str) -> Callable[[str], int]:
    """Pieces of a character outside the vocabulary: its bytes if the vocabulary has all byte pieces, else one unknown piece."""
    model = _model(model_file)
    if sum(map(model.is_byte, range(model.vocab_size()))) == 256:
        return lambda c: len(c.encode())
    return lambda c: 1


@lru_cache(maxsize=2)
def automaton(model_file: str) -> tuple[Automaton, Numbered]:
    made = Automaton(*pieces_of(model_file), spare_of(model_file))
    return made, Numbered(lambda word: made.count(WORD_START + word))


def token_counts(docs: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of docs: id, n_words, n_tokens.

    Words are split at white space; a word's pieces are those of greedy longest match from its start, the mark for the start of a
    word before it. A character that no piece covers counts its byte pieces, or one unknown piece. NULL and empty texts have none. Repeated rows are counted each; other columns are ignored.
    """

    @F.pandas_udf("n_words long, n_tokens long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        _, numbers = automaton(model_file)
        for part in texts:
            out = np.zeros((len(part), 2), np.int64)
            for k, text in enumerate(part):
                words = text.split() if text else []
                out[k] = len(words), sum(map(numbers.__getitem__, words))
            yield pd.DataFrame(out, columns=["n_words", "n_tokens"])

    counted = docs.select(F.col(id_column).alias("id"), count(F.col(text_column)).alias("n"))
    return counted.select(F.col("id").alias(id_column), "n.n_words", "n.n_tokens")
