"""Word-piece lengths by a linear longest-match automaton.

The vocabulary is a trie. Each node has a failure link, the node for what remains once the longest pieces
at its front are taken, and the number of those pieces, both worked out beforehand. A word is then read once,
letter by letter, and the popped pieces are counted, never built.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from pagemart.llm.base import once, query, table, text_kept

#: Fixed value: the sign that begins a word in the piece vocabulary.
WORD_MARK = "▁"
UNKNOWN = 1 << 40
ROOT, NOWHERE = 0, -1


class Automaton:
    """Counts the pieces that greedy longest match takes from a word; ``UNKNOWN`` + 1 where it gets stuck."""

    def __init__(self, pieces: Iterable[str]):
        self.steps: list[dict[str, int]] = [{}]
        ends = [False]
        for piece in pieces:
            node = ROOT
            for sign in piece:
                node = self.steps[node].setdefault(sign, len(self.steps))
                if node == len(self.steps):
                    self.steps.append({})
                    ends.append(False)
            ends[node] = node != ROOT
        self.link, self.popped = [NOWHERE] * len(self.steps), [0] * len(self.steps)
        level = [ROOT]
        while level:  # shorter prefixes first: a link always leads to a shorter one
            deeper = []
            for parent in level:
                for sign, node in self.steps[parent].items():
                    deeper.append(node)
                    if ends[node]:
                        self.link[node], self.popped[node] = ROOT, 1
                        continue
                    popped, at = self.popped[parent], self.link[parent]
                    while at != NOWHERE and sign not in self.steps[at]:
                        popped, at = popped + self.popped[at], self.link[at]
                    if at != NOWHERE:
                        self.link[node], self.popped[node] = self.steps[at][sign], popped
            level = deeper

    def length(self, word: str) -> int:
        steps, link, popped = self.steps, self.link, self.popped
        node, count = ROOT, 0
        for sign in word:
            while (ahead := steps[node].get(sign, NOWHERE)) == NOWHERE:
                if link[node] == NOWHERE:
                    return UNKNOWN + 1
                count, node = count + popped[node], link[node]
            node = ahead
        while node != ROOT:
            if link[node] == NOWHERE:
                return UNKNOWN + 1
            count, node = count + popped[node], link[node]
        return count


class Lengths(dict):
    """Lengths of words met before; emptied when it holds ``most``, so memory stays bounded."""

    def __init__(self, automaton: Automaton, mark: str, most: int = 400_000):
        super().__init__()
        self.automaton, self.mark, self.most = automaton, mark, most

    def __missing__(self, word: str) -> int:
        found = self.automaton.length(self.mark + word)
        if len(word) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[word] = found
        return found


def model_pieces(path: str) -> list[str]:
    """The pieces of a model file that stand for text: no control signs, unknown or single bytes."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]


def _lengths(path: str) -> Lengths:
    return once(("word lengths", path), lambda: Lengths(Automaton(model_pieces(path)), WORD_MARK))


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_words``, ``n_tokens`` and ``n_unknown`` words.

    Words are the runs between white space; each begins with the word mark. A word that longest match cannot
    cover is one unknown token as a whole. Null and empty texts have no words. Repeated rows are each
    counted; an empty table gives no rows; other columns are not read.
    """
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _lengths(path).__getitem__
        for batch in batches:
            words, tokens, unknown = [], [], []
            for text in batch.column(1).to_pylist():
                own = (text or "").split()
                total = sum(map(lengths, own))
                words.append(len(own))
                tokens.append(total % UNKNOWN)
                unknown.append(total // UNKNOWN)
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in (words, tokens, unknown))]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_words", "n_tokens", "n_unknown"])

    return text_kept(docs.select(id_col, text_col), text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_words long, n_tokens long, n_unknown long"
    )


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
