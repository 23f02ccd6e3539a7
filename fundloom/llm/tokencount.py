"""Token counts under a unigram vocabulary, by dynamic programming shared along a trie of words.

A word's segmentation is the one with the best sum of piece scores. The best score of a prefix depends on the prefix alone,
so words that begin alike share that work: distinct words are inserted in a trie, every node holds the best score of its
prefix and how many pieces that takes, and the node a word ends at stores its count.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batches, record, text_of, worker_state

#: Stands for the space before a word.
START = "▁"
#: Nodes, words and characters of words that a worker keeps before it starts anew; what is forgotten is computed again.
NODES, WORDS, CHARS = 300_000, 500_000, 1 << 25
#: A longer word shares hardly anything with others: it is walked through without nodes of its own.
LONG = 256


def piece_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Pieces with scores: the log-probability of a piece by Zipf's law over its rank. Any character that no piece holds
    costs one piece for each of its UTF-8 bytes, each a little worse than the worst piece."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(k) for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))]
        self.scores = {p: -math.log(k + 2) for k, p in enumerate(pieces)}
        self.longest = max(map(len, self.scores))
        self.byte = -math.log(len(pieces) + 2) - 1


class Trie:
    """Best score and number of pieces of every prefix that was seen, and the counts of whole words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.words, self.chars = vocabulary, {}, 0
        self.clear()

    def clear(self) -> None:
        # node 0 is the empty prefix
        self.child: list[dict[str, int]] = [{}]
        self.score, self.count = [0.0], [0]

    def insert(self, word: str) -> int:
        """How many pieces the best segmentation of the word has; of equally good ones the one with fewer pieces."""
        voc, path, node = self.vocabulary, [0], 0
        scores, longest = voc.scores, voc.longest
        for at, c in enumerate(word, 1):
            node = path[-1]
            below = self.child[node].get(c)
            if below is None:
                # one piece more for each byte of the character itself, or any piece that ends here
                size = len(c.encode("utf-8", "surrogatepass"))
                best = self.score[node] + size * voc.byte, -(self.count[node] + size)
                for first in range(max(0, at - longest), at):
                    s = scores.get(word[first:at])
                    if s is not None:
                        best = max(best, (self.score[path[first]] + s, -(self.count[path[first]] + 1)))
                below = self.child[node][c] = len(self.score)
                self.child.append({})
                self.score.append(best[0])
                self.count.append(-best[1])
            path.append(below)
        return self.count[path[-1]]

    def walk(self, word: str) -> int:
        """The same number with the scores of no more prefixes than the longest piece reaches back to."""
        voc, longest = self.vocabulary, self.vocabulary.longest
        scores, ring = voc.scores, longest + 1
        back = [(0.0, 0)] * ring
        for at, c in enumerate(word, 1):
            size = len(c.encode("utf-8", "surrogatepass"))
            score, less = back[(at - 1) % ring]
            best = score + size * voc.byte, less - size
            for first in range(max(0, at - longest), at):
                s = scores.get(word[first:at])
                if s is not None:
                    best = max(best, (back[first % ring][0] + s, back[first % ring][1] - 1))
            back[at % ring] = best
        return -back[len(word) % ring][1]

    def counts(self, words: list[str]) -> None:
        """Makes sure that all these words are known."""
        new = sorted(set(words).difference(self.words))
        size = sum(map(len, new))
        if len(self.words) + len(new) > WORDS or self.chars + size > CHARS:
            self.words.clear()
            new = sorted(set(words))
            self.chars, size = 0, sum(map(len, new))
        self.chars += size
        for word in new:
            if len(self.score) > NODES:
                self.clear()
            self.words[word] = self.insert(START + word) if len(word) <= LONG else self.walk(START + word)


def _count(path: str):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])

    def run(source):
        known = worker_state("tries", dict)
        if path not in known:
            known[path] = Trie(Vocabulary(path))
        trie = known[path]
        for batch in batches(source, 1 << 20):
            split = [t.split() for t in batch.column(1).to_pylist()]
            trie.counts([w for words in split for w in words])
            of = trie.words.__getitem__
            yield record(schema, batch.column(0), [len(w) for w in split], [sum(map(of, w)) for w in split])
    return run


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_words and n_tokens of each row of ``docs`` (doc_id, text; other columns are not read).

    Words are what white space parts, each with a mark for the space before it. Whole texts are counted where they are
    read, without a shuffle; a worker keeps bounded numbers of trie nodes, words and characters, and a word without end,
    such as a text without spaces, takes no more than its own text. Null and empty texts have no words and no tokens; a
    repeated row is counted again; an empty table gives an empty table.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(_count(vocabulary or piece_path()), "doc_id long, n_words long, n_tokens long")
