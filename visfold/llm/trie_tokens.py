"""Token counts of a unigram vocabulary by trie-shared dynamic programming.

The best segmentation of a pre-token maximises the sum of its pieces' scores. All
distinct pre-tokens that a task meets go into one trie; the best score of a path
from the root is computed once when its node is made, from the nodes
above it, so words with a common prefix share that work. A node at which a pre-token ends
keeps the number of tokens, and a document's count is the sum over its pre-tokens.

Row-local over whole texts with no shuffle: the counts of a document need nothing of another
one. The trie starts anew when it has ``KEPT_NODES`` nodes, also within a text, and a pre-token longer than
``LONG_WORD`` letters gets the same forward scores in a window as wide as the longest piece instead of nodes.
Both bound a worker's memory and change no result.
"""

from __future__ import annotations

from functools import lru_cache, partial

from pyspark.sql import DataFrame

from .common import map_texts

#: Nodes of a worker's trie before it starts anew.
KEPT_NODES = 1_200_000
#: Letters of a pre-token from which on it gets no nodes: others seldom share so long a prefix.
LONG_WORD = 256
#: The mark that stands before each pre-token.
SPACE = "▁"
#: An unknown letter scores this much below the worst piece.
UNKNOWN_PENALTY = 10.0


class PreTokenTrie:
    """Nodes are indices into lists: children, best score, tokens of the best path."""

    def __init__(self, scores: dict[str, float]):
        """``scores``: log-probabilities, none above 0."""
        self.scores = scores
        #: Score of each piece, and None for what only ends longer pieces: a place to stop looking.
        self.endings: dict[str, float | None] = {p[i:]: None for p in scores for i in range(1, len(p))}
        self.endings.update(scores)
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.longest = max(map(len, scores), default=1)
        self.byte_pieces = all(f"<0x{b:02X}>" in scores for b in range(256))
        self.clear()

    def clear(self) -> None:
        self.children: list[dict[str, int] | None] = [None]
        self.best = [0.0]
        self.tokens = [0]
        #: Tokens at the node where a pre-token ends.
        self.terminal: dict[str, int] = {}

    def insert(self, word: str) -> int:
        """Walk or make the nodes of a pre-token; its number of tokens, kept at its last node.

        A new node gets the best (score, tokens) of its path: over the pieces that end there,
        the best of the node where the piece starts plus the piece.
        """
        children, best, tokens, endings, scores = self.children, self.best, self.tokens, self.endings, self.scores
        node, path, end = 0, [0], 0
        for letter in word:
            end += 1
            below = children[node]
            if below is None:
                below = children[node] = {}
            child = below.get(letter)
            if child is None:
                score, n = float("-inf"), 0
                if letter not in scores:  # a letter without a piece: its bytes, or one unknown token
                    score = best[node] + self.unknown
                    n = tokens[node] + (len(letter.encode()) if self.byte_pieces else 1)
                for start in range(end - 1, -1, -1):
                    piece = endings.get(word[start:end], 1.0)
                    if piece is None:
                        continue
                    if piece > 0:  # nothing ends like this, so nothing longer does
                        break
                    before = path[start]
                    value = best[before] + piece
                    if value > score:
                        score, n = value, tokens[before] + 1
                child = below[letter] = len(best)
                children.append(None)
                best.append(score)
                tokens.append(n)
            path.append(child)
            node = child
        return tokens[node]

    def unshared(self, word: str) -> int:
        """Tokens of a long pre-token: forward scores of its last letters only, in a ring."""
        ring = self.longest + 1
        best, tokens = [0.0] * ring, [0] * ring
        endings, scores = self.endings, self.scores
        for end in range(1, len(word) + 1):
            letter, last = word[end - 1], (end - 1) % ring
            score, n = float("-inf"), 0
            if letter not in scores:
                score = best[last] + self.unknown
                n = tokens[last] + (len(letter.encode()) if self.byte_pieces else 1)
            for start in range(end - 1, -1, -1):
                piece = endings.get(word[start:end], 1.0)
                if piece is None:
                    continue
                if piece > 0:
                    break
                value = best[start % ring] + piece
                if value > score:
                    score, n = value, tokens[start % ring] + 1
            best[end % ring], tokens[end % ring] = score, n
        return tokens[len(word) % ring]

    def count(self, text: str) -> tuple[int, int]:
        """(tokens, pre-tokens) of a whole text."""
        words = text.split()
        counts: dict[str, int] = {}
        for word in set(words):
            if len(word) > LONG_WORD:
                counts[word] = self.unshared(SPACE + word)
                continue
            n = self.terminal.get(word)
            if n is None:
                if len(self.best) > KEPT_NODES:
                    self.clear()
                n = self.terminal[word] = self.insert(SPACE + word)
            counts[word] = n
        return sum([counts[w] for w in words]), len(words)


@lru_cache(maxsize=2)
def vocabulary_scores(model_file: str) -> dict[str, float]:
    """Unigram scores of a sentencepiece file's pieces: log-probabilities by Zipf's law on the
    rank (bytes last), as the file's own scores are merge ranks and no probabilities."""
    import math

    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [i for i in range(model.get_piece_size()) if not model.is_control(i) and not model.is_unknown(i)]
    pieces.sort(key=lambda i: (model.is_byte(i), i))
    total = sum(1 / (k + 1) for k in range(len(pieces)))
    return {model.id_to_piece(i): -math.log((k + 1) * total) for k, i in enumerate(pieces)}


def _make(model_file: str):
    trie = PreTokenTrie(vocabulary_scores(model_file))

    def rows(texts: list[str | None]):
        found = [trie.count(t or "") for t in texts]
        return [f[0] for f in found], [f[1] for f in found]
    return rows


def count_tokens(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens, n_pretokens of each whole text (pre-tokens: split at white space).

    A null or empty text has none. Null ids and repeated rows keep their rows; other columns
    are not read. ``model_file`` must be readable on every executor.
    """
    return map_texts(docs, partial(_make, model_file), "n_tokens bigint, n_pretokens bigint")
