"""Unigram token counts with one forward pass per shared prefix.

The pre-tokens of a text are its white-space separated words, each after the word mark. A
pre-token's tokens are those of its most probable segmentation under a unigram model over
the pieces of a public vocabulary, whose log-probabilities follow the pieces' rank (Zipf);
characters outside the vocabulary cost one token per UTF-8 byte. The best score of a prefix
does not depend on what follows, so distinct pre-tokens are put into a trie, its nodes carry
the forward score, and each node is computed once for all pre-tokens through it; terminal
nodes give the counts. A task keeps the counts of the words it has met in a bounded table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
BYTE_PENALTY = 10.0
TABLE_WORDS, TRIE_NODES = 300_000, 300_000
_models: dict[str, tuple[dict[str, float], dict[str, int]]] = {}


def unigram_scores(path: str) -> dict[str, float]:
    """Piece -> log-probability by rank, from a sentencepiece file; control and byte pieces are left out."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    norm = math.log(sum(1 / (r + 2) for r in range(len(pieces))))
    return {p: -math.log(r + 2) - norm for r, p in enumerate(pieces)}


class Trie:
    """Forward scores of all prefixes of the inserted pre-tokens. A node is (best score, tokens,
    children by character); the root stands for the empty prefix."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        sizes: dict[str, set[int]] = {}
        for piece in scores:
            if len(piece) > 2:
                sizes.setdefault(piece[-3:], set()).add(len(piece))
        self.sizes = {end: sorted(n) for end, n in sizes.items()}  # lengths of longer pieces by their last three characters
        self.unknown = min(scores.values(), default=0.0) - BYTE_PENALTY
        self.root: tuple[float, int, dict] = (0.0, 0, {})
        self.nodes = 0

    def insert(self, token: str) -> int:
        """The number of tokens of ``token``; nodes already there are reused."""
        path, scores = [self.root], self.scores
        for i, char in enumerate(token, 1):
            children = path[-1][2]
            node = children.get(char)
            if node is None:
                before, score = path[-1], scores.get(char)
                n = 1 if score is not None else len(char.encode("utf-8", "surrogatepass"))
                best, count = before[0] + (n * self.unknown if score is None else score), before[1] + n
                for size in (2, *self.sizes.get(token[i - 3:i], ())) if i > 2 else (2,):
                    if size > i:
                        break
                    score = scores.get(token[i - size:i])
                    if score is not None:
                        before = path[i - size]
                        way = before[0] + score
                        if way > best or (way == best and before[1] + 1 < count):
                            best, count = way, before[1] + 1
                node = children[char] = (best, count, {})
                self.nodes += 1
            path.append(node)
        return path[-1][1]


def _counter(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _models:
            _models[path] = (unigram_scores(path), {})
        scores, known = _models[path]
        trie = Trie(scores)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                some = batch.slice(at, 200)
                raw = [(t or "").encode() for t in some.column("text").to_pylist()]
                split = [t.split() for t in raw]  # of bytes: ASCII white space
                words = set().union(*split)
                if len(known) > TABLE_WORDS:
                    kept = {w: known[w] for w in words if w in known}
                    known.clear()
                    known.update(kept)
                if trie.nodes > TRIE_NODES:  # and those of 200 texts
                    trie.root[2].clear()
                    trie.nodes = 0
                for word in words.difference(known):
                    known[word] = trie.insert(MARK + word.decode())
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(map(len, split), pa.int64()), pa.array(map(len, raw), pa.int64()),
                                                  pa.array([sum(map(known.__getitem__, w)) for w in split], pa.int64())], schema=schema)
    return run


def token_counts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_bytes, n_tokens for every row; null and wordless texts have 0 tokens.
    Further columns are ignored, repeated rows are counted each. Narrow: no shuffle."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(_counter(model), "doc_id long, n_words long, n_bytes long, n_tokens long")
