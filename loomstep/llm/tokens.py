"""Token counts under a unigram vocabulary, with forward scores shared by all words of a common prefix."""

from __future__ import annotations

import math
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstep.llm.common import CACHE_WORDS, few_rows, raw_texts, small_batches

#: What begins each pre-token in the vocabulary.
WORD_START = "▁"
#: Characters of a word that is scored with others, at most.
LONG = 256
#: Words of a group of batches whose distinct pre-tokens share one trie, about.
GROUP_WORDS = 1_000_000


def fit_scores(docs: DataFrame, path: str, *, text_col: str = "text") -> dict[str, float]:
    """The pieces of a sentencepiece model with log-probabilities, fitted on all documents.

    A piece counts as often as the model's own split of the corpus's words has it, and half a time more; words
    are split once for all of their occurrences in a part of the corpus. Control, unknown and byte pieces are
    left out; what no piece covers counts as its UTF-8 bytes. The driver gets a count for each piece at most.
    """
    import sentencepiece

    with open(path, "rb") as f:
        proto = f.read()
    model = sentencepiece.SentencePieceProcessor(model_proto=proto)
    shared = docs.sparkSession.sparkContext.broadcast({"proto": proto})

    def run(batches):
        import sentencepiece

        if "model" not in shared.value:
            shared.value["model"] = sentencepiece.SentencePieceProcessor(model_proto=shared.value["proto"])
        held, words, total = shared.value["model"], Counter(), np.zeros(shared.value["model"].get_piece_size(), np.int64)

        def flush() -> None:
            ids = held.encode([w.decode() for w in words], num_threads=1) if words else []
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            times = np.repeat(np.fromiter(words.values(), np.int64, len(words)), sizes)
            np.add.at(total, np.fromiter(chain.from_iterable(ids), np.int64, int(sizes.sum())), times)
            words.clear()

        for batch in small_batches(batches):
            for text in raw_texts(batch.column(0)):
                words.update(text.split())
            if len(words) > CACHE_WORDS:
                flush()
        flush()
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["piece", "n"])

    counts = docs.select(text_col).mapInArrow(run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    with few_rows(docs.sparkSession):
        counts = counts.collect()
    times = {r["piece"]: r["n"] for r in counts}
    ids = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    norm = math.log(sum(times.get(i, 0) + 0.5 for i in ids))
    return {model.id_to_piece(i): math.log(times.get(i, 0) + 0.5) - norm for i in ids}


class Vocabulary:
    """The pieces as a trie in arrays: (node, character) to node, and the score of the piece that ends in a node."""

    def __init__(self, scores: dict[str, float]):
        self.byte = min(scores.values(), default=0.0) - 1.0
        self.edges = edges = {}
        ends = {0: np.nan}
        for piece, score in scores.items():
            node = 0
            for c in map(ord, piece):
                node = edges.setdefault(node << 21 | c, len(edges) + 1)
            ends[node] = score
        keys = np.fromiter(edges, np.int64, len(edges))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.to = np.append(np.fromiter(edges.values(), np.int64, len(edges))[order], 0)
        self.ends = np.array([ends.get(i, np.nan) for i in range(len(edges) + 1)])

    def step(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The node behind each edge, 0 where there is none."""
        key = nodes << 21 | chars
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.to[at], 0)


def long_count(word: str, vocabulary: Vocabulary) -> int:
    """Tokens of the best split of one word, by the recursion of trie_counts() along its single path."""
    edges, ends, byte = vocabulary.edges, vocabulary.ends.tolist(), vocabulary.byte
    under: list[tuple[int, float, int]] = []  # pieces under way: vocabulary node, score and tokens before the piece
    score, count = 0.0, 0
    for c in map(ord, word):
        width = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
        under.append((0, score, count))
        on, top, fewest = [], score + width * byte, count + width
        for node, before, tokens in under:
            if to := edges.get(node << 21 | c):
                on.append((to, before, tokens))
                total = before + ends[to]
                if total > top or total == top and tokens + 1 < fewest:  # of no piece that ends here, total is NaN
                    top, fewest = total, tokens + 1
        under, score, count = on, top, fewest
    return count


def trie_counts(words: list[str], vocabulary: Vocabulary) -> np.ndarray:
    """Tokens of the best split of each word; words: distinct and sorted.

    The words are inserted in a trie level by level. A node has the score and the number of tokens of the best
    split of its prefix, scored once for all words below it from the pieces that are under way in its parent;
    a word's count is stored where it ends. Of equal scores the split with fewer tokens counts. Words of over
    LONG characters, of which few share a prefix to their ends, are each scored alone by long_count().
    """
    long = [i for i, w in enumerate(words) if len(w) > LONG]
    if long:
        counts = np.zeros(len(words), np.int64)
        counts[long] = [long_count(words[i], vocabulary) for i in long]
        short = np.setdiff1d(np.arange(len(words)), long)
        counts[short] = trie_counts([words[i] for i in short], vocabulary)
        return counts
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    counts = np.zeros(len(words), np.int64)
    alive, parent = np.flatnonzero(sizes > 0), np.zeros(int((sizes > 0).sum()), np.int64)
    score, count = np.zeros(1), np.zeros(1, np.int64)
    # Pieces under way: trie node, vocabulary node, score and tokens before the piece; ordered by trie node.
    at, piece, before, tokens = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1), np.zeros(1, np.int64)
    depth = 0
    while len(alive):
        chars = codes[begin[alive] + depth]
        new = np.append(True, (parent[1:] != parent[:-1]) | (chars[1:] != chars[:-1]))
        node = np.cumsum(new) - 1
        up, char = parent[new], chars[new]
        n = len(up)
        width = 1 + (char > 0x7F) + (char > 0x7FF) + (char > 0xFFFF)
        held = np.bincount(at, minlength=len(score))
        first = np.cumsum(held) - held
        of = np.repeat(np.arange(n), held[up])
        take = np.arange(len(of)) - np.repeat(np.cumsum(held[up]) - held[up], held[up]) + first[up][of]
        piece = vocabulary.step(piece[take], char[of])
        on = piece > 0
        at, piece, before, tokens = of[on], piece[on], before[take][on], tokens[take][on]
        total = before + vocabulary.ends[piece]
        full = ~np.isnan(total)
        best, fewest = score[up] + width * vocabulary.byte, count[up] + width
        top = best.copy()
        np.maximum.at(top, at[full], total[full])
        fewest = np.where(top == best, fewest, np.iinfo(np.int64).max)
        tie = full & (total == top[at])
        np.minimum.at(fewest, at[tie], tokens[tie] + 1)
        score, count = top, fewest
        depth += 1
        ended = sizes[alive] == depth
        counts[alive[ended]] = count[node[ended]]
        alive, parent = alive[~ended], node[~ended]
        # A new piece may begin behind every node.
        order = np.argsort(np.append(at, np.arange(n)), kind="stable")
        at = np.append(at, np.arange(n))[order]
        piece = np.append(piece, np.zeros(n, np.int64))[order]
        before, tokens = np.append(before, score)[order], np.append(tokens, count)[order]
    return counts


def count_tokens(docs: DataFrame, scores: dict[str, float], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) of each row's whole text; pre-tokens are words between ASCII white space.

    Null and empty texts have zeros, repeated rows repeat, other columns are not read, an empty table gives no
    rows. There is no shuffle: each worker inserts the distinct pre-tokens of a group of batches that it has
    not counted before in a trie in sorted order, and keeps their counts for its later tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"scores": scores})

    def run(batches):
        state = shared.value
        if "known" not in state:
            state |= {"vocabulary": Vocabulary(state["scores"]), "known": {}}
        known, group, held = state["known"], [], 0

        def counted():
            new = sorted(set().union(*(words for _, split in group for words in split)).difference(known))
            known.update(zip(new, trie_counts([WORD_START + w.decode() for w in new], state["vocabulary"]).tolist(), strict=True))
            for ids, split in group:
                pretokens = pa.array(list(map(len, split)), pa.int64())
                tokens = pa.array([sum(map(known.__getitem__, words)) for words in split], pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pretokens, tokens], names=["doc_id", "n_pretokens", "n_tokens"])
            if len(known) > CACHE_WORDS:
                known.clear()

        for batch in small_batches(batches):
            split = [t.split() for t in raw_texts(batch.column(1))]
            group.append((batch.column(0), split))
            held += sum(map(len, split))
            if held > GROUP_WORDS:
                yield from counted()
                group, held = [], 0
        if group:
            yield from counted()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
