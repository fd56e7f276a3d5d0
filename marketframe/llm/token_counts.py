"""Greedy word-piece lengths by a linear longest-match automaton."""

from __future__ import annotations

import json
from collections import deque
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from marketframe.llm.arrow import add_columns, read_table, text_buffer
from marketframe.llm.textscan import NOT_SPACE, scan_words, word_hashes
from marketframe.llm.token_ids import BYTE_LETTERS

#: Words longer than this are walked one by one, the others side by side.
LONG_WORD = 64


def byte_level_pieces(path: str) -> tuple[list[bytes], list[bytes]]:
    """Pieces of a byte-level vocabulary file as bytes: those that begin a word (with a space in
    front) and those that go on one."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    byte_of = {c: b for b, c in BYTE_LETTERS.items()}
    pieces = [bytes(byte_of[c] for c in p) for p in vocabulary if all(c in byte_of for c in p)]
    return [p for p in pieces if p[:1] == b" "], [p for p in pieces if p[:1] != b" "]


@dataclass
class Automaton:
    """A trie of the vocabulary whose nodes know what to do when no child fits: how many pieces are
    complete there (``popped``) and at which node the rest goes on (``failure``; -1: the word has
    no pieces).  Node 0 begins words, node 1 goes on after a piece."""

    keys: np.ndarray        # node * 256 + byte, sorted
    children: np.ndarray
    failure: np.ndarray
    popped: np.ndarray
    lead: int               # node after the byte in front of every word
    edges: dict[int, int] = field(default_factory=dict)

    @classmethod
    def of(cls, initial: list[bytes], continuing: list[bytes], lead: bytes = b"") -> "Automaton":
        children: list[dict[int, int]] = [{}, {}]
        whole = [False, False]
        for root, pieces in ((0, initial), (1, continuing)):
            for piece in pieces:
                node = root
                for b in piece:
                    if b not in children[node]:
                        children[node][b] = len(children)
                        children.append({})
                        whole.append(False)
                    node = children[node][b]
                whole[node] = node > 1
        failure, popped = [-1] * len(children), [0] * len(children)
        queue = deque([0, 1])
        while queue:
            u = queue.popleft()
            for b, v in children[u].items():
                queue.append(v)
                if whole[v]:
                    failure[v], popped[v] = 1, 1
                    continue
                z, n = failure[u], popped[u]
                while z >= 0 and b not in children[z]:
                    z, n = failure[z], n + popped[z]
                if z >= 0:
                    failure[v], popped[v] = children[z][b], n
        edge = sorted((node << 8 | b, v) for node, out in enumerate(children) for b, v in out.items())
        at = 0
        for b in lead:
            at = children[at].get(b, -1) if at >= 0 else -1
        return cls(np.array([k for k, _ in edge], np.int64), np.array([v for _, v in edge], np.int32), np.array(failure, np.int32), np.array(popped, np.int32), at)

    def _child(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        key = node.astype(np.int64) << 8 | byte
        slot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[slot] == key, self.children[slot], -1)

    def _one(self, word: bytes) -> int:
        """Pieces of one word; 0: none fit."""
        if not self.edges:
            self.edges.update(zip(self.keys.tolist(), self.children.tolist()))
        node, n, edges, failure, popped = self.lead, 0, self.edges, self.failure, self.popped
        for b in word:
            while (v := edges.get(node << 8 | b, -1)) < 0:
                n += int(popped[node])
                node = int(failure[node])
                if node < 0:
                    return 0
            node = v
        while node != 1:
            n += int(popped[node])
            node = int(failure[node])
            if node < 0:
                return 0
        return n

    def lengths(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of pieces of each word data[start:end]; 0 where no pieces make it up."""
        size, out = ends - starts, np.zeros(len(starts), np.int64)
        if self.lead < 0 or not len(self.keys):
            return out
        for i in np.flatnonzero(size > LONG_WORD).tolist():
            out[i] = self._one(data[starts[i]: ends[i]].tobytes())
        alive = np.flatnonzero(size <= LONG_WORD)
        node = np.full(len(starts), self.lead, np.int64)
        step = 0
        while len(alive):                        # all words take their next byte
            done = size[alive] == step
            self._finish(alive[done], node, out)
            alive = alive[~done]
            moving = alive
            byte = data[starts[moving] + step].astype(np.int64) if len(moving) else np.zeros(0, np.int64)
            while len(moving):                   # those without a child fail over, again and again
                child = self._child(node[moving], byte)
                stuck = child < 0
                node[moving[~stuck]] = child[~stuck]
                moving, byte = moving[stuck], byte[stuck]
                out[moving] += self.popped[node[moving]]
                node[moving] = self.failure[node[moving]]
                lost = node[moving] < 0
                out[moving[lost]] = 0
                if lost.any():
                    alive = alive[node[alive] >= 0]
                moving, byte = moving[~lost], byte[~lost]
            step += 1
        return out

    def _finish(self, words: np.ndarray, node: np.ndarray, out: np.ndarray) -> None:
        while len(words):
            words = words[node[words] != 1]
            out[words] += self.popped[node[words]]
            node[words] = self.failure[node[words]]
            lost = node[words] < 0
            out[words[lost]] = 0
            words = words[~lost]


def count_tokens(docs: DataFrame, automaton: Automaton, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, n_tokens and n_unknown of every whole text.

    Words are runs of bytes other than ASCII white space; a word is worth the pieces
    of the greedy longest match from its beginning, or one unknown token if they don't
    make it up.  Null and empty texts have none; repeated rows count alike; columns
    with these names are replaced; an empty table gives no rows.  The automaton's size is
    that of the vocabulary; documents are not shuffled.
    """
    sent = docs.sparkSession.sparkContext.broadcast(automaton)

    def count(texts: pa.Array) -> list[pa.Array]:
        data, offsets = text_buffer(texts)
        data, starts, ends, first = scan_words(data, offsets, NOT_SPACE, fold=False)
        _, one, inverse = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        pieces = sent.value.lengths(data, starts[one], ends[one])
        total = np.concatenate([[0], np.cumsum(np.maximum(pieces, 1)[inverse])])
        unknown = np.concatenate([[0], np.cumsum((pieces == 0)[inverse])])
        return [pa.array(np.diff(first)), pa.array(np.diff(total[first])), pa.array(np.diff(unknown[first]))]

    return add_columns(docs, "n_words long, n_tokens long, n_unknown long", count, text)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece lengths of every document, with the pieces of the 50k byte-level vocabulary."""
    import public_tokenizers
    automaton = Automaton.of(*byte_level_pieces(public_tokenizers.path("byte_bpe_50k.json")), lead=b" ")
    return count_tokens(read_table(spark, sf_dir, "documents").select("doc_id", "text"), automaton).drop("text")
