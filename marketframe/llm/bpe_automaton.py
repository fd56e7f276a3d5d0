"""BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens: an arc is labelled with a token's bytes, and the labels along a path
are a correct BPE encoding of what they spell.  It begins as one state with a loop for every byte.
Each merge (u, v), in order of priority, is a gadget put on the automaton before it: where u and then
v led, an arc uv now leads, and the state behind u loses its arc v (it is split off first
where other tokens lead there too).  All arcs of one token lead to one state, so a gadget
adds one state at most, and every text has exactly one path.

States and arcs are kept as the gadgets made them: a state is its parent less what it lost, an arc
of uv stands wherever the arc of u stood.  A transition is looked up by undoing gadgets, the
latest first, so the tables have the size of the vocabulary instead of states times tokens.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.llm.arrow import add_columns, read_table
from marketframe.llm.token_ids import BYTE_LETTERS

#: The split of byte-level vocabularies, a public format.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Beyond this character Unicode versions differ on what is a letter: such texts are split by the library.
_LATE = re.compile("[^\x00-ԯ]")
#: Longer pieces are encoded each time they occur.
_CACHED_CHARS = 64


class Automaton:
    """States, arcs and labels of one vocabulary's merges, for bytes that were split before."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]], added: dict[int, bytes] | None = None, memo: int = 1 << 20):
        """``labels``: the bytes of each token; ``merges``: left, right and made token, by priority;
        ``added``: labels of tokens that are only decoded."""
        spelled = labels | (added or {})
        self.labels = [spelled.get(t, b"") for t in range(max(spelled) + 1)]
        self.size, self.memo_size = len(self.labels), memo
        self.parent, self.born = [-1], [-1]                 # by state
        self.left, self.made, self.target = [-1] * self.size, [-1] * self.size, [-1] * self.size        # by token
        self.lost: dict[int, int] = {}                      # state * size + token: the gadget that took the arc
        self.memo: dict[int, bool] = {}
        merged = {made for _, _, made in merges}
        leading = [1]                                       # tokens that lead to a state; the start counts as one
        for t, label in labels.items():
            if t not in merged and len(label) == 1:
                self.target[t] = 0
                leading[0] += 1
        if {self.labels[t] for t in labels if self.target[t] == 0} != {bytes([b]) for b in range(256)}:
            raise ValueError("a byte-level vocabulary has a token for every byte")
        for step, (u, v, made) in enumerate(merges):
            if self.target[made] >= 0:
                raise ValueError(f"token {made} is made by two merges")
            if self.target[u] < 0 or self.target[v] < 0 or not self._stands(self.target[u], v):
                continue                                    # u is never followed by v
            before, after = self.target[u], self.target[v]
            if leading[before] > 1 or u == v:               # others lead there too: u gets a state of its own
                leading[before] -= 1
                self.parent.append(before)
                self.born.append(step)
                leading.append(1)
                before = self.target[u] = len(self.parent) - 1
            self.lost[before * self.size + v] = step
            self.left[made], self.made[made], self.target[made] = u, step, after
            leading[after] += 1
        self.tokens = {self.labels[t]: t for t in labels if self.target[t] >= 0}
        self.longest: dict[bytes, int] = {}                 # longest label by its first two bytes
        for label in self.tokens:
            self.longest[label[:2]] = max(self.longest.get(label[:2], 1), len(label))

    def _stands(self, state: int, token: int) -> bool:
        """Whether an arc of ``token`` leaves ``state``."""
        until = len(self.labels) + len(self.born) + len(self.lost)          # later than any gadget
        while True:
            gone = self.lost.get(state * self.size + token)
            if gone is not None and gone < until:
                return False
            born, made = self.born[state], self.made[token]
            if made >= born:
                if made < 0:
                    return True
                token, until = self.left[token], made + 1   # the arc stood where its left part's did, after the same gadget
            else:
                state, until = self.parent[state], born

    def arc(self, state: int, token: int) -> int:
        """The state behind ``token``, or -1 if it can't come there."""
        key = state * self.size + token
        stands = self.memo.get(key)
        if stands is None:
            if len(self.memo) >= self.memo_size:
                self.memo.clear()
            stands = self.memo[key] = self._stands(state, token)
        return self.target[token] if stands else -1

    def encode(self, piece: bytes) -> list[int]:
        """Tokens of the one path that spells ``piece``.

        Longest labels are tried first; a place from which no arc goes on is not tried again, as
        only one path leads to it.  Time is linear in the piece (times the longest label).
        """
        whole = self.tokens.get(piece)
        if whole is not None:
            return [whole]
        n, dead, tokens = len(piece), set(), self.tokens
        path, places, states = [], [0], [0]
        tries = [min(n, self.longest.get(piece[:2], 1))]
        while places[-1] < n:
            at, state, size = places[-1], states[-1], tries[-1]
            while size:
                if at + size not in dead:
                    token = tokens.get(piece[at: at + size])
                    if token is not None:
                        then = self.arc(state, token)
                        if then >= 0:
                            break
                size -= 1
            if not size:
                dead.add(at)
                for track in (path, places, states, tries):
                    track.pop()
                continue
            tries[-1] = size - 1
            at += size
            path.append(token)
            places.append(at)
            states.append(then)
            tries.append(min(n - at, self.longest.get(piece[at: at + 2], 1)))
        return path

    def decode(self, tokens: list[int]) -> bytes:
        """The labels of the arcs, one after the other; unknown tokens have none."""
        labels, known = self.labels, self.size
        return b"".join([labels[t] for t in tokens if t < known])


class BpeCodec:
    """Texts to ids and back for a byte-level vocabulary file, as the tokenizers library gives them.

    Strings of added tokens in a text become these tokens; what lies between is split and each
    piece encoded by the automaton, short ones once (``cache_pieces`` bounds the memory of that;
    ids don't depend on it).  The library splits texts with late Unicode characters; it merges nothing.
    """

    def __init__(self, path: str, cache_pieces: int = 600_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        added = spec["added_tokens"]
        plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
        split = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        if spec["normalizer"] or not plain or not split or any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        byte_of = {c: b for b, c in BYTE_LETTERS.items()}
        self.added = {a["content"]: a["id"] for a in added}
        vocabulary = model["vocab"]
        labels = {i: bytes(byte_of[c] for c in t) for t, i in vocabulary.items() if t not in self.added}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(labels, [(vocabulary[u], vocabulary[v], vocabulary[u + v]) for u, v in pairs], {i: c.encode() for c, i in self.added.items()})
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.cache: dict[str, bytes] = {}
        self.cache_pieces = cache_pieces
        self.library = None

    def pieces(self, text: str) -> list[str]:
        """``text`` cut where no merge crosses."""
        if not _LATE.search(text):
            return _SPLIT.findall(text)
        if self.library is None:
            from tokenizers import pre_tokenizers
            self.library = pre_tokenizers.ByteLevel(add_prefix_space=False)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def _learn(self, pieces: list[str]) -> None:
        for p in pieces:
            if p not in self.cache and len(p) <= _CACHED_CHARS:
                if len(self.cache) >= self.cache_pieces:
                    self.cache.clear()
                self.cache[p] = array("I", self.automaton.encode(p.encode())).tobytes()

    def _ids(self, piece: str) -> bytes:
        known = self.cache.get(piece)
        return known if known is not None else array("I", self.automaton.encode(piece.encode())).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text (null: none)."""
        if not text:
            return b""
        if self.special is not None and self.special.search(text):
            return b"".join(array("I", [self.added[part]]).tobytes() if part in self.added else self.encode(part) for part in self.special.split(text))
        pieces = self.pieces(text)
        try:
            return b"".join([self.cache[p] for p in pieces])
        except KeyError:
            self._learn(pieces)
            return b"".join([self._ids(p) for p in pieces])

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return self.automaton.decode(np.frombuffer(ids, "<u4").tolist()).decode("utf-8", "replace")


_CODECS: dict[str, BpeCodec] = {}


def codec(path: str) -> BpeCodec:
    """This worker's codec for a vocabulary file (present on every machine, like the library)."""
    if path not in _CODECS:
        _CODECS[path] = BpeCodec(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` plus n_tokens and ids (little-endian unsigned 32-bit) of every whole text.

    Null and empty texts have no ids; repeated rows encode alike; columns with these names are
    replaced, others pass through; an empty table gives no rows.  A very long text is a slice of its
    own, held with its ids; documents are not shuffled.
    """
    def encode(texts: pa.Array) -> list[pa.Array]:
        ids = [codec(vocabulary).encode(t) for t in texts.to_pylist()]
        return [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]

    return add_columns(docs, "n_tokens long, ids binary", encode, text)


def decode_documents(docs: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """``docs`` plus ``decoded``, the text that the column ``ids`` spells (null: empty); ids outside the
    vocabulary spell nothing.  A column named decoded is replaced; an empty table gives no rows."""
    def decode(column: pa.Array) -> list[pa.Array]:
        return [pa.array([codec(vocabulary).decode(i or b"") for i in column.to_pylist()], pa.string())]

    return add_columns(docs, "decoded string", decode, ids, cast="binary")


def op11_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with the 50k byte-level vocabulary and decoded again: digests of ids and text."""
    import public_tokenizers
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = decode_documents(encode_documents(docs, vocabulary).drop("text"), vocabulary)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
