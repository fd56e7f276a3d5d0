"""Token ids of whole texts through the tokenizers library, with a cache of repeated chunks.

A BPE tokenizer first cuts a text into pieces that never merge.  ``ChunkEncoder``
cuts a text at boundaries which such a cut always respects, has the library
encode each distinct run once, and joins the ids.  Texts outside the alphabet
for which the boundaries are certain, and texts that hold the string of an added token,
go to the library whole (Latin-1 text is in NFC already), so ids always equal ``Tokenizer.encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# The letters of Latin-1, and the four white-space characters accepted on the cached path.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
SPACES = " \t\n\r"
#: Characters of Latin-1 on which notions of white space differ: such a text is encoded whole.
_ODD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\xa0\xad]")
#: A letter run, or a run of other characters; a letter run after an apostrophe stays with it ("'s").
_RUNS = rf"[{LETTERS}]+|[^{SPACES}{LETTERS}]+(?:(?<=')[{LETTERS}]+)?"
_WORDS = re.compile(_RUNS)
_SPACED = re.compile(rf" ?[{LETTERS}]+| ?[^{SPACES}{LETTERS}]+(?:(?<=')[{LETTERS}]+)?|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
_PLAIN = re.compile(rf" ?[{LETTERS}]+")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: visible bytes
    stand for themselves, the others follow from 256 on in byte order."""
    shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()
_SPACE = BYTE_LETTERS[ord(" ")]


class _Memo(dict):
    """Results of a function by its text, at most ``limit`` of them and none of long texts."""

    def __init__(self, function: Callable[[str], bytes], limit: int, longest: int = 64):
        self.function, self.limit, self.longest = function, limit, longest

    def __missing__(self, text: str) -> bytes:
        ids = self.function(text)
        if len(text) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[text] = ids
        return ids


class ChunkEncoder:
    """Little-endian unsigned 32-bit ids of texts; one per Python worker and vocabulary.

    ``cache_runs`` bounds the memory of the cache (about 150 bytes a run):
    when it is full it starts afresh; ids do not depend on it.
    """

    def __init__(self, path: str, cache_runs: int = 800_000):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.runs = _Memo(self._run_ids, cache_runs)
        spec = json.loads(self.tokenizer.to_str())
        self.added = [a["content"] for a in spec["added_tokens"]]
        pre, norm, model = spec["pre_tokenizer"] or {}, spec["normalizer"] or {}, spec["model"]
        plain_bpe = model.get("type") == "BPE" and not any(a["normalized"] for a in spec["added_tokens"]) and not model.get("dropout") and not model.get("ignore_merges") and not model.get("continuing_subword_prefix")
        spaced = plain_bpe and not norm and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        steps = pre.get("pretokenizers", [])
        lower = [n.get("type") for n in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        words = (plain_bpe and lower and [s["type"] for s in steps] == ["Split", "ByteLevel"] and steps[0]["invert"]
                 and steps[0]["pattern"] == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"})
        self.lower = bool(words)
        self.pattern = _SPACED if spaced else _WORDS if words else None

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _run_ids(self, run: str) -> bytes:
        """A letter run, with or without a space before it, goes straight to the library's model."""
        if not _PLAIN.fullmatch(run):
            return self._whole([run])[0]
        mapped = run.replace(" ", _SPACE) if run.isascii() else run.encode().decode("latin-1").translate(BYTE_LETTERS)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(mapped)]).tobytes()

    def _certain(self, text: str) -> bool:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return not _ODD.search(text) and not any(a in text for a in self.added)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as bytes (null: empty)."""
        out: list[bytes | None] = [None] * len(texts)
        whole = []
        for i, text in enumerate(texts):
            if not text:
                out[i] = b""
            elif self.pattern is not None and self._certain(text):
                runs = self.pattern.findall(text.lower() if self.lower else text)
                out[i] = b"".join(map(self.runs.__getitem__, runs))
            else:
                whole.append(i)
        for k in range(0, len(whole), 64):
            part = whole[k: k + 64]
            for i, ids in zip(part, self._whole([texts[i] for i in part])):
                out[i] = ids
        return out


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """This worker's encoder for a vocabulary file (present on every machine, like the library)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]
