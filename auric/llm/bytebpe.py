"""ids of chunks by a byte-level BPE file of the tokenizers library.

The file's merges are run by tiktoken, over all chunks in one string, where that
provably gives the library's ids; chunks that need more go to the library.
"""

from __future__ import annotations

import itertools
import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from auric.llm.chunks import joined, ranges, unspaced_start

LONG = 2000             # bytes of a chunk from which on the library merges it
# A byte-level vocabulary spells a byte as the printable Latin-1 character of that
# number; the other bytes, in order, as the characters from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
SPELT = {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)} \
    | {chr(b): b for b in _PRINTABLE}
_LOADED: dict = {}
_SAME: dict[str, bool] = {}


def _read(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def _spelled(entry: str) -> bytes:
    return bytes(SPELT[c] for c in entry) if all(c in SPELT for c in entry) else entry.encode()


def mergeable(path: str) -> bool:
    """Whether lowest-id-first merging of any two tokens that spell a third gives
    the file's ids: its merges come in the order of their tokens' ids, and each
    token's own bytes merge to it by the listed merges. Then two neighbours that
    spell a token have come about as in that token's bytes alone, so they are
    the pair that the list names. Checked once, on the driver."""
    if path not in _SAME:
        from auric.llm.bpe import replay

        spec = _read(path)
        model, cut = spec["model"], spec["pre_tokenizer"]
        plain = (spec["normalizer"] is None and cut["type"] == "ByteLevel" and cut.get("use_regex", True)
                 and not cut["add_prefix_space"] and model["type"] == "BPE"
                 and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix",
                                                    "byte_fallback", "ignore_merges")))
        special = {t["content"] for t in spec["added_tokens"]}
        ids = {e: i for e, i in model["vocab"].items() if e not in special}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = [ids[a + b] for a, b in pairs]
        plain = plain and made == sorted(made) and all(c in SPELT for e in ids for c in e)
        if plain:
            class Listed:
                of_byte = [ids[c] for c, _ in sorted(SPELT.items(), key=lambda x: x[1])]
                listed = {(ids[a], ids[b]): ids[a + b] for a, b in pairs}

                def merged(self, a: int, b: int) -> int:
                    return self.listed.get((a, b), -1)
            words = [(_spelled(e), i) for e, i in ids.items()]
            found, per_word = replay(Listed(), [w for w, _ in words])
            plain = len(found) == len(words) and bool((per_word == 1).all()) and found.tolist() == [i for _, i in words]
        _SAME[path] = plain
    return _SAME[path]


class ByteBpe:
    """``fast``: what ``mergeable`` said of the file. With ``plain`` the strings
    of special tokens are ordinary text."""

    def __init__(self, path: str, fast: bool, plain: bool):
        spec = _read(path)
        added = {t["content"] for t in spec["added_tokens"]}
        self.special = () if plain else tuple(t["content"] for t in spec["added_tokens"] if t["special"])
        self.path, self.plain, self.own = path, plain, None
        entries = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        spelled = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            spelled[i] = entry.encode() if entry in added else _spelled(entry)
        self.spelled = spelled
        self.lengths = np.fromiter(map(len, spelled), np.int64, len(spelled))
        self.fast = None
        if fast:
            import public_tokenizers
            import tiktoken

            ranks = {_spelled(e): i for e, i in spec["model"]["vocab"].items() if e not in added}
            self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def load(cls, path: str, fast: bool, plain: bool) -> "ByteBpe":
        if (path, plain) not in _LOADED:
            _LOADED[path, plain] = cls(path, fast, plain)
        return _LOADED[path, plain]

    def _library(self, chunks: list[str]) -> list[list[int]]:
        if self.own is None:
            from tokenizers import Tokenizer

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            self.own = Tokenizer.from_file(self.path)
            self.own.encode_special_tokens = self.plain
        return [e.ids for e in self.own.encode_batch_fast(chunks, add_special_tokens=False)]

    def __call__(self, chunks: list[str] | pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, per_chunk) of chunks that are tokenised each on its own."""
        chunks = chunks if isinstance(chunks, pa.Array) else pa.array(chunks, pa.large_string())
        if self.fast is None:
            return _joined(self._library(chunks.to_pylist()))
        # A space and then no white space always begins a token, whatever is before.
        flags = unspaced_start(chunks) & (pc.utf8_length(chunks).to_numpy(zero_copy_only=False) < LONG // 4)
        for s in self.special:
            flags &= ~pc.match_substring(chunks, s).to_numpy(zero_copy_only=False)
        text, ends = joined(chunks.filter(pa.array(flags)))
        alone = chunks.filter(pa.array(~flags)).to_pylist()
        ids = self.fast.encode_to_numpy(text).astype(np.int64) if text else np.zeros(0, np.int64)
        many = np.diff(np.searchsorted(np.cumsum(self.lengths[ids]), ends, side="right"), prepend=0)
        if not alone:
            return ids, many
        other, other_many = _joined(self._library(alone))
        per_chunk = np.empty(len(chunks), np.int64)
        per_chunk[flags], per_chunk[~flags] = many, other_many
        starts = np.cumsum(per_chunk) - per_chunk
        out = np.empty(int(per_chunk.sum()), np.int64)
        out[ranges(starts[flags], many)] = ids
        out[ranges(starts[~flags], other_many)] = other
        return out, per_chunk


def _joined(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(counts.sum())), counts
