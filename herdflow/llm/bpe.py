"""Rank-synchronous byte-pair merging over ragged numpy arrays.

A byte-level BPE vocabulary (a ``tokenizers`` JSON file) is turned into two sorted arrays:
pair keys and the rank of each pair. A batch of pre-tokens is held as one flat symbol array
with a length per pre-token. Every round finds each pre-token's lowest-rank pair, merges all
its occurrences at once (left to right, not overlapping), and drops the pre-tokens that have
no mergeable pair left; the symbols that survive are the tokens.
"""

from __future__ import annotations

import json
import sys
import unicodedata

import numpy as np
import regex

NO_RANK = np.int64(1 << 40)

#: The split rule of byte-level pre-tokenisers (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def newer_than_unicodedata() -> str | None:
    """Character class of the code points that `regex` knows and Python's own tables don't.

    Unicode versions differ between libraries just there; texts that hold such a character
    are split by the tokenizer's own pre-tokeniser instead.
    """
    assigned = regex.compile(r"\P{Cn}")
    ranges: list[list[int]] = []
    for c in range(0x80, sys.maxunicode + 1):
        if unicodedata.category(chr(c)) == "Cn" and assigned.match(chr(c)):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) or None


class RankTable:
    """A vocabulary's merges as arrays, its special strings and its split rule."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("a byte-level BPE vocabulary without a normalizer is needed")
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.base = max(vocab.values()) + 1
        keys = left * self.base + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.byte_symbol = np.array([vocab[ch] for _, ch in sorted(byte_alphabet().items())], np.int64)
        self.path = path
        self.prefix_space = bool(pre.get("add_prefix_space"))
        added = spec.get("added_tokens") or []
        if self.prefix_space or any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("prefix spaces and stripping special tokens are not supported")
        special = sorted((a["content"] for a in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.split = regex.compile(SPLIT)
        newer = newer_than_unicodedata()
        self.newer = regex.compile(f"[{newer}]") if newer else None
        self._own = None

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, `NO_RANK` where it is no merge."""
        key = a * self.base + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def pre_tokens(self, text: str) -> list[str]:
        """The text's pre-tokens; special strings must have been cut out before."""
        if self.newer is None or text.isascii() or not self.newer.search(text):
            return self.split.findall(text)
        if self._own is None:
            from tokenizers import Tokenizer

            self._own = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._own.pre_tokenize_str(text)]


def count_symbols(table: RankTable, pre_tokens: list[bytes]) -> np.ndarray:
    """Number of tokens of each (non-empty) pre-token."""
    n = len(pre_tokens)
    out = np.zeros(n, np.int64)
    if not n:
        return out
    lens = np.fromiter(map(len, pre_tokens), np.int64, n)
    sym = table.byte_symbol[np.frombuffer(b"".join(pre_tokens), np.uint8)]
    seq = np.arange(n)                       # the pre-token of each ragged row that is still live
    ends = np.cumsum(lens)
    rank = np.full(len(sym), NO_RANK)
    if len(sym) > 1:
        rank[:-1] = table.rank(sym[:-1], sym[1:])
    rank[ends - 1] = NO_RANK
    while len(seq):
        starts = np.cumsum(lens) - lens
        low = np.minimum.reduceat(rank, starts)
        live = low < NO_RANK
        if not live.all():                   # rows without a mergeable pair are done
            out[seq[~live]] = lens[~live]
            keep = np.repeat(live, lens)
            sym, rank, seq, lens, low = sym[keep], rank[keep], seq[live], lens[live], low[live]
            if not len(seq):
                break
        row = np.repeat(np.arange(len(lens)), lens)
        hit = rank == low[row]
        at = np.arange(len(sym))
        before = np.concatenate(([False], hit[:-1]))
        run = np.maximum.accumulate(np.where(hit & ~before, at, 0))
        take = at[hit & ((at - run) % 2 == 0)]  # of aaa only the first pair merges
        sym[take] = table.merged[rank[take]]
        kept = np.ones(len(sym), bool)
        kept[take + 1] = False
        lens = lens - np.bincount(row[take], minlength=len(lens))
        place = np.cumsum(kept) - 1
        sym, rank, row = sym[kept], rank[kept], row[kept]
        new = place[take]
        for i in (new, new[new > 0] - 1):    # the merged symbols' pairs, and those that end in them
            i = i[i < len(sym) - 1]
            same = row[i] == row[i + 1]
            rank[i[same]] = table.rank(sym[i[same]], sym[i[same] + 1])
        last = np.cumsum(lens) - 1
        rank[last] = NO_RANK
    return out
