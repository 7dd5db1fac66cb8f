"""Re-Pair grammars of integer sequences.

Frequent neighbouring pairs are replaced by new symbols until no pair can be replaced often
enough. A round counts all pairs at once and replaces every pair where it is the most frequent
one of its neighbourhood, so a round costs a few passes over the sequence and the globally most
frequent pair is always among the replaced ones.
"""

from __future__ import annotations

import numpy as np
import pandas as pd


class Grammar:
    """``sequence`` over terminals below ``first`` and rules: symbol ``first + k`` stands for the
    two symbols ``rules[k]``, which are older ones. ``lengths[k]`` terminals come out of it."""

    def __init__(self, sequence: np.ndarray, rules: np.ndarray, first: int, lengths: np.ndarray) -> None:
        self.sequence, self.rules, self.first, self.lengths = sequence, rules, first, lengths

    def widths(self, symbols: np.ndarray) -> np.ndarray:
        """Terminals under each symbol."""
        out = np.ones(len(symbols), np.int64)
        inner = symbols >= self.first
        out[inner] = self.lengths[symbols[inner] - self.first]
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The terminals of ``symbols``, level by level: every symbol knows where its terminals
        begin, so only rules still open are touched again."""
        symbols = np.asarray(symbols, np.int64)
        width = self.widths(symbols)
        at = np.cumsum(width) - width
        out = np.empty(int(width.sum()), np.int64)
        while len(symbols):
            inner = symbols >= self.first
            out[at[~inner]] = symbols[~inner]
            pair, start = self.rules[symbols[inner] - self.first], at[inner]
            symbols = np.concatenate([pair[:, 0], pair[:, 1]])
            at = np.concatenate([start, start + self.widths(pair[:, 0])])
        return out


def _frequent(keys: np.ndarray, least: int) -> np.ndarray:
    """Places whose key may occur ``least`` times: all that do, and few others. Counts per hash
    bucket leave out the rest, so that only frequent keys are grouped exactly. Few buckets stay in
    the processor's cache; there are enough of them that one holds a fraction of ``least``."""
    bits = max(len(keys) * 4 // least, 1).bit_length()
    bucket = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
    bucket = bucket.astype(np.int64)
    return np.flatnonzero(np.bincount(bucket, minlength=1 << bits)[bucket] >= least)


def _chosen(s: np.ndarray, at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which of the positions ``at`` hold a pair that outranks both neighbours; in a run of one
    symbol every other one."""
    around = np.zeros(len(s) + 1, np.int64)  # the rank of position i at i + 1
    around[at + 1] = rank
    take = (rank > 0) & (rank >= around[at]) & (rank >= around[at + 2])
    run = s[at] == s[at + 1]
    if run.any():
        # Offsets inside maximal stretches of neighbouring positions with one symbol.
        where = at[run]
        begins = np.ones(len(where), bool)
        begins[1:] = (where[1:] != where[:-1] + 1) | (s[where[1:]] != s[where[:-1]])
        take[run] &= (where - np.maximum.accumulate(np.where(begins, where, 0))) % 2 == 0
    return take


def compress(symbols: np.ndarray, first: int, least: int, barrier: int | None = None) -> Grammar:
    """The grammar of ``symbols``, all below ``first``. A rule replaces at least ``least`` places
    of its round. No rule reaches across a ``barrier`` symbol. Equally frequent pairs take a
    seeded order: in the order of the text, a repeated passage would shrink by one pair a round.

    A pair can become frequent only beside a new symbol, so later rounds look at these places
    and at those that were frequent before.
    """
    s = np.array(symbols, np.int64)
    rules, lengths, count = np.empty((0, 2), np.int64), np.empty(0, np.int64), first
    order = np.random.default_rng(1)
    at = np.arange(len(s) - 1)
    while len(at):
        if barrier is not None:
            at = at[(s[at] != barrier) & (s[at + 1] != barrier)]
        keys = s[at] * count + s[at + 1] if len(at) < len(s) - 1 else s[:-1] * count + s[1:]
        found = _frequent(keys, least)
        at, keys = at[found], keys[found]
        codes, pairs = pd.factorize(keys)
        often = np.bincount(codes, minlength=len(pairs))
        at, codes = at[often[codes] >= least], codes[often[codes] >= least]
        rank = (often * len(pairs) + order.permutation(len(pairs)))[codes]
        take = _chosen(s, at, rank)
        chosen, code = at[take], codes[take]
        new = np.flatnonzero(np.bincount(code, minlength=len(pairs)) >= least)
        if not len(new):
            break
        name = np.zeros(len(pairs), np.int64)
        name[new] = count + np.arange(len(new))
        name = name[code]
        chosen, name = chosen[name > 0], name[name > 0]
        made = np.stack([pairs[new] // count, pairs[new] % count], 1)
        sides = np.ones_like(made)
        sides[made >= first] = lengths[made[made >= first] - first]
        lengths = np.concatenate([lengths, sides.sum(1)])
        rules = np.concatenate([rules, made])
        live = np.zeros(len(s) + 1, bool)
        live[at] = live[chosen] = True
        s[chosen] = name
        keep = np.ones(len(s), bool)
        keep[chosen + 1] = False
        live[chosen - 1] = live[chosen - 2] = True  # the symbol before may itself have just become one
        at = np.flatnonzero(live[:-1][keep])
        s, count = s[keep], count + len(new)
        at = at[at < len(s) - 1]
    return Grammar(s, rules, first, lengths)
