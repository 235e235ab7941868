"""Byte-level BPE by speculation and verification (operator 10).

Words are cut by the vocabulary's public pre-tokenisation pattern. For the distinct words of a
block of texts a trie walk over all words at once proposes the greedy longest-match tokens; an
array check then tests every adjacent pair of proposals. A token sequence is the BPE result of its
word exactly when each token is reachable and each adjacent pair is compatible, so words that
pass are done, and only words that fail are merged rank by rank. A worker remembers the words it
has met; a remembered word counts as met only if its bytes agree, not its hash alone.

Edge cases: a null text counts as empty and has no ids; a special token's string inside a text
becomes its id, as in the tokenizers library; texts of any length are processed whole.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import _shared as sh
from .words import span_hashes

#: Letters and numbers (first, last code point) of Unicode 17 and 18, which the
#: tokenizers library, at Unicode 16, takes as other signs.
LATER = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D),
    (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB),
    (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24),
    (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5),
    (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD),
    (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]
#: Distinct words kept by a worker; the table starts anew beyond it, which costs time only.
CACHE_WORDS = 300_000
#: Odd multiplier that deals keys over slots.
BASE = 0x9E3779B97F4A7C15
#: Bytes beyond which a word is walked by itself, since words in step wait for the longest.
LONG = 400
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
NONE = np.iinfo(np.int64).max


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in shown}
    hidden = (b for b in range(256) if b not in set(shown))
    table.update({chr(256 + i): b for i, b in enumerate(hidden)})
    return table


class Table:
    """A map from distinct 64-bit keys (never 0) to non-negative numbers, looked up in bulk."""

    def __init__(self, bits: int) -> None:
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(BASE)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where there is none."""
        at = self.slots(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.values[at], -1)
        live = np.flatnonzero((there != keys) & (there != 0))
        while len(live):  # on to the next slot
            at[live] = step = (at[live] + 1) & self.mask
            there = self.keys[step]
            hit = there == keys[live]
            out[live[hit]] = self.values[step[hit]]
            live = live[~hit & (there != 0)]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds distinct keys that are not there."""
        at = self.slots(keys)
        live = np.arange(len(keys))
        while len(live):
            free = live[self.keys[at[live]] == 0]
            slots, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[slots], self.values[slots] = keys[won], values[won]
            rest = np.ones(len(keys), bool)
            rest[won] = False
            live = live[rest[live]]
            at[live] = (at[live] + 1) & self.mask


@functools.lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Of every code point: white space, letter, number or other."""
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((SPACE, r"\p{White_Space}+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            i, j = ord(m[0][0]), ord(m[0][-1])
            if j - i + 1 == len(m[0]):
                table[i : j + 1] = kind
            else:  # a run on both sides of the surrogates
                table[[ord(c) for c in m[0]]] = kind
    for i, j in LATER:
        table[i : j + 1] = OTHER
    return table


def gather(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans of ``data`` one after another, and where each ends."""
    ends = np.cumsum(stops - starts)
    return data[np.repeat(starts - ends + (stops - starts), stops - starts) + np.arange(ends[-1] if len(ends) else 0)], ends


def cut_words(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """First positions of the words of the public byte-level pattern; ``ends``: where each text ends.

    Runs of letters, of numbers and of other signs are words; a blank right before one joins it.
    White space before a word stands alone but for its last sign; at the end of a text it is one
    word. An apostrophe that begins a word cuts off the listed endings."""
    n = len(points)
    kind = classes()[points]
    first = np.zeros(n + 1, bool)  # of a text
    first[0] = True
    first[ends] = True
    start = first[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    last = np.ones(n, bool)  # of its white-space run, a word follows
    last[:-1] = (kind[1:] != SPACE) & ~first[1:n]
    last[-1] = False
    last &= space
    start |= last  # the last sign before a word leaves the run
    joined = np.zeros(n, bool)
    joined[1:] = (last & (points == 32))[:-1]
    start &= ~joined
    quote = np.flatnonzero((points == 39) & start)
    if len(quote):
        padded = np.concatenate([points, np.zeros(3, np.uint32)])
        text_end = ends[np.searchsorted(ends, quote, side="right")]
        a, b = padded[quote + 1], padded[quote + 2]
        one = np.isin(a, [115, 116, 109, 100]) & (quote + 1 < text_end)
        two = (((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108)) & (quote + 2 < text_end)
        for at, k in ((quote[one], 1), (quote[two & ~one], 2)):
            start[at + 1] = False
            stop = at + k + 1
            start[stop[stop < n]] = True
    return np.flatnonzero(start)


class BpeCodec:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of_char = byte_characters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            if token not in self.special:
                self.token_bytes[i] = bytes(of_char[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.size = size
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self._merges(vocab, spec["model"]["merges"])
        self._trie()
        self._forget()

    # -- tables -----------------------------------------------------------------------------
    def _merges(self, vocab: dict[str, int], merges: list) -> None:
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        a = np.array([vocab[x] for x, _ in pairs], np.int64)
        b = np.array([vocab[y] for _, y in pairs], np.int64)
        made = np.array([vocab[x + y] for x, y in pairs], np.int64)
        self.left = np.full(self.size, -1, np.int64)
        self.right = np.full(self.size, -1, np.int64)
        self.born = np.full(self.size, -1, np.int64)  # rank of the merge that makes a token; -1: a byte
        self.left[made[::-1]], self.right[made[::-1]], self.born[made[::-1]] = a[::-1], b[::-1], np.arange(len(made))[::-1]
        self.pairs = Table(18)
        self.pairs.put((a * self.size + b + 1).astype(np.uint64), np.arange(len(a)))
        self.merged = a, b
        self.made = made
        self.byte_id = np.zeros(256, np.int64)
        for i, token in enumerate(self.token_bytes):
            if len(token) == 1 and self.born[i] < 0 and i not in self.special.values():
                self.byte_id[token[0]] = i
        compound = np.flatnonzero(self.born >= 0)
        self.reachable = np.ones(self.size, bool)
        self.reachable[compound] = self.compatible(self.left[compound], self.right[compound], self.born[compound])
        for i in compound[np.argsort(self.born[compound])].tolist():  # halves come before wholes
            self.reachable[i] &= self.reachable[self.left[i]] and self.reachable[self.right[i]]

    def _trie(self) -> None:
        children: dict[int, int] = {}
        accept = [-1]
        specials = set(self.special.values())
        for i, token in enumerate(self.token_bytes):
            if not token or i in specials:
                continue
            node = 0
            for byte in token:
                key = node << 8 | byte
                nxt = children.get(key)
                if nxt is None:
                    nxt = children[key] = len(accept)
                    accept.append(-1)
                node = nxt
            accept[node] = i
        self.children, self.accepted = children, accept
        self.child = Table(19)
        self.child.put(np.fromiter(children.keys(), np.uint64, len(children)) + np.uint64(1), np.fromiter(children.values(), np.int64, len(children)))
        self.accept = np.array(accept, np.int32)

    def _forget(self, room: int = 0) -> None:
        self.index, self.known = Table(max(20, (2 * room).bit_length())), 0
        # of each word: where its ids and its bytes begin, and how many there are
        self.starts, self.counts = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.spots, self.sizes = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.flat, self.filled = np.zeros(1 << 18, np.int32), 0
        self.body, self.written = np.zeros(1 << 20, np.uint8), 0

    def _remember(self, hashes: np.ndarray | None, counts: np.ndarray, ids: np.ndarray, buf: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Numbers of new words; without hashes they are found by these numbers alone."""
        at, n = self.known, len(counts)
        numbers = np.arange(at, at + n)
        self.known += n
        if hashes is not None:
            self.index.put(hashes, numbers)
        for name, total in (("starts", self.known), ("counts", self.known), ("spots", self.known), ("sizes", self.known), ("flat", self.filled + len(ids)), ("body", self.written + len(buf))):
            held = getattr(self, name)
            if len(held) < total:
                setattr(self, name, np.concatenate([held, np.zeros(max(total - len(held), len(held)), held.dtype)]))
        self.counts[numbers] = counts
        self.starts[numbers] = self.filled + np.cumsum(counts) - counts
        self.sizes[numbers] = np.diff(ends, prepend=0)
        self.spots[numbers] = self.written + ends - self.sizes[numbers]
        self.flat[self.filled : self.filled + len(ids)] = ids
        self.body[self.written : self.written + len(buf)] = buf
        self.filled += len(ids)
        self.written += len(buf)
        return numbers

    def differing(self, at: np.ndarray, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Which of the words that follow each other in ``data`` are not, byte for byte, the remembered ones."""
        same = self.sizes[at] == stops - starts
        sure = np.flatnonzero(same)
        held, _ = gather(self.body, self.spots[at[sure]], self.spots[at[sure]] + self.sizes[at[sure]])
        own = data[starts[0] : stops[-1]] if len(sure) == len(at) else gather(data, starts[sure], stops[sure])[0]
        if not np.array_equal(held, own):
            unlike = np.concatenate([[0], np.cumsum(held != own)])
            ends = np.cumsum(stops[sure] - starts[sure])
            same[sure] = unlike[ends] == unlike[ends - (stops[sure] - starts[sure])]
        return np.flatnonzero(~same)

    # -- speculation, verification, exact merging -------------------------------------------
    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        rank = self.pairs.get((a.astype(np.int64) * self.size + b + 1).astype(np.uint64)).astype(np.int64)
        return np.where(rank < 0, NONE, rank)

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge across the border of tokens a, b comes before those inside them.

        Walks back in time from the finished tokens: of the two pieces at the border the one made
        later is undone; a merge of the pieces then present may not precede the merge undone. Of
        merges of equal rank the leftmost is made first: one inside ``a`` wins over the border,
        the border wins over one inside ``b``. ``before``: only merges of lower rank count."""
        n = len(a)
        ok = np.ones(n, bool)
        live = np.arange(n)
        x, y = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(n, NONE) if before is None else before.astype(np.int64)
        while len(live):
            bad = self.pair_rank(x, y) < limit
            ok[live[bad]] = False
            rx, ry = self.born[x], self.born[y]
            go = ~bad & ((rx >= 0) | (ry >= 0))
            live, x, y, rx, ry = live[go], x[go], y[go], rx[go], ry[go]
            undo_left = rx > ry  # of equal ranks the right one is made later
            limit = np.where(undo_left, rx, ry + 1)
            x, y = np.where(undo_left, self.right[x], x), np.where(undo_left, y, self.left[y])
        return ok

    def speculate(self, buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match over all words at once: token ids in word order, counts per word.

        ``buf``: the bytes of the words, one after another; ``ends``: where each word ends."""
        n = len(ends)
        buf = np.append(buf, np.uint8(0))
        pos = np.concatenate([[0], ends[:-1]])
        word = np.flatnonzero(pos < ends)
        pos, end = pos[word], ends[word]
        node, token, after = np.zeros(len(word), np.int32), np.full(len(word), -1, np.int32), pos.copy()
        out_word, out_token = [], []
        while len(word):
            nxt = np.where(pos < end, self.child.get((node.astype(np.int64) * 256 + buf[pos] + 1).astype(np.uint64)), -1)
            on = nxt >= 0
            node = np.where(on, nxt, 0)
            pos = pos + on
            got = self.accept[node]
            hit = on & (got >= 0)
            token, after = np.where(hit, got, token), np.where(hit, pos, after)
            stop = ~on
            if stop.any():
                out_word.append(word[stop])
                out_token.append(token[stop])
                pos = np.where(stop, after, pos)
                live = ~stop | (pos < end)
                if not live.all():
                    word, pos, end, node, token, after = word[live], pos[live], end[live], node[live], token[live], after[live]
        if not out_word:
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        which = np.concatenate(out_word)
        order = np.argsort(which, kind="stable")
        return np.concatenate(out_token)[order], np.bincount(which, minlength=n)

    def merge_all(self, buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging, all words in step: in every round each word makes its merge of the
        lowest rank, leftmost among equals. Returns ids in word order and their words."""
        token = self.byte_id[buf]
        word = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        rank = np.full(len(token), NONE)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside] = self.pair_rank(token[inside], token[inside + 1])
        out_word, out_token = [], []
        while len(token):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(starts, len(token)))
            least = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            over = least == NONE
            out_word.append(word[over])
            out_token.append(token[over])
            at = np.flatnonzero((rank == least) & ~over)
            at = at[np.append(True, word[at[1:]] != word[at[:-1]])] if len(at) else at
            token[at] = self.made[rank[at]]
            keep = ~over
            keep[at + 1] = False
            touched = np.zeros(len(token), bool)
            touched[at] = True
            rank[at] = rank[at + 1]  # NONE at the end of a word
            token, word, rank, touched = token[keep], word[keep], rank[keep], touched[keep]
            touched[:-1] |= touched[1:]  # the pair before a merge is a new one too
            again = np.flatnonzero(touched[:-1])
            again = again[word[again] == word[again + 1]]
            rank[again] = self.pair_rank(token[again], token[again + 1])
        which = np.concatenate(out_word) if out_word else np.zeros(0, np.int64)
        order = np.argsort(which, kind="stable")
        return (np.concatenate(out_token)[order] if out_token else token), which[order]

    def walk(self, word: bytes) -> list[int]:
        """Greedy longest match over one word."""
        children, accepted, out, at, n = self.children, self.accepted, [], 0, len(word)
        while at < n:
            node, pos, token, after = 0, at, -1, at
            while pos < n and (node := children.get(node << 8 | word[pos])) is not None:
                pos += 1
                if accepted[node] >= 0:
                    token, after = accepted[node], pos
            out.append(token)
            at = after
        return out

    def merge_long(self, word: bytes) -> list[int]:
        """Exact merging of one long word: a heap of pairs, lowest rank first, leftmost among equals."""
        ids = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        rank_of, made, size, n = self._ranks(), self.made.tolist(), self.size, len(ids)
        after, ahead = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank_of.get(ids[i] * size + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, x, y = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j >= n or ids[j] != y:
                continue
            ids[i], ids[j] = made[r], -1
            k = after[i] = after[j]
            if k < n:
                ahead[k] = i
                if (q := rank_of.get(ids[i] * size + ids[k])) is not None:
                    heapq.heappush(heap, (q, i, ids[i], ids[k]))
            if (h := ahead[i]) >= 0 and (q := rank_of.get(ids[h] * size + ids[i])) is not None:
                heapq.heappush(heap, (q, h, ids[h], ids[i]))
        return [t for t in ids if t >= 0]

    @functools.cache  # noqa: B019  codecs live as long as their process
    def _ranks(self) -> dict[int, int]:
        a, b = self.merged
        return dict(zip((a * self.size + b).tolist(), range(len(a)), strict=True))

    def propose(self, buf: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proposed ids in word order and the word of each; short words go in step, long ones alone."""
        n = len(ends)
        long = np.flatnonzero(ends - begins > LONG)
        if not len(long):
            ids, counts = self.speculate(buf, ends)
            return ids, np.repeat(np.arange(n), counts)
        short = np.flatnonzero(ends - begins <= LONG)
        ids, counts = self.speculate(*gather(buf, begins[short], ends[short]))
        own = [np.array(self.walk(buf[begins[i] : ends[i]].tobytes()), np.int32) for i in long.tolist()]
        which = np.concatenate([np.repeat(short, counts), np.repeat(long, [len(x) for x in own])])
        order = np.argsort(which, kind="stable")
        return np.concatenate([ids, *own])[order], which[order]

    def merge_words(self, buf: np.ndarray, begins: np.ndarray, ends: np.ndarray, bad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact ids of the words ``bad``, and the word of each id."""
        long = ends[bad] - begins[bad] > LONG
        short = bad[~long]
        ids, whose = self.merge_all(*gather(buf, begins[short], ends[short]))
        own = [np.array(self.merge_long(buf[begins[i] : ends[i]].tobytes()), np.int64) for i in bad[long].tolist()]
        return np.concatenate([ids, *own]), np.concatenate([short[whose], np.repeat(bad[long], [len(x) for x in own])])

    def encode_words(self, buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids in word order, counts per word, and how many words had to be merged exactly."""
        n = len(ends)
        begins = ends - np.diff(ends, prepend=0)
        ids, which = self.propose(buf, begins, ends)
        failed = np.zeros(n, bool)
        failed[which[~self.reachable[ids]]] = True
        inside = np.flatnonzero(which[1:] == which[:-1])
        if len(inside):
            keys, back = np.unique(ids[inside].astype(np.int64) * self.size + ids[inside + 1], return_inverse=True)
            fine = self.compatible(keys // self.size, keys % self.size)
            failed[which[inside[~fine[back]]]] = True
        if failed.any():
            exact, whose = self.merge_words(buf, begins, ends, np.flatnonzero(failed))
            fine = ~failed[which]
            which = np.concatenate([which[fine], whose])
            order = np.argsort(which, kind="stable")
            ids = np.concatenate([ids[fine], exact.astype(np.int32)])[order]
        return ids, np.bincount(which, minlength=n), int(failed.sum())

    def _learn(self, data: np.ndarray, begin: np.ndarray, stop: np.ndarray, which: np.ndarray, hashes: np.ndarray | None) -> np.ndarray:
        buf, ends = gather(data, begin[which], stop[which])
        ids, counts, _ = self.encode_words(buf, ends)
        return self._remember(hashes, counts, ids, buf, ends)

    # -- texts ------------------------------------------------------------------------------
    def _encode_specials(self, text: str) -> np.ndarray:
        parts = [np.zeros(0, np.int32)]
        for part in self.cut.split(text):
            parts.append(np.array([self.special[part]], np.int32) if part in self.special else self.encode_plain([part])[0])
        return np.concatenate(parts)

    def encode_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        starts = cut_words(points, ends)
        data = np.frombuffer("".join(texts).encode("utf-8", "surrogatepass"), np.uint8)
        byte = np.append(starts, len(points))
        if len(data) > len(points):  # not ASCII alone
            width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
            byte = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])[byte]
        begin, stop = byte[:-1], byte[1:]
        hashes = np.maximum(span_hashes(data, begin, stop), np.uint64(1))
        at = self.index.get(hashes)
        miss = np.flatnonzero(at < 0)
        if len(miss):
            new, first = np.unique(hashes[miss], return_index=True)
            if self.known + len(new) > CACHE_WORDS:  # all of the block's words are new then
                miss = np.arange(len(hashes))
                new, first = np.unique(hashes, return_index=True)
                self._forget(len(new))
            self._learn(data, begin, stop, miss[first], new)
            at[miss] = self.index.get(hashes[miss])
        unlike = self.differing(at, data, begin, stop)
        if len(unlike):  # equal hashes of different words: these are done by themselves
            at[unlike] = self._learn(data, begin, stop, unlike, None)
        counts = self.counts[at]
        before = np.concatenate([[0], np.cumsum(counts)])
        ids = self.flat[np.repeat(self.starts[at] - before[:-1], counts) + np.arange(before[-1])]
        return ids, before[np.searchsorted(starts, np.concatenate([[0], ends]))]

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another (int32), and the offsets of each text's ids."""
        odd = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        if not odd:
            return self.encode_plain(texts)
        own = {i: self._encode_specials(texts[i]) for i in odd}
        ids, offsets = self.encode_plain(["" if i in own else t for i, t in enumerate(texts)])
        parts = [own.get(i, ids[offsets[i] : offsets[i + 1]]) for i in range(len(texts))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(list(map(len, parts)))])

    def encode(self, text: str | None) -> list[int]:
        return self.encode_batch([text or ""])[0].tolist()

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def codec(path: str) -> BpeCodec:
    """One codec a worker process and file."""
    return BpeCodec(path)


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Adds ``out``, the ids of ``text`` as an array, to every row; an existing ``out`` is replaced."""
    df = df.drop(out) if out in df.columns else df
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    places = df.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            done = 0
            for part in sh.blocks(sh.strings(b.column(places.index(text)))):
                ids, offsets = c.encode_batch(part.to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*b.slice(done, len(part)).columns, lists], [*places, out])
                done += len(part)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds ``out``, the text of the ids in ``ids`` (special tokens kept); null ids give an empty text."""
    df = df.drop(out) if out in df.columns else df
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])
    places = df.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            texts = [c.decode(x or []) for x in b.column(places.index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*places, out])

    return df.mapInArrow(run, schema)


def roundtrip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes and decodes every text in one pass; digests of the ids and of the decoded text.

    The ids of a text never leave the worker, so a row costs four values and no id array is sent."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        shown = [str(i) for i in range(c.size)]
        for b in batches:
            n, ids_hex, text_hex = [], [], []
            for part in sh.blocks(sh.strings(b.column(1))):
                ids, offsets = c.encode_batch(part.to_pylist())
                for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    own = ids[i:j].tolist()
                    n.append(j - i)
                    ids_hex.append(hashlib.sha256(",".join(map(shown.__getitem__, own)).encode()).hexdigest())
                    text_hex.append(hashlib.sha256(c.decode(own).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
