"""Words, shingle sets and signatures of many texts at once, on their UTF-8 bytes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

M1, M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    s = np.uint64(33)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> s)) * M1
        x = (x ^ (x >> s)) * M2
    return x ^ (x >> s)


def stream(seed: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * np.uint64(0x9E3779B97F4A7C15))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: White space that parts words: 0x20 and 0x09 to 0x0D.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: All ASCII signs but letters and digits.
SIGNS = np.ones(256, bool)
SIGNS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
WINDOW = 1 << 20
#: Bytes of a span beyond which it is hashed by itself, and masks of the last bytes of shorter ones.
LONG = 64
ENDS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def heads(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number; zeros follow the data."""
    padded = np.append(data, np.zeros(8, np.uint8))
    return np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, seed: int = 5) -> np.ndarray:
    """64-bit hashes of spans of bytes.

    Eight bytes are taken at a time and the state goes through a bijection after each, so, unlike sums of
    powers, nothing that a text repeats cancels out; spans of up to eight bytes and one length never
    collide. Spans beyond LONG bytes get a keyed digest each."""
    sizes = stops - starts
    ahead = heads(data)
    with np.errstate(over="ignore"):
        out = mix(sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + stream(seed, 1))
        live, at, left = np.arange(len(starts)), starts, np.minimum(sizes, LONG)
        while len(live):
            out[live] = mix(out[live] ^ (ahead[at] & ENDS[np.minimum(left, 8)]))
            on = left > 8
            live, at, left = live[on], at[on] + 8, left[on] - 8
    key = seed.to_bytes(8, "little")
    for i in np.flatnonzero(sizes > LONG).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : stops[i]].tobytes(), digest_size=8, key=key).digest(), "little")
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and the offsets of its rows in them."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(column: pa.Array, parts: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all lower-cased (A-Z) words of the rows, and the number of words of each row."""
    hashes, counts = word_parts(column, parts, ())
    return hashes[0], counts


def word_parts(column: pa.Array, parts: np.ndarray, prefixes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """As word_hashes, with a row of hashes for the words and one for their first n bytes, for each n up to
    eight (a shorter word has its own hash there).

    Works through windows of about a megabyte that end between words; a single longer word is
    hashed alone."""
    data, offsets = text_bytes(column)
    out, at = [], []
    lo, end = 0, len(data)
    while lo < end:
        hi = min(end, lo + WINDOW)
        if hi < end:
            gaps = np.flatnonzero(parts[data[lo:hi]])
            rows = offsets[np.searchsorted(offsets, hi, side="right") - 1]
            cut = max(lo + gaps[-1] + 1 if len(gaps) else lo, int(rows))
            if cut <= lo:  # one word fills the window
                stop = int(offsets[np.searchsorted(offsets, hi, side="left")])
                while hi < stop and not parts[data[hi : hi + WINDOW]].any():
                    hi += WINDOW
                ahead = np.flatnonzero(parts[data[hi:stop]][:WINDOW]) if hi < stop else []
                hi = hi + int(ahead[0]) if len(ahead) else stop
                one = span_hashes(LOWER[data[lo:hi]], np.array([0]), np.array([hi - lo]))
                first = [mix(heads(LOWER[data[lo : lo + 8]])[:1] & ENDS[n] ^ stream(6, n)[-1:]) for n in prefixes]
                out.append(np.stack([one, *first]))
                at.append(np.array([lo]))
                lo = hi
                continue
            hi = cut
        b = LOWER[data[lo:hi]]
        inside = ~parts[b]
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        borders = offsets[np.searchsorted(offsets, lo, side="left") : np.searchsorted(offsets, hi, side="left")] - lo
        start[borders] = inside[borders]
        starts = np.flatnonzero(start)
        if len(starts):
            over = ~inside
            over[starts] = True  # a row can begin right behind a word
            stops = np.append(np.flatnonzero(over), len(b))
            stops = stops[np.searchsorted(stops, starts, side="right")]
            rows = [span_hashes(b, starts, stops)]
            ahead = heads(b)[starts] if prefixes else None
            for n in prefixes:
                rows.append(np.where(stops - starts >= n, mix(ahead & ENDS[n] ^ stream(6, n)[-1]), rows[0]))
            out.append(np.stack(rows))
            at.append(starts + lo)
        lo = hi
    hashes = np.concatenate(out, 1) if out else np.zeros((1 + len(prefixes), 0), np.uint64)
    places = np.concatenate(at) if at else np.zeros(0, np.int64)
    return hashes, np.diff(np.searchsorted(places, offsets))


def shingle_sets(hashes: np.ndarray, counts: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its runs of k words; with fewer words, of all of them as one."""
    starts = np.cumsum(counts) - counts
    factors = stream(2, k)
    sizes = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    ends = np.cumsum(sizes)
    with np.errstate(over="ignore"):
        n = max(0, len(hashes) - k + 1)
        runs = np.zeros(n, np.uint64)
        for j in range(k):
            runs += mix(hashes[j : j + n] + factors[j])* factors[j]
        runs = mix(runs)
        flat = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
        long = counts >= k
        if long.any():
            into = np.arange(sizes[long].sum()) - np.repeat(np.cumsum(sizes[long]) - sizes[long], sizes[long])
            flat[np.repeat((ends - sizes)[long], sizes[long]) + into] = runs[np.repeat(starts[long], sizes[long]) + into]
        for c in range(1, k):
            rows = np.flatnonzero(counts == c)
            if len(rows):
                total = np.full(len(rows), c, np.uint64)
                for j in range(c):
                    total += mix(hashes[starts[rows] + j] + factors[j]) * factors[j]
                flat[ends[rows] - 1] = mix(total * np.uint64(3))
    sets = []
    for i, j in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        own = np.sort(flat[i:j])
        sets.append(own[np.append(True, own[1:] != own[:-1])] if j - i > 1 else own)
    return sets


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """Minima of ``size`` hash functions (32 bits) over each set; every set has an element."""
    seeds = stream(3, 2 * size)
    a, b = (seeds[:size] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seeds[size:] >> np.uint64(32)).astype(np.uint32)
    out = np.zeros((len(sets), size), np.uint32)
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    lo = 0
    while lo < len(sets):
        hi = lo + 1
        total = lengths[lo]
        while hi < len(sets) and total + lengths[hi] <= 100_000:
            total += lengths[hi]
            hi += 1
        x = (np.concatenate(sets[lo:hi]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum(lengths[lo:hi]) - lengths[lo:hi]
        y = np.empty_like(x)
        for i in range(size):
            np.multiply(x, a[i], out=y)
            y += b[i]
            out[lo:hi, i] = np.minimum.reduceat(y, starts)
        lo = hi
    return out
