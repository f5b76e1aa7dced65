"""Suffix array and capped common-prefix values by recursive induced sorting.

The suffixes at the left-most S positions (the sample) are sorted first: their
substrings are named in order, the names form a shorter text, and the same
procedure sorts that text's suffixes. From level ``DOUBLING`` on, where the text
is small and most names are unique, prefix doubling sorts what is still tied.
From the sample the L suffixes, then the S suffixes, are induced: a queue
ordered by first symbol is read from the small (then the large) end, and each
suffix read puts the suffix one to its left behind (before) the ones its bucket
already holds.

The queue is one array with a zone per bucket and a write mark per zone; it,
the text, the order and the prefix values are kept in files mapped into memory
once a shard is larger than ``IN_MEMORY`` symbols, and are read and written in
sequential runs and per-bucket runs. Reading goes in batches: as many entries
as surely precede everything they induce.

Common-prefix values are carried by the queue: two neighbours induced by
entries p < q share one symbol more than the least value between p and q. A
running minimum per bucket gives it across batches, a sparse table within one.
Values are cut off at ``CAP``. The sample's own values are found by comparing
neighbours word by word.
"""

from __future__ import annotations

import tempfile

import numpy as np

CAP = 200
IN_MEMORY = 1 << 26
BATCH = 1 << 15
DOUBLING = 2


class Space:
    """Arrays in memory, or in mapped files that go when the space is closed."""

    def __init__(self, limit: int = IN_MEMORY):
        self.limit, self.folder, self.n = limit, None, 0

    def array(self, n: int, dtype, fill=None) -> np.ndarray:
        if n <= self.limit:
            return np.empty(n, dtype) if fill is None else np.full(n, fill, dtype)
        if self.folder is None:
            self.folder = tempfile.TemporaryDirectory()  # this worker's own; nothing else reads it
        self.n += 1
        out = np.memmap(f"{self.folder.name}/{self.n}", dtype=dtype, mode="w+", shape=(n,))
        if fill is not None:
            out[:] = fill
        return out

    def __enter__(self):
        return self

    def __exit__(self, *_):
        if self.folder is not None:
            self.folder.cleanup()


def s_types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its successor; the last one counts as smaller."""
    n = len(text)
    differs = np.append(text[:-1] != text[1:], True)
    less = np.append(text[:-1] < text[1:], True)
    where = np.flatnonzero(differs)  # each place takes the type of the next place that differs from its successor
    return np.repeat(less[where], np.diff(where, prepend=-1))[:n]


def sample_places(s: np.ndarray) -> np.ndarray:
    return np.flatnonzero(s[1:] & ~s[:-1]) + 1


def names_of(text: np.ndarray, s: np.ndarray, sample: np.ndarray) -> np.ndarray:
    """Rank of each sample substring (up to and with the next sample place), by
    symbol and type; refined by as many symbols at a time as fit into a word,
    and only where ties are left."""
    n = len(sample)
    bits = int(2 * int(text.max()) + 2).bit_length()
    per = max(1, 62 // bits)
    size = np.append(sample[1:], len(text) - 1) - sample + 1  # with the last symbol
    last = len(text) - 1
    rank = np.zeros(n, dtype=np.int64)
    left, depth = np.arange(n), 0
    while len(left):
        key = np.zeros(len(left), dtype=np.int64)
        places, room = sample[left] + depth, size[left] - depth
        for k in range(per):
            at = np.minimum(places + k, last)
            code = text[at].astype(np.int64) * 2 + s[at] + 1
            key = (key << bits) | np.where(k < room, code, 0)
        r = rank[left]
        order = np.lexsort((key, r)) if depth else np.argsort(key, kind="stable")
        r, key, room = r[order], key[order], room[order]
        place = np.arange(len(order))
        first = np.ones(len(order), dtype=bool)
        first[1:] = r[1:] != r[:-1]
        new = first.copy()
        new[1:] |= key[1:] != key[:-1]
        # rank: that of the group so far, and the members before the subgroup
        group = np.maximum.accumulate(np.where(first, place, 0))
        sub = np.maximum.accumulate(np.where(new, place, 0))
        rank[left[order]] = r + (sub - group)
        sizes = np.diff(np.append(np.flatnonzero(new), len(order)))
        left = left[order][np.repeat(sizes > 1, sizes) & (room > per)]
        depth += per
    return _dense(rank, n)


def _dense(rank: np.ndarray, n: int) -> np.ndarray:
    used = np.zeros(n + 1, dtype=np.int64)
    used[rank + 1] = 1
    return np.cumsum(used)[rank]


class _Least:
    """Least value of ranges of a short array (sparse table)."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        width = 1
        while 2 * width <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """min(values[a:b]) for each a < b."""
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), dtype=self.levels[0].dtype)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            v = self.levels[k]
            out[at] = np.minimum(v[a[at]], v[b[at] - (1 << k)])
        return out


def _grouped(y: np.ndarray):
    """(order, group starts' mask, place within the group) of a stable sort by y."""
    order = np.argsort(y, kind="stable")
    ys = y[order]
    first = np.ones(len(ys), dtype=bool)
    first[1:] = ys[1:] != ys[:-1]
    place = np.arange(len(ys))
    return order, ys, first, place - np.maximum.accumulate(np.where(first, place, 0))


def induce(text, s, sample, space: Space, sample_lcp=None):
    """(order, prefix values or None) of all suffixes from the sorted sample."""
    n = len(text)
    kinds = int(text.max()) + 1
    count = np.bincount(text, minlength=kinds)
    n_l = np.bincount(text[~s], minlength=kinds)
    carry = sample_lcp is not None
    if carry:
        change = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)

        def run_length(i):
            return np.minimum(change[np.searchsorted(change, i)] - i + 1, CAP).astype(np.uint8)

    # L suffixes: zones hold the L suffixes of a bucket, then its part of the sample
    n_s = np.bincount(text[sample], minlength=kinds)
    zone = np.concatenate([[0], np.cumsum(n_l + n_s)])
    place_type = np.int32 if n < 1 << 31 else np.int64
    queue = space.array(int(zone[-1]), place_type, -1)
    lcps = space.array(len(queue), np.uint8, 0) if carry else None
    chars = text[sample]
    before = np.concatenate([[0], np.cumsum(n_s)])
    at = zone[chars] + n_l[chars] + (np.arange(len(sample)) - before[chars])
    queue[at] = sample
    if carry:
        same = np.append(False, chars[1:] == chars[:-1])
        lcps[at] = np.where(same, sample_lcp, 0)
    meets = zone[:-1] + n_l  # where a zone's sample part begins
    meets = meets[(n_l > 0) & (n_s > 0)]
    head = zone[:-1].copy()
    run = np.full(kinds, CAP, dtype=np.uint8)
    pushed = np.zeros(kinds, dtype=bool)
    i, size = 0, 256
    while i < len(queue):
        batch = np.asarray(queue[i:i + size])
        gap = np.flatnonzero(batch < 0)
        if len(gap):
            batch = batch[:gap[0]]
        left = batch - 1
        makes = (left >= 0) & ~s[left]
        y = text[left]
        lands = np.where(makes, head[y], len(queue) + 1)
        fits = np.minimum.accumulate(lands) > i + np.arange(len(batch))
        m = int(fits.sum())  # fits is a prefix: everything these entries induce comes after them
        batch, makes, y, left = batch[:m], makes[:m], y[:m], left[:m]
        j = np.flatnonzero(makes)
        if carry:
            links = lcps[i:i + m]
            k = meets[np.searchsorted(meets, i):np.searchsorted(meets, i + m)]
            if len(k):
                lcps[k] = np.minimum(run_length(queue[k - 1]), run_length(queue[k]))
                links = lcps[i:i + m]
        if len(j):
            order, ys, first, place = _grouped(y[j])
            where = head[ys] + place
            queue[where] = left[j][order]
            if carry:
                jo = j[order]
                least = _Least(links)
                value = np.empty(len(jo), dtype=np.int64)
                f = np.flatnonzero(first)
                value[f] = np.minimum(run[ys[f]], least.of(np.zeros(len(f), np.int64), jo[f] + 1)).astype(np.int64) + 1
                value[f[~pushed[ys[f]]]] = 0
                g = np.flatnonzero(~first)
                value[g] = least.of(jo[g - 1] + 1, jo[g] + 1).astype(np.int64) + 1
                lcps[where] = np.minimum(value, CAP)
                np.minimum(run, links.min(), out=run)
                ends = np.append(f[1:], len(ys)) - 1
                tail = jo[ends] + 1
                run[ys[ends]] = CAP
                inner = np.flatnonzero(tail < m)
                run[ys[ends][inner]] = least.of(tail[inner], np.full(len(inner), m))
                pushed[ys[ends]] = True
            ends = np.append(np.flatnonzero(first)[1:], len(ys)) - 1
            head[ys[ends]] += place[ends] + 1
        elif carry:
            np.minimum(run, links.min(), out=run)
        i += m
        size = min(BATCH, 2 * m + 64)

    # all suffixes: the L zones are final, S suffixes go to their bucket's end
    start = np.concatenate([[0], np.cumsum(count)])
    out = space.array(n, place_type, -1)
    out_lcp = space.array(n + 1, np.uint8, 0) if carry else None
    for a in range(0, len(queue), 1 << 22):
        at = np.arange(a, min(len(queue), a + (1 << 22)))
        bucket = np.searchsorted(zone, at, side="right") - 1
        keep = at - zone[bucket] < n_l[bucket]
        to = (start[bucket] + at - zone[bucket])[keep]
        out[to] = queue[at[keep]]
        if carry:
            out_lcp[to] = lcps[at[keep]]
    del queue, lcps
    out[0] = n - 1
    tail = start[1:] - 1
    meets = start[:-1] + n_l
    meets = meets[(n_l > 0) & (count > n_l)]
    run = np.full(kinds, CAP, dtype=np.uint8)
    pushed = np.zeros(kinds, dtype=bool)
    i, size = n - 1, 256
    while i >= 0:
        batch = np.asarray(out[max(0, i - size + 1):i + 1])[::-1]
        gap = np.flatnonzero(batch < 0)
        if len(gap):
            batch = batch[:gap[0]]
        left = batch - 1
        makes = (left >= 0) & s[left]
        y = text[left]
        lands = np.where(makes, tail[y], -2)
        fits = np.maximum.accumulate(lands) < i - np.arange(len(batch))
        m = int(fits.sum())
        batch, makes, y, left = batch[:m], makes[:m], y[:m], left[:m]
        j = np.flatnonzero(makes)
        if carry:
            k = meets[np.searchsorted(meets, i - m + 2):np.searchsorted(meets, i + 2)]
            if len(k):
                out_lcp[k] = np.minimum(run_length(out[k - 1]), run_length(out[k]))
            # between each entry and the one read before it, its right neighbour
            links = np.asarray(out_lcp[i - m + 2:i + 2])[::-1]
        if len(j):
            order, ys, first, place = _grouped(y[j])
            where = tail[ys] - place
            out[where] = left[j][order]
            if carry:
                jo = j[order]
                least = _Least(links)
                value = np.empty(len(jo), dtype=np.int64)
                f = np.flatnonzero(first)
                value[f] = np.minimum(run[ys[f]], least.of(np.zeros(len(f), np.int64), jo[f] + 1)).astype(np.int64) + 1
                g = np.flatnonzero(~first)
                value[g] = least.of(jo[g - 1] + 1, jo[g] + 1).astype(np.int64) + 1
                # the value belongs to the right neighbour, which the bucket got before
                has = np.flatnonzero(~first | pushed[ys])
                out_lcp[where[has] + 1] = np.minimum(value[has], CAP)
                np.minimum(run, links.min(), out=run)
                ends = np.append(f[1:], len(ys)) - 1
                after = jo[ends] + 1
                run[ys[ends]] = CAP
                inner = np.flatnonzero(after < m)
                run[ys[ends][inner]] = least.of(after[inner], np.full(len(inner), m))
                pushed[ys[ends]] = True
            ends = np.append(np.flatnonzero(first)[1:], len(ys)) - 1
            tail[ys[ends]] -= place[ends] + 1
        elif carry:
            np.minimum(run, links.min(), out=run)
        i -= m
        size = min(BATCH, 2 * m + 64)
    if carry and count[text[-1]] > 1:
        out_lcp[1] = 1  # the last symbol alone, before the other suffixes that begin with it
    return out, out_lcp[:n] if carry else None


def common_prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common symbols of the suffixes at a and b, up to CAP, a word of four or eight symbols a step."""
    n = len(text)
    size = 1 if int(text.max()) < 255 else 2
    step = 8 // size
    padded = np.concatenate([text, np.full(CAP + 8, 256 ** size - 1, text.dtype)]).astype(np.uint8 if size == 1 else np.uint16)
    # the padding is no symbol of the text: nothing equals the end
    words = np.lib.stride_tricks.as_strided(padded.view(np.uint8), shape=(n + CAP + 1, 8), strides=(size, 1))
    words = np.ascontiguousarray(words).view(np.uint64).ravel()
    out = np.zeros(len(a), dtype=np.int64)
    left = np.arange(len(a))
    for k in range(0, CAP, step):
        x = words[np.minimum(a[left] + k, n + CAP)] ^ words[np.minimum(b[left] + k, n + CAP)]
        more = x == 0
        stop = left[~more]
        x = x[~more]
        same = np.zeros(len(x), dtype=np.int64)
        for c in range(1, step):
            same += (x & np.uint64((1 << (8 * size * c)) - 1)) == 0
        out[stop] = k + same
        left = left[more]
    out[left] = CAP
    return np.minimum(out, CAP)


def doubled(rank: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a text of dense ranks, by prefix doubling."""
    n = len(rank)
    start = np.concatenate([[0], np.cumsum(np.bincount(rank))])
    left = np.flatnonzero(np.diff(start)[rank] > 1)
    rank = np.append(start[rank], -1)  # of each place, the number of smaller ones so far; past the end: least
    depth = 1
    while len(left):
        after = rank[np.minimum(left + depth, n)]
        order = np.lexsort((after, rank[left]))
        left, after = left[order], after[order]
        r = rank[left]
        place = np.arange(len(left))
        first = np.append(True, r[1:] != r[:-1])
        new = first.copy()
        new[1:] |= after[1:] != after[:-1]
        group = np.maximum.accumulate(np.where(first, place, 0))
        subgroup = np.maximum.accumulate(np.where(new, place, 0))
        rank[left] = r + (subgroup - group)
        sizes = np.diff(np.append(np.flatnonzero(new), len(left)))
        left = left[np.repeat(sizes > 1, sizes)]
        depth *= 2
    out = np.empty(n, dtype=np.int64)
    out[rank[:n]] = np.arange(n)
    return out


def sorted_sample(text: np.ndarray, s: np.ndarray, space: Space, level: int = 1) -> np.ndarray:
    """The sample in the order of its suffixes."""
    sample = sample_places(s)
    if len(sample) < 2:
        return sample
    names = names_of(text, s, sample)
    if int(names.max()) + 1 == len(sample):
        order = np.empty(len(sample), dtype=np.int64)
        order[names] = np.arange(len(sample))
        return sample[order]
    if level >= DOUBLING:
        return sample[doubled(names)]
    shorter = np.append(names + 1, 0)  # ends with its own smallest symbol
    inner = s_types(shorter)
    order, _ = induce(shorter, inner, sorted_sample(shorter, inner, space, level + 1), space)
    return sample[np.asarray(order[1:])]


def suffix_array(text: np.ndarray, space: Space) -> tuple[np.ndarray, np.ndarray]:
    """(order, common-prefix values with the predecessor, cut off at CAP) of a
    text that ends with its smallest symbol, 0, for which values are below 65535."""
    s = s_types(text)
    sample = sorted_sample(text, s, space)
    lcp = np.zeros(len(sample), dtype=np.uint8)
    if len(sample) > 1:
        for a in range(1, len(sample), 1 << 20):
            b = min(len(sample), a + (1 << 20))
            lcp[a:b] = common_prefixes(text, sample[a:b], sample[a - 1:b - 1])
    return induce(text, s, sample, space, lcp)
