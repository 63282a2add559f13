"""Shingle sets and universe-partition signatures, on arrays of many documents at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import split_words

WORDS = 5
#: Sets of fewer elements take a segment per element; above, each band of sizes has its own partition.
SMALL, RATIO = 64, 4
#: Fixed odd multipliers of word places in a shingle, and of the published 64-bit finaliser (splitmix64).
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, one after the other, and their borders (texts + 1)."""
    import xxhash

    words, offsets = split_words(texts)
    own = words.dictionary_encode()
    known = np.array([xxhash.xxh3_64_intdigest(w) for w in own.dictionary.to_pylist()], np.uint64)
    hashes = known[own.indices.to_numpy(zero_copy_only=False)] if len(words) else np.empty(0, np.uint64)
    n = max(0, len(hashes) - WORDS + 1)
    rolled = np.zeros(n, np.uint64)
    for k in range(WORDS):
        rolled += hashes[k : k + n] * PLACES[k]
    rolled = mix(rolled)
    parts, sizes = [], np.zeros(len(offsets) - 1, np.int64)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        if b == a:
            continue
        if b - a < WORDS:  # the whole sequence is the one shingle; its length keeps it apart from longer ones
            one = mix((hashes[a:b] * PLACES[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
        else:
            one = np.unique(rolled[a : b - WORDS + 1])
        sizes[i] = len(one)
        parts.append(one)
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.concatenate(([0], np.cumsum(sizes)))


def band_of(sizes: np.ndarray) -> np.ndarray:
    """-1 for small sets, else the band [SMALL * RATIO**k, SMALL * RATIO**(k + 1))."""
    band = np.full(len(sizes), -1)
    edge = SMALL
    while (sizes >= edge).any():
        band[sizes >= edge] += 1
        edge *= RATIO
    return band


def schemes_of(sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(documents, band of the scheme, differences that a partner may have), own bands first, then the one below.

    Sets of a and b elements, a <= b, whose Jaccard similarity is at least 3/4
    have at most (a + b) / 7 elements in only one of them, and b <= 4a / 3.
    """
    band = band_of(sizes)
    own = (sizes + 4 * sizes // 3) // 7
    below = SMALL * np.power(RATIO, np.maximum(band, 0)) - 1  # largest set of the band below
    near = np.flatnonzero((band >= 0) & (4 * below >= 3 * sizes))
    everyone = np.flatnonzero(sizes > 0)
    return [(everyone, band[everyone], own[everyone]), (near, band[near] - 1, (sizes[near] + below[near]) // 7)]


def segments_of(band: np.ndarray) -> np.ndarray:
    """Segments of the universe in each scheme: half the largest set of the band, or one per element."""
    return np.where(band < 0, 1 << 31, SMALL * np.power(RATIO, np.maximum(band, 0) + 1) // 2).astype(np.uint64)


def signatures(sets: np.ndarray, borders: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, signature) of what each document has to show.

    The universe is cut into segments of rare elements and segments of hot ones.
    A document needs one unit more than a partner may have differences, and
    takes units in the order of their cost:

    1. a rare segment that is not empty, shown as it is, one unit each;
    2. a rare segment of two elements or more, its one-deletion neighbours
       shown as well, one more unit each;
    3. a hot segment that is not empty, shown as it is, one unit each.

    Let two similar documents be given and look at what comes before the place
    in this order where the first of them stops.  Its units there are more than
    the differences, so some segment of u units (1 or 2) has fewer than u
    differences: none, and both show it, or one, and then what the smaller side
    shows as it is, is a one-deletion neighbour that the larger side shows.  A
    document that runs out of segments has shown all; for partners that run out
    too it shows its first elements one by one.
    """
    sizes = np.diff(borders)
    is_hot = np.zeros(len(sets), bool)
    if len(hot) and len(sets):
        at = np.minimum(np.searchsorted(hot, sets), len(hot) - 1)
        is_hot = hot[at] == sets
    value = mix(sets + np.uint64(0x632BE59BD9B4E019))
    docs_out, sigs_out = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for docs, band, allowed in schemes_of(sizes):
        if not len(docs):
            continue
        shown, lacking = _shown(sets, value, is_hot, borders, docs, segments_of(band), band + 2, allowed + 1)
        if lacking.any():
            single = np.full(int(lacking.sum()), 1 << 31, np.uint64)
            shown += _shown(sets, value, np.zeros_like(is_hot), borders, docs[lacking], single, band[lacking] + 1002,
                            allowed[lacking] + 1)[0]
        docs_out += [d for d, _ in shown]
        sigs_out += [s for _, s in shown]
    return np.concatenate(docs_out), np.concatenate(sigs_out).view(np.int64)


def _rank(of: np.ndarray, n: int) -> np.ndarray:
    """Place of each row among the rows of its document (rows are in the order of documents)."""
    return np.arange(len(of)) - np.searchsorted(of, np.arange(n))[of]


def _shown(sets, value, is_hot, borders, docs, segments, scheme, need):
    """[(document, signature)] rows, and which of ``docs`` run out of segments."""
    sizes = (borders[1:] - borders[:-1])[docs]
    ends, n = np.cumsum(sizes), len(docs)
    place = np.repeat(borders[docs] - (ends - sizes), sizes) + np.arange(ends[-1])
    row = np.repeat(np.arange(n), sizes)
    if is_hot.any():  # rare first; the order inside stays
        place = place[np.lexsort((is_hot[place], row))]
    segment = ((sets[place] >> np.uint64(32)) * segments[row]) >> np.uint64(32)
    segment += is_hot[place].astype(np.uint64) << np.uint64(40)
    new = np.ones(len(place), bool)
    new[1:] = (row[1:] != row[:-1]) | (segment[1:] != segment[:-1])
    starts = np.flatnonzero(new)
    of, length = row[starts], np.diff(np.append(starts, len(place)))
    total = np.add.reduceat(value[place], starts)
    salt = mix(segment[starts] * np.uint64(2) + np.uint64(1)) + scheme[of].astype(np.uint64) * PLACES[1]
    rare = ~is_hot[place[starts]]
    units = np.bincount(of[rare], minlength=n)
    out = []
    one = np.flatnonzero(rare)
    one = one[_rank(of[one], n) < need[of[one]]]
    out.append((docs[of[one]], mix(total[one] + salt[one])))
    two = np.flatnonzero(rare & (length > 1) & (units < need)[of])
    two = two[_rank(of[two], n) < (need - units)[of[two]]]
    units = units + np.bincount(of[two], minlength=n)
    if len(two):
        again = np.repeat(two, length[two])
        element = np.repeat(starts[two] - (np.cumsum(length[two]) - length[two]), length[two]) + np.arange(length[two].sum())
        out.append((docs[of[again]], mix(total[again] - value[place[element]] + salt[again])))
    three = np.flatnonzero(~rare & (units < need)[of])
    three = three[_rank(of[three], n) < (need - units)[of[three]]]
    out.append((docs[of[three]], mix(total[three] + salt[three])))
    units = units + np.bincount(of[three], minlength=n)
    return out, units < need


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Jaccard similarity of two sorted sets, in whole numbers: at least 3/4."""
    if 4 * min(len(a), len(b)) < 3 * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= 75 * (len(a) + len(b) - both)
