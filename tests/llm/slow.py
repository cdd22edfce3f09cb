"""Brute-force definitions used by several tests."""

import re

import xxhash


def slow_simhash(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    sh = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_classes(ids, fps, bits=2):
    low = {i: i for i in ids}
    while True:
        moved = False
        for i, f in zip(ids, fps):
            for j, g in zip(ids, fps):
                if (f ^ g).bit_count() <= bits and low[j] < low[i]:
                    low[i], moved = low[j], True
        if not moved:
            return low
