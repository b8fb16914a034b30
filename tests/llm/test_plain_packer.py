"""The level array against a packer that tries every place."""

import random

import pytest

from fieldwatch.llm.packing import Packer


def plain(lengths, size):
    """Sequences that fill up, as lists of (document, start, length), and the windows left open."""
    full, windows = [], []
    for doc, length in enumerate(lengths):
        whole = length // size
        full += [[(doc, k * size, size)] for k in range(whole)]
        rest = length - whole * size
        if not rest:
            continue
        fills = [sum(p[2] for p in w) for w in windows]

        def cost(level, fills=fills, rest=rest):
            after = list(fills)
            if level:
                after.remove(level)
            after.append(level + rest)
            return sum(after.count(f) ** 2 for f in set(after) if f < size)

        level = min((x for x in {0, *fills} if x + rest <= size), key=lambda x: (cost(x), -x))
        at = max(k for k, f in enumerate(fills) if f == level) if level else None  # the window that came to this level last
        window = windows.pop(at) if level else []
        window = [*window, (doc, whole * size, rest)]
        (full if level + rest == size else windows).append(window)
    return full, windows


@pytest.mark.parametrize("seed", range(6))
def test_every_document_goes_where_the_squares_grow_least(seed):
    chance, size = random.Random(seed), 24
    lengths = [chance.choice([chance.randrange(1, 10), chance.randrange(1, 60)]) for _ in range(300)]
    packer, rows = Packer(size, 0, 10**6), []
    for doc, length in enumerate(lengths):
        rows += packer.add(doc, bytes(4 * length))
    got = {}
    for doc, start, length, _, _, sequence, offset in rows:
        assert offset == sum(p[2] for p in got.get(sequence, []))
        got.setdefault(sequence, []).append((doc, start, length))
    full, windows = plain(lengths, size)
    assert [got[k] for k in sorted(got)] == full
    assert sorted([[(d, s, len(ids) // 4) for d, s, ids, _ in w] for level in packer.open for w in level]) == sorted(windows)
    cut = {r[5] for r in packer.refill(last=True)}
    assert len(cut) < len(got) / 5  # few sequences are made of what was open at the end


def test_nothing_is_padded_and_every_id_is_in_one_piece():
    chance, size = random.Random(9), 32
    lengths = [chance.randrange(1, 100) for _ in range(200)]
    packer = Packer(size, 0, 5)
    rows = [r for doc, n in enumerate(lengths) for r in packer.add(doc, bytes(4 * n))] + packer.refill(last=True)
    sizes = {}
    for r in rows:
        sizes[r[5]] = sizes.get(r[5], 0) + r[2]
    assert all(n == size or n & (n - 1) == 0 for n in sizes.values()) and sum(n < size for n in sizes.values()) <= 5
    for doc, n in enumerate(lengths):
        pieces = sorted((r[1], r[2]) for r in rows if r[0] == doc)
        assert [s for s, _ in pieces] == [sum(k for _, k in pieces[:i]) for i in range(len(pieces))] and sum(k for _, k in pieces) == n
