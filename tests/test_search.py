"""SIM-06: seeds by bins of diagonals against brute force, and many alignments at once against one at a time."""

import random
from collections import defaultdict

import pytest

from strandweave.operators import pairwise, splicing


@pytest.mark.parametrize("letters", ["ACGT", "AC", "A", "ACGN"])
def test_seed_bins_equal_brute_force(letters):
    r = random.Random(2)
    text = "".join(r.choices(letters, k=300))
    templates = ["".join(r.choices(letters, k=r.randrange(0, 80))) for _ in range(7)] + [text[50:120], text[200:299]]
    want = defaultdict(list)
    for q, s in enumerate(templates):
        for pattern in splicing.SEEDS:
            on = [i for i, c in enumerate(pattern) if c == "1"]
            word = lambda x, i: "".join(x[i + k] for k in on)
            for j in range(min(200, len(text) - len(pattern) + 1)):
                own = word(text, j)
                for i in range(len(s) - len(pattern) + 1) if "N" not in own else ():
                    if word(s, i) == own:
                        want[q, (j + 1000 - i) // 16].append(j + 1000 - i)
                        want[q, (j + 1000 - i) // 16 - 1].append(j + 1000 - i)
    got = splicing.seed_bins(templates, text, 1000, 200, 16, at_once=64)
    assert {(q, b): x for q, b, *x in zip(*(v.tolist() for v in got))} == {k: [len(v), min(v), max(v)] for k, v in want.items()}


@pytest.mark.parametrize("gaps", [(-5, -3), (-3, 0)])
def test_pairs_aligned_together_equal_pairs_alone(gaps):
    r = random.Random(4)
    firsts, seconds = [], []
    for letters in ("ACGT", "ARNDBZ0123", "BZ-XA", "AC", "ACGé"):
        for _ in range(40):
            first = r.choices(letters, k=r.randrange(0, 60))
            second = list(first) if r.random() < 0.5 else r.choices(letters, k=r.randrange(0, 90))
            for _ in range(4):
                second.insert(r.randrange(len(second) + 1), r.choice(letters))
            firsts.append("".join(first))
            seconds.append("".join(second))
    table = pairwise.scores()
    want = [pairwise.align_pair(x, y, *gaps, table) for x, y in zip(firsts, seconds)]
    for cells in (1 << 24, 1 << 16):
        assert pairwise.align_pairs(firsts, seconds, *gaps, table, cells) == want
