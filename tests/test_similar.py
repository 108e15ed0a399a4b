"""SIM-05: pairs equal brute force, and what is written stays near the size of the texts."""

import random
from pathlib import Path

import numpy as np
import pytest

from strandweave.operators import lookups
from strandweave.operators.lookups import similar_sequences


def _alike(rows, size, least):
    sets = [(i, {s[p : p + size] for p in range(max(1, len(s) - size + 1))}) for i, s in rows]
    out = {(a, b): len(x & y) / len(x | y) for a, x in sets for b, y in sets if a < b}
    return {k: v for k, v in out.items() if v >= least}


@pytest.mark.parametrize("least", [0.2, 0.75])
def test_pairs_equal_brute_force_and_little_is_written(spark, tmp_path, monkeypatch, least):
    r = random.Random(5)
    fresh = lambda n: "".join(r.choices("ARNDCQEGHILKMFPSTWYV", k=n))
    common = fresh(300)  # a passage of all
    rows = [(i, common + fresh(3_000)) for i in range(1, 31)]
    for i in range(31, 61):  # parts of others, of any overlap
        own = rows[r.randrange(30)][1]
        rows.append((i, own[: r.randrange(300, 3_300)] + fresh(r.randrange(1, 2_000))))
    rows += [(61, rows[0][1]), (62, ""), (63, "ARND"), (64, "ARND"), (65, "AR" * 500), (66, "AR" * 700)]
    text = sum(len(s) for _, s in rows)
    monkeypatch.setattr("strandweave.session.shared_dir", lambda _: str(tmp_path))
    got = {(x.a, x.b): x.jaccard for x in similar_sequences(spark.createDataFrame(rows, "seq_id long, seq string"), 25, least).collect()}
    assert got == pytest.approx(_alike(rows, 25, least))
    assert sum(p.stat().st_size for p in Path(tmp_path).rglob("*.parquet")) < 4 * text + 200_000


@pytest.mark.parametrize("size", [1, 3, 25])
def test_hashed_grams_equal_brute_force(monkeypatch, size):
    r = random.Random(7)
    texts = ["".join(r.choices("ACGé", k=r.randrange(0, 90))) for _ in range(40)] + ["", "A" * 200]
    sets = [{s[p : p + size] for p in range(max(1, len(s) - size + 1))} for s in texts]
    owner, h = lookups.gram_hashes(texts, size)
    own = [set(h[owner == i].tolist()) for i in range(len(texts))]
    assert [len(x) for x in own] == [len(x) for x in sets] == [int((owner == i).sum()) for i in range(len(texts))]
    assert all(len(x & y) == len(u & v) for x, u in zip(own, sets) for y, v in zip(own, sets))
    # hashes that fall together change no share
    plain = lookups._hashes
    for mask in (2**64 - 1, 31):
        monkeypatch.setattr(lookups, "_hashes", lambda codes, n: plain(codes, n) & np.uint64(mask))
        made = [(lookups.Grams(s, size), u) for s, u in zip(texts, sets) if len(s) >= size]
        assert all(x.share(y) == len(u & v) / len(u | v) for x, u in made for y, v in made)
