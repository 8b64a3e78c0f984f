"""The bitmap bound of linking: it never rules out a link, and it keeps groups just below the threshold small."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidewatch.llm import linking, setjoin

from .conftest import with_clashes
from .test_setjoin import brute, got


def differing(a, b):
    return sum(int(x).bit_count() for x in np.bitwise_xor(a.view(np.uint64), b.view(np.uint64)))


@pytest.mark.parametrize("size", [1, 3, 60, 900, 20_000])
def test_bits_that_differ_bound_the_difference(size):
    rng = np.random.default_rng(size)
    base = rng.integers(1, 2**63, size, dtype=np.uint64)
    for swapped in (0, 1, size // 10, size // 2, size):
        other = base.copy()
        other[:swapped] = rng.integers(1, 2**63, swapped, dtype=np.uint64)
        h = np.r_[base, other]
        bits = linking.parities(h, np.array([0, size, size, 2 * size]))
        assert not bits[1].any()     # an empty set
        assert differing(bits[0], bits[2]) <= len(np.setxor1d(base, other))


def test_bitmaps_of_odd_texts(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, ""), (3, None), (4, "One two"), (5, "word " * 300_000)]
    out = {r.id: tuple(r)[1:] for r in linking.bitmaps(spark.createDataFrame(rows, "id bigint, text string")).collect()}
    assert set(out) == {1, 2, 3, 4, 5}
    assert not any(out[2]) and not any(out[3]) and any(out[1])
    assert sum(int(x & (2**64 - 1)).bit_count() for x in out[4]) == 1
    assert linking.bitmaps(spark.createDataFrame([], "id bigint, text string")).count() == 0


def test_bitmaps_do_not_depend_on_batches():
    texts = [" ".join(f"w{i * j % 97}" for j in range(i)) for i in range(1, 60)]
    whole = [linking.parities(h, o) for _, h, o in linking.shingle_sets(pa.array(texts))]
    one = [linking.parities(h, o) for t in texts for _, h, o in linking.shingle_sets(pa.array([t]))]
    assert (np.concatenate(whole) == np.concatenate(one)).all()


def variants(n=240, words=120, changed=7, seed=3):
    """Texts made from one that isn't there; two of them are a little less similar than a link needs, some more."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for i in range(n):
        t = list(base)
        for at in rng.sample(range(words), rng.choice([2, changed, changed])):
            t[at] = f"x{i}y{at}"
        out.append((i, " ".join(t)))
    return out


def test_variants_below_the_threshold(spark, monkeypatch):
    rows, made = variants(), {}
    real = linking.written

    def noted(df, name):
        made.setdefault(name, []).append(real(df, name))
        return made[name][-1]
    monkeypatch.setattr(linking, "written", noted)
    assert got(setjoin.join(with_clashes(spark, rows))) == brute(rows)
    n, verified = made["pairs"][0].count(), made["links"][1].count()
    assert n <= 2 * verified + len(rows)     # of about 28,000 pairs
