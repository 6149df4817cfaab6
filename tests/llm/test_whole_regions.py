import random

import pytest

from newsloom.llm import signatures

TEXT = "The harbour authority redrafted a ceasefire timetable from next Tuesday"


@pytest.mark.parametrize("bound", [512, 40])
@pytest.mark.parametrize("fresh", [False, True])
def test_every_pair_of_a_region_is_compared(spark, fresh, bound):
    """300 rows of one sketch: one region, or one that no depth divides, so it is compared in blocks."""
    ids = [2 * i + (fresh and i in (0, 150, 299)) for i in range(300)]
    rows = signatures.forest(spark.createDataFrame([(i, TEXT) for i in ids], "id long, text string"), 2)
    got = [(x.a, x.b) for x in signatures.neighbours(rows, 0.6, fresh, bound, levels=1).collect()]
    assert len(got) == len(set(got)) and set(got) == {(i, j) for i in ids for j in ids if i < j and (not fresh or j % 2)}


def test_dense_regions_become_deeper(spark, monkeypatch):
    """Texts of one template fill dense regions; deeper ones find the alike pairs with far fewer comparisons."""
    r = random.Random(5)
    words = [f"{a}{b}" for a in ("levy", "zinc", "rail", "quota", "grid", "bond") for b in range(40)]
    texts = [f"According to the quarterly bulletin the {r.choice(words)} of {r.choice(words)} and {r.choice(words)} near {r.choice(words)} rose {r.choice(words)}" for _ in range(250)]
    texts += [t + " again" for t in texts[:50]]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    shingles = [signatures.shingles_of(t) for t in texts]
    want = {(i, j) for i in range(300) for j in range(i) if len(shingles[i] & shingles[j]) >= 0.6 * len(shingles[i] | shingles[j])}
    levels = []
    deeper = signatures.deeper
    monkeypatch.setattr(signatures, "deeper", lambda d, n: levels.append(n) or deeper(d, n))
    got = {(x.b, x.a) for x in signatures.checked(signatures.neighbours(signatures.forest(df, 24), 0.6, bound=16), df, 0.6).collect()}
    assert levels and got <= want and len(got) >= 0.99 * len(want)
