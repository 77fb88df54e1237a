"""Candidate pairs of the n-gram join against all pairs of every list."""

import random

import pytest

from paywatch.llm import ngram_join

SCHEMA = "gram long, node long, size int, place int, root long"


def all_pairs(entries, percent):
    out = set()
    for i, (g, a, sa, pa, ra) in enumerate(entries):
        for h, b, sb, pb, rb in entries[i + 1:]:
            shared = min(sa - pa, sb - pb)
            if g == h and ra != rb and 100 * min(sa, sb) >= percent * max(sa, sb) and 100 * shared >= percent * (sa + sb - shared):
                out.add((max(a, b), min(a, b)))
    return out


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_candidates_against_all_pairs(spark, percent):
    rng = random.Random(percent)
    sizes = {n: rng.choice([1, 2, 3, 10, 11, 12, 20, 24, 25, 97, 100, 115]) for n in range(150)}
    entries = [(g, n, s, rng.randrange(max(1, s * (100 - percent) // 100 + 1)), n // 2) for n, s in sizes.items()
               for g in rng.sample(range(12), 3)]
    found = ngram_join._candidates(spark.createDataFrame(entries, SCHEMA).repartition(4), percent).collect()
    want = all_pairs(entries, percent)
    assert want and {(r.a, r.b) for r in found} == want and len(found) == len(want)


def test_texts_of_one_template_form_no_pairs(spark):
    """Three own words in each text of 100: its own n-grams come first, the template's behind them, at places that can't link."""
    entries = [(g, n, 97, 10 + g, n) for n in range(400) for g in range(4)]
    assert ngram_join._candidates(spark.createDataFrame(entries, SCHEMA), 85).count() == 0
