"""Alignments of altered recordings that landmarks of 64 equal bits missed."""

import numpy as np

from tessera.llm import chroma


def test_two_differing_bits_still_vote():
    rng = np.random.default_rng(5)
    p = rng.integers(1, 2**32, 60).astype(np.uint64)
    noisy = p ^ (np.uint64(1) << rng.integers(0, 32, 60).astype(np.uint64))  # one bit of each step, two of each pair
    (found,) = chroma.matched([p], [noisy[7:]], chroma.LEAST_VOTES, chroma.MAX_BIT_ERROR)
    assert found == (0, 0, 7, 60 - 7 - chroma.GAP, 1 / 32)


def test_noisy_shifted_copies_are_aligned(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(20):
        x, rate = chroma.decode_wav(chroma.melody(rng.uniform(-0.6, 0.6, 64)))
        rows += [(i, chroma.encode_wav(x)), (100 + i, chroma.encode_wav(x[chroma.HOP // 2 + 7 * chroma.HOP :] + rng.normal(0, 0.05, len(x) - chroma.HOP // 2 - 7 * chroma.HOP)))]
    prints = chroma.fingerprints(spark.createDataFrame(rows, "id bigint, audio binary"))
    got = chroma.align(prints, prints.where("id < 100")).collect()
    best = {r["query_class"]: r for r in got if r["match_class"] == r["query_class"] + 100}
    assert len(best) == 20 and all(r["offset"] in (7, 8) for r in best.values())
    wrong = [r for r in got if r["match_class"] != r["query_class"] + 100]
    assert len(wrong) < 0.01 * 20 * 38  # pairs of unrelated recordings


def test_a_few_steps_in_common_are_no_alignment():
    rng = np.random.default_rng(7)
    a, b = (rng.integers(1, 2**32, 80).astype(np.uint64) for _ in range(2))
    for shared, found in ((chroma.LEAST_OVERLAP - 1, 0), (chroma.LEAST_OVERLAP, 1)):
        other = np.concatenate([a[-shared:], b])
        assert len(list(chroma.matched([a], [other], chroma.LEAST_VOTES, chroma.MAX_BIT_ERROR))) == found
    assert len(set(chroma.FILTERS)) == 16
