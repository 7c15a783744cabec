import random

from civic_spark.llm.gsaca import common_prefixes, suffix_order


def test_suffix_order_and_common_prefixes_against_sorting():
    rng = random.Random(7)
    cases = [[], [3], [1, 1, 1, 1], [2, 1] * 9, [1, 2] * 9]
    cases += [[rng.randint(-a, a) for _ in range(rng.randint(0, 40))] for a in (1, 2, 5) for _ in range(150)]
    for seq in cases:
        order = suffix_order(seq)
        assert order == sorted(range(len(seq)), key=lambda k: seq[k:])
        for k, h in enumerate(common_prefixes(seq, order)):
            a, b = (seq[order[k - 1]:], seq[order[k]:]) if k else ([], [])
            assert h == next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
