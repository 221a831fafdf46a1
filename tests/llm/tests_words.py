from __future__ import annotations

import random


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    stems = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    return " ".join(rng.choice(stems) + str(rng.randrange(40)) for _ in range(n))
