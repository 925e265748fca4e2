"""Invented prose for tests."""

import random

WORDS = "the of and a to in stone river cloud mountain winter window garden letter silver engine paper light".split()


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) for _ in range(n))
