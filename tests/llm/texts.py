"""Invented texts."""

import random


def prose(seed, n, words=400):
    """n words of an invented language, the same for the same seed."""
    rng = random.Random(seed)
    parts = ["an", "ber", "cho", "dil", "er", "fu", "gal", "hi", "ino", "ke"]
    stock = ["".join(parts[int(d)] for d in str(1000 + k)) for k in range(words)]
    return [rng.choice(stock) for _ in range(n)]
