"""Made-up prose for the corpus operators' tests."""


def prose(rng, n, size=200):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))
