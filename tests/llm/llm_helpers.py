import random

WORDS = "the quick brown fox jumps over lazy dog and runs through green fields while rivers sing under pale moons".split()


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + str(rnd.randrange(40)) for _ in range(n))
