import random
import re

UPPER = {code: code + 32 for code in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return text.translate(UPPER)


def words(text):
    return WORD.findall(ascii_lower(text or ""))


def near_copies(rng: random.Random, count: int, length: int, changes: int, vocabulary: int = 400):
    """Copies of one text of which each has a few words replaced."""
    base = [f"w{rng.randrange(vocabulary)}" for _ in range(length)]
    made = []
    for _ in range(count):
        copy = list(base)
        for _ in range(changes):
            copy[rng.randrange(length)] = f"n{rng.randrange(10**6)}"
        made.append(" ".join(copy))
    return made
