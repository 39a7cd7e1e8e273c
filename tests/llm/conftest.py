import pytest

WORDS = "the of and river stone under bright seldom carry window market quiet engine paper winter garden letter copper silent harbor".split()


@pytest.fixture(scope="session")
def prose():
    """Deterministic sentences: prose(seed, words) -> text."""
    import random

    def make(seed, n):
        rnd = random.Random(seed)
        return " ".join(rnd.choice(WORDS) + (str(rnd.randrange(50)) if rnd.random() < 0.4 else "") for _ in range(n))

    return make
