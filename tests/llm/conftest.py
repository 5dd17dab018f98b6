import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    """Repeatable made-up text of n words."""
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    return prose


@pytest.fixture
def frame(spark):
    """A frame of documents from (doc_id, text) pairs, with columns whose names operators use inside."""

    def make(rows, lang=None):
        data = [(i, t, (lang or {}).get(i, "en"), "s", 0, "x", 1, "y") for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, k string, part int, token string"
        return spark.createDataFrame(data, schema)

    return make
