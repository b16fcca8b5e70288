import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def frame(spark):
    """Rows to a DataFrame over several partitions; an empty list gives an empty table."""
    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make


def prose(rng: random.Random, n: int) -> str:
    syllables = "an ber chi dor el fa gu hin io jak ki lo mun".split()
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))
