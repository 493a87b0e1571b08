import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField(n, t) for n, t in zip(("doc_id", "text", "lang", "source", "n_chars"), (T.LongType(), T.StringType(), T.StringType(), T.StringType(), T.LongType()))]
)
WORDS = "the red house stands by a long river where old men fish all day and children play in tall green grass near trees".split()

#: Texts that every operator has to stand.
ODD = [None, "", " ", "\n\n", "a", "a b", " lead and trail ", "x y z", "tab\tand\rreturn", "▁mark ▁", "<|endoftext|> ends", "é" * 30, "!!! ### $$$"]


def prose(seed: int, n: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randint(0, 9) or "") for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with nulls, ties, repeated rows, empty and very long texts."""
    rows = [(i, t, "en", f"s{i % 2}", 0) for i, t in enumerate(ODD)]
    rows += [(100 + i, prose(i, 60 + i), "en", None if i % 5 == 0 else "s0", i) for i in range(40)]
    rows += [(200, prose(7, 90), "en", "s1", 1)] * 3  # one row three times
    rows += [(None, prose(8, 70), None, None, None), (None, None, None, None, None)]
    rows += [(300 + i, prose(9, 120), "en", "hot", 2) for i in range(30)]  # copies
    rows += [(400, prose(11, 30_000), "en", "s1", 3)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clash(odd_docs):
    """Extra columns that have the names of results."""
    names = "score shard slot kept rule base_failed n_words n_shingles component_id sequence_id offset n_tokens _part2 cosine".split()
    return odd_docs.withColumns({n: F.lit("taken") for n in names})
