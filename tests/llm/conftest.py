import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
CLASHING = ["row", "key", "tid", "id", "fp", "items", "starts", "score", "part", "rank", "doc"]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang]) with extra columns whose names operators may use themselves."""
    def make(rows):
        from pyspark.sql import functions as F

        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None) for r in rows]
        return spark.createDataFrame(full, DOCS).withColumns({c: F.lit("x") for c in CLASHING})

    return make


@pytest.fixture(scope="session")
def awkward(spark):
    """Null, empty, blank, very long, repeated and odd texts; repeated and null ids."""
    import random

    rng = random.Random(3)
    vocabulary = ["alpha", "Beta", "gämma", "Δelta", "e", "zeta9", "\U0001F600", "theta,", "iota"] + [f"w{i}" for i in range(400)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared, base = say(90), say(300)
    words = base.split(" ")
    near = [" ".join(words[:k] + ["changed"] + words[k + 1:]) for k in range(20, 280, 40)]
    rows = [(1, None), (2, ""), (3, "  \n\t "), (4, "1 2 3 ..."), (5, "one"), (6, base), (7, base), (7, base), (None, base), (None, say(40)),
            (8, "a " * 3000), (9, "a" * 2500), (10, say(30) + " " + shared + " " + say(20)), (11, shared), (12, say(5) + "\n" + shared),
            (13, say(20000)), (14, "é" * 700), (15, "x\x0by\x85z"), (16, "tab\tand nbsp")]
    return rows + [(100 + i, t) for i, t in enumerate(near)] + [(200 + i, say(rng.randrange(1, 60))) for i in range(15)]
