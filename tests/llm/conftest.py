import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def documents(spark, rows, schema=SCHEMA):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows], schema)


def prose(seed, n, vocabulary=4000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture()
def odd(spark):
    """Null and empty texts, white space only, ties, repeated rows, null ids and sources, a long text, other scripts."""
    long = prose(1, 60_000)
    return documents(spark, [
        (1, None), (2, ""), (3, " \n\t\n"), (4, "one two three"), (4, "one two three"), (None, "one two three"), (None, None),
        (5, long, None), (6, prose(2, 300)), (7, prose(2, 300), "t"), (8, "É Ñandú été\nÉ Ñandú été\r\n ÉTÉ "), (9, "#!? ###"),
        (10, prose(3, 200) + "\n" + prose(4, 200)), (4, "another text of the same id"), (-1, "<|endoftext|> 'S it's don'T, İx 12 34")])
