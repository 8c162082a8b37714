"""Tables with the awkward cases: nulls anywhere, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

import pytest

from recogna.llm.common import known_to_workers

WORDS = "the of and thre ouer lant bische École straße nière мир one two three four five six seven eight nine".split()
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, n_lines long, n_replaced long, score double, ids string, piece string"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + (".\n" if rng.random() < 0.05 else "") for _ in range(n))


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    texts: list[tuple[int | None, str | None]] = [(i, prose(i, 60 + 7 * i)) for i in range(20)]
    texts += [(20, texts[3][1]), (21, texts[3][1]), (21, texts[3][1])]
    texts += [(22, texts[4][1] + " one"), (23, None), (24, ""), (25, " \n\t\n"), (26, "one"), (27, "one two"), (None, prose(99, 80)), (28, prose(5000, 30_000)), (29, "x" * 50_000)]
    texts += [(30 + i, f"  Shared LINE here \n{prose(300 + i, 55)}\nshared line here") for i in range(12)]
    texts += [(50, "mail Ann.Lee@mail.example.com or ann.lee@mail.example.com, call +1 (269) 555-1234 or +1 269 555 1234. Mrs Anna Orlova and Herr Otto wrote 10.20.30.40.")]
    texts += [(51, "again ann.lee@mail.example.com; card 4111 1111 1111 1111, token 0641917ea4e9feb9cda83477b57ac2654884f485, ssn 123-45-6789"), (52, "tab\tand\u00a0more  blanks   here \n\n end ﬁ ½ Ａ 日本語 <|endoftext|>")]
    return [(i, t, ("en", "de", None)[k % 3], "s", 0, None, 1, 2, 0.5, "x", "y") for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    known_to_workers(spark)
    return spark.createDataFrame(rows, COLUMNS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
