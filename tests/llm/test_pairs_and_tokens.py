"""What the findings on the pipeline's candidates and on op3 and op5's time asked for."""

from __future__ import annotations

import numpy as np
import pytest

from recogna.llm import near_copies as N
from recogna.llm.common import known_to_workers
from recogna.llm.queries import tokenizer_path
from recogna.llm.tokens import Encoder

ODD = [
    "Foo, foo! FOO (foo) foo's don't 'LL' x's, a.b a-b_c _ __ école, ÉCOLE! d́, éx É́ naïvé,",
    "<|endoftext|> x<|startoftext|>,y ªº µm İI ﬁ² x×y ÷a ẞß 0 10, a0b a,0 ... ,,, \x85a a\x85 a​b 　x ñ,ñ;ñ",
    "  two  blanks \n\n x \n\n\ny, \n z\n", "tab\tand more, x\ty \n z", "\n", "", " ", "日本 語、 мир, нет жabc abcж, 1234 a1 1a ½ x½,",
    "{e} [f] `g` ~h~ @i #j$ k% l^ m& n* o( p) q= r+ s/ t\\ u| v; w: x\" y< z> A? B' end,", "foo, \n bar. \nbaz.\n\nFoo,foo",
]


@pytest.mark.parametrize(("kind", "blanks"), [("bytes", "kept"), ("words", "dropped")])
def test_cuttings_give_the_ids_of_whole_texts(kind, blanks):
    tokenizer = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer_path(kind))
    tokenizer.encode_special_tokens = True
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in ODD]
    assert Encoder(tokenizer_path(kind), blanks).encode(ODD) == want
    few = Encoder(tokenizer_path(kind), blanks, most=3)
    assert [few.encode([t])[0] for t in ODD] == want


def test_words_are_remembered_without_marks_and_capitals():
    pytest.importorskip("tokenizers")
    words = Encoder(tokenizer_path("words"), "dropped")
    words.encode(["Merci, merci! MERCI merci."])
    assert set(words.young) == {"merci", ",", "!", "."}
    words.encode(["МИР Merci"])  # other scripts are left to the tokenizer
    assert "МИР" in words.young and "Merci" in words.young
    kept = Encoder(tokenizer_path("bytes"), "kept")
    kept.encode([" merci, merci! merci don't."])
    assert set(kept.young) == {" merci", ",", "!", " don't."}


def _family(n: int) -> np.ndarray:
    """Codes of texts that are all as far from one text as similar ones are, and of as many unrelated ones."""
    rng = np.random.default_rng(n)
    flips = rng.random((n, 64 * N.LANES)) < 0.08
    flips[n // 2 :] = rng.random((n - n // 2, 64 * N.LANES)) < 0.5
    return np.packbits(flips, axis=1, bitorder="little").view("<i8")


def _first(spark, codes: np.ndarray) -> list[tuple[int, int]]:
    known_to_workers(spark)
    lanes = [f"l{k}" for k in range(N.LANES)]
    reps = spark.createDataFrame([(i, i, 100, *map(int, c)) for i, c in enumerate(codes)], "rep long, root long, size long, " + ", ".join(f"{x} long" for x in lanes))
    return [(r.a, r.b) for r in N.routed(reps).repartition(4, "route").mapInArrow(N.first_pairs, "a long, b long").collect()]


def test_candidates_grow_with_the_texts_and_none_is_lost(spark):
    made = {}
    for n in (300, 600, 1200):
        codes = _family(n)
        rows = _first(spark, codes)
        made[n] = len(rows)
        apart = np.bitwise_count((codes[:, None] ^ codes[None]).view(np.uint8)).reshape(n, n, N.TABLES, 3).sum(axis=3)
        want = {(a, b) for a, b in np.argwhere((apart.min(axis=2) <= 2) & (apart.sum(axis=2) <= N.CODE_APART)).tolist() if a < b}
        pairs, later = {(a, b) for a, b in rows if a != b}, {a for a, b in rows if a == b}
        assert pairs <= want and all(p in pairs or later.issuperset(p) for p in want)
        assert len(want) > n * n // 16
    assert made[1200] <= 2.5 * made[600]
