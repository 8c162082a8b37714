"""Surrogates where an entity's own shape has few or none."""

from __future__ import annotations

import re

from recogna.llm import pii


def test_entities_without_a_free_surrogate_of_their_shape_get_one(spark):
    names = [f"Mr {c}u" for c in "BCDFGHJKLMNPQRSTVWXYZ"] + ["Ms An", "Ms En", "Ms In", "Ms On", "Ms Un", "Herr Öz", "г-н Юё", "господин 漢", "Mme Éloïse"]
    entities = [("person", n) for n in names] + [("email", "--@--.com"), ("email", "_@-.com")] + [("ssn", f"{i:02d}") for i in range(100)]
    out = pii.assign(spark.createDataFrame(entities, "kind string, entity string"), "k").collect()
    made = {(r.kind, r.entity): r.surrogate for r in out}
    assert len(made) == len(out) == len(entities) and len({(k, v) for (k, _), v in made.items()}) == len(entities)
    assert not {(k, v) for (k, _), v in made.items()} & set(entities)
    assert all(v.split(" ")[0] == e.split(" ")[0] for (k, e), v in made.items() if k == "person")
    assert all(re.fullmatch(pii.KINDS["email"], v) for (k, _), v in made.items() if k == "email")
    assert all(re.fullmatch(r"\S+ \w+", v) for (k, _), v in made.items() if k == "person")


def test_a_longer_surrogate_is_written_out(spark):
    rows = [("phone", "(269) 555-1234", "26955512349"), ("iban", "DE12 3456", "DE1234567"), ("ssn", "123-45-6789", "987654321")]
    frame = spark.createDataFrame(rows, "kind string, mention string, put string")
    got = [r[0] for r in frame.select(pii.rendered(frame.mention, frame.kind, frame.put)).collect()]
    assert got == ["(269) 555-12349", "DE12 34567", "987-65-4321"]
