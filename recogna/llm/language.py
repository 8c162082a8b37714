"""Language identification with hyperdimensional profiles."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recogna.llm.common import text_batches, widened

DIM = 1024
GRAM = 3
SEED = 20_240_501
#: A unit vector's components are counted in these steps, so that sums don't depend on their order.
STEPS = 1 << 20
UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_BLOCK = 2048


@lru_cache(maxsize=20_000)
def letter(code: int) -> np.ndarray:
    """The random vector of -1 and 1 that stands for a character."""
    return np.random.default_rng([SEED, code]).integers(0, 2, DIM, dtype=np.int8) * 2 - 1


def letters_of(text: str) -> str:
    """The lower-cased text with one blank for whatever isn't a letter, and none at its ends."""
    plain = _NOT_LETTERS.sub(" ", text.lower()).strip()
    if plain and not plain.replace(" ", "").isalpha():  # numbers that are no decimal digits, such as superscripts and fractions
        plain = " ".join("".join(c if c.isalpha() else " " for c in plain).split())
    return plain


def bundles(texts: list[str]) -> np.ndarray:
    """One row for each text: the sum of its n-gram vectors, scaled to length 1 (0 without letters).

    Texts are lower-cased, and whatever isn't a letter is one blank. An n-gram's vector is the product of its
    letters' vectors, each rotated by its place. Distinct n-grams are multiplied with their counts in blocks,
    so memory doesn't follow the number of n-grams.
    """
    plain = [letters_of(t) for t in texts]
    codes = [np.frombuffer(f" {p} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64) if p else np.zeros(0, np.int64) for p in plain]
    out = np.zeros((len(texts), DIM), np.float32)
    grams = [c[:-2] << 42 | c[1:-1] << 21 | c[2:] if len(c) >= GRAM else np.zeros(0, np.int64) for c in codes]
    owner = np.repeat(np.arange(len(texts)), [len(g) for g in grams])
    if not len(owner):
        return out
    distinct, place = np.unique(np.concatenate(grams), return_inverse=True)
    for begin in range(0, len(distinct), _BLOCK):
        some = distinct[begin : begin + _BLOCK]
        parts = np.stack([some >> 42, some >> 21 & 0x1FFFFF, some & 0x1FFFFF])
        used, at = np.unique(parts, return_inverse=True)
        at = at.reshape(parts.shape)
        letters = np.stack([letter(int(u)) for u in used])
        bound = np.roll(letters, 2, axis=1)[at[0]] * np.roll(letters, 1, axis=1)[at[1]] * letters[at[2]]
        here = (place >= begin) & (place < begin + len(some))
        cells = owner[here] * len(some) + place[here] - begin
        counts = np.bincount(cells, minlength=len(texts) * len(some)).reshape(len(texts), len(some))
        out += counts.astype(np.float32) @ bound.astype(np.float32)
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norms, out=np.zeros_like(out), where=norms > 0)


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Language prototypes: the bundles of all labelled documents, summed by language.

    Tasks sum what they read, one vector a language; sums are of whole numbers and therefore the same in any order.
    What reaches the driver is one vector a language. Rows without label, text or letters teach nothing.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null and text is not null")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch, texts in text_batches(batches, "text"):
            units = np.rint(bundles(texts).astype(np.float64) * STEPS).astype(np.int64)
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in set(langs):
                sums[lang] = sums.get(lang, 0) + units[langs == lang].sum(axis=0)
        if sums:
            yield pa.record_batch([pa.array(list(sums)), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64()))], ["lang", "units"])

    partial = rows.mapInArrow(run, "lang string, units array<long>").select("lang", F.posexplode("units").alias("place", "unit"))
    whole = partial.groupBy("lang", "place").agg(F.sum("unit").alias("unit"))
    got = whole.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "unit"))).alias("units")).collect()  # DIM values a language
    sums = {r["lang"]: np.array([u["unit"] for u in r["units"]], np.float64) for r in got}
    return {lang: s / np.linalg.norm(s) for lang, s in sums.items() if s.any()}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, ``lang_pred`` and ``score``: the language of highest cosine, and that cosine,
    from 0 to 1. Of equal ones the first by name. ``und`` and 0 for null text, no letters or no prototypes. Columns of
    ``docs`` with these names are replaced; rows are independent, so repeated and skewed ones don't matter."""
    names = sorted(prototypes)
    matrix = np.stack([prototypes[n] for n in names]).astype(np.float32) if names else np.zeros((0, DIM), np.float32)
    rows = docs.drop("lang_pred", "score")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, text_col):
            units = bundles(texts)
            known = units.any(axis=1) & bool(names)
            cosines = units @ matrix.T if names else np.zeros((len(texts), 1), np.float32)
            best = cosines.argmax(axis=1)
            score = np.clip(cosines[np.arange(len(best)), best].astype(np.float64), 0, 1)
            langs = [names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(np.where(known, score, 0.0))], [*batch.schema.names, "lang_pred", "score"])

    return rows.mapInArrow(run, widened(rows.schema, lang_pred="string", score="double"))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learnt from the documents that aren't held out, predicted for all."""
    fold = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    prototypes = learn(docs.where(~fold))
    return predict(docs.select("doc_id", fold.alias("held_out"), "text"), prototypes).drop("text")
