"""Quality rules as a short-circuit cascade, in DataFrame functions only."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recogna.llm.common import WHITE, WHITE_RUN, clash_free, stored

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Documents on which costs and selectivities of rules are estimated.
SAMPLE = 2_000
RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


@dataclass(frozen=True)
class Rule:
    """``fails`` is never null; it may use the text, ``_words`` and the counts of ``with_counts``."""

    name: str
    fails: Column


def with_counts(docs: DataFrame) -> DataFrame:
    """Add ``_words`` (array), n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    A word belongs to ``n_repeat_words`` if a window of three words that covers it is found again. Window hashes
    are compared as a set first; only texts with a repeat sort them to find its places.
    """
    text = F.coalesce("text", F.lit(""))
    bare = F.btrim(text, F.lit(WHITE))
    docs = docs.withColumn("_words", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WHITE_RUN)))
    docs = docs.withColumn("_lines", F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(WHITE)) != ""))
    first, second, third = (F.slice("_words", k, F.size("_words") - 2) for k in (1, 2, 3))
    hashes = F.zip_with(F.zip_with(first, second, lambda a, b: F.xxhash64(a, b)), third, lambda h, c: F.xxhash64(h, c))
    docs = docs.withColumn("_windows", F.when(F.size("_words") >= 3, hashes))
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    docs = docs.withColumn("_placed", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), placed))
    again = F.filter(
        "_placed",
        lambda w, k: F.coalesce(F.get("_placed", k - 1)["h"] == w["h"], F.lit(False)) | F.coalesce(F.get("_placed", k + 1)["h"] == w["h"], F.lit(False)),
    )
    covered = F.array_distinct(F.flatten(F.transform(again, lambda w: F.array(w["i"], w["i"] + 1, w["i"] + 2))))
    return docs.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.when(F.col("_placed").isNull(), 0).otherwise(F.size(covered)).cast("long"),
        "_n_lines": F.size("_lines"),
    }).drop("_lines", "_windows", "_placed")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def default_rules() -> list[Rule]:
    """Shares a document of running prose does not reach; all are 0 for a text without words."""
    text = F.coalesce("text", F.lit(""))
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))

    def cut(pattern: str) -> Column:
        return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))

    return [
        Rule("symbols", F.col("n_symbols") / words > 0.1),
        Rule("repeated_lines", F.col("n_dup_lines") / F.greatest("_n_lines", F.lit(1)) > 0.5),
        Rule("word_length", (F.col("n_words") > 0) & ~(F.col("word_chars") / words).between(2, 25)),
        Rule("capitals", cut(r"\p{Lu}+") / chars > 0.5),
        Rule("exclamations", F.regexp_count(text, F.lit("!")) / words > 0.5),
        Rule("letters", (F.col("n_words") > 0) & (cut(r"\p{L}+") / chars < 0.5)),
    ]


def ordered_rules(docs: DataFrame, rules: list[Rule], sample: int = SAMPLE) -> list[Rule]:
    """Rules by rejected share per second, highest first, as found on about ``sample`` documents.

    Documents are drawn before anything is counted in them. The order decides how soon a document is done with,
    never whether it is kept, so timings may vary.
    """
    rows = docs.count()
    if not rows:
        return rules
    some = stored(with_counts(docs.sample(fraction=min(1.0, sample / rows), seed=7)), "quality-sample")

    def run(fails: Column) -> tuple[int, float]:
        begin = time.perf_counter()
        got = some.agg(F.count_if(fails)).first()[0]
        return got, time.perf_counter() - begin

    run(F.lit(True))
    base = min(run(F.lit(True))[1] for _ in range(2))
    rank = []
    for at, rule in enumerate(rules):
        rejected, took = run(rule.fails)
        rank.append((-(rejected + 1) / max(took - base, 1e-3), at))
    return [rules[at] for _, at in sorted(rank)]


@clash_free()
def judged(docs: DataFrame, rules: list[Rule] | None = None, sample: int = SAMPLE) -> DataFrame:
    """All columns of ``docs``, the counts of ``with_counts``, ``base_failed`` and ``kept``.

    ``kept`` is one conditional chain: the base counts first, then the rules in their order, each only if all
    before it passed. Null text has no words and fails the base. Everything happens row by row, without a
    shuffle, so copies, hot sources and repeated ids don't matter; columns of ``docs`` with
    the names of results are replaced, all others come back whatever they are called.
    """
    rows = docs.drop(*RESULTS)
    counted = with_counts(rows)
    rules = default_rules() if rules is None else rules
    chain = F.when(base_failed(), False)
    sampled = ordered_rules(rows.select("text"), rules, sample) if len(rules) > 1 else rules
    for rule in sampled:
        chain = chain.when(rule.fails, False)
    out = counted.withColumn("base_failed", base_failed()).withColumn("kept", chain.otherwise(True))
    # a row of one struct: a filter on the results stays above and doesn't copy all that they are made of
    return out.select(*rows.columns, F.inline(F.array(F.struct(*RESULTS))))
