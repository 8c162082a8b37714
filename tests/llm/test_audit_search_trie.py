"""The source audit, the exact search and the conversation trie against brute force, on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from recogna.llm import conversation_trie, source_audit, topk_search
from recogna.llm.common import known_to_workers
from recogna.llm.radix_tree import Direct, Indexed, RadixTree, Sorted

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit_of(rows, min_docs, top):
    docs = [(lang or "", source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        seen: dict[str, int] = {}
        for _, _, terms in mine:
            for t in set(terms):
                seen[t] = seen.get(t, 0) + 1
        kept = [t for t, n in seen.items() if n >= min_docs]
        sources = {d[1] for d in mine}

        def shares(docs, kept=kept):
            counts = dict.fromkeys(kept, 0)
            for _, _, terms in docs:
                for t in terms:
                    if t in counts:
                        counts[t] += 1
            total = sum(counts.values()) + 5 * len(kept)
            return {t: (n, 1 + 10**9 * (n + 5) // total) for t, n in counts.items()}

        of = {s: shares([d for d in mine if d[1] == s]) for s in sources}
        whole = shares(mine)
        for s in sources:
            pairs = [("pair", o, sum(abs(of[s][t][1] - of[o][t][1]) for t in kept)) for o in sources if o != s]
            terms = [("term", t, of[s][t][1] - whole[t][1]) for t in kept if of[s][t][0] and of[s][t][1] > whole[t][1]]
            for some, most in ((pairs, len(pairs)), (terms, top)):
                some.sort(key=lambda r: (-r[2], r[1].encode()))
                out += [(lang, s, *r, i + 1) for i, r in enumerate(some[:most])]
    return sorted(out)


def audit_rows():
    rng = random.Random(7)
    words = "the The THE, the-cat cat's élan Élan naïve x.y.x one two three ﬁn 日本 a1b & ...  nb \x1cfs".split(" ")
    rows = [(rng.choice((" ", "\n", "\t ")).join(rng.choice(words) for _ in range(rng.randrange(30))), rng.choice(("en", "de", None)), rng.choice(("a", "b", "B", None))) for _ in range(150)]
    rows += [rows[3]] * 5 + [(None, "en", "a"), ("", "en", "z"), (None, None, None), ("12 34 ...", "fr", "q"), ("word", "fr", "r"), ("the " * 30_000, "en", "a"), ("x" * 60_000 + ",the" * 9_000, "en", "a")]
    # terms whose documents only just reach the limit through several chunks of one document, or just don't
    rows += [(f"edge{k} edge{k}, (edge{k})", "en", "a") for k in range(3) for _ in range(3 + k)]
    return rows


def test_audit_is_the_plain_one(spark):
    known_to_workers(spark)
    rows = audit_rows()
    docs = spark.createDataFrame([(*r, 1, "t") for r in rows], "text string, lang string, source string, docs int, term string").repartition(5)
    got = source_audit.audited(docs, min_docs=4, top_terms=6)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == audit_of(rows, 4, 6)


def test_bounds_leave_terms_open_and_counting_decides(spark):
    rows = source_audit._rows(spark.createDataFrame([("a a, (a)", "en", "s")] * 3 + [("a", "en", "t"), ("b", "en", "s")], "text string, lang string, source string"))
    bounds = {r["term"]: (r["times"], r["least"], r["most"]) for r in source_audit.term_counts(rows).groupBy("term").agg({"times": "sum", "least": "sum", "most": "sum"}).toDF("term", "times", "most", "least").select("term", "times", "least", "most").collect()}
    assert bounds["b"][1:] in ((1, 1),)
    assert min(bounds["a"][1:]) == 4 and max(bounds["a"][1:]) == 10
    wanted = spark.createDataFrame([("en", "a"), ("en", "c")], "lang string, term string")
    assert [tuple(r) for r in source_audit.exact_docs(rows, wanted).select("lang", "term", "docs").collect()] == [("en", "a", 4)]


def test_audit_of_nothing(spark):
    schema = "text string, lang string, source string"
    assert source_audit.audited(spark.createDataFrame([], schema)).collect() == []
    got = source_audit.audited(spark.createDataFrame([(None, "en", "a"), ("", "en", "b")], schema))
    assert sorted(tuple(r) for r in got.collect()) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def search_of(rows, k, step):
    vectors = [(i, v, [math.floor(256 * x) for x in e]) for i, (v, e) in enumerate(rows) if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, q, a in vectors:
        if q is None or q % step:
            continue
        scores = []
        for j, c, b in vectors:
            if i != j and len(a) == len(b):
                s = min(max(sum(x * y for x, y in zip(a, b, strict=True)), -(2**63)), 2**63 - 1)
                scores.append((-s, c is None, c or 0, j))
        scores.sort()
        out += [(q, r + 1, None if none else c, -s) for r, (s, none, c, _) in enumerate(scores[:k])]
    return sorted(out, key=repr)


def vector_rows():
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(120)]
    rows += [(200 + i, rows[1][1]) for i in range(40)] + [rows[50], (50, rows[7][1]), (None, rows[50][1]), (None, rows[3][1]), (-100, rows[9][1])]
    rows += [(300, None), (301, [None] * 6), (302, [1.0, 2.0, float("nan"), 0.0, 0.0, 0.0]), (350, [float("inf")] * 6), (400, [0.0] * 6), (450, [-0.0] * 6)]
    rows += [(500, [1.0, 2.0]), (501, [3.0, 4.0]), (550, []), (551, []), (600, [1.5] * 9)]
    return rows


SEARCH = "vec_id long, embedding array<float>, label int, rank string, row int"


@pytest.mark.parametrize("tile", [topk_search.TILE_VALUES, 100])
def test_search_is_the_plain_one(spark, monkeypatch, tile):
    known_to_workers(spark)
    monkeypatch.setattr(topk_search, "TILE_VALUES", tile)
    rows = vector_rows()
    got = topk_search.top_k(spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SEARCH).repartition(4)).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted((tuple(r) for r in got), key=repr) == search_of(rows, 5, 50)


def test_search_beyond_exact_doubles(spark):
    rows = [(i, [x * 10.0**e, 1.0]) for i, (x, e) in enumerate([(1, 30), (-3, 30), (7, 12), (7.0625, 12), (2, 8), (-2, 8)])]
    got = topk_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=3, step=2).collect()
    assert sorted((tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in got), key=repr) == search_of(rows, 3, 2)


def test_search_of_nothing(spark):
    assert topk_search.top_k(spark.createDataFrame([], SEARCH)).collect() == []
    assert topk_search.top_k(spark.createDataFrame([(50, [1.0], 0, "", 0)], SEARCH)).collect() == []


def trie_of(rows, share=100, most=5):
    own: dict[int, list] = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [s[2:] for s in sorted(v)] for c, v in own.items()}
    full = {}
    for c, s in turns.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        full[c] = tuple(turns.get(c - int(math.fmod(c, share)), [])[:h] + s[h:])
    nodes: dict[tuple, list[int]] = {}
    for c, s in full.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    children: dict[tuple, list] = {}
    for s in nodes:
        if s:
            children.setdefault(s[:-1], []).append(s)
    leaves, saved, out = {}, {}, []
    for s in sorted(nodes, key=len, reverse=True):
        below = children.get(s, [])
        leaves[s] = sum(leaves[k] for k in below) or 1
        saved[s] = (len(nodes[s]) - 1) * (len(s[-1][1]) if s else 0) + sum(saved[k] for k in below)
        ends = ",".join(map(str, sorted(c for c in nodes[s] if len(full[c]) == len(s))))
        out.append((min(nodes[s]), len(s), min(nodes[s[:-1]]) if s else None, len(nodes[s]), len(below), leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def turn_rows():
    rng = random.Random(11)
    rows = []
    for c in [*range(160), 230, 260, -150, -100, -90]:
        said = ["hello", "hello there", "", "Grüße ½ 日本", None]
        rows += [(c, t, rng.choice(("user", "assistant", None)) if rng.random() < 0.2 else ("user", "assistant")[t % 2], rng.choice(said)) for t in range(rng.randrange(1, 9))]
    rows += [(300, t, "user", f"turn {t // 3}") for t in range(1200)] + [(c, t, "user", f"turn {t // 3}") for c in (400, 500) for t in range(1190)]
    rows += [(c, t, "user", "copy") for c in range(1000, 1060) for t in range(7)]
    rows += [(7, None, "user", "before"), (7, 0, "user", "hello"), (7, 0, "user", "hello"), (8, 3, "a", "tie"), (8, 3, "a", "tie b"), (8, 3, None, "tie"), (None, 0, "user", "nobody's"), (None, None, None, None), (9, None, None, None)]
    rows += [(600, 0, "user", "x" * 50_000), (700, 0, "us", "er x"), (800, 0, "user", " x")]
    return rows


TURNS = "conv_id long, turn long, role string, text string, key string, depth int"


@pytest.mark.parametrize("tree", [conversation_trie.TREE_TURNS, 40])
def test_trie_is_the_plain_one(spark, monkeypatch, tree):
    known_to_workers(spark)
    monkeypatch.setattr(conversation_trie, "TREE_TURNS", tree)
    rows = turn_rows()
    got = conversation_trie.prefix_trie(spark.createDataFrame([(*r, "k", 1) for r in rows], TURNS).repartition(4))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == trie_of(rows)


def test_trie_of_nothing(spark):
    assert conversation_trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []
    assert conversation_trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x", "", 0)], TURNS)).collect() == []


def test_radix_tree_resizes_and_keeps_keys():
    rng = random.Random(5)
    keys = {bytes(rng.randrange(256) for _ in range(rng.choice((0, 1, 2, 2, 3, 8)))) for _ in range(4000)} | {b"abcdefgh", b"abcdefghi", b"abcd"}
    tree = RadixTree()
    for k in rng.sample(sorted(keys), len(keys)):
        tree.insert(k, k)
    found, kinds, todo = [], set(), [(tree.root, b"")]
    while todo:
        node, before = todo.pop()
        key = before + node.path
        assert node.value in (None, key)
        found += [key] * (node.value is not None)
        below = node.ordered()
        kinds.add((type(node.layout), getattr(node.layout, "most", None)))
        assert [c.path[0] for c in below] == sorted({c.path[0] for c in below})
        assert node is tree.root or node.value is not None or len(below) > 1  # paths are compressed
        todo += [(c, key) for c in reversed(below)]
    assert found == sorted(keys)
    assert kinds == {(type(None), None), (Sorted, 4), (Sorted, 16), (Indexed, None), (Direct, None)}
