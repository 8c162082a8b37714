"""Document operators against brute force, on awkward rows and on an empty table."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from recogna.llm import language, line_dedup, near_copies, packing, pii, piece_lattice, quality, simhash, token_records
from recogna.llm.common import known_to_workers, scratch, stored
from recogna.llm.queries import tokenizer_path

WHITE = " \t\n\x0b\f\r"


def library(kind):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(tokenizer_path(kind))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_line_dedup(docs, rows, no_docs):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))

    found = Counter(k for r in rows for k in {key(x) for x in (r[1] or "").split("\n")})
    want = Counter()
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if not key(x) or found[key(x)] < 10]
        want[r[0], "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    out = line_dedup.drop_frequent_lines(docs)
    assert out.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()) == want
    assert sum(r[3] for r in want.elements()) == 24
    assert line_dedup.drop_frequent_lines(no_docs).count() == 0


def test_runs_are_merged(spark, docs):
    runs = line_dedup.LineRuns(spark, scratch(spark, "test-runs"), min_docs=2, fanout=2)
    for _ in range(5):
        runs.add(docs.select("text"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert runs.frequent().count() == runs.frequent().distinct().count() > 0


def test_simhash(docs, rows, no_docs):
    import xxhash

    def mark(text):
        words = (text or "").encode().lower().split()
        grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    marks = [mark(r[1]) for r in rows]
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(len(rows)):
                if (marks[a] ^ marks[b]).bit_count() <= 3 and root[b] < root[a]:
                    root[a], changed = root[b], True
    group = defaultdict(list)
    for r, x in zip(rows, root, strict=True):
        group[x].append(r[0])
    lowest = {x: min((i for i in ids if i is not None), default=None) for x, ids in group.items()}
    want = Counter((r[0], f"{m:016x}", lowest[x]) for r, m, x in zip(rows, marks, root, strict=True))
    assert Counter(map(tuple, simhash.near_duplicates(docs).collect())) == want
    assert simhash.near_duplicates(no_docs).count() == 0


def test_every_flip_of_up_to_three_bits_meets():
    rng = np.random.default_rng(3)
    for n in range(400):
        a = int(rng.integers(-(2**63), 2**63 - 1))
        flips = [int(b) for b in rng.choice(64, n % 6, replace=False)]
        b = a ^ simhash._flip(*flips) if flips else a
        sent = []
        for m in {a, b}:
            even = (m & (2**64 - 1)).bit_count() % 2 == 0
            sent += [((m ^ f) & 0xFFFFFFFF, m) for f in [0, *simhash.LOW_ONE, *(simhash.LOW_TWO if even else [])]]
        batch = pa.record_batch([pa.array([s[0] for s in sent]), pa.array([s[1] for s in sent])], ["route", "fingerprint"])
        links = [x for out in simhash.meetings([batch]) for x in zip(*out.to_pydict().values(), strict=True)]
        assert bool(links) == (1 <= len(flips) <= 3)


def test_packing(docs, rows, no_docs):
    encode = library("bytes")
    want = Counter()
    for r in rows:
        ids = np.array([*encode(r[1]), 2], "<u4")
        cuts = [0, *range((len(ids) - 1) % 1024 + 1, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[r[0], k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    got = packing.packed_documents(docs, tokenizer_path("bytes")).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    lengths = np.array([r.length for r in got])
    assert len(sequences) <= packing.lower_bound(lengths, 1024) + 1
    assert packing.packed_documents(no_docs, tokenizer_path("bytes")).count() == 0


def test_parts_exchange_what_their_open_bins_hold(spark):
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 1024, 4000)
    pieces = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "uid long, length long")
    used = [packing.pack(pieces, per_part=100, rounds=r).select("sequence_id").distinct().count() for r in (0, 4)]
    assert used[1] < used[0] and used[1] >= packing.lower_bound(lengths, 1024)
    out = packing.pack(pieces, per_part=100)
    assert out.count() == 4000 == out.select("uid").distinct().count()


def test_bounds_hold():
    assert packing.lower_bound(np.array([600, 600, 600]), 1024) == 3
    assert packing.lower_bound(np.array([400] * 6), 1024) == 3
    rng = np.random.default_rng(8)
    for _ in range(50):
        lengths = rng.integers(1, 1024, 40)
        assert packing.lower_bound(lengths, 1024) <= len(packing.best_fit(lengths, 1024)[2])


def test_records(spark, docs, rows, no_docs):
    encode = library("words")
    out = token_records.encoded_documents(docs, tokenizer_path("words"), width=4).orderBy("start").collect()
    ids = {id(r): np.array([*encode(r[1]), 2], "<u4") for r in rows}
    want = Counter((r[0], len(ids[id(r)]), zlib.crc32(ids[id(r)].tobytes())) for r in rows)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == want
    assert [r.doc_id for r in out] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    starts = np.cumsum([0, *(r.n_tokens for r in out)])
    assert [r.start for r in out] == starts[:-1].tolist()
    assert token_records.encoded_documents(no_docs, tokenizer_path("words")).count() == 0


def test_records_at_places_of_the_index(spark, docs, rows):
    folder = scratch(spark, "test-records")
    token_records.write_records(docs, tokenizer_path("words"), f"{folder}/data")
    index = token_records.write_index(spark, f"{folder}/data", f"{folder}/index")
    encode = library("words")
    got = token_records.fetch(spark, f"{folder}/data", index.where("doc_id % 3 = 1")).collect()
    want = Counter((r[0], (*encode(r[1]), 2)) for r in rows if r[0] is not None and r[0] % 3 == 1)
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want


def test_damaged_records_are_errors():
    good = bytearray(token_records.frame(7, np.arange(5), 2) + b"\n")
    doc_id, ids, after = token_records.unframe(memoryview(bytes(good)), 0)
    assert (doc_id, ids.tolist(), after) == (7, [0, 1, 2, 3, 4], len(good))
    for at in range(len(good) - 1):
        bad = good.copy()
        bad[at] ^= 1
        with pytest.raises(ValueError):
            token_records.unframe(memoryview(bytes(bad)), 0)


def test_pieces(docs, rows, no_docs):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = tokenizer_path("pieces")
    model, pieces = sentencepiece.SentencePieceProcessor(model_file=path), piece_lattice.Pieces.load(path)
    out = piece_lattice.decoded(piece_lattice.encoded(docs, pieces, most=300), pieces).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in out) == Counter((r[0], tuple(model.encode(r[1] or ""))) for r in rows)
    assert all(r.decoded == (r.text or "") for r in out)
    assert piece_lattice.encoded(no_docs, pieces).count() == 0


def test_encoding_and_decoding_in_one_pass(spark, docs, rows):
    pytest.importorskip("sentencepiece")
    pieces = piece_lattice.Pieces.load(tokenizer_path("pieces"))
    one = piece_lattice.round_trip(docs, pieces, most=300)
    two = piece_lattice.decoded(piece_lattice.encoded(docs, pieces, most=300), pieces)
    assert one.schema == two.schema and Counter(map(repr, one.collect())) == Counter(map(repr, two.collect()))
    assert one._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_viterbi_finds_the_best_path(spark):
    table = [("a", -1.0, 0), ("b", -1.5, 1), ("ab", -2.0, 2), ("abc", -5.0, 3), ("bc", -1.2, 4), ("cab", -2.2, 5)]
    words = ["abc", "abcab", "a", "xab", "cabcab"]
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    edges = piece_lattice.lattice(frame, spark.createDataFrame(table, "piece string, score double, id int"), 3)
    got = {r.word: [s.piece for s in r.path] for r in piece_lattice.best_paths(edges).collect()}
    score = {p: s for p, s, _ in table}

    def best(w):
        ways = [(0.0, [])] if not w else [(score.get(w[:n], -1e6) + s, [w[:n], *p]) for n in range(1, len(w) + 1) if w[:n] in score or n == 1 for s, p in [best(w[n:])]]
        return max(ways, key=lambda x: x[0])

    assert all(sum(score.get(p, -1e6) for p in got[w]) == pytest.approx(best(w)[0]) and "".join(got[w]) == w for w in words)


def test_quality(docs, rows, no_docs):
    out = quality.judged(docs)
    assert out.columns == [c for c in docs.columns if c != "kept"] + ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    want = Counter()
    for r in rows:
        text = r[1] or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        windows = Counter(zip(words, words[1:], words[2:], strict=False))
        again = {j + k for j in range(len(words) - 2) if windows[tuple(words[j : j + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if x.strip(WHITE)]
        failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
        want[r[0], len(words), sum(map(len, words)), sum(c in quality.SYMBOLS for c in text), len(lines) - len(set(lines)), len(again), failed] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out.collect()) == want
    assert quality.judged(no_docs).count() == 0


def test_order_of_rules_does_not_change_verdicts(docs):
    rules = quality.default_rules()
    one, two = (Counter((r.doc_id, r.kept) for r in quality.judged(docs, x).collect()) for x in (rules, rules[::-1]))
    assert one == two


def test_surrogates(docs, rows, no_docs):
    out = pii.replace_pii(docs, "k")
    assert out.columns == [c for c in docs.columns if c != "n_replaced"] + ["n_replaced"]
    got = {r.doc_id: r for r in out.collect()}
    assert all(got[r[0]].text == r[1] for r in rows if r[0] not in (50, 51))
    a, b = got[50].text, got[51].text
    mails = re.findall(r"[a-z.A-Z]+@[a-z.]+", a + " " + b)
    assert len(set(m.lower() for m in mails)) == 1 and mails[0].endswith(".com") and "lee" not in mails[0].lower()
    phones = re.findall(r"\+1[ 0-9()-]+[0-9]", a)
    assert len(phones) == 2 and len({re.sub(r"\D", "", p) for p in phones}) == 1 and re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", phones[0]) and "5551234" not in re.sub(r"\D", "", a)
    assert re.search(r"Mrs [A-Z][a-z]{2}a [A-Z][a-z]{4}a and Herr [A-Z][a-z]{2}o wrote", a) and "Anna" not in a and "10.20.30.40" not in a
    card = re.sub(" ", "", re.search(r"card ([0-9 ]{19}),", b)[1])
    assert card[0] == "4" and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(card))) % 10 == 0
    assert re.search(r"token [0-9a-f]{40},", b) and "0641917e" not in b and re.search(r"ssn \d{3}-\d{2}-\d{4}$", b)
    assert (got[50].n_replaced, got[51].n_replaced) == (7, 4)
    assert pii.replace_pii(no_docs, "k").count() == 0


def test_surrogates_stay_apart(spark):
    entities = spark.createDataFrame([("ssn", f"{i:03d}") for i in range(700)], "kind string, entity string")
    out = pii.assign(entities.where("entity < '400'"), "k").collect()
    assert len({r.surrogate for r in out}) == 400 and not {r.surrogate for r in out} & {f"{i:03d}" for i in range(400)}


def test_language(spark, docs, rows, no_docs):
    out = language.identified(docs).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    for r in out:
        assert 0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert (r.lang_pred == "und") == (r.doc_id in (23, 24, 25)) and r.lang_pred in ("en", "de", "und")
    assert language.identified(no_docs).count() == 0
    alone = language.predict(docs.select("doc_id", "text"), {})
    assert {(r.lang_pred, r.score) for r in alone.collect()} == {("und", 0.0)}


def test_profiles_are_sums_of_bound_letters():
    text = "Ab b"
    letters = [language.letter(ord(c)).astype(int) for c in " ab b "]
    want = sum(np.roll(x, 2) * np.roll(y, 1) * z for x, y, z in zip(letters, letters[1:], letters[2:], strict=False))
    assert np.allclose(language.bundles([text, "12"])[0], want / np.linalg.norm(want)) and not language.bundles(["12"]).any()


def test_stages_keep_columns(spark, docs, no_docs):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for start in (docs, no_docs):
        frame = start.select(columns)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stored(stage(spark, frame, ""), "test-stage")
            assert frame.columns == columns
        last = stored(corpus_pipeline.STAGES[-1][1](spark, frame, ""), "test-stage")
        assert {"doc_id", "sequence_id", "offset"} <= set(last.columns)
        assert last.select("doc_id").distinct().count() == frame.select("doc_id").distinct().count()


def test_text_hashes_in_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from recogna.llm.queries import ORACLES, QUERIES

    for name, sql in ORACLES.items():
        con = duckdb.connect()
        con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
        got = QUERIES[name](spark, "/root/testdata/sf0.001")
        want = con.execute(sql)
        names = [d[0] for d in want.description]
        assert sorted(names) == sorted(got.columns)
        assert Counter(map(tuple, got.select(names).collect())) == Counter(want.fetchall())
    assert hashlib.sha256(b"").hexdigest()


CLASHING = ["_id", "_MARK", "_lines", "_places", "_puts", "_row", "_words", "_n_lines", "_windows", "_placed", "found", "entity", "key", "a.b", "with blank"]


@pytest.mark.parametrize("operator", [line_dedup.drop_frequent_lines, lambda d: pii.replace_pii(d, "key"), quality.judged, near_copies.keep_one])
def test_clashing_columns_come_back(spark, docs, operator):
    known_to_workers(spark)
    small = docs.select("doc_id", "text", *[F.concat(F.lit(f"{c} "), F.coalesce(F.col("doc_id"), F.lit(-1))).alias(c) for c in CLASHING])
    out, plain = operator(small), operator(docs.select("doc_id", "text"))
    assert out.columns == small.columns + [c for c in plain.columns if c not in ("doc_id", "text")]
    got = out.collect()
    assert all(r[2 + k] == f"{c} {-1 if r.doc_id is None else r.doc_id}" for r in got for k, c in enumerate(CLASHING))
    rest = [0, 1, *range(2 + len(CLASHING), len(out.columns))]
    assert Counter(tuple(r[k] for k in rest) for r in got) == Counter(map(tuple, plain.collect()))


def test_stages_return_columns_called_like_results(spark, docs):
    known_to_workers(spark)
    names = ["n_words", "Kept", "base_failed", "n_lines", "n_dropped", "n_replaced", "_row", "_id"]
    small = docs.select("doc_id", "text", "n_chars", *[F.lit(f"own {c}").alias(c) for c in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, small, "")
        assert out.columns == small.columns
        got = out.collect()
        assert got and all(list(r[3:]) == [f"own {c}" for c in names] for r in got)


def test_an_id_wider_than_its_field_is_an_error():
    with pytest.raises(ValueError, match="70000"):
        token_records.frame(1, np.array([5, 70_000], np.uint32), 2)
    assert list(token_records.unframe(memoryview(token_records.frame(1, np.array([5, 70_000], np.uint32), 4)), 0)[1]) == [5, 70_000]
