"""URL and vector operators against brute force."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np

from recogna.llm import url_filter, vector_dedup
from recogna.llm.queries import URL_RULES

PAGES = "page_id long, url string, verdict string"


def test_urls(spark):
    urls = [None, "", "no scheme", "http://Example.COM/en/1", "https://www.example.com/en/2?x=1", "http://a.net/es/", "http://net/fr/x#y", "http://b.org/fr/", "http://badnet/es/", "x://y.com", "x://Y.com/?a://b/c"]
    urls += [f"https://h{i % 7}.example.{'com' if i % 2 else 'net'}/{('en', 'es', 'de')[i % 3]}/{i}" for i in range(120)] + ["http://long.net/es/" + "a" * 30_000]
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)], PAGES)
    out = url_filter.judged(pages, URL_RULES).collect()
    assert len(out) == len(urls)
    for r in out:
        url = r.url or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, path = rest[:end].lower(), rest[end:]
        path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
        fits = [x for x in URL_RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        rule = max(fits, key=lambda x: len(x.text), default=None)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text)
        assert r.verdict == rule.verdict if rule else r.verdict in ("allow", "block")
    assert len({r.verdict for r in out if r.url == urls[8]}) == 1
    none = url_filter.judged(spark.createDataFrame([], PAGES), URL_RULES)
    assert none.count() == 0 and none.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    only = url_filter.judged(pages, URL_RULES[:1]).collect()
    assert {r.verdict for r in only} == {"allow"}


def test_url_features(spark):
    page = spark.createDataFrame([("http://a.b.net/x/y1?p=1&q=2", "a.b.net", "/x/y1")], "url string, host string, path string")
    r = url_filter.with_features(page).first()
    url = r.url
    entropy = -sum(n / len(url) * math.log2(n / len(url)) for n in Counter(url).values())
    assert (r.depth, r.host_labels, r.parameters, r["last"], r.last_two) == (2, 3, 2, "net", "b.net") and abs(r.entropy - entropy) < 1e-9


def test_repeated_urls_and_small_samples(spark):
    """Two labelled URLs with many copies, and samples smaller than the labels: every page gets a verdict."""
    urls = ["https://a.com/x"] * 60 + ["https://b.net/es/1"] * 60 + ["https://c.org/1", "https://d.net/de/7", None]
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], PAGES)
    for most in (1, 5, 1000):
        out = url_filter.judged(pages, URL_RULES, most).collect()
        assert len(out) == len(urls) and {r.verdict for r in out} <= {"allow", "block"}
        assert all(r.verdict == ("allow" if r.url == urls[0] else "block") for r in out if r.rule)


def test_rates_count_all_labelled_pages(spark):
    urls = ["https://a.com/x"] * 5 + ["https://b.net/es/1"] * 3 + [f"https://h{i}.net/fr/{i}" for i in range(40)] + ["https://n.net/x"]
    parsed = spark.createDataFrame([(u,) for u in urls], "url string")
    parsed = parsed.withColumns({"host": url_filter.host_of(parsed.url), "path": url_filter.path_of(parsed.url)})
    parsed = parsed.withColumns({k: url_filter.matched(parsed.host, parsed.path, URL_RULES, v) for k, v in (("rule", "text"), ("_ruled", "verdict"))})
    labelled = url_filter.labelled_urls(parsed)
    rates = {tuple(r) for r in url_filter.suffix_rates(url_filter.with_features(labelled), "last").collect()}
    assert rates == {("com", 1 / 7), ("net", 44 / 45)}
    sample = url_filter.training_sample(labelled, {0.0: 5, 1.0: 43}, 8).collect()
    assert sorted(r.label for r in sample) == [0.0, 1.0, 1.0, 1.0, 1.0]
    assert abs(sum(r.weight for r in sample) - 5) < 1e-9 and abs(sum(r.weight for r in sample if not r.label) - 5 * 5 / 48) < 1e-9


def test_learned_verdicts_follow_the_labels(spark):
    """Pages that no rule decides are judged like labelled ones of their host's ending."""
    urls = [f"https://s{i}.{'example.com' if i % 2 else 'site.net'}/{('en', 'es', 'fr')[i % 3]}/{i}" for i in range(300)]
    out = url_filter.judged(spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], PAGES), URL_RULES).collect()
    free = [r for r in out if r.rule is None]
    assert len(free) == 50 and all(r.host.endswith(".net") and r.verdict == "block" for r in free)


def test_clashing_page_columns_come_back(spark):
    names = [*url_filter.FEATURES, "last", "Features", "prediction", "probability", "label", "weight", "copies", "_ruled", "_key_hash", "a.b"]
    rows = [(u, *[f"{k}{i}" for k in range(len(names))]) for i, u in enumerate(["https://a.com/x", "https://b.net/es/1", "https://c.org/1"])]
    pages = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in ["url", *names]))
    out = url_filter.judged(pages, URL_RULES)
    assert out.columns == ["url", *names, *url_filter.RESULTS]
    assert {tuple(r)[: len(rows[0])] for r in out.collect()} == set(rows)


def test_vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 32))
    vectors = [(c + rng.normal(scale=s, size=32)).tolist() for c in centres for s in (0.02, 0.05, 0.1, 0.14, 0.17)]
    vectors += [vectors[0]] * 4 + [[2 * x for x in vectors[5]], None, [0.0] * 32, [float("nan"), *[1.0] * 31], [None, *[1.0] * 31], [float("inf"), *[1.0] * 31], [1.0, 2.0], [2.0, 4.0], []]
    rows = [(i, v, (i // 5) % 3) for i, v in enumerate(vectors)] + [(900, vectors[1], None), (None, vectors[1], 0), (7, vectors[7], 1)]
    schema = "vec_id long, embedding array<double>, label int"
    frame = spark.createDataFrame(rows, schema).repartition(3)

    def fit(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    links = [[] for _ in rows]
    for a in range(n):
        for b in range(n):
            x, y = rows[a], rows[b]
            if a != b and x[2] is not None and x[2] == y[2] and fit(x[1]) and fit(y[1]) and len(x[1]) == len(y[1]):
                p, q = np.array(x[1]), np.array(y[1])
                if p @ q / np.linalg.norm(p) / np.linalg.norm(q) >= 0.98:
                    links[a].append(b)
    root = list(range(n))
    for _ in range(n):
        root = [min([root[a], *(root[b] for b in links[a])]) for a in range(n)]
    lowest = {r: min((rows[a][0] for a in range(n) if root[a] == r and rows[a][0] is not None), default=None) for r in set(root)}
    want = Counter((rows[a][0], len(links[a]), lowest[root[a]], rows[a][0] is not None and rows[a][0] == lowest[root[a]]) for a in range(n))
    got = Counter(map(tuple, vector_dedup.near_vectors(frame).collect()))
    found, all_links = sum(k[1] * v for k, v in got.items()), sum(map(len, links))
    assert found >= 0.97 * all_links > 0 and found <= all_links
    if found == all_links:
        assert got == want
    assert vector_dedup.near_vectors(spark.createDataFrame([], schema)).count() == 0


def test_recall_of_the_tables(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = vector_dedup.near_vectors(rows).agg({"n_links": "sum"}).first()[0]
    frame = rows.toPandas()
    x = np.stack(frame["embedding"]).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = frame["label"].to_numpy()
    want = sum(int((x[label == k] @ x[label == k].T >= 0.98).sum() - (label == k).sum()) for k in set(label))
    assert 0.9 * want <= got <= want


def test_negative_zero_components_keep_their_result(spark):
    x = [1.0, -0.0, 0.5, 0.25]
    rows = [(1, x, "a"), (2, [1.0, 0.0, 0.5, 0.25], "a"), (3, [1.0, 0.0, 0.5, 0.2501], "a"), (4, [-0.0, 1.0, 0.0, 0.0], "a")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {tuple(r) for r in vector_dedup.near_vectors(frame).collect()}
    assert got == {(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 0, 4, True)}


def test_exploded_keys_and_vectors_are_not_broadcast(spark, tmp_path):
    """Spark's estimate of exploded rows and of arrays is far too low, and small tables show it as well."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        spark.createDataFrame([(i, 1, 2, [i % 3, 7, i, 9, 11]) for i in range(20)], "rep long, label int, size int, keys array<long>").write.parquet(f"{tmp_path}/coded")
        spark.createDataFrame([(i, [1.0, float(i % 4)]) for i in range(20)], "rep long, embedding array<double>").write.parquet(f"{tmp_path}/vectors")
        coded, vectors = (spark.read.parquet(f"{tmp_path}/{x}") for x in ("coded", "vectors"))
        pairs = vector_dedup.candidates(coded)
        for frame in (pairs, vector_dedup.linked(pairs, vectors, 0.98)):
            assert frame.count() > 0
            assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
