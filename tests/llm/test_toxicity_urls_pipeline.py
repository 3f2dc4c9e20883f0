"""The network's gradients and held-out accuracy, url rules, and the pipeline."""

import re
import zlib

import corpus_pipeline
import numpy as np
import pytest
from llm_fixtures import AWKWARD, awkward, nothing  # noqa: F401
from pyspark.sql import functions as F

from varsift.llm import toxicity_gru, url_rules

SF = "/root/testdata/sf0.001"


def test_gradients_agree_with_differences():
    net = toxicity_gru.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    texts = [b"the cat sat on the mat tonight", b"one two"]
    data, at = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    words = toxicity_gru.Words(data, at)
    _, first, size = words.windows(2)
    target = np.array([1.0, 0.0])

    def loss():
        p = 1 / (1 + np.exp(-net.score(words, first, size)))
        return -np.mean(target * np.log(p) + (1 - target) * np.log(1 - p))

    for name, g in net.gradients(words, first, size, target, np.ones(2)).items():
        value, g = net.p[name], np.asarray(g).reshape(net.p[name].shape)
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        keep = value[at]
        value[at] = keep + 1e-3
        high = loss()
        value[at] = keep - 1e-3
        low = loss()
        value[at] = keep
        assert g[at] == pytest.approx((high - low) / 2e-3, rel=1e-2, abs=1e-6), name


def test_windows_cover_every_word():
    texts = [b"w " * n for n in (0, 1, 31, 32, 33, 56, 57, 200)]
    words = toxicity_gru.Words(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    row, first, size = words.windows(len(texts))
    covered = {int(k) for a, s in zip(first, size) for k in range(a, a + s)}
    assert covered == set(range(len(words.number)))
    assert set(row.tolist()) == set(range(1, len(texts)))
    whole = toxicity_gru.LENGTH - toxicity_gru.STEP + 1
    low = np.searchsorted(words.row, len(texts) - 1)  # the longest text: each passage lies whole in some window
    own = [(a, a + s) for a, s, r in zip(first, size, row) if r == len(texts) - 1]
    assert all(any(a <= k and k + whole <= b for a, b in own) for k in range(low, low + 200 - whole + 1))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity_gru.contract(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.95
    assert np.mean([r.predicted for r in held if r.toxic == 0]) < 0.03


def test_toxicity_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1), (5, 0), (8, 0), (None, 1), (1, 0)], "doc_id long, toxic int")
    got = toxicity_gru.contract(awkward, labels).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (2, 3, 4)} == {0.0}
    assert toxicity_gru.contract(nothing, labels).collect() == []
    assert {r.score for r in toxicity_gru.contract(awkward, labels.where("false")).collect()} == {0.0}


# -- urls --------------------------------------------------------------------------------------

URLS = ["https://Sub.Example.ORG/es/1?x", "http://example.org/en/12", "http://example.org/en/2", "http://org/x", "http://xorg/x",
        "http://a.org", "https://news.com/fr/a#b", "http://shop.com/de/", "http://shop.com/de", "http://shop.com?de=1", None,
        "no scheme", "x://://com/fr/", "http://COM/fr/\u00c9", "ftp://h#f", ""]


def plain_rule(url):
    at = (url or "").find("://")
    if at < 0:
        return "", "", None
    rest = url[at + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in url_rules.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return host, path, best


def test_fixed_rules_equal_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").unionByName(
        spark.createDataFrame([(10_000 + k, u) for k, u in enumerate(URLS)], "page_id long, url string"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    urls = {r.page_id: r.url for r in pages.collect()}
    for r in url_rules.judged(pages, labels).collect():
        host, path, best = plain_rule(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, best[0] if best else None)
        assert r.verdict == (best[1] if best else ("block" if r.mined else "allow"))


def test_mined_rules_follow_the_labels(spark):
    """A combination that is mostly bad blocks; its single tokens, mostly good, do not."""
    rows, marks = [], []
    for k in range(400):
        host, first = ("a.net", "b.net")[k % 2], ("x", "y")[k // 2 % 2]
        rows.append((k, f"https://{host}/{first}/{k}", "extra"))
        bad = (host, first) == ("a.net", "x") and k % 40 != 0
        marks.append((k, 0 if bad else 1, 0))
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    labels = spark.createDataFrame(marks + marks[:50], "doc_id long, quality int, toxic int")
    got = url_rules.judged(pages, labels).collect()
    assert {r.verdict for r in got if r.host == "a.net" and r.path.startswith("/x")} == {"block"}
    assert {r.verdict for r in got if not (r.host == "a.net" and r.path.startswith("/x"))} == {"allow"}
    assert len(got) == len(rows)
    assert {r.verdict for r in url_rules.judged(pages, labels.where("false")).collect()} == {"allow"}
    assert url_rules.judged(pages.where("false"), labels).collect() == []


@pytest.mark.parametrize("bad, good", [
    ("http://a.net/a/casino/{}", "http://a.net/a/b/{}"),
    ("http://a.net/x/y/casino", "http://a.net/x/y/{}"),
    ("http://a.net/casino", "http://a.net/{}"),
    ("http://a.net/{}?a&b&c&d&adult=1", "http://a.net/{}?a&b&c&d&e=1"),
    ("http://casino.b.c.d.net/{}", "http://b.c.d.net/{}"),
    ("http://a.net/{}.torrents", "http://a.net/{}.html"),
])
def test_rules_see_every_part_of_a_url(spark, bad, good):
    rows = [(k, (bad if k % 4 == 0 else good).format(k)) for k in range(1300)]  # a number occurs too rarely for a rule
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(1200)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in url_rules.judged(pages, labels).collect()}
    assert got == {k: "block" if k % 4 == 0 else "allow" for k, _ in rows}


def _urls(spark, urls, bad):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return pages, spark.createDataFrame([(k, int(not b), 0) for k, b in enumerate(bad)], "doc_id long, quality int, toxic int")


def test_few_pages_make_no_rule(spark):
    for n, blocked in ((url_rules.LEAST_PAGES - 1, 0), (url_rules.LEAST_PAGES, url_rules.LEAST_PAGES)):
        urls = ["http://a.net/casino/x"] * n + [f"http://b.net/{k}" for k in range(200)]
        pages, labels = _urls(spark, urls, [True] * n + [k % 10 == 0 for k in range(200)])
        assert sum(r.verdict == "block" for r in url_rules.judged(pages, labels).collect()) == blocked


def test_labels_without_a_pattern_make_no_rule(spark):
    rng = np.random.default_rng(4)
    urls = [f"http://{'abc'[k % 3]}.net/{'xyz'[k // 3 % 3]}/p?{'uvw'[k // 9 % 3]}=1" for k in range(900)]
    pages, labels = _urls(spark, urls, (rng.random(900) < 0.3).tolist())
    assert {r.verdict for r in url_rules.judged(pages, labels).collect()} == {"allow"}


def test_urls_with_very_many_keys_finish(spark):
    """Forty keys on one page, and the same forty on thirty bad pages: no page hangs the mining, none is cut."""
    keys = "&".join(f"k{k}=1" for k in range(40))
    urls = [f"http://odd.net/?{keys.replace('k', 'j')}"] + [f"http://b.net/?{keys}"] * 30 + [f"http://b.net/{k}" for k in range(100)]
    pages, labels = _urls(spark, urls, [True] * 31 + [False] * 100)
    more = spark.createDataFrame([(1000, "http://c.net/?k7=2"), (1001, "http://c.net/?k77=2")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_rules.judged(pages.union(more), labels).collect()}
    assert got == {k: "block" if 1 <= k <= 30 or k == 1000 else "allow" for k in got}


def test_mined_rules_equal_brute_force(spark):
    """All combinations of tokens, counted one by one."""
    from itertools import combinations

    rng = np.random.default_rng(9)
    urls = [f"http://{rng.choice(['a', 'b'])}.net/{rng.choice(['x', 'y', 'z'])}?{rng.choice(['u', 'v'])}=1" for _ in range(1200)]
    bad = [("a.net/x" in u or ("/y" in u and "?v" in u)) and rng.random() < 0.97 for u in urls]
    pages, labels = _urls(spark, urls, bad)
    rows = pages.select("page_id", "url", *[c.alias(n) for c, n in zip(url_rules.host_and_path(), ("host", "path"))]).select(
        "page_id", url_rules.url_tokens().alias("tokens"))
    rules, classes = url_rules.mined_rules(rows, labels)
    item = {r.token: r.item for r in classes.collect()}
    sets = [frozenset(item[t] for t in r.tokens if t in item) for r in rows.orderBy("page_id").collect()]
    z, found = url_rules.Z, {}
    for size in (1, 2, 3, 4):
        for tokens in combinations(sorted(set(item.values())), size):
            on = [b for s, b in zip(sets, bad) if s.issuperset(tokens)]
            if len(on) >= url_rules.LEAST_PAGES:
                n, p = len(on), sum(on) / len(on)
                low = (p + z * z / 2 / n - z * (p * (1 - p) / n + z * z / 4 / n / n) ** 0.5) / (1 + z * z / n)
                if low >= url_rules.CONFIDENCE:
                    found[tokens] = low
    want = {t for t, low in found.items() if not any(set(o) < set(t) and c >= low for o, c in found.items())}
    assert {tuple(r.tokens) for r in rules.collect()} == want and want


def test_url_rules_run_no_python(spark):
    plan = url_rules.judged(spark.read.parquet(f"{SF}/pages.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)


# -- pipeline ----------------------------------------------------------------------------------


def test_stages_take_effect(spark):
    """Each stage against its own operator, on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    start = docs.count()
    sizes = [start]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == docs.columns, name
            out = out.checkpoint()
        sizes.append(out.count())
        docs = out
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4] == sizes[5]
    run = corpus_pipeline.run(spark, SF)
    assert run.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert run.count() == sizes[5]


def test_clean_documents_pass_and_planted_ones_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    item = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").first().text
    base = docs.where("n_chars between 1000 and 3000").orderBy("doc_id").first().text
    own = " ".join(f"plain{k}words here{k}" for k in range(60))
    planted = spark.createDataFrame([(900_001, base), (900_002, own + " " + item + " " + own[::-1]), (900_003, own),
                                     (900_004, own[::-1] + " token=abcdef123456")], "doc_id long, text string")
    planted = planted.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    docs = docs.unionByName(planted)
    for _, stage in corpus_pipeline.STAGES[1:4]:
        docs = stage(spark, docs, "/root/testdata/sf0.01").checkpoint()
    kept = {r.doc_id: r.text for r in docs.where("doc_id > 900000").collect()}
    assert set(kept) == {900_003, 900_004}
    assert kept[900_004].endswith(" [secret]")


def test_pipeline_of_awkward_rows(spark, awkward, nothing):
    for rows in (awkward, nothing):
        docs = rows
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        docs.collect()


def test_stages_keep_columns_with_their_own_names(spark):
    """Values of neighbouring columns named as the stages' helpers are the same before and after."""
    from varsift.llm import jaccard_join, secret_ledger
    from varsift.llm.storage import shared_path

    names = ["_blob", "_spans", "_ID", "_h", "_g", "_key", "_text", "blob", "spans"]
    rows = [(k, f"text number {k} with password = hunter{k}22 inside it", *[f"{n}{k}" for n in names]) for k in range(8)]
    docs = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", *[f"`{n}` string" for n in names]]))
    kept = {r[0]: tuple(r) for r in jaccard_join.one_of_each(docs).collect()}
    assert kept == {r[0]: r for r in rows}
    masked = {r[0]: tuple(r) for r in secret_ledger.without_secrets(docs, shared_path(spark, "ledger")).collect()}
    assert {k: v[2:] for k, v in masked.items()} == {r[0]: r[2:] for r in rows}
    assert all("hunter" not in v[1] for v in masked.values())


def test_string_ids_and_repeated_ids_in_training(spark):
    bad, good = "you are a horrid stupid fool and liar", "the river runs along the old mill"
    rows = [(f"d{k}", (bad if k % 2 else good) + f" {k}") for k in range(60)] + [("d1", "another text of one id")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    labels = spark.createDataFrame([(f"d{k}", k % 2) for k in range(60)], "doc_id string, toxic int")

    def rows_of(frame):  # the last digits depend on which rows share a batch
        return {(r[0], r[1], round(r[2], 4), r[3]) for r in toxicity_gru.contract(frame, labels).collect()}

    first = rows_of(docs)
    assert len(first) == 61 and first == rows_of(docs.repartition(5))
    assert all(r[3] == (int(r[0][1:]) % 2) for r in first if r[1] and r[0] != "d1")
