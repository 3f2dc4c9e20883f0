"""Token counts, phrase mining and the filter audit against plain versions."""

import itertools
import random
import re
from collections import Counter

import brute as B
import pytest
from llm_fixtures import AWKWARD, awkward, documents, nothing  # noqa: F401

from varsift.llm import bpe_automaton, filter_audit, phrase_mining, token_counts
from varsift.llm.queries import tokenizer_file

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe_automaton.Vocabulary.read(tokenizer_file())


@pytest.fixture(scope="module")
def reference():
    t = tokenizers.Tokenizer.from_file(tokenizer_file())
    t.no_truncation()
    t.no_padding()
    return t


# -- token counts --------------------------------------------------------------------------------


def _tokens(reference, text):
    n = len(reference.encode(text or "", add_special_tokens=False).ids)
    return len((text or "").encode()), n, n > 2048


def test_counts_equal_the_library(documents, vocabulary, reference):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.contract(documents, vocabulary).collect()}
    assert got == {r.doc_id: _tokens(reference, r.text) for r in documents.collect()}


def test_counts_of_awkward_rows(awkward, nothing, vocabulary, reference):
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.contract(awkward, vocabulary).collect()), key=repr)
    assert got == sorted(((d, *_tokens(reference, t)) for d, t in AWKWARD), key=repr)
    assert token_counts.contract(nothing, vocabulary).collect() == []


def test_proven_strings_are_one_token_and_no_other_is(vocabulary, reference):
    proven = token_counts.whole_strings(vocabulary)
    assert len(proven) == len(set(proven)) > 30_000
    counts = token_counts.Counts(vocabulary, proven)
    rng = random.Random(8)
    for word in rng.sample(proven, 2000):
        if bpe_automaton.words_of(word) == [word]:
            assert len(reference.encode(word, add_special_tokens=False).ids) == 1
    merges = token_counts.Merges(vocabulary)
    known = set(proven)
    for _ in range(3000):
        word = "".join(rng.choice("aeiouthnsrl") for _ in range(rng.randint(1, 7)))
        n = len(merges.tokens(word.encode()))
        assert (n == 1) == (word in known) and counts[word] == n


def test_counts_of_random_text_and_a_full_memory(vocabulary, reference, monkeypatch):
    monkeypatch.setattr(token_counts, "KNOWN_WORDS", 20)
    counts = token_counts.Counts(vocabulary, token_counts.whole_strings(vocabulary))
    rng = random.Random(4)
    cases = ["<|endoftext|>", "a<|startoftext|>B ΣΑΣ", "<|ENDOFTEXT|>", "it's I'LL don't''ve", "é ﬁ ½", "a" * 20000]
    cases += ["".join(rng.choice("abcdeaaaothein  'st.ré#1A") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    for text in cases:
        assert counts.text(text)[0] == len(reference.encode(text, add_special_tokens=False).ids), text[:60]
    assert len(counts) <= counts.proven + 20


# -- phrases -------------------------------------------------------------------------------------


def _phrases(rows, least, top=2000):
    """The plain version: all counts, then scores, then tops."""
    count, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", B.lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    count[lang, tuple(words[i:i + k])] += 1
    often = {p: n for p, n in count.items() if n >= least}
    covered = {}
    for (lang, p), n in often.items():
        for k in range(1, len(p)):
            for i in range(len(p) - k + 1):
                key = (lang, p[i:i + k])
                covered[key] = max(n, covered.get(key, 0))
    found = {}
    for (lang, p), a in often.items():
        if len(p) > 1 and covered.get((lang, p), 0) < a:
            score, k = min((1000 * a * total[lang] // (often[lang, p[:k]] * often[lang, p[k:]]), k) for k in range(1, len(p)))
            found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), often[lang, p[:k]], often[lang, p[k:]]))
    return sorted((lang, k, p.decode(), -a, left, right, total[lang], -score) for lang, own in found.items()
                  for k, (score, a, p, left, right) in enumerate(sorted(own)[:top], 1))


def _made(spark, seed, n=160):
    rng = random.Random(seed)
    stock = [" ".join(rng.choice("ab cd ef gh ij été KL mn".split()) for _ in range(rng.randint(2, 7))) for _ in range(12)]
    rows = [(rng.choice(["en", "de", None, ""]),
             rng.choice(["  ", ". ", ",", "\t"]).join(rng.choice(stock) for _ in range(rng.randint(0, 9)))) for _ in range(n)]
    return rows + [(None, None), ("en", "...")], spark.createDataFrame(rows + [(None, None), ("en", "...")], "lang string, text string")


@pytest.mark.parametrize("seed, least, shards, slots", [(1, 4, 4, 1 << 22), (2, 9, 3, 1 << 22), (3, 6, 2, 8)])
def test_phrases_equal_brute_force(spark, seed, least, shards, slots):
    """Also with a table of 8 slots, in which nearly every phrase begins too early."""
    rows, docs = _made(spark, seed)
    found = phrase_mining.frequent_phrases(docs.repartition(3), least, shards, slots)
    got = sorted(tuple(r) for r in phrase_mining.collocations(found, least, 25).collect())
    want = _phrases(rows, least, 25)
    assert got == want and any(len(r[2].split(" ")) > 2 for r in want)


def test_no_phrase_is_missed_when_the_words_of_a_shard_come_late(spark):
    """A phrase whose words reach the threshold only with the last shard is counted by the next cycles."""
    rows = [("en", "a b c d e")] * 5 + [("en", "x y")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = {r.phrase: r.n for r in phrase_mining.frequent_phrases(docs, 5, 4).where("size > 0").collect()}
    assert got == {" ".join("abcde"[i:i + k]): 5 for k in range(1, 6) for i in range(6 - k)}


def test_phrases_of_awkward_rows(spark, awkward, nothing):
    rows = [("und", t) for _, t in AWKWARD]
    got = sorted(tuple(r) for r in phrase_mining.contract(awkward).collect())
    assert got == _phrases(rows, 100) and got
    assert phrase_mining.contract(nothing).collect() == []


def test_scores_beyond_64_bits(spark):
    big = 10**13
    found = spark.createDataFrame([("en", "", 0, big), ("en", "a", 1, 3), ("en", "b", 1, 7), ("en", "a b", 2, 3)],
                                  "lang string, phrase string, size int, n long")
    assert [r.score for r in phrase_mining.collocations(found, 1).collect()] == [1000 * 3 * big // 21]
    found = spark.createDataFrame([("en", "", 0, big), ("en", "a", 1, big - 1), ("en", "b", 1, big - 2), ("en", "a b", 2, big // 3)],
                                  "lang string, phrase string, size int, n long")
    assert [r.score for r in phrase_mining.collocations(found, 1).collect()] == [1000 * (big // 3) * big // ((big - 1) * (big - 2))]


# -- filter audit --------------------------------------------------------------------------------


def _mask(text):
    words = re.findall(B.NON_SPACE, text)
    upper = sum("A" <= c <= "Z" for c in text)
    return ((len(words) < 100) + 2 * (100 * len(set(words)) < 80 * len(words)) + 4 * (100 * upper > 10 * len(text))
            + 8 * bool(re.search(r"[#$%&*|]", text)))


def _audit(rows, labels):
    """rows: (doc_id, text, lang); the plain version walks every order over every document."""
    good, toxic = ({d for d, *own in labels if d is not None and own[k] == 1} for k in (0, 1))
    seen = {}
    for d, t, _ in rows:
        if d is not None:
            seen[t or ""] = min(d, seen.get(t or "", d))
    parts = {}
    for d, t, lang in rows:
        fails = _mask(t or "") + 16 * (d is not None and seen[t or ""] < d)
        parts.setdefault(lang or "", []).append((fails, d in good, d in toxic))
    out = []
    for part, docs in parts.items():
        own, share = [], Counter()
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, name in enumerate(order, 1):
                bit = 1 << "ABCDE".index(name)
                gone = [d for d in left if d[0] & bit]
                left = [d for d in left if not d[0] & bit]
                share[name] += len(gone)
                own.append((part, "".join(order), step, len(left), len(gone), sum(bool(d[0] & bit) for d in docs) - len(gone),
                            sum(d[0] == bit for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)))
        out += [(*r, share[r[1][r[2] - 1]]) for r in own]
    return sorted(out)


def test_audit_equals_brute_force(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("aa bb CC dd# ee ff gg".split()) + str(rng.randint(0, k)) for _ in range(n))
             for n in (3, 99, 100, 130) for k in (1, 40, 4000)] + ["", None, "X", "#", "x y " * 60]
    rows = [(rng.randint(1, 150) if rng.random() < 0.95 else None, rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(300)]
    labels = [(rng.randint(1, 150), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(120)] + [(None, 1, 1)]
    docs = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], "doc_id long, text string, lang string, mask string, good long, n long")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = sorted(tuple(r) for r in filter_audit.contract(docs, marks).collect())
    assert got == _audit(rows, labels) and len(got) == 3 * 600


def test_audit_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = sorted(tuple(r) for r in filter_audit.contract(awkward, labels).collect())
    assert got == _audit([(d, t, None) for d, t in AWKWARD], [])
    assert filter_audit.contract(nothing, labels).collect() == []


def test_swaps_lead_through_all_orders_and_keep_the_function():
    rng = random.Random(2)
    weights = {m: (rng.randint(0, 9), rng.randint(0, 3), rng.randint(0, 2)) for m in range(32)}
    diagram = filter_audit.Diagram(weights)
    orders = {diagram.order}
    for place in filter_audit.plain_changes(5):
        diagram.swap(place)
        orders.add(diagram.order)
        fresh = filter_audit.Diagram({sum(1 << k for k, f in enumerate(diagram.order) if m >> "ABCDE".index(f) & 1): w
                                      for m, w in weights.items()}, diagram.order)
        assert list(diagram.steps()) == list(fresh.steps())
    assert len(orders) == 120
    assert len(filter_audit.Diagram({0: (1, 0, 0), 31: (1, 0, 0)}).nodes) < 32  # equal subdiagrams are one


def test_shuffles_of_a_written_step_are_dropped(spark, tmp_path):
    from varsift.llm.storage import shuffles_dropped

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)

    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {x for x in files.mkString("\n").split("\n") if x.endswith(".data") and "shuffle_" in x}

    old = shuffles()
    with shuffles_dropped(spark):
        spark.range(1000).selectExpr("id % 100 AS k").groupBy("k").count().write.parquet(str(tmp_path / "step"))
    assert not shuffles() - old
    assert spark.read.parquet(str(tmp_path / "step")).count() == 100
    assert spark.conf.get(name, None) == before
