"""Randomised checks of the scalar expressions against plain-Python models (one Spark job each)."""

import math
import random

import pytest

from varsift.functions import expressions as X

RND = random.Random(2024)


def _num_text(rnd):
    kind = rnd.random()
    if kind < 0.45:
        return str(rnd.randint(-3, 12))
    if kind < 0.8:
        return f"{rnd.choice(['', '-'])}{rnd.randint(0, 3)}.{rnd.randint(0, 99)}"
    return rnd.choice(["", ".", "x", "1e2", "1e-1", "5E-1", "0e0", " 2", "07", "-.5", "+0", "-", "3."])


def _int_part(text):
    """Integer reading of a text as the original's comparison with 0 does it (None: not an integer).

    Optional sign, digits, then an optional '.' followed only by digits; the fraction is dropped.
    """
    t = text.strip()
    if not t:
        return None
    sign = 1
    if t[0] in "+-":
        if len(t) == 1:
            return None
        sign, t = (-1 if t[0] == "-" else 1), t[1:]
    head, dot, frac = t.partition(".")
    if (head and not head.isdigit()) or (frac and not frac.isdigit()):
        return None
    return sign * int(head or "0")


def _float(text):
    try:
        return float(text)
    except ValueError:
        return None


def model_ratio(s):
    """The original: null when the total reads as integer 0, else a double division (null when a
    part is not a number or the total is 0.0)."""
    if s is None:
        return None
    parts = s.split("_")
    if len(parts) < 2 or _int_part(parts[1]) == 0:
        return None
    num, den = _float(parts[0]), _float(parts[1])
    if num is None or den is None or den == 0:
        return None
    return num / den


def test_damage_ratio_matches_model(spark, ansi):
    rows = [(f"{_num_text(RND)}_{_num_text(RND)}",) for _ in range(300)] + [(None,), ("5",)]
    df = spark.createDataFrame(rows, "d string")
    got = [r[0] for r in df.select(X.damage_ratio("d")).collect()]
    for (s,), g in zip(rows, got):
        m = model_ratio(s)
        if m is None:
            assert g is None, s
        else:
            assert g == pytest.approx(m), s


def model_first_gene(g):
    return None if g is None else g.split("|")[0].split(":")[0]


def test_first_gene_matches_model(spark, ansi):
    alphabet = ["A", "B", "1", ":", "|", "-"]
    rows = [("".join(RND.choice(alphabet) for _ in range(RND.randint(0, 8))),) for _ in range(300)] + [(None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "g string").select(X.first_gene("g")).collect()]
    assert got == [model_first_gene(g) for (g,) in rows]


def model_sort_key(c):
    if c is None:
        return None
    pad = "2" if c in ("X", "Y", "x", "y") else "0"
    return c[:2] if len(c) >= 2 else (pad * (2 - len(c)) + c)


def test_chromosome_sort_key_matches_model(spark, ansi):
    pool = [str(i) for i in range(1, 23)] + ["X", "Y", "x", "y", "M", "MT", "chr1", "", "Un"]
    rows = [(RND.choice(pool),) for _ in range(200)] + [(None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "c string").select(X.chromosome_sort_key("c")).collect()]
    assert got == [model_sort_key(c) for (c,) in rows]


def test_vaf_and_adjusted_calls_match_model(spark, ansi):
    rows = []
    for _ in range(300):
        ad = None if RND.random() < 0.05 else [RND.randint(0, 30) for _ in range(RND.choice([1, 2, 2, 2, 3]))]
        calls = RND.choice([[0, 0], [0, 1], [1, 1], [-1, -1]])
        rows.append((ad, calls))
    df = spark.createDataFrame(rows, "ad array<int>, calls array<int>")
    vaf = X.allele_fraction("ad")
    out = df.select(vaf.alias("vaf"), X.adjusted_calls(vaf, "calls", 0.2).alias("adj")).collect()
    for (ad, calls), r in zip(rows, out):
        want = None if ad is None or len(ad) < 2 or ad[0] + ad[1] == 0 else ad[1] / (ad[0] + ad[1])
        assert (r.vaf is None and want is None) or math.isclose(r.vaf, want)
        assert r.adj == ([0, 0] if want is not None and want < 0.2 else calls)
