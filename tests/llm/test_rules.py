import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import presslake.llm.rules as rules
from presslake.llm.queries import QUERIES
from presslake.llm.rules import RULES, binomial_tail, cutoffs, judge, measures

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = list(zip(w, w[1:], w[2:]))
    n = Counter(windows)
    covered = {k + j for k, g in enumerate(windows) if n[g] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:k] for k, x in enumerate(lines)), len(covered))


def failed_base(m):
    return m[0] < 50 or 100 * m[4] > 50 * m[0]


TEXTS = ["", None, "a", "a b", "a b c", "a b c a b c", "a a a a", "x a a a a y", "a b c d b c d e b c d", "l\nl\n\n \nl\n l\nl",
         "日本 😀 #|* <b>\x0bx\x0cy\r\nz", "\n".join(["same line here"] * 30), " ".join(f"w{i}" for i in range(60)), "\x85 \xa0x y"]


def test_measures_follow_the_definition(spark):
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string")
    for x in measures(docs).collect():
        m = brute(TEXTS[x.id])
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == m, TEXTS[x.id]
        assert x.base_failed == failed_base(m)


@pytest.mark.parametrize("n,k,p", [(1, 0, 0.5), (10, 0, 0.1), (10, 3, 0.1), (1000, 4, 0.005), (5000, 10, 0.005),
                                   (200_000, 900, 0.005), (20, 20, 0.3)])
def test_binomial_tail_is_exact(spark, n, k, p):
    got = spark.range(1).select(binomial_tail(F.lit(n).cast("long"), F.lit(k).cast("long"), p).alias("x")).first().x
    logs = [math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p)
            for j in range(k + 1)]
    assert got == pytest.approx(sum(map(math.exp, logs)), rel=1e-6)


def brute_cutoffs(rows, alpha, delta):
    """rows: (stratum, {rule: measure}) of good documents."""
    grid, out = [2 ** (-k / 4) for k in range(rules.STEPS)], {}
    strata = {s for s, _ in rows}
    share, level = alpha / len(RULES), delta / max(1, len(strata) * len(RULES))
    for s in strata:
        mine = [v for t, v in rows if t == s]
        for r in RULES:
            last = None
            for c in grid:
                k, n = sum(v[r] > c for v in mine), len(mine)
                if k >= share * n or sum(math.comb(n, j) * share ** j * (1 - share) ** (n - j) for j in range(k + 1)) > level:
                    break
                last = c
            if last is not None:
                out.setdefault(s, {})[r] = last
    return out


def sample(spark, n):
    """Good and bad documents of three strata; the third is too small to prove anything."""
    import random
    r, docs, labels = random.Random(1), [], []
    for i in range(n):
        stratum = ["en", "de", None][0 if i % 10 < 5 else 1 if i % 10 < 9 else 2]
        bad = i % 7 == 0
        words = [f"{r.choice('abcXYZ')}{r.randrange(500)}" + ("##" if bad and r.random() < 0.6 else "") for _ in range(60)]
        if r.random() < 0.01:
            words[0] = "###"
        docs.append((i, " ".join(words), stratum))
        labels.append((i, 0 if bad else 1))
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string"),
            spark.createDataFrame(labels, "doc_id long, quality int"), docs, dict(labels))


def test_cutoffs_and_verdicts_against_brute_force(spark):
    docs, labels, rows, good = sample(spark, 900)
    alpha, delta = 0.2, 0.05
    values = {}
    for i, t, s in rows:
        m, upper = brute(t), sum(c.isupper() for c in t)
        values[i] = s, {"symbols": m[2] / m[1], "upper": upper / m[1], "repeats": m[4] / m[0], "lines": 0.0}
    expected = brute_cutoffs([values[i] for i in values if good[i] == 1], alpha, delta)
    got = {x.stratum: {r: x[r] for r in RULES if x[r] is not None} for x in cutoffs(measures(docs), labels, alpha, delta).collect()}
    assert got == expected and "symbols" in got["en"]
    kept = {x.id: x.kept for x in judge(docs, labels, alpha, delta).collect()}
    for i, (s, v) in values.items():
        assert kept[i] == all(v[r] <= c for r, c in expected.get(s, {}).items())
    rejected = [i for i in kept if good[i] == 1 and not kept[i]]
    assert len(rejected) <= alpha * sum(good.values())
    assert sum(not kept[i] for i in kept if good[i] == 0) > 0.8 * sum(1 for i in kept if good[i] == 0)


def test_edge_rows(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (99, 1)], "doc_id long, quality int")
    out = judge(edge, labels).collect()
    assert len(out) == 11 and judge(empty, labels).count() == 0
    assert {x.kept for x in out} == {False}  # all are short or repeat themselves
    assert judge(edge, labels.limit(0)).count() == 11


def test_query_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {x.doc_id: x for x in QUERIES["op6_quality_rules"](spark, sf).collect()}
    assert len(got) == len(docs)
    for d in docs:
        x, m = got[d.doc_id], brute(d.text)
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == m
        assert x.base_failed == failed_base(m) and not (x.base_failed and x.kept)


def test_no_python_in_the_plan(spark, sf):
    plan = QUERIES["op6_quality_rules"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_small_strata_by_one_joint_path(spark, scratch):
    """Strata of some 300 good documents, too few for a test of each rule, and one of too few for any."""
    import random
    r, rows, labels = random.Random(3), [], []
    for i in range(1_600):
        stratum = None if i % 40 == 0 else ["en", "de"][i % 2]
        bad, labelled = i % 8 == 1 or i % 8 == 4, i % 2000 < 850
        words = [f"{r.choice('abcXYZ')}{r.randrange(900)}" + ("##" if bad and r.random() < 0.6 else "") for _ in range(60)]
        rows.append((i, " ".join(words), stratum, "s", 0))
        if labelled:
            labels.append((i, 0 if bad else 1, 0))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    got = {x.doc_id: x for x in QUERIES["op6_quality_rules"](spark, scratch).collect()}
    bad = {i for i, q, _ in labels if q == 0}
    stratum = {i: s for i, _, s, *_ in rows}
    for s in ("en", "de"):
        mine = [i for i, *_ in labels if stratum[i] == s]
        n, k = sum(i not in bad for i in mine), sum(i not in bad and not got[i].kept for i in mine)
        assert 234 <= n < 1_000  # three strata: log(0.05 / 3) / log(0.98) = 203
        assert sum(math.comb(n, j) * 0.02 ** j * 0.98 ** (n - j) for j in range(k + 1)) <= 0.05 / 3
        assert not any(got[i].kept for i in mine if i in bad)
        # unlabelled rows are judged by the same cutoffs
        rest = {q: [got[i].kept for i in stratum if stratum[i] == s and i >= 850 and (i % 8 in (1, 4)) == q] for q in (True, False)}
        assert sum(rest[True]) <= 0.05 * len(rest[True]) and sum(rest[False]) >= 0.95 * len(rest[False])
    assert all(x.kept for i, x in got.items() if stratum[i] is None)


def test_the_path_takes_every_step_once_and_bad_ones_first():
    zero, bad, other = ({r: [0] * (rules.STEPS + 1) for r in RULES} for _ in range(3))
    for r in RULES:
        other[r][20], other[r][41], bad[r][41] = 50, 950, 100
    bad["symbols"][10], bad["symbols"][41], bad["lines"][3], bad["lines"][41] = 100, 0, 1, 99
    for x in (bad, zero):
        moves = rules._path(x, other)
        assert sorted(moves) == sorted((r, k) for r in RULES for k in range(rules.STEPS))
        for r in RULES:
            assert [k for q, k in moves if q == r] == list(range(rules.STEPS))
    assert rules._path(bad, other)[:11] == [("symbols", k) for k in range(11)]


def test_joint_cutoffs_of_odd_labels(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (99, 1)], "doc_id long, quality int")
    assert judge(edge, labels, joint=True).count() == 11 and judge(empty, labels, joint=True).count() == 0
    assert judge(edge, labels.limit(0), joint=True).count() == 11
