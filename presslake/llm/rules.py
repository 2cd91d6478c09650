"""Quality rules whose cutoffs carry a proven limit on false rejections.

Built from DataFrame functions alone.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.functions.text import let
from presslake.llm.common import SPACE_RUN, SPACES, read, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
#: Share of a stratum's good documents that all rules together may reject, and the
#: chance that any stratum's limit is broken.
ALPHA = 0.02
DELTA = 0.05
#: Cutoffs of each rule from lenient to strict: 1, 0.84, 0.71, ... (a quarter power of two each).
STEPS = 41
#: Unlabelled documents that a stretch of cutoffs counts as rejecting besides those it does.
PRIOR = 5
STRATUM = "lang"


def _cutoffs() -> Column:
    return F.array(*[F.lit(2.0 ** (-k / 4)) for k in range(STEPS)])


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more: windows are sorted with
    their places, those equal to a neighbour kept, and the words they cover counted."""
    windows = F.when(F.size(words) < 3, F.array().cast("array<struct<g:string,i:int>>")).otherwise(
        F.transform(F.slice(words, 1, F.size(words) - 2), lambda w, i: F.struct(
            F.concat_ws(" ", w, F.get(words, i + 1), F.get(words, i + 2)).alias("g"), i.alias("i"))))

    def places(s: Column) -> Column:
        def repeated(x: Column, k: Column) -> Column:
            return F.when((x["g"] == F.get(s, k - 1)["g"]) | (x["g"] == F.get(s, k + 1)["g"]), x["i"])
        return F.sort_array(F.filter(F.transform(s, repeated), lambda i: i.isNotNull()))

    def covered(d: Column) -> Column:
        steps = F.transform(d, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(d, k + 1) - i, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)
    return let(let(F.sort_array(windows), places), covered)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = STRATUM) -> DataFrame:
    """``(id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, base_failed)``
    of every row; a NULL text is an empty one."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(stratum_col).cast("string").alias("stratum"), text.alias("text"))

    def of_words(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"), _repeat_words(words).alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        n = F.size(lines)
        return F.struct(n.cast("long").alias("n_lines"), (n - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))
    words = F.filter(F.split("text", SPACE_RUN), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: F.translate(x, SPACES, "") != "")
    rows = rows.select(
        "id", "stratum", let(words, of_words).alias("w"), let(lines, of_lines).alias("l"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"))
    out = rows.select("id", "stratum", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words",
                      "l.n_lines", "n_upper")
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) |
                          (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _share(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)


#: Each rule's measure; larger is worse.
RULES = {"symbols": ("n_symbols", "word_chars"), "upper": ("n_upper", "word_chars"),
         "repeats": ("n_repeat_words", "n_words"), "lines": ("n_dup_lines", "n_lines")}


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) of X ~ Binomial(n, p), summed term by term (each from the one before, in logarithms)."""
    import math
    first = n * math.log1p(-p)

    def term(acc: Column, j: Column) -> Column:
        log = F.when(j == 0, first).otherwise(acc["log"] + F.log((n - j + 1) / j) + math.log(p / (1 - p)))
        return F.struct(log.alias("log"), (acc["sum"] + F.exp(log)).alias("sum"))
    start = F.struct(F.lit(0.0).alias("log"), F.lit(0.0).alias("sum"))
    return F.aggregate(F.sequence(F.lit(0).cast("long"), k), start, term, lambda acc: acc["sum"])


def cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``(stratum, symbols, upper, repeats, lines)``: the cutoffs that each stratum's
    labelled good documents allow; NULL where none is proven.

    A rule gets an equal share of ``alpha``. Its cutoffs are tested from lenient to
    strict: one passes while the exact binomial chance of so few false rejections,
    were the true rate above its share, is at most ``delta`` over the number of strata and
    rules; the first failure ends the sequence, so the cutoffs themselves need no
    correction. Documents that fail the base rules do not count. A document whose
    labels differ is good only if all say so; unlabelled ones say nothing.
    """
    good = labels.groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("good")).where("good = 1").select("id")
    held = measured.where("NOT base_failed AND id IS NOT NULL").join(good, "id", "left_semi")
    values = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), _share(*c).alias("value")) for r, c in RULES.items()]))
    held = held.select("stratum", values.alias("v")).select("stratum", "v.rule", "v.value")
    # a document is rejected from the first cutoff below its measure on
    held = held.withColumn("step", F.size(F.filter(_cutoffs(), lambda c: c >= F.col("value"))))
    counts = written(held.groupBy("stratum", "rule", "step").count(), "rule-steps")
    strata = counts.select("stratum").distinct().count()
    by = ["stratum", "rule"]
    n = counts.groupBy(*by).agg(F.sum("count").alias("n"), F.collect_list(F.struct("step", "count")).alias("steps"))
    n = n.select(*by, "n", "steps", F.explode(F.sequence(F.lit(0), F.lit(STEPS - 1))).alias("step"))
    rejected = F.aggregate("steps", F.lit(0).cast("long"),
                           lambda a, x: a + F.when(x["step"] <= F.col("step"), x["count"]).otherwise(0))
    share, level = alpha / len(RULES), delta / max(1, strata * len(RULES))
    # at or above the allowed rate the chance is near a half at least, so it need not be summed
    tested = n.withColumn("k", rejected).withColumn("passed", F.when(F.col("k") < F.col("n") * share, binomial_tail(
        F.col("n"), F.col("k"), share) <= level).otherwise(F.lit(False)))
    best = tested.groupBy(*by).agg(F.min(F.when(~F.col("passed"), F.col("step"))).alias("failed"))
    best = best.withColumn("last", F.coalesce("failed", F.lit(STEPS)) - 1).where("last >= 0")
    return best.groupBy("stratum").pivot("rule", list(RULES)).agg(F.first(F.get(_cutoffs(), F.col("last"))))


def _path(bad: dict[str, list[int]], other: dict[str, list[int]]) -> list[tuple[str, int]]:
    """The order ``(rule, step)`` in which the rules' cutoffs are tightened, from how many labelled bad
    and how many unlabelled documents fall to each rule at each step (the last entry: at none).

    The next stretch of steps is the one that rejects most bad for the unlabelled it
    rejects (``PRIOR`` added to these, so that a single bad document does not lead);
    where no stretch rejects a larger share of the bad than of the unlabelled, the step
    that rejects fewest unlabelled.
    """
    b, u = ({r: [0, *accumulate(x[r][:STEPS])] for r in RULES} for x in (bad, other))
    at, moves = dict.fromkeys(RULES, 0), []
    least = max(sum(bad[r]) / (sum(other[r]) + PRIOR) for r in RULES)  # alike for all rules

    def stretch(r: str) -> tuple:
        k = at[r]
        slope, j = max(((b[r][j] - b[r][k]) / (u[r][j] - u[r][k] + PRIOR), -j) for j in range(k + 1, STEPS + 1))
        return (-slope, 0, k, -j, r) if slope > least else (0.0, u[r][k + 1] - u[r][k], k, k + 1, r)
    while any(k < STEPS for k in at.values()):
        *_, j, r = min(stretch(r) for r in RULES if at[r] < STEPS)
        j = abs(j)
        moves += [(r, k) for k in range(at[r], j)]
        at[r] = j
    return moves


def joint_cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """As ``cutoffs``, by one test for all rules together.

    The cutoffs are tightened along one path of single steps, which labelled bad and
    unlabelled documents of all strata set (``_path``); the good documents that test
    it have no part in it. Each stratum follows the path while the exact binomial
    chance of so few false rejections by any rule, were the true rate above ``alpha``,
    is at most ``delta`` over the number of strata. A stratum proves something from
    ``log(delta / strata) / log(1 - alpha)`` good documents on (217 for four strata);
    one with fewer has no row here.
    """
    names = [f"_{r}" for r in RULES]

    def step(value: Column) -> Column:
        return F.size(F.filter(_cutoffs(), lambda c: c >= value))
    steps = [step(_share(*x)).alias(n) for n, x in zip(names, RULES.values())]
    passed = measured.where("NOT base_failed")
    quality = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("good"))
    known = passed.join(quality.where("good IS NOT NULL"), "id").select("stratum", (F.col("good") == 1).alias("good"), *steps)
    known = written(known.groupBy("stratum", "good", *names).count(), "labelled-steps")

    def by_rule(counts: DataFrame) -> dict[str, list[int]]:
        each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(n).alias("step")) for r, n in zip(RULES, names)]))
        out = {r: [0] * (STEPS + 1) for r in RULES}
        for x in counts.select(each.alias("v"), "count").groupBy("v.rule", "v.step").agg(F.sum("count").alias("n")).collect():
            out[x.rule][x.step] = x.n
        return out
    good, bad = (by_rule(known.where(c)) for c in ("good", "NOT good"))
    every = by_rule(passed.select(*steps).groupBy(*names).count())
    moves = _path(bad, {r: [e - g - b for e, g, b in zip(every[r], good[r], bad[r])] for r in RULES})

    # the move by which a rule first rejects a document, and each rule's cutoff after each move
    grid, never, cut, after = [2.0 ** (-k / 4) for k in range(STEPS)], len(moves), dict.fromkeys(RULES), []
    place = {m: i for i, m in enumerate(moves)}
    for r, k in moves:
        cut[r] = grid[k]
        after.append(dict(cut))
    falls = F.least(*[F.get(F.array(*[F.lit(place.get((r, k), never)) for k in range(STEPS + 1)]), F.col(n))
                      for r, n in zip(RULES, names)])
    counts = known.where("good").groupBy("stratum", falls.alias("move")).agg(F.sum("count").alias("count"))
    n = counts.groupBy("stratum").agg(F.sum("count").alias("n"), F.collect_list(F.struct("move", "count")).alias("falls"))
    n = written(n, "falls")
    level = delta / max(1, n.count())
    n = n.select("stratum", "n", "falls", F.explode(F.sequence(F.lit(0), F.lit(never - 1))).alias("move"))
    k = F.aggregate("falls", F.lit(0).cast("long"),
                    lambda a, x: a + F.when(x["move"] <= F.col("move"), x["count"]).otherwise(0))
    tested = n.withColumn("k", k).withColumn("passed", F.when(F.col("k") < F.col("n") * alpha, binomial_tail(
        F.col("n"), F.col("k"), alpha) <= level).otherwise(F.lit(False)))
    last = tested.groupBy("stratum").agg((F.coalesce(F.min(F.when(~F.col("passed"), F.col("move"))), F.lit(never)) - 1).alias("last"))
    return last.where("last >= 0").select("stratum", *[
        F.get(F.array(*[F.lit(x[r]).cast("double") for x in after]), F.col("last")).alias(r) for r in RULES])


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, id_col: str = "doc_id",
          text_col: str = "text", stratum_col: str = STRATUM, joint: bool = False) -> DataFrame:
    """The measures of every row, ``kept`` and ``failed`` (names of the rules it breaks).

    Strata are the values of ``stratum_col`` (NULL is one too). A NULL text is an empty
    one and fails the base rules; repeated rows and NULL ids are judged like others
    (NULL ids never match a label); without labels only the base rules reject; no
    rows give none; other columns are not read. Measures are written once and
    serve both the cutoffs and the verdicts. ``joint`` tests all rules together
    (``joint_cutoffs``), which proves cutoffs from about a fifth of the good documents.
    """
    measured = written(measures(docs, id_col, text_col, stratum_col), "measures")
    cuts = written((joint_cutoffs if joint else cutoffs)(measured, labels, alpha, delta), "cutoffs").withColumnRenamed("stratum", "_stratum")
    both = measured.join(cuts, measured["stratum"].eqNullSafe(cuts["_stratum"]), "left")
    broken = F.array_compact(F.array(*[F.when(_share(*c) > F.col(r), F.lit(r)) for r, c in RULES.items()]))
    both = both.withColumn("failed", broken).withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
    return both.select(*measured.columns, "failed", "kept")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: base measures and verdict of every document."""
    out = judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), joint=True)
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept", "failed")
