"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Every text gets counts (``measures``). Rules compare a share made of them with
a cutoff: above it, the text is rejected. Cutoffs come from a labelled holdout:
for each stratum and rule, candidate cutoffs are tested from the laxest to the
strictest; a cutoff is valid if the exact binomial test (the one that
Clopper-Pearson bounds invert) rejects "the rule drops more than its share of
good texts". Each rule's share is ``max_false_rejection / number of rules``, so
that all rules together stay within ``max_false_rejection`` per stratum; the
error level is divided by strata x rules (Bonferroni), and within one rule the
fixed order of tests needs no further correction. A stratum with too few good
labels gets no cutoff for that rule, which then rejects nothing there.

Defined results: null or empty text has no words and fails the base rules; a
null stratum is a stratum of its own; a null or repeated document id stays as
many rows as it has; a document labelled twice is good only if all its labels
are 1; an empty table gives an empty result; extra columns pass through; where
one has the name of the output, the output's name gets ``_`` appended until it is free.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.llm.util import SPACES, fresh, materialise, read_table

#: Characters counted as symbols.
SYMBOLS = "[#*$%&|<>]"
#: Candidate cutoffs of every rule, laxest last (fixed before any label is seen).
CUTOFFS = [0.002, 0.005, 0.01, 0.015, 0.02, 0.03, 0.04, 0.05, 0.065, 0.08, 0.1, 0.125, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.7]
#: Rule -> (count, what it is a share of).
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "repeats": ("n_repeat_words", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "capitals": ("n_capitals", "word_chars"),
    "shouts": ("n_shouts", "n_words"),
}
MAX_FALSE_REJECTION = 0.05
ERROR_LEVEL = 0.05
#: Joins with the cutoff table are broadcast up to so many strata.
BROADCAST_STRATA = 10_000
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_shouts"]


def _again(pairs: str) -> Column:
    """Positions, ascending, of the windows whose hash occurs twice; ``pairs``:
    column of (hash, position) in order. A column, not an expression: a lambda
    evaluates what it refers to once for each element."""
    at = lambda j: F.get(F.col(pairs), j)["h"]
    return F.sort_array(F.filter(
        F.transform(pairs, lambda e, j: F.when(
            F.coalesce(at(j - 1) == e["h"], F.lit(False)) | F.coalesce(at(j + 1) == e["h"], F.lit(False)), e["i"]).otherwise(F.lit(-1))),
        lambda i: i >= 0))


def _covered(again: Column) -> Column:
    """Words covered by the 5-word windows at ascending positions."""
    return F.aggregate(
        again, F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct((i + 5).alias("end"), (a["n"] + i + 5 - F.greatest(a["end"], i)).alias("n")))["n"]


def measures(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` with a struct column ``out`` of the MEASURES of ``text_col``."""
    names = ("text", "words", "hash", "windows", "lines", "pairs", "again")
    t, w, h, win, ln, pairs, again = (fresh(df.columns + [out], f"__{x}") for x in names)
    has_word = lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0
    trimmed = F.btrim(F.col(t), F.lit(SPACES))
    step = df.withColumn(t, F.coalesce(F.col(text_col), F.lit("")))
    step = step.withColumn(w, F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+")))
    step = step.withColumn(ln, F.filter(F.split(F.col(t), "\n"), has_word))
    step = step.withColumn(h, F.transform(F.col(w), lambda x: F.xxhash64(x)))
    step = step.withColumn(win, F.when(F.size(w) >= 5, F.transform(
        F.sequence(F.lit(0), F.size(w) - 5),
        lambda i: F.xxhash64(*(F.get(F.col(h), i + k) for k in range(5))))).otherwise(F.array().cast("array<bigint>")))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    step = step.withColumn(pairs, F.when(F.size(F.array_distinct(win)) == F.size(win), none).otherwise(
        F.sort_array(F.transform(win, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    step = step.withColumn(again, _again(pairs))
    n = lambda c: c.cast("long")
    return step.withColumn(out, F.struct(
        n(F.size(w)).alias("n_words"),
        n(F.length(F.array_join(w, ""))).alias("word_chars"),
        n(F.regexp_count(F.col(t), F.lit(SYMBOLS))).alias("n_symbols"),
        n(F.size(ln)).alias("n_lines"),
        n(F.size(ln) - F.size(F.array_distinct(ln))).alias("n_dup_lines"),
        _covered(F.col(again)).alias("n_repeat_words"),
        n(F.regexp_count(F.col(t), F.lit("[A-Z]"))).alias("n_capitals"),
        n(F.regexp_count(F.col(t), F.lit("[!]"))).alias("n_shouts"),
    )).drop(t, w, h, win, ln, pairs, again)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def share(m: Column, rule: str) -> Column:
    count, whole = RULES[rule]
    return F.when(m[whole] > 0, m[count] / m[whole]).otherwise(F.lit(0.0))


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), summed exactly in log space."""
    odds = math.log(p / (1 - p))
    first = n * F.lit(math.log1p(-p))

    def add(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i + 1) / i) + F.lit(odds)
        top = F.greatest(a["total"], term)
        return F.struct(term.alias("term"), (top + F.log(F.exp(a["total"] - top) + F.exp(term - top))).alias("total"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.exp(F.aggregate(steps, F.struct(first.cast("double").alias("term"), first.cast("double").alias("total")), add)["total"])


def learn_cutoffs(
    holdout: DataFrame, measure_col: str, stratum_col: str,
    max_false_rejection: float = MAX_FALSE_REJECTION, error_level: float = ERROR_LEVEL,
) -> DataFrame:
    """(stratum, cutoffs map<rule, double>) from the good rows of a holdout.

    ``holdout``: one row per good text, with the measure struct and a stratum.
    Rows are counted per (stratum, rule, cutoff bin) with map-side combine, so
    only strata x rules x bins rows are ever shuffled.
    """
    m = F.col(measure_col)
    bins = F.array(*(
        F.struct(F.lit(rule).alias("rule"),
                 sum((share(m, rule) > c).cast("int") for c in CUTOFFS).alias("bin"))
        for rule in RULES))
    counts = (holdout.select(F.col(stratum_col).alias("stratum"), F.explode(bins).alias("b"))
              .groupBy("stratum", F.col("b.rule").alias("rule"), F.col("b.bin").alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    by_rule = counts.groupBy("stratum", "rule").agg(
        F.sum("n").alias("n"), F.collect_list(F.struct("bin", "n")).alias("bins"))
    strata = by_rule.agg(F.countDistinct(F.coalesce(F.concat(F.lit("s"), "stratum"), F.lit("")))).first()[0]
    level = error_level / max(1, strata * len(RULES))
    allowed = max_false_rejection / len(RULES)
    tested = by_rule.select("stratum", "rule", "n", F.posexplode(F.array(*map(F.lit, CUTOFFS))).alias("at", "cutoff"), "bins")
    # A text in bin b exceeds the cutoffs 0..b-1.
    lost = F.aggregate(F.filter("bins", lambda b: b["bin"] > F.col("at")), F.lit(0).cast("long"), lambda a, b: a + b["n"])
    tested = tested.withColumn("lost", lost)
    valid = (F.col("lost") < F.col("n") * allowed) & (
        F.when(F.col("lost") < F.col("n") * allowed, binomial_cdf(F.col("lost"), F.col("n"), allowed)).otherwise(1.0) <= level)
    chosen = tested.where(valid).groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))
    return chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))


def good_labels(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__good_id"))
            .agg(F.min(F.coalesce("quality", F.lit(0))).alias("__good")).where("__good = 1").select("__good_id"))


def apply_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
    out: str = "quality", keep_text: bool = True,
) -> DataFrame:
    """``docs`` (without the text if ``keep_text`` is false) plus a struct ``out``
    of measures, ``base_failed``, ``rejected_by`` (rules) and ``kept``."""
    cols = [c for c in docs.columns if keep_text or c != text_col]
    out, in_stratum, its_cutoffs = (fresh(docs.columns, x) for x in (out, "__stratum", "__cutoffs"))
    m = fresh(docs.columns + [out], "__m")
    measured = materialise(measures(docs, text_col, m).select(*cols, m), "quality")
    s = F.coalesce(F.concat(F.lit("s"), F.col(stratum_col)), F.lit(""))
    good = measured.select(id_col, s.alias("stratum"), m).where(~base_failed(F.col(m)))
    good = good.join(good_labels(labels), F.col(id_col) == F.col("__good_id"), "left_semi")
    cutoffs = materialise(learn_cutoffs(good, m, "stratum"), "cutoffs")
    few = cutoffs.count() <= BROADCAST_STRATA
    cutoffs = cutoffs.select(F.col("stratum").alias(in_stratum), F.col("cutoffs").alias(its_cutoffs))
    joined = measured.join(F.broadcast(cutoffs) if few else cutoffs, s == F.col(in_stratum), "left")
    hits = F.filter(F.array(*(
        F.when(share(F.col(m), r) > F.try_element_at(its_cutoffs, F.lit(r)), F.lit(r)) for r in RULES)), lambda x: x.isNotNull())
    kept = ~base_failed(F.col(m)) & (F.size(hits) == 0)
    verdict = F.struct(*(F.col(m)[k].alias(k) for k in MEASURES), base_failed(F.col(m)).alias("base_failed"),
                       hits.alias("rejected_by"), kept.alias("kept"))
    return joined.select(*(F.col(c) for c in cols), verdict.alias(out))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    q = apply_rules(docs, read_table(spark, sf_dir, "labels"), out="q", keep_text=False)
    return q.select("doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines", "q.n_repeat_words",
                    "q.base_failed", "q.kept")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the rules keep, with their columns."""
    out = fresh(docs.columns, "__quality")
    q = apply_rules(docs, read_table(spark, sf_dir, "labels"), out=out)
    return q.where(F.col(out)["kept"]).select(*docs.columns)


def _oracle() -> str:
    rules = ", ".join(f"('{r}', CASE WHEN {w} > 0 THEN {c}::DOUBLE / {w} ELSE 0.0 END)" for r, (c, w) in RULES.items())
    cut = ", ".join(map(str, CUTOFFS))
    a = MAX_FALSE_REJECTION / len(RULES)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce('s' || lang, '') AS stratum FROM documents),
w AS (SELECT doc_id, t, stratum, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
wp AS (SELECT doc_id, unnest(ws) AS x, unnest(range(len(ws))) AS p FROM w),
win AS (SELECT doc_id, p, struct_pack(a := x, b := lead(x, 1) OVER s, c := lead(x, 2) OVER s, d := lead(x, 3) OVER s, e := lead(x, 4) OVER s) AS g,
        lead(x, 4) OVER s IS NOT NULL AS whole FROM wp WINDOW s AS (PARTITION BY doc_id ORDER BY p)),
dup AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win WHERE whole) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM dup, range(5) AS r(k) GROUP BY doc_id),
m AS (SELECT w.doc_id, stratum, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
        len(regexp_extract_all(t, '[A-Z]'))::BIGINT AS n_capitals, len(regexp_extract_all(t, '!'))::BIGINT AS n_shouts
      FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
b AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM m),
s AS (SELECT doc_id, stratum, base_failed, r.rule, r.share FROM b, LATERAL (VALUES {rules}) AS r(rule, share)),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(coalesce(quality, 0)) = 1),
h AS (SELECT stratum, rule, c.cutoff, count(*) AS n, count(*) FILTER (share > c.cutoff) AS lost
      FROM s, (SELECT unnest([{cut}])::DOUBLE AS cutoff) AS c
      WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good) GROUP BY ALL),
p AS (SELECT stratum, rule, cutoff, n, lost,
        (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({a}) + (n - i) * ln(1 - {a})))
         FROM range(0, lost + 1) AS x(i)) AS tail FROM h WHERE lost < n * {a}),
z AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM p
      WHERE tail <= {ERROR_LEVEL} / ((SELECT count(DISTINCT stratum) FROM h) * {len(RULES)}) GROUP BY ALL),
bad AS (SELECT DISTINCT s.doc_id FROM s JOIN z ON s.stratum = z.stratum AND s.rule = z.rule WHERE s.share > z.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad)) AS kept FROM b
"""


ORACLE = _oracle()
