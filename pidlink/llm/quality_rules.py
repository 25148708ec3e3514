"""Quality rules: a learned decision list over text statistics, all in Spark expressions.

Statistics of each whole text come from array functions (split, hash, sort, compare with the
array's own tail), each linear in the text or one sort of it; no text moves. They are stored
once, and everything after works on those numbers.

Learning is sequential covering. The labelled rows that the base rule leaves are cut into
bins at quantiles of each statistic. A rule is grown one condition at a time: one grouped
count of good and bad rows by (statistic, bin) gives the gain of every threshold at once, and
the best is added until the rule covers no good row of the growing set or nothing gains. The
rule is then pruned: of its prefixes the one that does best on the other third of the rows is
kept, if its precision there is at least MIN_PRECISION. Rows it covers are taken out and the
next rule is learned. The driver sees only counts per bin and rule. The list is emitted as one
ordered CASE expression.

Defined results: a null text has no words; rows that repeat are judged alike; labels that are
null or of unknown ids are not used; a document with several labels counts once for each;
without labels of both kinds there are no rules beyond the base rule; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pidlink.llm.common import GAP, stored

SYMBOLS = "[#*$%&|<>]+"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

#: Statistics the rules may use, as shares, so that they do not depend on a text's length.
FEATURES = {
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
}
QUANTILES = 32
MAX_RULES = 10
MAX_CONDITIONS = 4
MIN_PRECISION = 0.9
#: Bad rows that a rule must cover in the pruning set.
MIN_COVER = 3


def _tail(c: str, by: int, n: Column) -> Column:
    """The array without its first ``by`` elements; ``n`` is how many are left."""
    return F.slice(c, F.lit(by + 1), F.greatest(n, F.lit(0)))


def _head(c: str, n: Column) -> Column:
    return F.slice(c, F.lit(1), F.greatest(n, F.lit(0)))


def _removed(pattern: str) -> Column:
    return (F.length("_text") - F.length(F.regexp_replace("_text", pattern, ""))).cast("long")


def text_stats(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each text (longs).

    Each step is a projection of its own whose arrays are used at least twice by the next, so
    that an array is computed once and never inside a lambda."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    rows = rows.select("doc_id", "_text", F.array_remove(F.split("_text", GAP), "").alias("_words"),
                       F.filter(F.split("_text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("_lines"))
    total = F.aggregate("_words", F.lit(0).cast("long"), lambda n, w: n + F.length(w))
    rows = rows.select(
        "doc_id", F.size("_words").alias("_n"), total.alias("word_chars"),
        _removed(SYMBOLS).alias("n_symbols"), _removed("\\p{Lu}+").alias("n_upper"), _removed("[!?]+").alias("n_marks"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_w"))
    n = F.col("_n")
    done = ["doc_id", "_n", "word_chars", "n_symbols", "n_upper", "n_marks", "n_lines", "n_dup_lines"]
    two = F.zip_with(_head("_w", n - 1), _tail("_w", 1, n - 1), lambda a, b: F.xxhash64(a, b))
    rows = rows.select(*done, F.size(F.array_distinct("_w")).cast("long").alias("n_distinct_words"), "_w", two.alias("_two"))
    done.append("n_distinct_words")
    four = F.zip_with(_head("_two", n - 3), _tail("_two", 2, n - 3), lambda a, b: F.xxhash64(a, b))
    rows = rows.select(*done, "_w", four.alias("_four"))
    # the hash of every 5-word window
    five = F.zip_with(_head("_four", n - 4), _tail("_w", 4, n - 4), lambda a, b: F.xxhash64(a, b))
    rows = rows.select(*done, five.alias("_five"))
    repeats = F.size(F.array_distinct("_five")) < F.size("_five")
    pairs = F.array_sort(F.transform("_five", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.select(*done, F.when(repeats, pairs).alias("_pairs"))
    m = F.size("_pairs")
    same = F.zip_with(_head("_pairs", m - 1), _tail("_pairs", 1, m - 1), lambda a, b: a["h"] == b["h"])
    rows = rows.select(*done, "_pairs", F.when(F.col("_pairs").isNotNull(), same).alias("_same"))
    no = F.array(F.lit(False))
    either = F.zip_with(F.concat(no, F.col("_same")), F.concat(F.col("_same"), no), lambda a, b: a | b)
    at = F.array_sort(F.array_compact(F.zip_with("_pairs", either, lambda p, hit: F.when(hit, p["i"]))))
    rows = rows.select(*done, at.alias("_at"))
    k = F.size("_at")
    steps = F.zip_with(_head("_at", k - 1), _tail("_at", 1, k - 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(WINDOW).cast("long"), lambda x, y: x + y)
    return rows.select(
        "doc_id", F.col("_n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.col("_at").isNull(), F.lit(0).cast("long")).otherwise(covered).alias("n_repeat_words"),
        "n_upper", "n_marks", "n_lines", "n_distinct_words")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = list[Condition]


def covers(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def cut_points(rows: DataFrame) -> dict[str, list[float]]:
    """Thresholds of each statistic: its quantiles among the bad and among the good rows."""
    share = [i / QUANTILES for i in range(1, QUANTILES)]
    got = rows.groupBy("bad").agg(
        *[F.percentile_approx(F.expr(e), share, 2000).alias(f) for f, e in FEATURES.items()]).collect()
    return {f: sorted({float(x) for r in got for x in (r[f] or [])}) for f in FEATURES}


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    if not p:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def _bin(value: Column, cuts: list[float]) -> Column:
    """Number of thresholds below a value."""
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < value))


def _best_condition(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[Condition, int, int] | None:
    """The threshold of most gain among the given rows, with the bad and good rows it leaves."""
    bins = [F.struct(F.lit(f).alias("f"), _bin(F.expr(e), cuts[f]).alias("bin")) for f, e in FEATURES.items() if cuts[f]]
    counts: dict[str, dict[int, tuple[int, int]]] = {}
    melted = rows.select("bad", F.explode(F.array(*bins)).alias("b"))
    for f, b, bad, good in melted.groupBy("b.f", "b.bin").agg(
            F.sum(F.col("bad").cast("long")), F.sum((~F.col("bad")).cast("long"))).collect():
        counts.setdefault(f, {})[b] = (bad, good)
    best = None
    for f in sorted(counts):
        all_bad, all_good = (sum(x[i] for x in counts[f].values()) for i in (0, 1))
        bad = good = 0
        if not all_bad:
            return None
        for k, cut in enumerate(cuts[f]):  # bins up to k hold values <= cut
            more = counts[f].get(k, (0, 0))
            bad, good = bad + more[0], good + more[1]
            for above, p, n in ((False, bad, good), (True, all_bad - bad, all_good - good)):
                gain = _gain(p, n, all_bad, all_good)
                if gain > 1e-9 and (best is None or gain > best[0]):
                    best = (gain, Condition(f, above, cut), p, n)
    return best and best[1:]


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    rule: Rule = []
    while len(rule) < MAX_CONDITIONS:
        found = _best_condition(rows.where(covers(rule)), cuts)
        if found is None:
            break
        rule.append(found[0])
        if not found[2]:
            break
    return rule


def _prune(rows: DataFrame, rule: Rule) -> Rule:
    """The prefix of the rule that does best on the pruning rows, or nothing."""
    if not rule:
        return []
    sums = []
    for i in range(1, len(rule) + 1):
        hit = covers(rule[:i])
        sums += [F.sum((hit & F.col("bad")).cast("long")), F.sum((hit & ~F.col("bad")).cast("long"))]
    got = [x or 0 for x in rows.agg(*sums).first()]
    scored = [((p - n) / (p + n), -i, p, n) for i, (p, n) in enumerate(zip(got[::2], got[1::2])) if p >= MIN_COVER]
    scored = [s for s in scored if s[2] / (s[2] + s[3]) >= MIN_PRECISION]
    return rule[:1 - max(scored)[1]] if scored else []


def learn_rules(stats: DataFrame, labels: DataFrame) -> list[Rule]:
    """Ordered rules that reject a document, learned from labels (doc_id, quality 0 or 1)."""
    known = labels.where(F.col("quality").isin(0, 1)).select(
        F.col("doc_id").alias("l_id"), (F.col("quality") == 0).alias("bad"))
    rows = stats.where(~base_failed()).join(known, F.col("doc_id") == F.col("l_id"))
    rows = stored(rows.withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(3))).drop("l_id"), "rules")
    cuts = cut_points(rows)
    rules: list[Rule] = []
    left = rows
    while any(cuts.values()) and len(rules) < MAX_RULES:
        rule = _prune(left.where("fold = 0"), _grow(left.where("fold <> 0"), cuts))
        if not rule:
            break
        rules.append(rule)
        left = left.where(~covers(rule))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one ordered conditional expression: whether a document is kept."""
    out = F.when(base_failed(), F.lit(False))
    for rule in rules:
        out = out.when(covers(rule), F.lit(False))
    return out.otherwise(F.lit(True))


def fired(rules: list[Rule]) -> Column:
    """What rejects a document: ``base``, or the conditions of the first rule that covers it; null
    if it is kept."""
    out = F.when(base_failed(), F.lit("base"))
    for rule in rules:
        out = out.when(covers(rule), F.lit(" and ".join(map(str, rule))))
    return out


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, rule (what rejects it)."""
    stats = stored(text_stats(docs), "stats")
    rules = learn_rules(stats, labels)
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        base_failed().alias("base_failed"), verdict(rules).alias("kept"), fired(rules).alias("rule"))
