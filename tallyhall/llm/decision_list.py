"""Quality rules as a learned decision list.

Statistics of each text are plain columns.  Rules that mark bad texts are
learned by sequential covering: a rule grows, one threshold condition at a
time, by the largest FOIL gain on two thirds of the labelled rows that no
earlier rule covers, and is pruned from its end on the other third, to the
best of its beginnings that are precise enough.  If none is, the feature that
it began with is left out from then on; the list ends when nothing gains.  The list becomes one ordered ``CASE`` of
threshold conjunctions.

Only DataFrame and SQL functions run here; a learning step brings to the
driver one count for each feature, threshold and label.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import UPPER, WHITE_RUN, saved, table

SYMBOLS = "#*$%&|<>"
FEATURES = ("n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "bang_share",
            "digit_share", "stop_share", "line_words")
PLACE_BITS = 26  # of a window's place beside its hash's high bits; longer texts, and those whose high bits clash, sort both in full
MAX_RULES, MAX_CONDITIONS, BINS, MIN_PRECISION, MIN_COVER = 8, 4, 24, 0.9, 3


BANGS, DIGITS, STOPS = "!", "0123456789", ".,;:"


def _count(chars: str) -> Column:
    """How many of ``chars`` are among the text's ``marks``."""
    return F.length("marks") - F.length(F.translate("marks", chars, ""))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the base counts and ``FEATURES`` of every whole text.

    A null or empty text has zeros; repeated rows are returned each; an empty
    table gives no rows.  Words that stand in a three-word window
    which the text has twice or more are counted once each: windows are
    hashed, sorted within the text, and the places with an equal neighbour
    are joined."""
    t = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    t = t.withColumn("words", F.array_remove(F.split("text", WHITE_RUN, -1), ""))
    t = t.withColumn("marks", F.regexp_replace("text", f"[^{UPPER}{BANGS}{DIGITS}{STOPS}{SYMBOLS}]+", ""))
    t = t.withColumn("lines", F.filter(F.split("text", "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    windows = F.transform(F.sequence(F.lit(0), F.size("words") - 3),
                          lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))
    t = t.select(
        "doc_id", F.size("words").cast("bigint").alias("n_words"), F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        _count(SYMBOLS).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"), F.size("lines").alias("n_lines"),
        _count(UPPER).alias("n_upper"), _count(BANGS).alias("n_bang"), _count(DIGITS).alias("n_digit"), _count(STOPS).alias("n_stop"),
        F.when(F.size("words") >= 3, windows).otherwise(F.array().cast("array<bigint>")).alias("windows"))
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    # A long for each window: the high bits of its hash, then its place.  Sorted, equal windows are neighbours, unless
    # unlike windows share the high bits or a text has more windows than places: such a text sorts hash and place in full.
    place = (1 << PLACE_BITS) - 1
    t = t.withColumn("placed", F.when(again & (F.size("windows") <= place), F.sort_array(F.expr(
        f"transform(windows, (h, i) -> shiftleft(shiftright(h, {PLACE_BITS}), {PLACE_BITS}) + i)"))))
    mixed = F.expr(f"""exists(sequence(1, size(placed) - 1), j -> shiftright(get(placed, j), {PLACE_BITS}) = shiftright(get(placed, j - 1), {PLACE_BITS})
        and get(windows, cast(get(placed, j) & {place} as int)) <> get(windows, cast(get(placed, j - 1) & {place} as int)))""")
    t = t.withColumn("placed", F.when(F.col("placed").isNotNull() & ~mixed, F.expr(f"transform(placed, x -> cast(x & {place} as int))")))
    t = t.withColumn("placed", F.when(again, F.coalesce("placed", F.expr(
        "transform(array_sort(transform(windows, (h, i) -> struct(h, i))), x -> x.i)"))))
    t = t.withColumn("places", F.expr("""sort_array(filter(transform(placed, (p, j) -> if(
        coalesce(get(windows, p) = get(windows, get(placed, j - 1)), false)
        or coalesce(get(windows, p) = get(windows, get(placed, j + 1)), false), p, -1)), p -> p >= 0))"""))
    t = t.withColumn("n_repeat_words", F.expr("""cast(coalesce(aggregate(places, named_struct('total', 0, 'upto', 0),
        (a, p) -> named_struct('total', a.total + p + 3 - greatest(p, a.upto), 'upto', p + 3), a -> a.total), 0) as bigint)"""))
    n, chars, lines = (F.greatest(c, F.lit(1)) for c in (F.col("n_words"), F.col("word_chars"), F.col("n_lines")))
    base = ("doc_id", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return t.select(*base, F.col("n_words").cast("bigint").alias("n_words"), (F.col("word_chars") / n).alias("mean_word"),
                    (F.col("n_symbols") / chars).alias("symbol_share"), (F.col("n_dup_lines") / lines).alias("dup_line_share"),
                    (F.col("n_repeat_words") / n).alias("repeat_share"), (F.col("n_upper") / chars).alias("upper_share"),
                    (F.col("n_bang") / chars).alias("bang_share"), (F.col("n_digit") / chars).alias("digit_share"),
                    (F.col("n_stop") / n).alias("stop_share"), (F.col("n_words") / lines).alias("line_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def sql(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold!r}D"


Rule = tuple[Condition, ...]


def rule_sql(rule: Rule) -> str:
    return " and ".join(c.sql() for c in rule) or "true"


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1; 0 if none does."""
    if not rules:
        return F.lit(0)
    return F.expr("case " + " ".join(f"when {rule_sql(r)} then {i}" for i, r in enumerate(rules, 1)) + " else 0 end")


def foil_gain(p: float, n: float, p0: float, n0: float) -> float:
    if p <= 0 or p0 <= 0:
        return -math.inf
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def _thresholds(rows: DataFrame, features: tuple[str, ...], bins: int) -> dict[str, list[float]]:
    """Quantiles of each feature among the bad and among the other rows."""
    q = [(i + 0.5) / bins for i in range(bins)]
    marks = rows.groupBy("bad").agg(*[F.percentile_approx(F.col(f).cast("double"), q, 2000).alias(f) for f in features]).collect()
    return {f: sorted({float(x) for r in marks for x in (r[f] or [])}) for f in features}


def _best_condition(rows: DataFrame, rule: Rule, marks: dict[str, list[float]]) -> tuple[Condition | None, float, float]:
    """The condition with the largest gain, and the (p, n) it leaves."""
    held = rows.where(rule_sql(rule))
    numbers = [F.struct(F.lit(f).alias("feature"), F.expr(
        f"size(filter(array({', '.join(f'{t!r}D' for t in m)}), t -> t <= {f}))").alias("bin")) for f, m in marks.items() if m]
    if not numbers:
        return None, 0, 0
    counts = (held.select("bad", F.explode(F.array(*numbers)).alias("x")).groupBy("x.feature", "x.bin")
              .agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect())  # features x (thresholds + 1)
    best, left, top = None, (0, 0), 1e-9
    for f, m in marks.items():
        per = {r.bin: (r.p, r.n) for r in counts if r.feature == f}
        p0, n0 = sum(x[0] for x in per.values()), sum(x[1] for x in per.values())
        for i, t in enumerate(m, 1):
            over = [sum(per.get(b, (0, 0))[k] for b in range(i, len(m) + 1)) for k in (0, 1)]
            for at_least, (p, n) in ((True, over), (False, (p0 - over[0], n0 - over[1]))):
                gain = foil_gain(p, n, p0, n0)
                if gain > top:
                    best, left, top = Condition(f, at_least, t), (p, n), gain
    return best, *left


def learn(rows: DataFrame, features: tuple[str, ...] = FEATURES, max_rules: int = MAX_RULES, bins: int = BINS,
          min_precision: float = MIN_PRECISION, min_cover: int = MIN_COVER) -> list[Rule]:
    """The decision list for boolean ``bad`` from ``rows`` (features, ``bad``
    and boolean ``prune``).  Rows without bad ones give an empty list."""
    marks, rules = _thresholds(rows, features, bins), []
    while len(rules) < max_rules:
        left = rows.where(verdict(rules) == 0)
        grow, rule = left.where("not prune"), ()
        while len(rule) < MAX_CONDITIONS:
            best, _, n = _best_condition(grow, rule, marks)
            if best is None:
                break
            rule = (*rule, best)
            if not n:
                break
        if not rule:
            break
        sums = [c for i in range(1, len(rule) + 1) for c in
                (F.count_if(F.expr(f"prune and bad and {rule_sql(rule[:i])}")).alias(f"p{i}"),
                 F.count_if(F.expr(f"prune and not bad and {rule_sql(rule[:i])}")).alias(f"n{i}"),
                 F.count_if(F.expr(f"bad and {rule_sql(rule[:i])}")).alias(f"a{i}"),
                 F.count_if(F.expr(f"not bad and {rule_sql(rule[:i])}")).alias(f"b{i}"))]
        r = left.agg(*sums).first()

        def precise(i: int) -> bool:
            return r[f"a{i}"] >= min_cover and r[f"p{i}"] > 0 and all(
                r[f"{x}{i}"] >= min_precision * (r[f"{x}{i}"] + r[f"{y}{i}"]) for x, y in ("ab", "pn"))

        kept = [i for i in range(1, len(rule) + 1) if precise(i)]
        if not kept:
            marks = {f: m for f, m in marks.items() if f != rule[0].feature}
            continue
        rules.append(rule[:max(kept, key=lambda i: ((r[f"p{i}"] - r[f"n{i}"]) / (r[f"p{i}"] + r[f"n{i}"]), -i))])
    return rules


def learn_from(stats: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id") -> list[Rule]:
    """The list for ``label`` = 0 from all labelled rows.  Null ids and
    labels are left out; of several labels of a document the largest counts."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id_col).alias("doc_id"))
             .agg((F.max(F.col(label).cast("int")) == 0).alias("bad")))
    rows = stats.join(known, "doc_id").withColumn("prune", F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0)
    return learn(saved(rows.select("bad", "prune", *FEATURES), "labelled-statistics"))


def op7_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = saved(statistics(table(spark, sf_dir, "documents")), "statistics")
    rules = learn_from(stats, table(spark, sf_dir, "labels"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                        (~failed & (verdict(rules) == 0)).alias("kept"))
