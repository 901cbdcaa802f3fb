"""Quality rules as learned decision lists, with built-in functions only.

Statistics of every text come from SQL expressions. Sequential covering then learns rules against bad
documents from labelled statistics: a rule grows by the threshold condition of most information gain,
is pruned on rows it was not grown on, and the rows it covers are taken out before the next one. The
list is an ordered conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framesift.llm.common import held_out, uniform, words_of
from framesift.session import materialise

BLANK = " \t\r\x0b\f\n"
FEWEST_WORDS = 50
MOST_REPEATED = 50
FEATURES = ("symbol_rate", "shout_rate", "repeat_rate", "dup_line_rate", "mean_word", "n_words")

# Of the labelled rows about this many are used, chosen by a hash; grids of that many thresholds.
LABELLED_ROWS = 200_000
GRID = 32
MOST_RULES = 8
MOST_CONDITIONS = 3
PRECISION = 0.9
SEED = 8


def _let(value: Column, body) -> Column:
    """Binds a value once inside an expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column, window: int = 3) -> Column:
    """Words inside windows of so many words that the text holds twice or more.

    Window hashes are sorted with their places, so equal ones meet; the places found then cover
    ``window`` words each, less what the next one covers. Most texts repeat nothing and stop at the
    distinct count.
    """

    def of(ws: Column) -> Column:
        parts = [ws.alias("w0"), *[F.slice(ws, k + 1, F.size(ws)).alias(f"w{k}") for k in range(1, window)]]
        grams = F.transform(F.slice(F.arrays_zip(*parts), 1, F.size(ws) - (window - 1)), lambda z: F.xxhash64(*[z[f"w{k}"] for k in range(window)]))

        def places(hs: Column) -> Column:
            ranked = F.array_sort(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
            same = lambda s, a, j: F.coalesce(F.get(a, j)["h"] == s["h"], F.lit(False))
            found = _let(ranked, lambda a: F.filter(a, lambda s, j: ((j > 0) & same(s, a, F.greatest(j - 1, F.lit(0)))) | same(s, a, j + 1)))
            starts = F.array_sort(F.transform(found, lambda s: s["i"]))
            covered = _let(starts, lambda p: F.transform(p, lambda x, j: F.least(F.lit(window), F.coalesce(F.get(p, j + 1), x + window) - x)))
            return F.aggregate(covered, F.lit(0), lambda total, x: total + x)

        return _let(grams, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(places(hs)))

    return _let(words, lambda ws: F.when(F.size(ws) < window, F.lit(0)).otherwise(of(ws)))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines and n_shouts (bigint).

    Words are runs of anything but ASCII white space; a missing text has none. Windows are compared by
    64-bit hashes within one text. Columns of these names are replaced.
    """
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouts")
    base = docs.select(*[c for c in docs.columns if c.lower() not in made])
    whole = F.coalesce(F.col(text), F.lit(""))
    worded = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(BLANK)) != "")
    counts = F.struct(
        F.size("_words").alias("n_words"),
        F.char_length(F.array_join("_words", "")).alias("word_chars"),
        F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.size("_lines").alias("n_lines"),
        F.regexp_count(whole, F.lit("!")).alias("n_shouts"),
    )
    # Words and lines are split once: a one-row explode keeps the optimizer from repeating it.
    parts = base.withColumn("_parts", F.explode(F.array(F.struct(words_of(F.col(text)).alias("words"), worded.alias("lines")))))
    parts = parts.withColumns({"_words": F.col("_parts.words"), "_lines": F.col("_parts.lines")})
    counted = parts.withColumn("_counts", F.explode(F.array(counts)))
    return counted.select(*base.columns, *[F.col(f"_counts.{c}").cast("bigint").alias(c) for c in made])


def features() -> dict[str, Column]:
    """What rules test, from the statistics."""
    words = F.greatest("n_words", F.lit(1))
    return {
        "symbol_rate": F.col("n_symbols") / words,
        "shout_rate": F.col("n_shouts") / words,
        "repeat_rate": F.col("n_repeat_words") / words,
        "dup_line_rate": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "mean_word": F.col("word_chars") / words,
        "n_words": F.col("n_words").cast("double"),
    }


def base_failed(fewest: int = FEWEST_WORDS, most: int = MOST_REPEATED) -> Column:
    return (F.col("n_words") < fewest) | (100 * F.col("n_repeat_words") > most * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Rules in order; the first that holds rejects, and a text that none fits is kept."""

    rules: list[tuple[Condition, ...]] = field(default_factory=list)

    def verdict(self) -> Column:
        out = None
        for rule in self.rules:
            holds = _all(rule)
            out = F.when(holds, F.lit(False)) if out is None else out.when(holds, F.lit(False))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))

    def __str__(self) -> str:
        return "\n".join(f"reject if {' and '.join(map(str, rule))}" for rule in self.rules)


def _all(rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def _grid(rows: DataFrame) -> dict[str, list[float]]:
    """Thresholds per feature: values at equal shares of the bad and of all rows."""
    shares = [k / (GRID - 1) for k in range(GRID)]
    row = rows.agg(
        *[F.percentile_approx(c, shares, 10_000).alias(f"all_{n}") for n, c in features().items()],
        *[F.percentile_approx(F.when(F.col("_bad"), c), shares, 10_000).alias(f"bad_{n}") for n, c in features().items()],
    ).first()
    return {n: sorted(set(row[f"all_{n}"] or []) | set(row[f"bad_{n}"] or [])) for n in FEATURES}


def _counts(rows: DataFrame, grid: dict[str, list[float]]) -> dict[str, list[tuple[int, int]]]:
    """Bad and good rows per feature and grid cell: cell k lies between thresholds k - 1 and k."""

    def cell(value: Column, thresholds: list[float]) -> Column:
        return F.size(F.filter(F.array(*[F.lit(t) for t in thresholds]), lambda t: t <= value))

    cells = [F.struct(F.lit(name).alias("feature"), cell(value, grid[name]).alias("cell")) for name, value in features().items() if grid[name]]
    if not cells:
        return {}
    found = rows.select("_bad", F.explode(F.array(*cells)).alias("c")).groupBy("c.feature", "c.cell").agg(F.count_if(F.col("_bad")).alias("bad"), F.count_if(~F.col("_bad")).alias("good"))
    out = {name: [(0, 0)] * (len(grid[name]) + 1) for name in FEATURES}
    for r in found.collect():  # features times cells at most
        out[r["feature"]][r["cell"]] = (r["bad"], r["good"])
    return out


def _best_condition(rows: DataFrame, grid: dict[str, list[float]]) -> tuple[Condition | None, int]:
    """The condition of most gain (FOIL) on the rows, and how many good rows it still covers."""
    counts = _counts(rows, grid)
    best, gain, left = None, 1e-9, 0
    for name, cells in counts.items():
        all_bad, all_good = sum(b for b, _ in cells), sum(g for _, g in cells)
        if not all_bad:
            continue
        before = math.log2(all_bad / (all_bad + all_good))
        low_bad = low_good = 0
        for k, threshold in enumerate(grid[name]):
            low_bad, low_good = low_bad + cells[k][0], low_good + cells[k][1]
            for at_least, bad, good in ((True, all_bad - low_bad, all_good - low_good), (False, low_bad, low_good)):
                if bad and (value := bad * (math.log2(bad / (bad + good)) - before)) > gain:
                    best, gain, left = Condition(name, at_least, threshold), value, good
    return best, left


def _pruned(rows: DataFrame, rule: list[Condition]) -> tuple[tuple[Condition, ...], float]:
    """The beginning of the rule that is worth most on other rows, and its precision there."""
    sizes = range(1, len(rule) + 1)
    row = rows.agg(
        *[F.count_if(F.col("_bad") & _all(rule[:k])).alias(f"bad_{k}") for k in sizes],
        *[F.count_if(~F.col("_bad") & _all(rule[:k])).alias(f"good_{k}") for k in sizes],
    ).first()
    worth = [((row[f"bad_{k}"] - row[f"good_{k}"]) / max(row[f"bad_{k}"] + row[f"good_{k}"], 1), row[f"bad_{k}"], -k) for k in sizes]
    k = -max(worth)[2]
    return tuple(rule[:k]), row[f"bad_{k}"] / max(row[f"bad_{k}"] + row[f"good_{k}"], 1)


def learn(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DecisionList:
    """A decision list from rows of statistics and labels.

    Held-out ids, missing ids, labels other than 0 and 1 and ids with both are not used, nor are rows
    that the base rules reject anyway. A third of the rows prunes. Each step is one aggregate over the
    labelled rows; only grids and cell counts reach the driver. Without bad rows the list is empty.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(key)))
    agreed = known.groupBy(F.col(key).alias("_key")).agg(F.min(label).alias("_label"), F.max(label).alias("_most")).filter("_label = _most")
    numbers = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouts"]
    joined = stats.filter(~base_failed()).select(F.col(key).alias("_key"), *numbers).join(agreed, "_key").select("*", (F.col("_label") == 0).alias("_bad"))
    joined = materialise(joined, "labelled")
    share = LABELLED_ROWS / max(joined.count(), 1)
    if share < 1:
        joined = materialise(joined.filter(uniform(SEED, F.col("_key")) < share), "labelled")
    pruning = uniform(SEED + 1, F.col("_key")) < 1 / 3
    grow, prune = joined.filter(~pruning), joined.filter(pruning)
    grid, rules = _grid(grow), []
    for _ in range(MOST_RULES):
        rule, open_rows, left = [], grow, 1
        while left and len(rule) < MOST_CONDITIONS:
            condition, left = _best_condition(open_rows, grid)
            if condition is None:
                break
            rule.append(condition)
            open_rows = open_rows.filter(condition.column())
        if not rule:
            break
        chosen, precision = _pruned(prune, rule)
        if precision < PRECISION:
            break
        rules.append(chosen)
        grow, prune = grow.filter(~_all(chosen)), prune.filter(~_all(chosen))
    return DecisionList(rules)


def judge(stats: DataFrame, rules: DecisionList) -> DataFrame:
    """Adds ``base_failed`` and ``kept``: false where the base rules fail, else the list's verdict."""
    base = stats.select(*[c for c in stats.columns if c.lower() not in ("base_failed", "kept")])
    return base.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & rules.verdict())
