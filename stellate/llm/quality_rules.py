"""Learned decision lists over text statistics.

Statistics of whole texts are plain Spark expressions. Sequential covering learns rules for the
class "reject" from labelled rows: a rule is a conjunction of thresholds on shares and means, grown
on two thirds of the labelled rows and pruned on the rest. Rules come out as one ordered Spark
conditional expression. Learning reads histograms only: every step is one aggregate whose result
has (features x bins x classes) rows, so all labelled rows count and nothing grows on the driver.

NULL and empty texts have zero for every statistic, so they fail the base rules. Repeated rows
count as often as they occur. NULL labels are left out; without labels there are no learned rules
and the base rules decide alone.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.frames import bind, free_name, words
from stellate.sources.staging import stage

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
CAPITALS = "[A-Z]"
MARKS = "[!?:;=+~^@_]"

FEATURES = (
    "mean_word_chars",
    "symbol_share",
    "mark_share",
    "capital_share",
    "repeat_share",
    "duplicate_line_share",
)


def _count_of(text: Column, characters: str) -> Column:
    return F.regexp_count(text, F.lit(characters))


def _position_bits(n: Column) -> Column:
    """A mask of as many bits as the positions up to ``n`` need."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(n))) - 1


def _repeat_words(word_list: Column, hashes: Column, low: Column) -> Column:
    """Words inside three-word windows that occur at least twice in the text.

    Each window becomes one number: a hash, its last bits replaced by the window's position. Sorted
    numbers bring equal windows together, and their words are compared. Each repeated window adds
    the words up to the next repeated window, three at most.
    """
    n = F.size(hashes)

    def packed(x: Column, i: Column) -> Column:
        window = F.xxhash64(x, F.get(hashes, i + 1), F.get(hashes, i + 2))
        return window.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long"))

    def same(x: Column, y: Column) -> Column:
        def word(value: Column, k: int) -> Column:
            return F.get(word_list, (value.bitwiseAND(low) + k).cast("int"))

        alike = x.bitwiseXOR(y).bitwiseAND(F.bitwise_not(low)) == 0
        for k in range(3):
            alike = alike & (word(x, k) == word(y, k))
        return F.coalesce(alike, F.lit(False))

    windows = F.sort_array(F.transform(F.slice(hashes, F.lit(1), n - 2), packed))
    repeated = bind(
        windows,
        lambda s: F.filter(s, lambda x, i: same(x, F.get(s, i + 1)) | same(x, F.get(s, i - 1))),
    )
    covered = bind(
        F.sort_array(F.transform(repeated, lambda x: x.bitwiseAND(low))),
        lambda p: F.aggregate(
            F.transform(
                p, lambda at, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - at, F.lit(3)))
            ),
            F.lit(0).cast("long"),
            lambda total, x: total + x,
        ),
    )
    return F.when(n > 3, covered).otherwise(F.lit(0))


def with_statistics(documents: DataFrame, text: str = "text", into: str = "statistics") -> DataFrame:
    """Add one struct column of statistics of each whole text.

    The struct comes out of a generator, which filters on it cannot pass: pushed below it they would
    count the text again for every place that a nested expression uses it.
    """
    value, listed, hashed, mask, lines = (
        free_name(documents, c) for c in ("_text", "_words", "_hashes", "_mask", "_lines")
    )
    prepared = (
        documents.withColumn(value, F.coalesce(F.col(f"`{text}`"), F.lit("")))
        .withColumn(listed, words(F.col(value), WORD_GAP))
        .withColumn(hashed, F.transform(F.col(listed), lambda x: F.xxhash64(x)))
        .withColumn(mask, _position_bits(F.size(listed)))
        .withColumn(
            lines,
            F.filter(F.split(F.col(value), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        )
    )
    t, w, ln = F.col(value), F.col(listed), F.col(lines)
    counted = {
        "n_words": F.size(w),
        "word_chars": F.char_length(F.array_join(w, "")),
        "n_symbols": _count_of(t, SYMBOLS),
        "n_dup_lines": F.size(ln) - F.size(F.array_distinct(ln)),
        "n_repeat_words": _repeat_words(w, F.col(hashed), F.col(mask)),
        "n_lines": F.size(ln),
        "n_capitals": _count_of(t, CAPITALS),
        "n_marks": _count_of(t, MARKS),
    }
    struct = F.struct(*(c.cast("long").alias(name) for name, c in counted.items()))
    kept = [F.col(f"`{c}`") for c in documents.columns if c != into]
    return prepared.select(*kept, F.explode(F.array(struct)).alias(into))


def features(s: Column) -> dict[str, Column]:
    """Scale-free numbers of a statistics struct: they do not depend on the text's length."""

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(part / F.when(whole > 0, whole), F.lit(0.0))

    return {
        "mean_word_chars": share(s["word_chars"], s["n_words"]),
        "symbol_share": share(s["n_symbols"], s["word_chars"]),
        "mark_share": share(s["n_marks"], s["word_chars"]),
        "capital_share": share(s["n_capitals"], s["word_chars"]),
        "repeat_share": share(s["n_repeat_words"], s["n_words"]),
        "duplicate_line_share": share(s["n_dup_lines"], s["n_lines"]),
    }


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


@dataclass(frozen=True)
class Condition:
    """``feature >= threshold`` or ``feature < threshold``."""

    feature: str
    at_least: bool
    threshold: float

    def column(self, values: dict[str, Column]) -> Column:
        value = values[self.feature]
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; ``uncovered`` labelled rejects meet none of them."""

    rules: tuple[tuple[Condition, ...], ...] = ()
    uncovered: int = 0

    def rule(self, s: Column) -> Column:
        """Number of the first rule that holds, from 1; 0 if none does."""
        values = features(s)
        found = F.lit(0)
        for i, conditions in reversed(list(enumerate(self.rules, 1))):
            holds = reduce(lambda a, b: a & b, (c.column(values) for c in conditions))
            found = F.when(holds, F.lit(i)).otherwise(found)
        return found

    def __str__(self) -> str:
        return "\n".join(" and ".join(map(str, r)) for r in self.rules)


@dataclass(frozen=True)
class Learner:
    """Parameters of sequential covering.

    Rules are added as long as one is found that is precise and covers enough; a rule that is not
    precise is not the end, the next best feature or direction comes first then. Conditions are added as long as
    they gain information. precision: least share of rejects among the pruning rows that a rule covers.
    support: least number of rejects that a rule covers among the growing rows.
    gain: least information, in bits over the covered rejects, that a further condition must bring.
    quantiles: cut points per feature, taken within each class.
    """

    precision: float = 0.95
    support: int = 10
    gain: float = 2.0
    quantiles: tuple[float, ...] = field(
        default=(0.001, 0.01, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99, 0.999)
    )

    def fit(self, labelled: DataFrame, statistics: str, reject: Column) -> DecisionList:
        """Learn from rows with a statistics struct and a boolean ``reject`` column."""
        values = features(F.col(statistics))
        rows = labelled.select(
            reject.alias("reject"),
            (F.pmod(F.xxhash64(F.col(statistics)), F.lit(3)) == 0).alias("prune"),
            *(c.alias(name) for name, c in values.items()),
        ).filter("reject IS NOT NULL")
        cuts = self._cuts(rows)
        if not any(cuts.values()):
            return DecisionList()
        bins = {
            f: reduce(lambda a, b: a + b, (F.when(F.col(f) >= c, 1).otherwise(0) for c in cuts[f]))
            if cuts[f]
            else F.lit(0)
            for f in FEATURES
        }
        cells = stage(
            rows.groupBy("reject", "prune", *(c.alias(f) for f, c in bins.items())).agg(
                F.count(F.lit(1)).alias("n")
            ),
            "quality-cells",
        )
        rules: list[tuple[tuple[str, bool, int], ...]] = []
        rest, failed = cells, set()
        while grown := self._grow(rest, failed):
            rule = self._prune(rest, grown)
            if rule:
                rules.append(rule)
                # Every rule covers rejects that no earlier one did, so this ends.
                rest, failed = stage(rest.filter(~self._holds(rule)), "quality-cells"), set()
            else:
                failed.add(grown[0][:2])
        left = rest.filter("reject").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        return DecisionList(tuple(self._conditions(r, cuts) for r in rules), left)

    @staticmethod
    def _conditions(rule, cuts) -> tuple[Condition, ...]:
        """Thresholds instead of bins; of several bounds on one side only the tightest."""
        tightest: dict[tuple[str, bool], int] = {}
        for f, up, b in rule:
            choose = max if up else min
            tightest[f, up] = choose(b, tightest.get((f, up), b))
        return tuple(Condition(f, up, cuts[f][b - 1]) for (f, up), b in tightest.items())

    def _cuts(self, rows: DataFrame) -> dict[str, list[float]]:
        found = (
            rows.groupBy("reject")
            .agg(*(F.percentile_approx(f, list(self.quantiles), 10_000).alias(f) for f in FEATURES))
            .collect()
        )
        return {f: sorted({x for r in found for x in r[f] or ()}) for f in FEATURES}

    @staticmethod
    def _holds(rule) -> Column:
        tests = [(F.col(f) >= b) if up else (F.col(f) < b) for f, up, b in rule]
        return reduce(lambda a, b: a & b, tests)

    def _grow(self, cells: DataFrame, failed):
        """Conditions of the most gain, one after the other; the first has a feature and direction that
        is not among ``failed``."""
        rule: list[tuple[str, bool, int]] = []
        rows = cells.filter("NOT prune")
        while True:
            covered = rows.filter(self._holds(rule)) if rule else rows
            hist = (
                covered.select(
                    "reject",
                    "n",
                    F.explode(
                        F.array(*(F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in FEATURES))
                    ).alias("x"),
                )
                .groupBy("x.f", "x.b", "reject")
                .agg(F.sum("n").alias("n"))
                .collect()
            )
            best = self._best(hist, failed if not rule else ())
            if best is None:
                break
            condition, bad = best
            rule.append(condition)
            if bad == 0:
                break  # no condition can add to it
        return tuple(rule)

    def _best(self, hist, failed):
        """The condition of the highest information gain, as (condition, clean rows it covers)."""
        from math import log2

        counts: dict[str, dict[int, list[int]]] = {}
        for r in hist:
            counts.setdefault(r["f"], {}).setdefault(r["b"], [0, 0])[bool(r["reject"])] += r["n"]
        first = next(iter(counts.values()), {})
        clean, rejects = (sum(c[k] for c in first.values()) for k in (0, 1))
        if not rejects or not clean:
            return None
        before = log2(rejects / (rejects + clean))
        best = None
        for f in FEATURES:
            below = [0, 0]
            for b in sorted(counts.get(f, ())):
                if below != [0, 0]:
                    over = [clean - below[0], rejects - below[1]]
                    for up, (bad, good) in ((True, over), (False, below)):
                        if good >= self.support and bad + good < clean + rejects and (f, up) not in failed:
                            gain = good * (log2(good / (good + bad)) - before)
                            if gain > self.gain and (best is None or gain > best[0] + 1e-9):
                                best = (gain, (f, up, b), bad)
                below = [below[k] + counts[f][b][k] for k in (0, 1)]
        return best and (best[1], best[2])

    def _prune(self, cells: DataFrame, rule):
        """The prefix of the rule that does best on the pruning rows, if it is precise enough."""
        prefixes = [rule[: i + 1] for i in range(len(rule))]
        row = (
            cells.filter("prune")
            .agg(
                *(
                    F.coalesce(F.sum(F.when(self._holds(p) & (F.col("reject") == k), F.col("n"))), F.lit(0)).alias(
                        f"n_{i}_{k}"
                    )
                    for i, p in enumerate(prefixes)
                    for k in (False, True)
                )
            )
            .first()
        )
        scored = []
        for i, p in enumerate(prefixes):
            bad, good = row[f"n_{i}_False"], row[f"n_{i}_True"]
            if good and good / (good + bad) >= self.precision:
                scored.append((good - bad, -i, p))
        return max(scored, default=(0, 0, ()))[2]


def learn(statistics: DataFrame, labels: DataFrame, key: str = "doc_id", learner: Learner | None = None) -> DecisionList:
    """Fit on the rows of ``statistics`` (key, statistics) whose key has a quality label."""
    marked = labels.groupBy(F.col(key).alias("_key")).agg(F.min("quality").alias("_quality"))
    joined = statistics.join(marked, F.col(key) == F.col("_key"))
    return (learner or Learner()).fit(joined, "statistics", F.col("_quality") == 0)
