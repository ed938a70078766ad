"""Operator 10: quality rules from a learned decision list, native.

Word and line statistics are column expressions. A list of threshold conjunctions is learned by
sequential covering: a rule grows by the condition with the best information gain, is pruned
back on held-out rows, and takes the rows it covers with it. The list becomes one Spark CASE.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = "[\\x20\\x09-\\x0D]+"
FEATURES = ("symbol_share", "dup_line_share", "repeat_share", "upper_share", "mean_word", "n_words")
#: At most so many labelled documents, chosen by a hash of their id, are fitted on.
TRAINING_ROWS = 4000


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, ``>`` or ``<=``, threshold) that rejects a document."""

    conditions: tuple[tuple[str, str, float], ...]

    def covers(self, row: dict) -> bool:
        return all((row[f] > t) if op == ">" else (row[f] <= t) for f, op, t in self.conditions)

    def column(self) -> Column:
        out = F.lit(True)
        for f, op, t in self.conditions:
            out = out & (F.col(f) > t if op == ">" else F.col(f) <= t)
        return out


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the shares of them.

    Null and empty texts have no words; every share of nothing is 0.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    df = df.withColumn("__body", body).withColumn("__words", F.array_remove(F.split("__body", BLANKS), ""))
    df = df.withColumn("n_words", F.size("__words").cast("long")).withColumn("__joined", F.array_join("__words", ""))
    df = df.withColumn(
        "__windows",
        F.when(
            F.col("n_words") >= 3,
            F.expr("transform(sequence(0, size(__words) - 3), i -> xxhash64(__words[i], __words[i + 1], __words[i + 2]))"),
        ).otherwise(F.expr("array(0L)")),
    )
    lines = F.expr(f"filter(split(__body, '\n', -1), x -> x rlike '{_escaped('[^' + BLANKS[1:-2] + ']')}')")
    df = df.withColumn("__lines", lines)
    # Windows found twice, in order of place; words covered = 3 each, less the overlap with the one before.
    order = "sort_array(transform(__windows, (x, i) -> struct(x AS x, i AS i)))"
    df = df.withColumn("__twice", F.when(F.size(F.array_distinct("__windows")) < F.size("__windows"), F.expr(order)))
    df = df.withColumn(
        "__twice",
        F.expr(
            "sort_array(transform(filter(transform(__twice, (w, j) -> struct(w.i AS i, "
            "(j > 0 AND get(__twice, j - 1).x = w.x) OR (j + 1 < size(__twice) AND get(__twice, j + 1).x = w.x) AS r)), "
            "w -> w.r), w -> w.i))"
        ),
    )
    covered = F.expr(
        "3 * size(__twice) - aggregate(transform(__twice, (p, j) -> IF(j = 0, 0, "
        "greatest(0, 3 - (p - get(__twice, j - 1))))), 0, (a, b) -> a + b)"
    )
    base = {
        "n_words": F.col("n_words"),
        "word_chars": F.char_length("__joined").cast("long"),
        "n_symbols": (F.char_length("__joined") - F.char_length(F.regexp_replace("__joined", "[#*$%&|<>]+", ""))).cast("long"),
        "n_upper": (F.char_length("__joined") - F.char_length(F.regexp_replace("__joined", "\\p{Lu}+", ""))).cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": F.when(F.col("__twice").isNull(), 0).otherwise(covered).cast("long"),
    }
    # Through a generator of one row: a later filter on these columns is not pushed into their
    # making, where Catalyst would repeat the expressions for every use.
    packed = F.explode(F.array(F.struct(*[c.alias(n) for n, c in base.items()])))
    df = df.withColumn("__stats", packed).drop("__body", "__words", "__joined", "__windows", "__lines", "__twice", "n_words")
    df = df.withColumns({n: F.col(f"__stats.{n}") for n in base}).drop("__stats")

    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)

    return df.withColumns(
        {
            "symbol_share": share("n_symbols", "word_chars"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "upper_share": share("n_upper", "word_chars"),
            "mean_word": share("word_chars", "n_words"),
        }
    ).drop("n_upper", "n_lines")


def _escaped(pattern: str) -> str:
    return pattern.replace("\\", "\\\\")


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def labelled_rows(documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> list[dict]:
    """Statistics of at most ``rows`` labelled documents, spread by a hash of the id; a document
    with several labels counts as bad if one of them says so. The result is bounded by ``rows``."""
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64(F.lit("train"), "doc_id"), "doc_id").limit(rows)
    )
    texts = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"])
    got = with_statistics(texts).where(~base_failed()).select("doc_id", "quality", *FEATURES)
    return sorted((r.asDict() for r in got.collect()), key=lambda r: r["doc_id"])


def _gain(p0: int, n0: int, p1: int, n1: int) -> float:
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0))) if p1 else 0.0


def _cuts(rows: list[dict], feature: str, count: int) -> list[float]:
    values = sorted({r[feature] for r in rows})
    step = max(1, len(values) // count)
    return [(a + b) / 2 for a, b in zip(values, values[1:])][::step]


def learn(rows: list[dict], target: str = "quality", bad: int = 0, max_rules: int = 8, max_conditions: int = 3,
          cuts: int = 32, precision: float = 0.9, support: int = 5) -> list[Rule]:
    """An ordered list of rules that reject, learned by sequential covering.

    Every third row is held out for pruning. Learning ends when a new rule, pruned, is right on
    fewer than ``precision`` of all rows left, covers fewer than ``support`` bad ones, or nothing
    bad is left. No rows, or rows of one class, give an empty list.
    """
    left, rules = list(rows), []
    while len(rules) < max_rules and any(r[target] == bad for r in left):
        grow = [r for i, r in enumerate(left) if i % 3] or left
        held = left[::3]
        conditions, inside = [], grow
        while len(conditions) < max_conditions:
            p0 = sum(r[target] == bad for r in inside)
            n0 = len(inside) - p0
            if not p0 or not n0:
                break
            best = (0.0, None)
            for f in FEATURES:
                for t in _cuts(inside, f, cuts):
                    over = [r for r in inside if r[f] > t]
                    p = sum(r[target] == bad for r in over)
                    n = len(over) - p
                    best = max(best, (_gain(p0, n0, p, n), (f, ">", t)), (_gain(p0, n0, p0 - p, n0 - n), (f, "<=", t)), key=lambda x: x[0])
            if best[1] is None:
                break
            conditions.append(best[1])
            inside = [r for r in inside if Rule((best[1],)).covers(r)]
        if not conditions:
            break

        def worth(size: int) -> float:
            got = [r for r in held if Rule(tuple(conditions[:size])).covers(r)]
            p = sum(r[target] == bad for r in got)
            return (2 * p - len(got)) / len(got) if got else -1.0

        size = max(range(1, len(conditions) + 1), key=lambda s: (worth(s), -s))
        rule = Rule(tuple(conditions[:size]))
        got = [r for r in left if rule.covers(r)]
        p = sum(r[target] == bad for r in got)
        if p < support or p < precision * len(got):
            break
        rules.append(rule)
        left = [r for r in left if not rule.covers(r)]
    return rules


def decision(rules: list[Rule]) -> Column:
    """Number of the first rule that rejects the row, null if none does."""
    out = F.lit(None).cast("int")
    for i in range(len(rules) - 1, -1, -1):
        out = F.when(rules[i].column(), i).otherwise(out)
    return out


def judged(documents: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """``documents`` with the statistics, ``base_failed``, ``rule`` and ``kept``."""
    df = with_statistics(documents, text).withColumn("base_failed", base_failed()).withColumn("rule", decision(rules))
    return df.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
