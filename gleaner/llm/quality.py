"""Quality by weak supervision: rules vote or abstain, and their accuracies are estimated from how they agree.

No labels are used. Every rule calls a document good (+1), bad (-1) or abstains
(0). A label model with one accuracy per rule and kind of document, fitted by
expectation maximisation on the counts of vote patterns, weighs the votes; a document is kept
where its posterior probability of being good is high enough. A single bad vote
does not drop a document, as it would if every rule had to pass.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import words_of
from gleaner.session import materialised

WINDOW = 5


def signals(text: Column) -> Column:
    """struct of counts over a whole text; null counts as empty.

    n_words, word_chars (code points in words), n_symbols (characters of
    #*$%&|<>), n_dup_lines (lines with a word that equal an earlier line),
    n_repeat_words (words inside 5-word windows that occur twice or more, the first
    included), n_lines (lines with a word), n_distinct (distinct words), n_upper (upper-case letters).
    """
    body = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    inner = F.struct(body.alias("body"), words_of(text).alias("words"), lines.alias("lines"))
    return _let(inner, _counts)


def _counts(t: Column) -> Column:
    words, body = t["words"], t["body"]
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size(t["lines"]) - F.size(F.array_distinct(t["lines"]))).cast("long").alias("n_dup_lines"),
        repeated_words(words).alias("n_repeat_words"),
        F.size(t["lines"]).cast("long").alias("n_lines"),
        F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
        F.length(F.regexp_replace(body, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
    )


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie inside windows that occur twice or more.

    Windows are compared by 64-bit hashes. Only where some are equal they are
    sorted; equal windows then stand side by side, and the starts of repeated windows, in order, cover
    min(``window``, distance to the next start) words each.
    """
    count = F.size(words) - (window - 1)
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    codes = F.transform(words, lambda w: F.xxhash64(w))
    hashes = _let(codes, lambda c: F.transform(starts, lambda i: F.xxhash64(*[F.get(c, i + k) for k in range(window)])))

    def again(pairs: Column) -> Column:
        twice = F.transform(
            pairs,
            lambda p, k: F.when((F.get(pairs, k + 1)["c"] == p["c"]) | (F.get(pairs, k - 1)["c"] == p["c"]), p["i"]),
        )
        return F.sort_array(F.filter(twice, lambda i: i.isNotNull()))

    def covered(starts: Column) -> Column:
        widths = F.transform(
            starts, lambda i, k: F.least(F.coalesce(F.get(starts, k + 1), i + window) - i, F.lit(window))
        )
        return F.aggregate(widths, F.lit(0).cast("long"), lambda a, x: a + x)

    def of_hashes(codes: Column) -> Column:
        pairs = F.sort_array(F.transform(codes, lambda c, i: F.struct(c.alias("c"), i.cast("long").alias("i"))))
        return F.when(F.size(F.array_distinct(codes)) == F.size(codes), F.lit(0).cast("long")).otherwise(
            _let(_let(pairs, again), covered)
        )

    return _let(hashes, of_hashes)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


@dataclass(frozen=True)
class Rule:
    """Good where ``value`` lies in ``good``, bad where it lies outside ``fair``, else no vote. Bounds belong to both ranges."""

    name: str
    value: Column
    good: tuple[float, float]
    fair: tuple[float, float]

    def vote(self) -> Column:
        v = self.value
        return (
            F.when(v.isNull(), 0)
            .when((v >= self.good[0]) & (v <= self.good[1]), 1)
            .when((v < self.fair[0]) | (v > self.fair[1]), -1)
            .otherwise(0)
        )


def rules(counts: str) -> list[Rule]:
    """The rules over a column that holds ``signals``."""

    def c(name: str) -> Column:
        return F.col(f"{counts}.{name}").cast("double")

    def share(part: str, whole: str) -> Column:
        return F.when(c(whole) > 0, c(part) / c(whole))

    inf = math.inf
    return [
        Rule("length", c("n_words"), (30, inf), (10, inf)),
        Rule("word_size", share("word_chars", "n_words"), (3.5, 9), (2.5, 13)),
        Rule("symbols_by_word", share("n_symbols", "n_words"), (0, 0.02), (0, 0.1)),
        Rule("symbols_by_size", share("n_symbols", "word_chars"), (0, 0.005), (0, 0.02)),
        Rule("lines", share("n_dup_lines", "n_lines"), (0, 0.1), (0, 0.4)),
        Rule("repeats", share("n_repeat_words", "n_words"), (0, 0.05), (0, 0.15)),
        Rule("capitals", share("n_upper", "word_chars"), (0, 0.1), (0, 0.25)),
        Rule("variety", F.when(c("n_words") >= 100, c("n_distinct") / F.sqrt(c("n_words"))), (5, inf), (3, inf)),
    ]


@dataclass(frozen=True)
class LabelModel:
    """log_odds: of a good document before any vote; weights: (name, added by a good vote, added by a bad vote)."""

    log_odds: float
    weights: tuple[tuple[str, float, float], ...]

    def posterior(self, votes: str) -> Column:
        total = F.lit(self.log_odds)
        for name, good, bad in self.weights:
            v = F.col(f"{votes}.{name}")
            total = total + F.when(v > 0, F.lit(good)).when(v < 0, F.lit(bad)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def fit(votes: DataFrame, names: Sequence[str], rounds: int = 25, prior: float = 0.9, on_good: float = 0.99, on_bad: float = 0.4) -> LabelModel:
    """Fits the label model on all rows of ``votes`` by expectation maximisation.

    The votes are first counted by pattern; with m rules there are at most 3^m
    patterns, so the rounds run over one row that holds them, whatever the number of
    documents, and one row of parameters comes to the driver. A rule's chance of
    voting right, given that it votes, is estimated for good and for bad documents,
    from ``on_good`` and ``on_bad`` on. A bad document need not break most rules,
    so a rule may be wrong about most of them; but it is held to this: a bad vote
    never speaks for a document, nor a good one against it. The share of good documents starts at
    ``prior`` and stays between 0.05 and 0.95. Without rows the start values stay.
    """
    counted = votes.groupBy(*names).agg(F.count("*").cast("double").alias("n"))
    pattern = F.struct(F.array(*[F.col(k).cast("int") for k in names]).alias("votes"), "n")
    # Sorted, so that sums are added in one order and reruns agree to the last digit.
    patterns = counted.agg(F.sort_array(F.collect_list(pattern)).alias("patterns"))
    start = F.struct(
        F.lit(prior).alias("share"),
        F.array(*[F.struct(F.lit(on_good).alias("good"), F.lit(on_bad).alias("bad")) for _ in names]).alias("right"),
    )
    fitted = F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)), start, lambda model, _: _round(F.col("patterns"), model, len(names), on_good, on_bad)
    )
    found = patterns.select(F.when(F.size("patterns") > 0, fitted).otherwise(start).alias("model")).first()["model"]
    return _model(found["share"], {k: (r["good"], r["bad"]) for k, r in zip(names, found["right"], strict=True)})


#: Chances of voting right are held inside these. The lower bounds add up to more than 1, so votes keep their direction.
BOUNDS = {"good": (0.98, 0.999), "bad": (0.1, 0.99)}


def _round(patterns: Column, model: Column, n_rules: int, on_good: float, on_bad: float) -> Column:
    """One round: the posterior of every pattern, and the parameters that the posteriors give."""
    weights = F.transform(
        model["right"],
        lambda r: F.struct(F.log(r["good"] / (1 - r["bad"])).alias("up"), F.log((1 - r["good"]) / r["bad"]).alias("down")),
    )

    def weighed(p: Column, w: Column) -> Column:
        votes = F.zip_with(
            p["votes"], w, lambda v, x: F.when(v > 0, x["up"]).when(v < 0, x["down"]).otherwise(F.lit(0.0))
        )
        odds = F.aggregate(votes, F.log(model["share"] / (1 - model["share"])), lambda a, x: a + x)
        return F.struct(p["votes"].alias("votes"), p["n"].alias("n"), (p["n"] / (1 + F.exp(-odds))).alias("good"))

    def parameters(posterior: Column) -> Column:
        def total(part: Callable[[Column], Column]) -> Column:
            return F.aggregate(posterior, F.lit(0.0), lambda a, p: a + part(p))

        def right(rule: int, kind: str) -> Column:
            def mass(p: Column) -> Column:
                return p["good"] if kind == "good" else p["n"] - p["good"]

            def voted(p: Column) -> Column:
                return F.get(p["votes"], rule)

            hit = total(lambda p: F.when(voted(p) > 0 if kind == "good" else voted(p) < 0, mass(p)).otherwise(F.lit(0.0)))
            cast = total(lambda p: F.when(voted(p) != 0, mass(p)).otherwise(F.lit(0.0)))
            # One imagined vote at the start value keeps a rule without votes where it was.
            return _between((hit + (on_good if kind == "good" else on_bad)) / (cast + 1), *BOUNDS[kind])

        share = _between(total(lambda p: p["good"]) / total(lambda p: p["n"]), 0.05, 0.95)
        rights = [F.struct(right(k, "good").alias("good"), right(k, "bad").alias("bad")) for k in range(n_rules)]
        return F.struct(share.alias("share"), F.array(*rights).alias("right"))

    posterior = _let(weights, lambda w: F.transform(patterns, lambda p: weighed(p, w)))
    return _let(posterior, parameters)


def _between(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def _model(share: float, right: dict[str, tuple[float, float]]) -> LabelModel:
    weights = tuple((k, math.log(g / (1 - b)), math.log((1 - g) / b)) for k, (g, b) in right.items())
    return LabelModel(math.log(share / (1 - share)), weights)


def base_failed(counts: str) -> Column:
    """Fewer than 10 words, or more than a fifth of them in repeated windows."""
    n, repeated = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (n < 10) | (100 * repeated > 20 * n)


def judged(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, counts, votes, posterior, base_failed, kept) for every row of ``docs``.

    ``kept`` is false where ``base_failed``, else whether the posterior is at
    least ``threshold``. Null and blank texts have zero counts and fail the base;
    equal texts are judged alike. Reads doc_id and text only; texts are read once.
    """
    counted = materialised(docs.select("doc_id", signals(F.col("text")).alias("counts")), "signals")
    table = rules("counts")
    voted = counted.withColumn("votes", F.struct(*[r.vote().alias(r.name) for r in table]))
    model = fit(voted.select("votes.*"), [r.name for r in table])
    return (
        voted.withColumn("posterior", model.posterior("votes"))
        .withColumn("base_failed", base_failed("counts"))
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
    )


def good_documents(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that ``judged`` would keep, with all their columns. Texts are read and written once."""
    counted = materialised(docs.select(F.struct("*").alias("doc"), signals(F.col("text")).alias("counts")), "counted")
    table = rules("counts")
    voted = counted.withColumn("votes", F.struct(*[r.vote().alias(r.name) for r in table]))
    model = fit(voted.select("votes.*"), [r.name for r in table])
    return voted.where(~base_failed("counts") & (model.posterior("votes") >= threshold)).select("doc.*")
