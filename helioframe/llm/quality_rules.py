"""Quality rules by weak supervision, in DataFrame expressions only.

Each rule votes good (1), bad (-1) or abstains (0) on a document. Expectation-
maximisation over the table of vote patterns estimates how often each rule gives each
vote on good documents and on every kind of bad ones (its coverage and accuracy), and
the share of each; a document's posterior probability of being good replaces an
all-rules-must-pass filter.

Scale: counts come from one map over the texts, written once with the votes. The
patterns are at most 3 ** rules rows, pre-aggregated before their only shuffle; the
rounds run over those rows on the driver, so no plan is made anew for each round, and
documents get their pattern's posterior by a broadcast of the same bound. No document is
shuffled.

Defined cases: a null text has no words; a text without words gets votes only from
rules that need none, and fails the base rule; an empty table gives an empty result;
rows are judged one by one, so repeated rows and ids get equal verdicts; carried
columns stay inside ``row`` and cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, fsum, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.session import stage

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
ROUNDS = 10
SMOOTHING = 1.0
GOOD, BAD, ABSTAIN = VOTES = 1, -1, 0


def base_counts(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` and the counts of the text: all exact, all linear in its length but for one sort."""
    t, w = F.col("t"), F.col("w")
    out = docs.select(
        F.struct(*[F.col(c) for c in keep or docs.columns]).alias("row"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"),
    )
    out = out.select(
        "row", "t",
        F.filter(F.split(t, SPACE), lambda x: x != "").alias("w"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    out = out.select(
        "row", "t", "w", "lines", F.size(w).alias("n"),
        F.expr(
            "CASE WHEN size(w) >= 3 THEN transform(sequence(0, size(w) - 3),"
            " i -> xxhash64(get(w, i), get(w, i + 1), get(w, i + 2))) ELSE array() END"
        ).alias("k"),
    )
    out = out.withColumn("s", F.sort_array("k"))
    out = out.withColumn("twice", F.expr("size(filter(s, (x, i) -> i > 0 AND x = get(s, i - 1))) > 0"))
    out = out.withColumn(
        "by_key", F.expr("CASE WHEN twice THEN sort_array(transform(k, (h, i) -> struct(h AS h, i AS i))) END")
    )
    out = out.withColumn(
        "starts",
        F.expr(
            "sort_array(transform(filter(by_key, (x, j) -> (j > 0 AND get(by_key, j - 1).h = x.h)"
            " OR (j < size(by_key) - 1 AND get(by_key, j + 1).h = x.h)), x -> x.i))"
        ),
    )
    size = lambda c: F.size(c).cast("bigint")
    left = lambda chars: F.length(F.translate(t, chars, "")).cast("bigint")
    return out.select(
        "row",
        size("w").alias("n_words"),
        left(" \t\n\x0b\f\r").alias("word_chars"),
        (F.length(t) - left(SYMBOLS)).cast("bigint").alias("n_symbols"),
        (size("lines") - size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.expr(
            "CAST(coalesce(aggregate(starts, named_struct('last', -9, 'n', 0), (a, p) ->"
            " named_struct('last', p, 'n', a.n + least(3, p - a.last)), a -> a.n), 0) AS BIGINT)"
        ).alias("n_repeat_words"),
        size("lines").alias("n_lines"),
        size(F.array_distinct("w")).alias("n_distinct"),
        (F.length(t) - left("!")).alias("n_shouts"),
        F.length(F.regexp_replace(t, r"\P{Lu}+", "")).cast("bigint").alias("n_upper"),
        F.length(F.regexp_replace(t, r"\P{L}+", "")).cast("bigint").alias("n_letters"),
        size(F.filter("lines", lambda x: x.rlike(r"[.!?:;\"'»”)][\x20\x09-\x0D]*$"))).alias("n_ended"),
    )


def _vote(bad: Column, good: Column | None = None) -> Column:
    """A rule without ``good`` only ever votes bad: passing it says nothing about the rest."""
    said = F.when(bad, BAD)
    return (said if good is None else said.when(good, GOOD)).otherwise(ABSTAIN)


def rules() -> dict[str, Column]:
    """Votes over the counts. Thresholds are shares of words, letters or lines."""
    n, some = F.col("n_words"), F.col("n_words") > 0
    mean = F.try_divide(F.col("word_chars"), n)  # null without words
    return {
        "symbols": _vote(F.col("n_symbols") * 10 > n),
        "dup_lines": _vote(F.col("n_dup_lines") * 10 > F.col("n_lines") * 4),
        "repeats": _vote(F.col("n_repeat_words") * 10 > n * 4),
        "shouts": _vote(F.col("n_shouts") * 4 > n),
        "capitals": _vote(F.col("n_upper") * 2 > F.col("n_letters")),
        "variety": _vote((n >= 30) & (F.col("n_distinct") * 10 < n) & (F.col("n_distinct") < 300)),
        "word_length": _vote(some & ((mean < 2) | (mean > 14)), some & mean.between(3, 9)),
        "letters": _vote(
            some & (F.col("n_letters") * 10 < F.col("word_chars") * 6),
            some & (F.col("n_letters") * 10 >= F.col("word_chars") * 8),
        ),
        "sentences": _vote(
            (F.col("n_lines") >= 3) & (F.col("n_ended") * 10 < F.col("n_lines")),
            (F.col("n_lines") > 0) & (F.col("n_ended") * 10 >= F.col("n_lines") * 7),
        ),
    }


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * n)


@dataclass
class Model:
    """``priors[k]``, and ``rates[rule][vote][k]``: how often kind k gets that vote. Kind 0 is
    good, kind k the sort of bad document that rule k was made for."""

    priors: list[float]
    rates: dict[str, dict[int, list[float]]]

    def accuracy(self, rule: str) -> float | None:
        """Share of the rule's votes that agree with good or bad; None if it never votes."""
        joint = {v: [p * r for p, r in zip(self.priors, self.rates[rule][v], strict=True)] for v in (GOOD, BAD)}
        right = joint[GOOD][0] + sum(joint[BAD][1:])
        cast = sum(map(sum, joint.values()))
        return right / cast if cast else None


def with_shares(df: DataFrame, names: list[str], model: Model) -> DataFrame:
    """Adds ``q0`` (posterior of good), ``q1`` ... of the other kinds.

    Built in three projections, so each sum of logs is planned and computed once.
    """
    kinds = range(len(model.priors))
    logs = {}
    for kind in kinds:
        total = F.lit(log(model.priors[kind]))
        for name in names:
            step = {v: log(model.rates[name][v][kind]) for v in VOTES}
            vote = F.col(name)
            total = total + F.when(vote == GOOD, step[GOOD]).when(vote == BAD, step[BAD]).otherwise(step[ABSTAIN])
        logs[f"q{kind}"] = total
    out = df.withColumns(logs)
    out = out.withColumn("q_most", F.greatest(*[F.col(f"q{k}") for k in kinds]))
    out = out.withColumns({f"q{k}": F.exp(F.col(f"q{k}") - F.col("q_most")) for k in kinds})
    out = out.withColumn("q_all", sum((F.col(f"q{k}") for k in kinds), F.lit(0.0)))
    return out.withColumns({f"q{k}": F.col(f"q{k}") / F.col("q_all") for k in kinds}).drop("q_most", "q_all")


def fit(patterns: DataFrame, names: list[str], rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over good documents and one kind of bad ones per rule.

    Bad documents differ in kind, so votes are independent only within a kind; with a
    single bad class the estimate would follow its largest kind and call the others
    good. The first round shares a document with bad votes among the kinds of those
    rules. ``patterns`` has one row for each pattern of votes and its ``count``.
    """
    kinds = range(len(names) + 1)
    model = Model([1 / len(kinds)] * len(kinds), {n: {v: [1 / 3] * len(kinds) for v in VOTES} for n in names})
    # At most 3 ** 9 rows, however many documents there are.
    known = [([r[n] for n in names], r["count"]) for r in patterns.select(*names, "count").collect()]
    shared = []
    for votes, _ in known:
        bad = sum(v == BAD for v in votes)
        others = [0.95 * (v == BAD) / bad if bad else 0.05 / len(names) for v in votes]
        shared.append([0.05 if bad else 0.95, *others])
    for _ in range(rounds if known else 0):
        sums = [fsum(q[k] * n for q, (_, n) in zip(shared, known)) for k in kinds]
        model.priors = [(s + SMOOTHING) / (sum(sums) + SMOOTHING * len(sums)) for s in sums]
        for i, name in enumerate(names):
            for v in VOTES:
                mine = [(q, n) for q, (votes, n) in zip(shared, known) if votes[i] == v]
                model.rates[name][v] = [(fsum(q[k] * n for q, n in mine) + SMOOTHING) / (sums[k] + 3 * SMOOTHING) for k in kinds]
        steps = [{v: [log(x) for x in model.rates[name][v]] for v in VOTES} for name in names]
        start = [log(p) for p in model.priors]
        for at, (votes, _) in enumerate(known):
            logs = [start[k] + sum(step[v][k] for step, v in zip(steps, votes)) for k in kinds]
            most = max(logs)
            weights = [exp(x - most) for x in logs]
            shared[at] = [w / sum(weights) for w in weights]
    return model


def assess(docs: DataFrame, text: str = "text", keep: list[str] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """``row`` (columns ``keep``, else all), the counts, one column per rule, ``quality``
    (posterior probability of good), ``base_failed`` and ``kept``."""
    votes = rules()
    names = list(votes)
    judged = stage(base_counts(docs, text, keep).select("*", *[v.alias(n) for n, v in votes.items()]), "votes")
    patterns = stage(judged.groupBy(*names).count(), "patterns")
    # One posterior for each pattern; a pattern's documents get it by their votes.
    weighed = with_shares(patterns, names, fit(patterns, names, rounds)).select(*names, F.col("q0").alias("quality"))
    return (
        judged.join(F.broadcast(weighed), names)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
    )
