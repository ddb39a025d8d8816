"""Quality rules combined by weak supervision, in DataFrame operations only.

Each rule votes good (1), bad (-1) or abstains (0) on a text, and rules may disagree. Expectation-maximisation over the votes
of all documents estimates, without labels, the share of good documents and, for each rule, how often it votes good and bad
on good and on bad documents; a document is kept if its posterior probability of being good reaches a threshold. An
abstention says nothing. So a bad vote of a rule that good documents hardly ever get weighs more than several good votes that
bad documents get too, and one that good documents often get weighs little.

A document's votes are one of at most 3 ** rules patterns (729), so EM runs over the counts of patterns, a table whose size
does not grow with the data; all its rounds are one SQL expression over an array of them, one Spark job.

Defined results: null, empty and blank texts have no words and fail the base rules; a text on which every rule abstains has
the estimated share of good documents as its probability; repeated rows get their own, equal results; an empty table gives an
empty one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, WORD, Scratch

#: The characters counted as symbols (a fixed value of the data contract).
SYMBOLS = "[^#*$%&|<>]+"
WINDOW = 5
#: How often a rule votes bad, abstains and votes good on good and on bad documents, and the share of good ones, before the
#: first EM round; the former also count as PSEUDO documents of each class.
ON_GOOD, ON_BAD, GOOD, PSEUDO = (0.02, 0.08, 0.9), (0.5, 0.1, 0.4), 0.8, 2.0


def _window_repeats() -> Column:
    """Words of ``w`` (word hashes) that lie in WINDOW-word windows found at least twice; ``g`` has the windows' hashes."""
    at = F.arrays_zip(F.col("g"), F.sequence(F.lit(0), F.size("g") - 1).alias("p"))
    pairs = F.sort_array(F.transform(at, lambda x: F.struct(x["g"].alias("h"), x["p"].alias("p"))))
    # A window is repeated if its neighbour in hash order has the same hash.
    same = lambda s: F.sort_array(
        F.filter(
            F.transform(
                s,
                lambda x, i: F.when((F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]), x["p"]),
            ),
            lambda p: p.isNotNull(),
        )
    )
    # Starts p1 < p2 < ... cover min(p[i + 1] - p[i], WINDOW) words each, the last one WINDOW.
    cover = lambda p: F.aggregate(
        p,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, x: F.struct((a["n"] + F.least(x - a["last"], F.lit(WINDOW))).alias("n"), x.alias("last")),
        lambda a: a["n"],
    )
    by_let = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))
    return by_let(pairs, lambda s: by_let(same(s), cover))


def measures(docs: DataFrame) -> DataFrame:
    """Counts of every whole text: the contract's, and what further rules look at."""
    text = F.coalesce(F.col("text"), F.lit(""))
    ws = F.filter(F.split(F.col("t"), SPACES), lambda x: x != "")
    lines = F.filter(F.split(F.col("t"), "\n"), lambda x: x.rlike(WORD))
    step1 = docs.select("doc_id", text.alias("t")).select(
        "doc_id",
        F.length(F.regexp_replace("t", SPACES, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("t", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace("t", r"[^!?]+", "")).cast("long").alias("n_marks"),
        lines.alias("l"),
        F.transform(ws, lambda x: F.xxhash64(x)).alias("w"),
    )
    windows = F.transform(
        F.sequence(F.lit(0), F.size("w") - WINDOW), lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)])
    )
    step2 = step1.select(
        "doc_id", "word_chars", "n_symbols", "n_upper", "n_marks",
        F.size("w").cast("long").alias("n_words"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        F.size(F.filter("w", lambda x, i: (i > 0) & (x == F.get("w", i - 1)))).cast("long").alias("n_stutters"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") >= WINDOW, windows).alias("g"),
    )
    repeats = F.when(F.size(F.array_distinct("g")) < F.size("g"), _window_repeats()).otherwise(0)
    return step2.withColumn("n_repeat_words", F.coalesce(repeats, F.lit(0)).cast("long")).drop("g")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Votes: 1 good, -1 bad, 0 abstain."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    mean = F.col("word_chars") / n
    symbols, repeats, marks, stutters = F.col("n_symbols") / n, F.col("n_repeat_words") / n, F.col("n_marks") / n, F.col("n_stutters") / n
    upper = F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1))
    # Distinct words grow about as the root of all words, so their share alone would speak against long texts.
    distinct, dups = F.col("n_distinct") / F.sqrt(n), F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    good_and_bad = {
        "symbols": (symbols <= 0.02, symbols > 0.1),
        "words": (mean.between(4.2, 6), (mean < 3) | (mean > 6.5)),
        "prose": ((n >= 30) & (symbols <= 0.02) & (upper <= 0.1) & (marks <= 0.05) & (repeats <= 0.05), (symbols > 0.1) | (upper > 0.3) | (marks > 0.2)),
        "variety": ((distinct >= 4) & (stutters <= 0.03), ((distinct < 2) & (n >= 20)) | (stutters > 0.05)),
        "repetition": ((repeats <= 0.02) & (dups <= 0.05), (repeats > 0.1) | (dups > 0.2)),
        "case": ((upper > 0) & (upper <= 0.06) & (marks <= 0.02), (upper > 0.2) | (marks > 0.2)),
    }
    return {r: F.when(bad, -1).when(good, 1).otherwise(0) for r, (good, bad) in good_and_bad.items()}


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def em_round(state: Column, patterns: Column, n_rules: int) -> Column:
    """The next state of EM: for each rule its six vote probabilities (bad, none, good; on good, on bad), then the share of
    good documents."""
    last = 6 * n_rules
    at = lambda k: F.get(state, k)

    def posterior(p: Column) -> Column:
        odds = lambda a, r, v: a + F.when(v == 0, 0.0).otherwise(F.log(at(r * 6 + v + 1)) - F.log(at(r * 6 + v + 4)))
        prior = F.log(at(F.lit(last)) / (1 - at(F.lit(last))))
        return 1 / (1 + F.exp(-F.aggregate(F.sequence(F.lit(0), F.lit(n_rules - 1)), prior, lambda a, r: odds(a, r, F.get(p["v"], r)))))

    def share(k: Column, p: Column, q: Column) -> Column:
        """What a pattern adds to the k-th sum: its documents that are good, or bad, if the k-th vote is theirs."""
        rule, vote = F.floor(k / 6).cast("int"), k % 3 - 1
        documents = p["n"] * F.when(k % 6 < 3, q).otherwise(1 - q)
        return F.when(k == last, p["n"] * q).when(F.get(p["v"], rule) == vote, documents).otherwise(0.0)

    zero = F.array_repeat(F.lit(0.0), last + 1)
    sums = F.aggregate(patterns, zero, lambda a, p: _let(posterior(p), lambda q: F.transform(a, lambda x, k: x + share(k, p, q))))
    n = F.aggregate(patterns, F.lit(0.0), lambda a, p: a + p["n"])
    start = F.array(*[F.lit(x) for x in (*ON_GOOD, *ON_BAD)])

    def estimate(s: Column) -> Column:
        good = F.get(s, F.lit(last))
        documents = lambda k: F.when(k % 6 < 3, good).otherwise(n - good)
        smoothed = lambda x, k: (x + PSEUDO * F.get(start, k % 6)) / (documents(k) + PSEUDO)
        return F.transform(s, lambda x, k: F.when(k == last, (x + 0.5) / (n + 1)).otherwise(smoothed(x, k)))

    return _let(sums, estimate)


def fit(votes: DataFrame, names: list[str], rounds: int = 30) -> list[float]:
    """EM over vote patterns: its last state, see ``em_round``."""
    counted = votes.groupBy(*names).agg(F.count("*").cast("double").alias("n"))
    pattern = F.struct(F.array(*[F.col(r).cast("int") for r in names]).alias("v"), "n")
    start = F.array(*[F.lit(x) for _ in names for x in (*ON_GOOD, *ON_BAD)], F.lit(GOOD))
    one = counted.agg(F.array_sort(F.collect_list(pattern)).alias("patterns"))  # at most 3 ** rules
    return one.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda s, _: em_round(s, F.col("patterns"), len(names)))).first()[0]


def log_odds(names: list[str], state: list[float]) -> Column:
    """Log odds of good: those of all documents, and what each vote adds to them."""
    total = F.lit(math.log(state[-1] / (1 - state[-1])))
    for k, r in enumerate(names):
        bad, _, good, bad_on_bad, _, good_on_bad = state[6 * k : 6 * k + 6]
        total = total + F.when(F.col(r) == 1, math.log(good / good_on_bad)).when(F.col(r) == -1, math.log(bad / bad_on_bad)).otherwise(0.0)
    return total


def weak_quality(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, counts, votes, base_failed, quality, kept) of every document."""
    scratch = Scratch(docs.sparkSession)
    named = rules()
    counted = measures(docs)
    voted = scratch.table(counted.select("*", *[c.alias(f"vote_{r}") for r, c in named.items()]), keep=True)
    names = [f"vote_{r}" for r in named]
    scored = voted.withColumn("quality", 1 / (1 + F.exp(-log_odds(names, fit(voted, names))))).withColumn("base_failed", base_failed())
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
