"""Quality rules as weak supervision: votes, expectation-maximisation over vote patterns, posterior. DataFrame functions only."""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import LOWER, SPACE, UPPER, WORD, any_names, checkpointed

# Frequent words of the four languages.
STOP_WORDS = (
    "the of and to in is that it was for with as on be by this are from at or an not have a "
    "de la le les et des en un une du que est pour dans qui sur au aux par ne pas "
    "der die das und ist von zu den mit sich nicht ein eine auf für dem im auch "
    "el los las y del se por con una su para al lo como más o es"
).split()
#: Rounds of expectation-maximisation at most, and the change of a parameter below which it ends.
ROUNDS, STILL = 25, 1e-4
#: What is believed of a rule before any data, as chances of a vote for and a vote against: on good and on bad documents. It
#: weighs as much as this part of all documents, which keeps the two classes from swapping or from drifting to another split.
ON_GOOD, ON_BAD, BELIEF, GOOD = (0.5, 0.02), (0.2, 0.35), 0.1, 0.85


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once a row: a name inside a lambda is not expanded."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(words: Column) -> Column:
    """Words in 3-word windows found twice or more, the first included. Windows are told apart by 64-bit hashes: sorted
    with their places, equal ones are neighbours, so a text of n words costs n log n."""

    def windows(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        return F.when(F.size(w) >= 3, F.transform(at, lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))).otherwise(
            F.array().cast("array<struct<h:bigint,i:int>>")
        )

    def places(s: Column) -> Column:
        again = F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x)

    def of(v: Column) -> Column:
        hashes = F.transform(v, lambda x: x["h"])
        return F.when(F.size(F.array_distinct(hashes)) == F.size(v), F.lit(0).cast("long")).otherwise(_let(_let(F.sort_array(v), places), covered))

    return _let(_let(words, windows), of)


def signals(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, and with ``__`` columns: counts of the whole text (null: none)."""
    keep = [c for c in docs.columns if c != text]
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    split = docs.select(*keep, t.alias("__t"), F.filter(F.split(t, SPACE, -1), lambda w: w != "").alias("__w"), F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD)).alias("__l"))
    without = lambda marks: F.length("__t") - F.length(F.translate(F.col("__t"), marks, ""))
    return split.select(
        *keep,
        F.size("__w").cast("long").alias("__n_words"),
        F.aggregate("__w", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("__word_chars"),
        without("#*$%&|<>").cast("long").alias("__n_symbols"),
        F.size("__l").cast("long").alias("__n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("__n_dup_lines"),
        repeat_words(F.col("__w")).alias("__n_repeat_words"),
        without(UPPER + "!").alias("__n_loud"),
        F.size(F.filter("__w", lambda w: F.translate(w, UPPER, LOWER).isin(STOP_WORDS))).alias("__n_stop"),
        F.size(F.filter("__l", lambda x: x.rlike(r"[.!?:;\"')][\x20\x09-\x0D]*$"))).alias("__n_ended"),
    )


def rules() -> list[tuple[str, Column, Column]]:
    """(name, votes for keeping, votes against); neither abstains."""
    c = lambda name: F.col(f"__{name}").cast("double")
    words, lines, chars = F.greatest(c("n_words"), F.lit(1.0)), F.greatest(c("n_lines"), F.lit(1.0)), F.greatest(c("word_chars"), F.lit(1.0))
    symbols, repeats, dup, loud = c("n_symbols") / words, c("n_repeat_words") / words, c("n_dup_lines") / lines, c("n_loud") / chars
    mean, stop, ended = c("word_chars") / words, c("n_stop") / words, c("n_ended") / lines
    never = F.lit(False)
    return [
        ("symbols", never, symbols > 0.1),
        ("repeats", never, repeats > 0.3),
        ("lines", never, dup > 0.4),
        ("case", never, loud > 0.3),
        ("length of words", never, ~mean.between(2.5, 16)),
        ("frequent words", stop > 0.12, stop < 0.02),
        ("sentences", ended > 0.5, ended < 0.05),
        ("length", c("n_words") >= 100, c("n_words") < 30),
    ]


Model = tuple[float, list[tuple[float, float]], list[tuple[float, float]]]


def _log_odds(model: Model, votes: list[str]) -> Column:
    """The log odds of quality. The model: the share of good documents, and each rule's chances of a vote for and a vote
    against on good and on bad ones. An abstention is evidence as well."""
    prior, good, bad = model
    out = F.lit(log(prior / (1 - prior)))
    for (g, h), (b, d), v in zip(good, bad, votes):
        out = out + F.when(F.col(v) == 1, log(g / b)).when(F.col(v) == -1, log(h / d)).otherwise(log((1 - g - h) / (1 - b - d)))
    return out


def fit(patterns: DataFrame, votes: list[str]) -> Model:
    """The model by expectation-maximisation.

    ``patterns`` has one row for each row of votes that occurs and its ``n``: at most 3 to the power of the rules,
    whatever the corpus. Each round is one aggregate over it; only its few sums come to the driver.
    """
    model: Model = (GOOD, [ON_GOOD] * len(votes), [ON_BAD] * len(votes))
    for _ in range(ROUNDS):
        p = patterns.withColumn("__p", 1 / (1 + F.exp(-_log_odds(model, votes))))
        w, x = F.col("n") * F.col("__p"), F.col("n") * (1 - F.col("__p"))
        sums = [F.sum("n"), F.sum(w), *(F.sum(F.when(F.col(v) == vote, side).otherwise(0.0)) for side in (w, x) for v in votes for vote in (1, -1))]
        total, of_good, *s = p.agg(*[e.alias(f"s{i}") for i, e in enumerate(sums)]).first()
        if not total:
            break
        belief = BELIEF * total
        pair = lambda at, mass, before: tuple((s[at + i] + belief * before[i]) / (mass + belief) for i in (0, 1))
        k = len(votes)
        now = (
            (of_good + belief * GOOD) / (total + belief),
            [pair(2 * j, of_good, ON_GOOD) for j in range(k)],
            [pair(2 * (k + j), total - of_good, ON_BAD) for j in range(k)],
        )
        flat = lambda m: [m[0], *(c for side in m[1:] for two in side for c in two)]
        change = max(abs(a - b) for a, b in zip(flat(now), flat(model)))
        model = now
        if change < STILL:
            break
    return model


@any_names
def judge(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` without its text, and with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    quality (the posterior probability) and kept. Columns of these names are replaced.

    Words are runs without ASCII white space. ``base_failed``: under 50 words, or over half of them in repeated 3-word
    windows. Each rule votes for keeping, against it, or abstains; how far to trust it is estimated from all documents by
    expectation-maximisation, not set. ``kept``: the posterior is ``least`` or more and the base has not failed. Null and empty texts
    have no words and fail. Repeated rows are judged alike. One pass over the texts, no shuffle but of vote counts.
    """
    out = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "quality", "kept"]
    keep = [c for c in docs.columns if c not in (text, *out)]
    vote = lambda for_, against: F.when(for_, 1).when(against, -1).otherwise(0).cast("tinyint")
    all_rules = rules()
    votes = [f"__v{i}" for i in range(len(all_rules))]
    voted = signals(docs.select(*keep, text), text).select(
        *keep, *[F.col(f"__{c}").alias(c) for c in out[:5]], *[vote(a, b).alias(v) for v, (_, a, b) in zip(votes, all_rules)]
    )
    voted = checkpointed(voted, "votes")
    model = fit(checkpointed(voted.groupBy(*votes).agg(F.count(F.lit(1)).alias("n")), "patterns"), votes)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    quality = 1 / (1 + F.exp(-_log_odds(model, votes)))
    return voted.select(*keep, *out[:5], failed.alias("base_failed"), quality.alias("quality"), (~failed & (quality >= least)).alias("kept"))
