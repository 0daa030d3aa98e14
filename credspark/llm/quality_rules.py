"""Quality rules by weak supervision.  DataFrame functions only.

Every rule looks at counts of one text and votes good, votes bad or abstains.
Expectation maximisation over the table of vote patterns (at most 3 ** rules
rows, whatever the corpus's size) estimates for each rule how often it votes
each way on good and on bad texts.  The posterior probability of good then
replaces the usual requirement that every rule passes.

Defined results: null and empty texts have zero counts and fail the base
rule; repeated rows get equal rows; an empty table gives an empty result
(and prior guesses as the model); other columns are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BREAKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
GOOD, BAD, ABSTAIN = 1, -1, 0
#: A text is kept where the posterior probability of good is at least this.
KEEP_FROM = 0.5



def _with_repeats(d: DataFrame) -> DataFrame:
    """Adds n_repeat_words: how many words stand in windows of three words (hashes ``w3``) found twice or more.

    Window hashes are sorted with the position in their low bits, so that equal
    windows become neighbours without a quadratic search.  A neighbour with equal
    high bits counts only where the full hashes are equal too.  Each step is a
    column of its own: inside a lambda, an expression would be computed anew for
    every element.
    """
    one = F.lit(1).cast("long")
    low = F.call_function("shiftleft", one, F.length(F.bin(F.size("wr").cast("long")))) - 1
    keep = [c for c in d.columns if c != "w3"]
    d = d.select(*keep, F.when(F.size(F.array_distinct("w3")) < F.size("w3"), F.col("w3"))
                 .otherwise(F.array().cast("array<bigint>")).alias("wr"))
    d = d.select(*keep, "wr", low.alias("low"))
    d = d.select(*keep, "wr", F.transform(F.sort_array(F.transform(
        "wr", lambda h, i: h.bitwiseAND(F.bitwise_not(F.col("low"))).bitwiseOR(i.cast("long")))),
        lambda x: x.bitwiseAND(F.col("low")).cast("int")).alias("at"))
    d = d.select(*keep, "at", F.transform("at", lambda i: F.get(F.col("wr"), i)).alias("by"))
    same = lambda h, k: h.eqNullSafe(F.get(F.col("by"), k - 1)) | h.eqNullSafe(F.get(F.col("by"), k + 1))
    found = F.sort_array(F.filter("at", lambda i, k: same(F.get(F.col("by"), k), k)))
    covered = F.aggregate(found, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("sum")),
                          lambda a, i: F.struct(i.alias("last"),
                                                (a["sum"] + F.least(F.lit(3), i - a["last"])).alias("sum")),
                          lambda a: a["sum"])
    return d.select(*keep, covered.alias("n_repeat_words"))


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of every text, and base_failed."""
    d = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    bare = F.translate("text", WORD_BREAKS, "")
    lines = F.filter(F.split("text", "\n"), lambda x: F.translate(x, WORD_BREAKS, "") != "")
    d = d.select(
        "doc_id", F.length(bare).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        (F.length(bare) - F.length(F.regexp_replace(bare, r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
        F.transform(F.filter(F.split("text", r"[ \x09-\x0D]+"), lambda w: w != ""),
                    lambda w: F.xxhash64(w)).alias("wh"))
    n = F.size("wh")
    three = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(
        F.get("wh", i), F.get("wh", i + 1), F.get("wh", i + 2)))).otherwise(F.array().cast("array<bigint>"))
    d = d.select("doc_id", n.cast("long").alias("n_words"), "word_chars", "n_symbols", "n_upper",
                 F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.size(F.array_distinct("wh")).cast("long").alias("n_distinct"), three.alias("w3"))
    d = _with_repeats(d)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return d.withColumn("base_failed", failed)


def _vote(value: Column, good: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(BAD)).when(good, F.lit(GOOD)).otherwise(F.lit(ABSTAIN)).cast("int")


def votes() -> dict[str, Column]:
    """The rules.  Each abstains between its two borders and where it has nothing to look at."""
    c = {k: F.col(k).cast("double") for k in
         ("n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines", "n_distinct", "n_repeat_words")}
    per = lambda a, b: c[a] / F.when(c[b] > 0, c[b])
    rule = lambda x, good, bad: _vote(x, x <= good, x >= bad)
    length = per("word_chars", "n_words")
    return {
        "symbols_in_words": rule(per("n_symbols", "n_words"), 0.02, 0.25),
        "symbols_in_chars": rule(per("n_symbols", "word_chars"), 0.005, 0.05),
        "upper_case": rule(per("n_upper", "word_chars"), 0.12, 0.4),
        "repeated_words": rule(per("n_repeat_words", "n_words"), 0.08, 0.35),
        "repeated_lines": rule(per("n_dup_lines", "n_lines"), 0.05, 0.35),
        "few_distinct": _vote(per("n_distinct", "n_words"), per("n_distinct", "n_words") * F.sqrt(c["n_words"]) >= 5,
                              per("n_distinct", "n_words") * F.sqrt(c["n_words"]) <= 2),
        "word_length": _vote(length, length.between(3.0, 9.0), (length < 2.2) | (length > 14)),
        "length": _vote(c["n_words"], c["n_words"] >= 2 * MIN_WORDS, c["n_words"] < MIN_WORDS),
    }


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100) -> tuple[list[dict[int, float]], float]:
    """EM over (votes, count): for each rule the log odds (good against bad) of each vote, and of the prior.

    It starts from the belief that a text with more bad votes than none is bad.
    Counts are smoothed by one vote of each kind, so no estimate is 0 or 1.
    """
    rules = len(patterns[0][0]) if patterns else 0
    good = [0.05 if BAD in v else 0.95 for v, _ in patterns]
    tables: list[dict[int, float]] = [{v: 0.0 for v in (GOOD, BAD, ABSTAIN)} for _ in range(rules)]
    prior = 0.0
    for _ in range(rounds):
        mass = [sum(g * n for g, (_, n) in zip(good, patterns)), sum((1 - g) * n for g, (_, n) in zip(good, patterns))]
        prior = math.log((mass[0] + 1) / (mass[1] + 1))
        for j in range(rules):
            seen = {v: [1.0, 1.0] for v in (GOOD, BAD, ABSTAIN)}
            for g, (v, n) in zip(good, patterns):
                seen[v[j]][0] += g * n
                seen[v[j]][1] += (1 - g) * n
            tables[j] = {v: math.log(a / (mass[0] + 3)) - math.log(b / (mass[1] + 3)) for v, (a, b) in seen.items()}
        new = [1 / (1 + math.exp(-max(-50.0, min(50.0, prior + sum(t[x] for t, x in zip(tables, v))))))
               for v, _ in patterns]
        done = all(abs(a - b) < 1e-9 for a, b in zip(good, new))
        good = new
        if done:
            break
    return tables, prior


def quality_rules(docs: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, p_good."""
    from credspark.session import materialize

    rules = votes()
    counted = materialize(base_counts(docs).select("*", *[v.alias(f"v_{k}") for k, v in rules.items()]))
    names = [f"v_{k}" for k in rules]
    rows = counted.groupBy(*names).agg(F.count(F.lit(1)).alias("n_docs")).collect()  # 3 ** rules at most
    tables, prior = fit(sorted((tuple(r[k] for k in names), r["n_docs"]) for r in rows))
    odds = F.lit(prior)
    for k, t in zip(names, tables):
        odds = odds + F.when(F.col(k) == GOOD, t[GOOD]).when(F.col(k) == BAD, t[BAD]).otherwise(t[ABSTAIN])
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))
    return (counted.withColumn("p_good", p)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & (F.col("p_good") >= keep_from)).alias("kept"), "p_good"))
