"""Quality rules as weak supervision, with DataFrame functions only: rules vote or abstain, and expectation-maximisation weighs them.

Each rule looks at one trait of a text and votes 1 (good), 0 (bad) or abstains. Nobody tells which votes are right: two
accuracies of each rule, that of its votes on good and that on bad documents, and the share of good documents are the unknowns of a
mixture in which rules vote independently given the class. They are estimated from all documents; a document's posterior probability
of being good then decides, so one vote against may be outweighed by what the others say of it.

The likelihood needs no document, only how often each pattern of votes occurs: at most 3 ** len(RULES) of them, counted map-side. Expectation and
maximisation run as one fold over that table's array in a single row, and patterns meet their posteriors by a broadcast of as many rows.

What a text says is worked out once, row by row, without a shuffle; no text is sent anywhere. Texts are taken whole: the 8-word windows that occur
twice are found by sorting the hashes (64 bits) of those texts that have any, so a long text costs n log n.

Null and empty texts have no words, and all counts 0; they fail the base and count in the estimate with what their rules say (nothing). Rows that repeat each
count and get the same verdict; ids aren't read, null ones included; an empty table gives an empty result. ``features`` keeps the
columns asked for by name and adds its own; where a name is taken, the caller has chosen to replace it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import table
from gleanery.session import cut

BLANKS = " \t\n\x0b\f\r"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30
#: Rounds of expectation-maximisation, and what a rule is taken to have said before any count: (right, wrong) votes.
ROUNDS, PRIOR = 40, (2.0, 1.0)
#: Where the estimate starts: share of good documents, accuracy of votes on good and on bad ones.
START = (0.8, 0.95, 0.4)
KEEP = 0.5

# Frequent function words of the languages that the rule on them knows.
FUNCTION_WORDS = {
    "en": "the of and to in is that was for on are with as by this from it be not or have",
    "de": "der die das und ist nicht mit von den im zu sich auf ein eine als auch es an werden",
    "fr": "le la les de des et un une est que qui dans pour pas sur par en du au plus",
    "es": "el la los las de que y en un una es por con para se del no su lo como",
}

#: Each rule: good where the first condition holds, bad where the second does, else it abstains. They vote on texts of MIN_WORDS words or more only.
RULES: dict[str, tuple[str, str]] = {
    "symbols": ("50 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    "plain_words": ("100 * n_plain >= 85 * n_words", "100 * n_plain < 70 * n_words"),
    "capitals": ("100 * n_capitals <= 8 * word_chars", "100 * n_capitals > 25 * word_chars"),
    "shouts": ("100 * n_shouts <= n_words", "10 * n_shouts > n_words"),
    "word_length": ("word_chars between 3 * n_words and 9 * n_words", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    "variety": ("100 * n_different >= 40 * n_words", "100 * n_different < 15 * n_words"),
    "echoes": ("100 * n_echoes <= 2 * n_words", "100 * n_echoes > 20 * n_words"),
    "repeats": ("100 * n_repeat_words <= 2 * n_words", "100 * n_repeat_words > 20 * n_words"),
    "lines": ("n_dup_lines = 0", "100 * n_dup_lines > 30 * n_lines"),
    "function_words": ("n_function >= 4", "n_function = 0 and n_words >= 40"),
}


def repeated_words(windows: Column) -> Column:
    """How many words lie in windows whose hash occurs twice or more, from the windows' hashes in order."""
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda s, x, k: x["h"].eqNullSafe(F.get(s, k - 1)["h"]) | x["h"].eqNullSafe(F.get(s, k + 1)["h"])
    places = F.transform(F.array(pairs), lambda s: F.sort_array(F.transform(F.filter(s, lambda x, k: same(s, x, k)), lambda x: x["i"])))
    covered = lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.transform(places, covered)[0]).otherwise(0)


def features(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    """The columns ``keep`` and, as longs: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (the base) and n_lines, n_plain,
    n_capitals, n_shouts, n_echoes (words equal to the one before), n_different, n_function, which the rules look at."""
    t = F.coalesce(F.col(text), F.lit(""))
    bare = F.btrim(t, F.lit(BLANKS))
    words = F.when(bare != "", F.split(bare, r"[ \t-\r]+")).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    without = lambda pattern: F.length(t) - F.length(F.regexp_replace(t, pattern, ""))
    capitals, symbols = without(r"\p{Lu}+"), without(r"[#*$%&|<>]+")
    # Arrays are columns of their own, so that each is made once.
    rows = docs.select(*keep, words.alias("_w"), lines.alias("_l"), capitals.alias("n_capitals"), symbols.alias("n_symbols"))
    function = F.array(*[F.lit(w) for w in sorted({w for ws in FUNCTION_WORDS.values() for w in ws.split()})])
    rows = rows.select(
        *keep,
        F.size("_w").alias("n_words"),
        F.length(F.array_join("_w", "")).alias("word_chars"),
        "n_symbols",
        (F.size("_l") - F.size(F.array_distinct("_l"))).alias("n_dup_lines"),
        F.size("_l").alias("n_lines"),
        F.size(F.filter("_w", lambda w: w.rlike(r"^[\p{L}]+(?:['’-][\p{L}]+)*[.,;:?!]?$"))).alias("n_plain"),
        "n_capitals",
        F.size(F.filter("_w", lambda w: w.endswith("!!"))).alias("n_shouts"),
        F.size(F.filter("_w", lambda w, i: w == F.get("_w", i - 1))).alias("n_echoes"),
        F.size(F.array_distinct("_w")).alias("n_different"),
        F.size(F.array_intersect("_w", function)).alias("n_function"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
    )
    # sequence() counts down when its end is below its start, so short texts take the other branch.
    windows = F.when(F.size("_h") > WINDOW, F.transform(F.sequence(F.lit(0), F.size("_h") - WINDOW), lambda i: F.xxhash64(*[F.get("_h", i + j) for j in range(WINDOW)])))
    rows = rows.select("*", F.coalesce(windows, F.array().cast("array<bigint>")).alias("_x")).drop("_h")
    rows = rows.withColumn("n_repeat_words", repeated_words(F.col("_x"))).drop("_x")
    own = [c for c in rows.columns if c not in keep]
    return rows.select(*keep, *[F.col(c).cast("long").alias(c) for c in own])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def pattern() -> Column:
    """The rules' votes as text, one sign for each rule in order: 1, 0 or - for an abstention."""
    enough = F.col("n_words") >= MIN_WORDS
    votes = [F.when(enough & F.expr(good), "1").when(enough & F.expr(bad), "0").otherwise("-") for good, bad in RULES.values()]
    return F.concat(*votes)


def _sum(xs: Column, of=lambda x: x) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + of(x))


def _posterior(votes: Column, state: Column) -> Column:
    """P(good | votes) under the state's share and accuracies."""
    good, bad = lambda j: F.get(state["good"], j), lambda j: F.get(state["bad"], j)
    says = lambda v, j: F.when(v == 1, F.log(good(j) / (1 - bad(j)))).when(v == 0, F.log((1 - good(j)) / bad(j))).otherwise(0.0)
    odds = F.log(state["share"] / (1 - state["share"])) + _sum(F.transform(votes, says))
    return 1 / (1 + F.exp(-odds))


def _maximised(seen: Column) -> Column:
    """The state that fits patterns (v, n, p) best: p is each one's posterior as things stand."""
    right, wrong = PRIOR

    def accuracy(j, weight, vote):
        said = _sum(seen, lambda x: F.when(F.get(x["v"], j) >= 0, weight(x)).otherwise(0.0))
        agreed = _sum(seen, lambda x: F.when(F.get(x["v"], j) == vote, weight(x)).otherwise(0.0))
        return (agreed + right) / (said + right + wrong)

    n_good, n_bad = lambda x: x["n"] * x["p"], lambda x: x["n"] * (1 - x["p"])
    rules = F.array(*[F.lit(j) for j in range(len(RULES))])
    share = (_sum(seen, n_good) + 1) / (_sum(seen, lambda x: x["n"]) + 2)
    return F.struct(share.alias("share"), F.transform(rules, lambda j: accuracy(j, n_good, 1)).alias("good"), F.transform(rules, lambda j: accuracy(j, n_bad, 0)).alias("bad"))


def _with_posteriors(table_: Column, state: Column) -> Column:
    return F.transform(table_, lambda x: F.struct(x["v"].alias("v"), x["n"].alias("n"), _posterior(x["v"], state).alias("p")))


def estimate(rows: DataFrame) -> DataFrame:
    """From rows with a column ``votes``, one row: ``state`` (share of good documents, accuracies on good and on bad ones by rule) and ``seen``, the patterns (v, n)."""
    counted = rows.groupBy("votes").agg(F.count("*").cast("double").alias("n"))
    signs = F.transform(F.sequence(F.lit(1), F.lit(len(RULES))), lambda k: F.instr(F.lit("01"), F.substring("votes", k, F.lit(1))) - 1)
    # In one order everywhere, so that the sums are the same on every run.
    one = counted.agg(F.sort_array(F.collect_list(F.struct(signs.alias("v"), "n"))).alias("seen"))
    start = F.struct(F.lit(START[0]).alias("share"), *[F.array_repeat(F.lit(a), len(RULES)).alias(k) for k, a in zip(("good", "bad"), START[1:], strict=True)])
    step = lambda state, _: F.transform(F.array(_with_posteriors(F.col("seen"), state)), _maximised)[0]
    return one.select("seen", F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step).alias("state"))


def posteriors(rows: DataFrame) -> DataFrame:
    """(votes, posterior) of each pattern that occurs."""
    each = cut(estimate(rows)).select("state", F.explode("seen").alias("x"))
    votes = F.array_join(F.transform(F.col("x.v"), lambda s: F.when(s < 0, "-").otherwise(s.cast("string"))), "")
    return each.select(votes.alias("votes"), _posterior(F.col("x.v"), F.col("state")).alias("posterior"))


def judge(rows: DataFrame) -> DataFrame:
    """Rows of ``features`` with ``base_failed``, ``votes``, ``posterior`` and ``kept``."""
    rows = cut(rows.withColumns({"base_failed": base_failed(), "votes": pattern()}))
    # 3 ** len(RULES) patterns at most.
    known = F.broadcast(cut(posteriors(rows)))
    return rows.join(known, "votes").withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP))


def op11_qualityrules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(features(docs, "text", "doc_id")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "votes", "posterior")
