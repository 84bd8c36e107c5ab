"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them, a posterior decides.

Everything is a column expression or an aggregate. Texts are read once for their signals; the estimate works on the counts of vote patterns,
of which there are at most 2 ** 7 * 3 ** 4, whatever the size of the corpus.
"""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from onblock.llm.tables import carried, quoted, settle, unpacked

SPACE = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED = 50
KEEP_FROM = 0.5
ROUNDS = 25
SETTLED = 1e-4
HELD = 0.05
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SIGNALS = [*BASE, "n_chars", "n_lines", "n_letters", "n_capitals", "n_calls", "n_stops", "n_runs", "n_long_runs", "n_distinct"]


def _vote(bad: Column, good: Column | None = None) -> Column:
    """-1 for bad, 1 for good, 0 where the rule has no opinion or cannot measure; a rule without `good` only ever objects."""
    said = F.when(bad, -1)
    return (said if good is None else said.when(good, 1)).otherwise(0)


def _rules() -> dict[str, Column]:
    """Votes over the signals; shares are per word, per line or per character, and null where there are none."""
    per = lambda name, whole: F.col(name) / F.nullif(F.col(whole), F.lit(0))
    per_word = lambda name: per(name, "n_words")
    letters, length, stops = per("n_letters", "word_chars"), per_word("word_chars"), per_word("n_stops")
    vocabulary = F.log1p("n_distinct") / F.nullif(F.log1p("n_words"), F.lit(0.0))
    return {
        "symbols": _vote(per_word("n_symbols") > 0.25),
        "runs": _vote(per_word("n_runs") > 0.2),
        "long_runs": _vote(per_word("n_long_runs") > 0.1),
        "lines": _vote(per("n_dup_lines", "n_lines") > 0.5),
        "repeats": _vote(per_word("n_repeat_words") > 0.4),
        "capitals": _vote(per("n_capitals", "word_chars") > 0.4),
        "calls": _vote(per_word("n_calls") > 0.2),
        "letters": _vote(letters < 0.8, letters > 0.93),
        "sentences": _vote(stops < 0.005, stops.between(0.02, 0.4)),
        "word_length": _vote((length < 2) | (length > 14), length.between(2.5, 7.5)),
        "vocabulary": _vote(vocabulary < 0.5, vocabulary > 0.7),
    }


RULES = list("symbols runs long_runs lines repeats capitals calls letters sentences word_length vocabulary".split())
ONLY_OBJECT = set(RULES[:7])


def _repeated_words(words: DataFrame) -> DataFrame:
    """Turns `words` into `n_repeat_words`, keeping `row` and `plain`.

    The hash of every window is sorted together with its position, in one long each, so equal windows become neighbours; the positions
    of those with an equal neighbour, sorted again, tell which words they cover. The hash keeps the 64 bits less those of the
    position (9 for 500 words). Steps are columns of their own, so that none is worked out again for every element of another.
    """
    n, bits = F.size("words"), F.col("bits")
    at = lambda array, i: F.get(F.col(array), i)
    hashed = lambda word, i: F.xxhash64(word, at("words", i + 1), at("words", i + 2))
    packed = words.withColumn("bits", F.ceil(F.log2(n + 1)).cast("int")).withColumn(
        "packed",
        F.when(n < WINDOW, F.array().cast("array<bigint>")).otherwise(
            F.transform(
                F.slice("words", 1, F.greatest(n - (WINDOW - 1), F.lit(0))),
                lambda word, i: F.call_function("shiftleft", hashed(word, i), bits).bitwiseOR(i.cast("long")),
            )
        ),
    )
    ordered = packed.select("row", "plain", "words", "bits", F.sort_array("packed").alias("ordered"))
    same = lambda x, y: F.call_function("shiftright", x.bitwiseXOR(y), bits) == 0
    doubled = F.filter("ordered", lambda x, i: same(x, F.when(i > 0, at("ordered", i - 1))) | same(x, at("ordered", i + 1)))
    places = ordered.select("row", "plain", "words", "bits", doubled.alias("doubled"))
    place = lambda x: x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)
    placed = places.select("row", "plain", "words", F.sort_array(F.transform("doubled", place)).alias("places"))
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    cover = lambda acc, p: F.struct((p + WINDOW).alias("end"), (acc["n"] + p + WINDOW - F.greatest(acc["end"], p)).alias("n"))
    return placed.withColumn("n_repeat_words", F.aggregate("places", start, cover)["n"]).drop("places")


def with_signals(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns of docs as `row`, and the counts of its whole text as columns named in SIGNALS; null texts count as empty.

    Marks and capitals are counted in what is left of a text when every run of a-z and white space has become one space.
    """
    content, marks = F.col("content"), F.col("marks")
    count = lambda kinds: F.length(F.regexp_replace(marks, f"[^{kinds}]++", "")).cast("long")
    lines = F.filter(F.split(content, "\n", -1), lambda line: line.rlike(f"[^{SPACE}]"))
    plain = {
        "n_symbols": count(SYMBOLS),
        "n_runs": F.regexp_count(marks, F.lit(f"[{SYMBOLS}]++")).cast("long"),
        "n_long_runs": F.regexp_count(marks, F.lit(f"[{SYMBOLS}]{{3,}}+|[!?]{{2,}}+")).cast("long"),
        "n_other_letters": count(r"A-Z\u0080-\uFFFF"),
        "n_marks": F.length(F.replace(marks, F.lit(" "), F.lit(""))).cast("long"),
        "n_capitals": count("A-Z"),
        "n_calls": count("!?"),
        "n_stops": count(".,;:"),
        "lines": lines,
        "n_chars": F.length(content).cast("long"),
    }
    carry = docs if keep is None else docs.select(*[quoted(c) for c in keep])
    read = docs.select(carried(carry).alias("row"), F.coalesce(quoted(text), F.lit("")).alias("content"))
    read = read.withColumn("marks", F.regexp_replace("content", f"[a-z{SPACE}]++", " "))
    read = read.select(
        "row",
        F.struct(*[value.alias(name) for name, value in plain.items()]).alias("plain"),
        F.array_remove(F.split(content, f"[{SPACE}]+", -1), "").alias("words"),
    )
    word_chars = F.length(F.array_join("words", "")).cast("long")
    return _repeated_words(read).select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        word_chars.alias("word_chars"),
        "n_repeat_words",
        (word_chars - F.col("plain.n_marks") + F.col("plain.n_other_letters")).alias("n_letters"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.size("plain.lines").cast("long").alias("n_lines"),
        (F.size("plain.lines") - F.size(F.array_distinct("plain.lines"))).cast("long").alias("n_dup_lines"),
        *[F.col(f"plain.{name}").alias(name) for name in plain if name not in ("lines", "n_marks", "n_other_letters")],
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


Rates = dict[str, dict[int, tuple[float, float]]]


def _posterior(prior: float, rates: Rates) -> Column:
    """Probability of good quality given the votes: votes are independent within a class, abstentions count as votes."""
    evidence = [
        reduce(lambda rest, v: F.when(F.col(rule) == v, log(by[v][0] / by[v][1])).otherwise(rest), by, F.lit(0.0)) for rule, by in rates.items()
    ]
    return 1 / (1 + F.exp(-(F.lit(log(prior / (1 - prior))) + reduce(lambda a, b: a + b, evidence))))


def estimate(votes: DataFrame) -> tuple[float, Rates]:
    """Prior of good quality and, by rule and vote, how often good and bad documents get that vote.

    votes: the columns named in RULES. The start is what rules are written for, and it stays in the estimate as HELD of the documents,
    so that a rule that stands alone is not outvoted by many that have no opinion on its kind of trouble. A round is one aggregate over the
    pattern counts that returns a single row. Without rows the start is returned.
    """
    prior = 0.8
    start: Rates = {rule: {0: (0.98, 0.5), -1: (0.02, 0.5)} if rule in ONLY_OBJECT else {1: (0.85, 0.4), 0: (0.13, 0.3), -1: (0.02, 0.3)} for rule in RULES}
    rates = start
    patterns = settle(votes.groupBy(*RULES).agg(F.count("*").alias("n")), "votes").coalesce(1).cache()
    for _ in range(ROUNDS):
        p = patterns.withColumn("good", F.col("n") * _posterior(prior, rates)).withColumn("bad", F.col("n") - F.col("good"))
        cells = [(rule, v) for rule in RULES for v in start[rule]]
        sums = [F.sum(F.when(F.col(rule) == v, F.col(side))).alias(f"{rule}_{v}_{side}") for rule, v in cells for side in ("good", "bad")]
        row = p.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), *sums).first()
        if not row["good"] or not row["bad"]:
            break
        held = HELD * (row["good"] + row["bad"])
        new: Rates = {rule: {} for rule in RULES}
        for rule, v in cells:
            counts = [row[f"{rule}_{v}_{side}"] or 0.0 for side in ("good", "bad")]
            wholes = [row["good"], row["bad"]]
            new[rule][v] = tuple((c + held * first) / (w + held) for c, w, first in zip(counts, wholes, start[rule][v], strict=True))
        moved = max(abs(a - b) for rule, v in cells for a, b in zip(new[rule][v], rates[rule][v], strict=True))
        prior, rates = min(max(row["good"] / (row["good"] + row["bad"]), 0.01), 0.99), new
        if moved < SETTLED:
            break
    patterns.unpersist()
    return prior, rates


def judge(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds the base counts, base_failed, quality (posterior) and kept to every row of docs; of its columns all stay, or those named in keep.

    base_failed: under LEAST_WORDS words, or over MOST_REPEATED percent of them in repeated windows. Other documents are kept if the
    posterior of good quality reaches KEEP_FROM. Rules are weighed on the documents that pass the base. Null and empty texts have no
    words and fail it; repeated rows count as often as they occur; an empty table gives an empty result. Columns of docs named
    like a result are replaced. Rows are written once with their signals, so name in keep only the columns that are needed later.
    """
    columns = docs.columns if keep is None else keep
    signals = settle(with_signals(docs, text, columns), "signals")
    votes = _rules()
    voted = signals.withColumn("base_failed", base_failed()).withColumns({rule: votes[rule] for rule in RULES})
    prior, rates = estimate(voted.filter("not base_failed"))
    decided = voted.withColumn("quality", _posterior(prior, rates))
    results = {name: F.col(name) for name in [*BASE, "base_failed", "quality"]}
    return unpacked(decided, "row", columns, results | {"kept": ~F.col("base_failed") & (F.col("quality") >= KEEP_FROM)})
