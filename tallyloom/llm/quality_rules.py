"""Quality rules: a table of thresholds compiled into one projection of counts and ratios of a text.

A rule bounds a measure of the text, or the ratio of two.  `verdict` turns any table of rules into a single column: the
text is taken apart once, the measures are worked out from its words and lines, and every rule is a comparison of them.
Everything is built-in functions: no Python runs on executors and nothing is shuffled.

Words are runs of characters other than ASCII white space; lines are parted by line feeds.

Null and empty texts have no words, so a rule that asks for words fails and ratios by words count as 0.  Rows that repeat,
tie or lack an id are judged one by one; an empty table gives an empty one.  Texts of any length are measured whole: the
work grows with length (times its logarithm where a text repeats windows of words).  Kept columns named like results
give way to them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words, the characters that count as symbols, and the length of windows.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5

#: Common function words of the languages that the rules are meant for; they count where they stand as here.
STOP_WORDS = (
    "the and of to in is that it for was with as be on this by are or from at an "
    "der die und das ist den von zu mit sich auf ein eine nicht dem des "
    "le la les et des un une que pour dans est sur de du "
    "el los las en y por con para una del se"
).split()


@dataclass(frozen=True)
class Rule:
    """`value`, or `value` / `per`, must lie in [least, most]; texts of fewer than `from_words` words are not asked."""

    name: str
    value: str
    per: str | None = None
    least: float | None = None
    most: float | None = None
    from_words: int = 0


#: What makes a text fail whatever the table says: too short, or too much of it said twice.
BASE = (Rule("too_short", "n_words", least=10), Rule("repeats_itself", "n_repeat_words", "n_words", most=0.2))

RULES = (
    Rule("word_length", "word_chars", "n_words", least=2.0, most=14.0),
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("capitals", "n_capitals", "word_chars", most=0.4),
    Rule("stop_words", "n_stop_words", "n_words", least=0.02, from_words=50),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=0.3),
    Rule("cut_lines", "n_cut_lines", "n_lines", most=0.3),
    Rule("listed_lines", "n_listed_lines", "n_lines", most=0.9),
)

BASE_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, however often the body and its lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _count_of(text: Column, characters: str) -> Column:
    """Characters of a text that match a class."""
    return F.length(text) - F.length(F.regexp_replace(text, characters, ""))


def _lines_like(lines: Column, pattern: str) -> Column:
    return F.size(F.filter(lines, lambda x: x.rlike(pattern)))


def _covered(starts: Column) -> Column:
    """Words covered by windows that start at these places, given in order."""
    gaps = F.zip_with(starts, F.slice(starts, F.lit(2), F.size(starts)), lambda a, b: F.coalesce(b - a, F.lit(WINDOW)))
    return F.aggregate(gaps, F.lit(0), lambda total, gap: total + F.least(gap, F.lit(WINDOW)))


def repeat_words(words: Column) -> Column:
    """Words of an array that lie in a window of five found twice or more.

    Windows are hashed first.  Only where hashes agree, they are sorted with their places, and the windows at agreeing
    places are themselves sorted and compared with their neighbours, so that hashes never decide the answer.
    """
    low = (1 << 31) - 1

    def hashed(w):
        window = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
        return F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: window(i).bitwiseAND(F.lit(~low)))

    def agreeing(ordered):
        """Places in a sorted array of hash and place where a neighbour has the same hash."""
        same = lambda x, at: F.shiftright(F.get(ordered, at), 31) == F.shiftright(x, 31)
        place = lambda x, i: F.when(same(x, i - 1) | same(x, i + 1), x.bitwiseAND(F.lit(low)).cast("int"))
        return F.array_compact(F.transform(ordered, place))

    def equal(ordered):
        """Places in a sorted array of window and place where a neighbour has the same window."""
        same = lambda x, at: F.get(ordered, at)["window"] == x["window"]
        return F.array_compact(F.transform(ordered, lambda x, i: F.when(same(x, i - 1) | same(x, i + 1), x["place"])))

    def exact(w, hashes):
        packed = F.sort_array(F.transform(hashes, lambda h, i: h.bitwiseOR(i.cast("long"))))
        window = lambda i: F.array_join(F.slice(w, i + 1, F.lit(WINDOW)), " ").alias("window")
        windows = F.transform(let(packed, agreeing), lambda i: F.struct(window(i), i.alias("place")))
        return let(F.sort_array(let(F.sort_array(windows), equal)), _covered)

    def counted(w):
        told = let(hashed(w), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), exact(w, h)).otherwise(0))
        return F.when(F.size(w) > WINDOW, told).otherwise(0)

    return let(words, counted)


def measures(text: Column) -> Column:
    """A struct of all counts that rules may name; null texts count as empty."""

    def measured(t):
        words = F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
        lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
        by_lines = lambda x: {
            "n_lines": F.size(x),
            "n_dup_lines": F.size(x) - F.size(F.array_distinct(x)),
            "n_cut_lines": _lines_like(x, r"(\.\.\.|…)[\x20\x09-\x0D]*\z"),
            "n_listed_lines": _lines_like(x, r"\A[\x20\x09-\x0D]*[-*•]"),
        }
        counts = lambda w, x: {
            "n_words": F.size(w),
            "word_chars": F.length(F.array_join(w, "")),
            "n_symbols": _count_of(t, SYMBOLS),
            "n_capitals": _count_of(t, "[A-Z]+"),
            "n_stop_words": F.size(F.filter(w, lambda x: x.isin(STOP_WORDS))),
            "n_repeat_words": repeat_words(w),
            **by_lines(x),
        }
        shown = lambda w, x: F.struct(*[c.cast("long").alias(n) for n, c in counts(w, x).items()])
        return let(words, lambda w: let(lines, lambda x: shown(w, x)))

    return let(F.coalesce(text, F.lit("")), measured)


def broken(rule: Rule, counts: Column) -> Column:
    """Whether measured counts break a rule; never null."""
    value = counts[rule.value]
    if rule.per:
        value = F.when(counts[rule.per] == 0, F.lit(0.0)).otherwise(value / counts[rule.per])
    out = F.lit(False)
    if rule.least is not None:
        out = out | (value < F.lit(rule.least))
    if rule.most is not None:
        out = out | (value > F.lit(rule.most))
    return out & (counts["n_words"] >= rule.from_words)


def verdict(text: Column, rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE) -> Column:
    """One struct: `counts`, `base_failed`, and the names of the broken `rules` (those of `base` first)."""

    def judged(counts):
        names = [F.when(broken(rule, counts), F.lit(rule.name)) for rule in [*base, *rules]]
        failed = F.lit(False)
        for rule in base:
            failed = failed | broken(rule, counts)
        return F.struct(counts.alias("counts"), failed.alias("base_failed"), F.array_compact(F.array(*names)).alias("broken"))

    return let(measures(text), judged)


def judge(
    df: DataFrame, rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE, text: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """`keep` columns (all if None) with the base counts, base_failed, kept and `broken`, the names of broken rules."""
    added = [*BASE_COUNTS, "base_failed", "kept", "broken"]
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in added]
    out = df.select(*[F.col(f"`{c}`") for c in kept], verdict(F.col(f"`{text}`"), rules, base).alias("\x00"))
    told = F.col("`\x00`")
    return out.select(
        *[F.col(f"`{c}`") for c in kept],
        *[told["counts"][c].alias(c) for c in BASE_COUNTS],
        told["base_failed"].alias("base_failed"),
        (F.size(told["broken"]) == 0).alias("kept"),
        told["broken"].alias("broken"),
    )


def passing(df: DataFrame, rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE, text: str = "text") -> DataFrame:
    """The rows whose text breaks no rule, with all their columns as they are."""
    return df.where(F.size(verdict(F.col(f"`{text}`"), rules, base)["broken"]) == 0)
