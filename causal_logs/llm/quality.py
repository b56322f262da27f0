"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

``metrics`` are columns of counts and ratios; a ``Rule`` bounds one of them; ``judged``
turns a table of rules into the columns ``failed`` (names of the broken rules, in
table order) and ``kept``. Nothing is shuffled and no user function runs.

Words are ``[^\\x20\\x09-\\x0D]+``. A null text has no words, like an empty one.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.barrier import settled

_SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"
# Frequent short words of the languages of the corpus.
STOP_WORDS = {
    "en": "the of and to in is that it for was with as on at by this",
    "de": "der die das und ist in den von zu mit sich auf für nicht ein eine",
    "fr": "le la les de des et en un une du que qui dans pour au est",
    "es": "el la los las de que y en un una por se del con para lo",
}


class Rule(NamedTuple):
    """``name`` fails where ``metric`` is below ``low`` or above ``high``. A base rule also sets ``base_failed``."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None
    base: bool = False


RULES = (
    Rule("too_short", "n_words", low=50, base=True),
    Rule("repeated_words", "repeat_ratio", high=0.5, base=True),
    Rule("too_long", "n_words", high=100_000),
    Rule("word_length", "mean_word", low=2.0, high=12.0),
    Rule("symbols", "symbol_ratio", high=0.1),
    Rule("repeated_lines", "dup_line_ratio", high=0.3),
    Rule("stop_words", "stop_ratio", low=0.02),
)


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _SPACE))


def _windows(words: Column, n: int) -> Column:
    """A hash of each window of ``n`` words."""
    size = F.size(words)
    at = F.when(size >= n, F.sequence(F.lit(0), size - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))


def metrics(docs: DataFrame, text: str = "text", stop_words: dict[str, str] = STOP_WORDS) -> DataFrame:
    """``docs`` with the counts ``n_words word_chars n_symbols n_dup_lines n_repeat_words n_stop n_lines`` (bigint) and the
    ratios ``mean_word symbol_ratio dup_line_ratio repeat_ratio stop_ratio`` (0 where there is nothing to divide by).

    ``n_repeat_words`` compares windows of three words by a 64-bit hash.
    """
    stops = sorted({x for group in stop_words.values() for w in group.split() for x in (w, w.capitalize(), w.upper())})
    whole = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<int>")
    total = lambda values: F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)
    lines = F.filter(F.split(whole, "\n"), lambda x: F.regexp_like(x, F.lit("[^\\x20\\x09-\\x0D]")))
    # Names that no column of ``docs`` has, whatever its case.
    mark = "_"
    while any(c.lower().startswith(mark) for c in docs.columns):
        mark += "_"
    words_, lines_, symbols_, windows_, twice_, starts_ = (f"{mark}{n}" for n in ("words", "lines", "symbols", "windows", "twice", "starts"))
    df = docs.withColumns({words_: _words(whole), lines_: lines, symbols_: F.regexp_count(whole, F.lit(SYMBOLS))})
    df = df.withColumn(windows_, _windows(F.col(words_), 3))
    # Only texts with a repeated window need them sorted.
    repeats = F.size(F.array_distinct(windows_)) < F.size(windows_)
    pairs = F.sort_array(F.transform(windows_, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn(twice_, F.when(repeats, pairs))
    twins = F.filter(
        twice_,
        lambda p, k: F.get(twice_, k - 1).h.eqNullSafe(p.h) | F.get(twice_, k + 1).h.eqNullSafe(p.h),
    )
    df = df.withColumn(starts_, F.coalesce(F.sort_array(F.transform(twins, lambda p: p.i)), none))
    # A window covers its three words, or those up to the next one.
    covers = F.transform(starts_, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(starts_, k + 1) - p, F.lit(3))))
    counts = {
        "n_words": F.size(words_),
        "word_chars": F.length(F.array_join(words_, "")),
        "n_symbols": F.col(symbols_),
        "n_dup_lines": F.size(lines_) - F.size(F.array_distinct(lines_)),
        "n_repeat_words": total(covers),
        "n_stop": F.size(F.filter(words_, lambda w: w.isin(stops))),
        "n_lines": F.size(lines_),
    }
    df = df.select(*docs.columns, *[c.cast("bigint").alias(name) for name, c in counts.items()])
    # Filters on the verdict must not bring all this into the filter once more.
    df = settled(df, list(counts))
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return df.withColumns({
        "mean_word": ratio("word_chars", "n_words"),
        "symbol_ratio": ratio("n_symbols", "word_chars"),
        "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "repeat_ratio": ratio("n_repeat_words", "n_words"),
        "stop_ratio": ratio("n_stop", "n_words"),
    })


def judged(df: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` (with the metrics named by the rules) and ``base_failed``, ``failed``, ``kept``."""

    def broken(rule: Rule) -> Column:
        value, tests = F.col(rule.metric), []
        if rule.low is not None:
            tests.append(value < rule.low)
        if rule.high is not None:
            tests.append(value > rule.high)
        return tests[0] if len(tests) == 1 else tests[0] | tests[1]

    base = F.lit(False)
    for rule in rules:
        if rule.base:
            base = base | broken(rule)
    failed = F.array_compact(F.array(*[F.when(broken(r), F.lit(r.name)) for r in rules]))
    return df.select("*", base.alias("base_failed"), failed.alias("failed")).withColumn("kept", F.size("failed") == 0)


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with metrics and verdict; columns of those names are replaced."""
    made = ("n_words word_chars n_symbols n_dup_lines n_repeat_words n_stop n_lines mean_word symbol_ratio "
            "dup_line_ratio repeat_ratio stop_ratio base_failed failed kept").split()
    own = [c for c in docs.columns if c.lower() not in made]
    return judged(metrics(docs.select(*own), text), rules)
