"""Quality rules: a threshold table compiled into one projection over whole texts.

Everything is a Spark expression on the row itself: no shuffle, no user function.  Rules
are data (``RULES``): name, ratio, bounds.  ``quality(df)`` works out the measures and the
verdict, ``passes(df)`` keeps the rows that every rule accepts.

Null and empty texts have no words and fail on length; texts of any length are measured
whole; repeated rows are judged alike; other columns are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \\t-\\r"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3

#: Common words of the languages the corpus is kept in; fixed values, lower case.
STOP_WORDS = (
    "the of and to in is that it for was on are as with be by this at or an "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch "
    "de la le les et des en un du une que est pour qui dans par sur pas au plus "
    "el los las del y se con una su al lo por para como más"
).split(" ")

#: (rule, measure, least, most); None is open.  A text without words passes none.
RULES: tuple[tuple[str, str, float | None, float | None], ...] = (
    ("word length", "mean_word_chars", 2.0, 14.0),
    ("symbols", "symbol_ratio", None, 0.05),
    ("stop words", "stop_ratio", 0.02, None),
    ("capitals", "capital_ratio", None, 0.60),
    ("repeated lines", "dup_line_ratio", None, 0.50),
    ("repeated words", "repeat_ratio", None, 0.50),
)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{WHITE}]+"), lambda w: w != "")


def _shifted(direction: str, value: Column, bits: Column) -> Column:
    return F.call_function(f"shift{direction}", value, bits)


def _windows(words: Column, n: Column, bits: Column) -> Column:
    """Per window of three words one number: its hash above, its place below; sorted.

    The place takes as many bits as the text needs, so equal windows come to stand
    side by side; ``_repeated`` compares the words themselves.
    """
    place = F.transform(F.sequence(F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(1))), lambda i: _shifted(
        "left", F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)), bits).bitwiseOR(i.cast("long")))
    return F.sort_array(place)


def _repeated(words: Column, sorted_windows: Column, bits: Column) -> Column:
    """Places of windows whose words stand elsewhere in the text too, in order.

    A window is compared with its neighbours in hash order.  A different window of the same hash between two equal ones would hide
    them; what is left of the hash beside the place makes that likely only in texts of about a million words.
    """
    size = F.size(sorted_windows)
    mask = _shifted("left", F.lit(1).cast("long"), bits) - 1
    spot = lambda i: F.get(sorted_windows, i).bitwiseAND(mask).cast("int")

    def same(a: Column, b: Column) -> Column:
        near = _shifted("rightunsigned", F.get(sorted_windows, a), bits) == _shifted(
            "rightunsigned", F.get(sorted_windows, b), bits)
        alike = F.lit(True)
        for k in range(WINDOW):
            alike = alike & (F.get(words, spot(a) + (k - 1)) == F.get(words, spot(b) + (k - 1)))
        return F.coalesce(near & alike, F.lit(False))

    hits = F.filter(F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0))),
                    lambda i: ((i > 0) & same(i, i - 1)) | ((i < size - 1) & same(i, i + 1)))
    return F.sort_array(F.transform(hits, spot))


def _covered(places: Column) -> Column:
    """How many words the windows at these places cover together."""
    last = F.size(places)
    gaps = F.zip_with(F.slice(places, 1, F.greatest(last - 1, F.lit(0))),
                      F.slice(places, 2, F.greatest(last - 1, F.lit(0))), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    return F.when(last == 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(WINDOW), lambda x, y: x + y))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _barrier() -> Column:
    """Always true.  Catalyst moves no filter below a column that uses it; a filter moved down would
    repeat the whole chain of array expressions for each of its uses."""
    return F.monotonically_increasing_id() >= 0


def _with_measures(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """``df`` with the measures, each named with ``prefix``; steps follow one another so
    that none is worked out again for each use."""
    def add(name, value):
        nonlocal df
        df = df.withColumn(prefix + name, value)

    own = lambda name: F.col(prefix + name)
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    add("words", words_of(value))
    add("n_words", F.size(own("words")))
    add("bits", F.length(F.bin(own("n_words").cast("long"))))
    add("windows", F.when(own("n_words") >= WINDOW, _windows(own("words"), own("n_words"), own("bits"))).otherwise(
        F.array().cast("array<bigint>")))
    add("places", F.when(_barrier(), _repeated(own("words"), own("windows"), own("bits"))))
    lines = F.filter(F.split(value, "\n"), lambda line: line.rlike(f"[^{WHITE}]"))
    add("lines", lines)
    add("n_lines", F.size(own("lines")).cast("long"))
    add("n_dup_lines", (own("n_lines") - F.size(F.array_distinct(own("lines")))).cast("long"))
    add("word_chars", F.length(F.array_join(own("words"), "")).cast("long"))
    add("n_symbols", F.regexp_count(value, F.lit(SYMBOLS)).cast("long"))
    add("n_repeat_words", F.when(own("n_words") >= WINDOW, _covered(own("places"))).otherwise(F.lit(0)).cast("long"))
    add("n_stop_words", F.regexp_count(value, F.lit(rf"(?i)(?<![^{WHITE}])(?:{'|'.join(STOP_WORDS)})(?![^{WHITE},.;:!?])")))
    add("n_capitals", F.regexp_count(value, F.lit(r"\p{Lu}")))
    add("n_words", own("n_words").cast("long"))
    add("mean_word_chars", _ratio(own("word_chars"), own("n_words")))
    add("symbol_ratio", _ratio(own("n_symbols"), own("word_chars")))
    add("stop_ratio", _ratio(own("n_stop_words"), own("n_words")))
    add("capital_ratio", _ratio(own("n_capitals"), own("word_chars")))
    add("dup_line_ratio", _ratio(own("n_dup_lines"), own("n_lines")))
    add("repeat_ratio", _ratio(own("n_repeat_words"), own("n_words")))
    return df


def _verdict(prefix: str, rules) -> tuple[Column, Column]:
    own = lambda name: F.col(prefix + name)
    failed = (own("n_words") < MIN_WORDS) | (100 * own("n_repeat_words") > MAX_REPEAT_PERCENT * own("n_words"))
    kept = ~failed
    for _, measure, least, most in rules:
        if least is not None:
            kept = kept & (own(measure) >= F.lit(least))
        if most is not None:
            kept = kept & (own(measure) <= F.lit(most))
    return failed, kept


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATIOS = ["mean_word_chars", "symbol_ratio", "stop_ratio", "capital_ratio", "dup_line_ratio", "repeat_ratio"]


def quality(df: DataFrame, id_column: str = "doc_id", text: str = "text", rules=RULES) -> DataFrame:
    """Measures and verdict of every row: the id, counts, ``base_failed``, ``kept``, ratios."""
    measured = _with_measures(df.select(F.col(f"`{id_column}`"), F.col(f"`{text}`")), text, "__q_")
    failed, kept = _verdict("__q_", rules)
    return measured.select(
        f"`{id_column}`", *(F.col(f"__q_{c}").alias(c) for c in COUNTS), failed.alias("base_failed"),
        kept.alias("kept"), *(F.col(f"__q_{c}").alias(c) for c in RATIOS))


def passes(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows that every rule accepts, with the columns they came with."""
    measured = _with_measures(df, text, "__q_")
    judged = measured.select(*(f"`{c}`" for c in df.columns), (_verdict("__q_", rules)[1] & _barrier()).alias("__q_kept"))
    return judged.filter("__q_kept").drop("__q_kept")
