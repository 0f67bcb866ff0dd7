"""Line-first cleaning: rules look at one line at a time and remove it, then documents that lost too much go.

Everything is built from column expressions; a document's arrays of words and lines never leave its row, so
nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.functions.scalars import let
from stockyard.llm.texts import carried

FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "clean_text", "removed", "lost", "kept")

# Fixed values, in Java's regex dialect.
BLANK = r"[ \x09-\x0D]"
SYMBOLS = "#*$%&|<>"
BOILERPLATE = (
    r"(?i)(lorem ipsum|all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)|use of cookies"
    r"|enable javascript|subscribe to our newsletter|powered by|copyright ©|\(c\) \d{4})")
NAVIGATION = (
    r"(?i)^\W*(home|menu|next|previous|back to top|log ?in|log ?out|sign (in|up|out)|register|share( this)?|read more|click here"
    r"|skip to (main )?content|contact us|about us|sitemap|search|comments?|reply|print|email)\W*$")
SEPARATOR = r" [|»›·•>/] "
TWO_CAPITALS = r"\p{Lu}[^\p{L}]*\p{Lu}"
ENDS = r"[.!?…:;。！？)\]\"'”’»]$"

#: Parameters: a line with fewer words must end in punctuation; parts of a line's characters that may be symbols
#: or capitals; separators that make a line a menu, if there is one for so many words or fewer; words from which a line is
#: boilerplate only if such phrases are that part of its characters; the part of a document's characters that may be lost.
SHORT_LINE = 8
MAX_SYMBOLS = 0.1
MAX_CAPITALS = 0.6
MENU_SEPARATORS = 3
MENU_WORDS = 8
PROSE_LINE = 20
MIN_BOILERPLATE = 0.1
MAX_LOSS = 0.4
MIN_WORDS = 50


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{BLANK}+"), "")


def line_fails(line: Column) -> Column:
    """Name of the first rule that a line with words breaks; null for a good line.

    What several rules need is bound once per line; what one rule needs is only worked out if no rule before it is broken.
    """
    def rules(text: Column, size: Column, n_words: Column) -> Column:
        menu = let(F.regexp_count(text, F.lit(SEPARATOR)), lambda n: (n >= MENU_SEPARATORS) & (n * MENU_WORDS >= n_words))
        phrases = text.rlike(BOILERPLATE) & ((n_words < PROSE_LINE) | (size - F.length(F.regexp_replace(text, BOILERPLATE, "")) >= MIN_BOILERPLATE * size))
        letters, capitals = (F.length(F.regexp_replace(text, f"[^\\p{{{k}}}]", "")) for k in ("L", "Lu"))
        # more than half capitals among a dozen letters: two of them follow each other
        shouted = text.rlike(TWO_CAPITALS) & let(letters, lambda n: (n >= 12) & (capitals > MAX_CAPITALS * n))
        return (F.when(size - _without(text, SYMBOLS) > MAX_SYMBOLS * size, "symbols").when(menu | text.rlike(NAVIGATION), "navigation")
                .when(phrases, "boilerplate").when(shouted, "capitals")
                .when((n_words < SHORT_LINE) & ~text.rlike(ENDS), "punctuation"))

    trimmed = F.regexp_replace(line, f"^{BLANK}+|{BLANK}+$", "")
    known = let(trimmed, lambda t: F.struct(t.alias("text"), F.length(t).alias("size"), F.size(F.split(t, f"{BLANK}+")).alias("n_words")))
    return let(known, lambda k: rules(k["text"], k["size"], k["n_words"]))


def clean(docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Quality measures, cleaned text and verdict, one row per row of ``docs``.

    Adds ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (lines with a word, equal to an
    earlier line), ``n_repeat_words`` (words in three-word windows found twice or more), ``base_failed`` (fewer than
    50 words, or more than half of them repeated), ``clean_text`` (the lines that break no rule, empty lines
    included), ``removed`` (rule names of the other lines, in order), ``lost`` (part of the characters in words that
    went with them) and ``kept``: not ``base_failed`` and not more than 0.4 lost.

    Three-word windows are compared by 64-bit hashes.  A null text counts as empty: no words, ``base_failed``.  Repeated rows are
    judged one by one; null ids and further columns make no difference; an empty table gives an empty result.
    """
    carry = carried(carry, FIELDS)
    raw = F.coalesce(F.col("_text"), F.lit(""))
    blank = " \t\n\x0b\x0c\r"
    df = docs.select(*[F.col(f"`{c}`").alias(f"_carry_{i}") for i, c in enumerate(carry)],
                     F.col(f"`{text}`").cast("string").alias("_text")).withColumn("_text", raw)
    df = df.withColumns({"_words": words_of(F.col("_text")), "_lines": F.split("_text", "\n", -1)})
    n = F.size("_words")

    def window(i: Column) -> Column:
        return F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2))

    df = df.withColumn("_windows", F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window))
                       .otherwise(F.array().cast("array<bigint>")))
    # positions ordered by window; only texts that repeat a window are sorted
    ordered = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    df = df.withColumn("_ordered", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), ordered))

    def repeated(x: Column, i: Column) -> Column:
        same = [F.coalesce(F.get("_ordered", j)["h"] == x["h"], F.lit(False)) for j in (i - 1, i + 1)]
        return same[0] | same[1]

    df = df.withColumn("_places", F.sort_array(F.transform(F.filter("_ordered", repeated), lambda x: x["at"])))
    # a window covers three words, less those the previous one has covered
    covered = F.transform("_places", lambda p, j: F.coalesce(F.least(F.lit(3), p - F.get("_places", j - 1)), F.lit(3)))
    df = df.withColumns({
        "_repeat": F.coalesce(F.aggregate(covered, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long"),
        "_judged": F.transform("_lines", lambda x: let(x.rlike(f"[^{BLANK[1:-1]}]"), lambda filled: F.struct(
            x.alias("line"), filled.alias("filled"), F.when(filled, line_fails(x)).alias("rule")))),
    })
    df = df.withColumns({
        "_filled": F.transform(F.filter("_judged", lambda x: x["filled"]), lambda x: x["line"]),
        "_clean": F.array_join(F.transform(F.filter("_judged", lambda x: x["rule"].isNull()), lambda x: x["line"]), "\n"),
        "_removed": F.transform(F.filter("_judged", lambda x: x["rule"].isNotNull()), lambda x: x["rule"]),
        "_chars": _without(F.col("_text"), blank).cast("long"),
    })
    failed = (n < MIN_WORDS) | (100 * F.col("_repeat") > 50 * n)
    lost = F.coalesce(F.try_divide(F.col("_chars") - _without(F.col("_clean"), blank), F.col("_chars")), F.lit(0.0))
    # the row number keeps a filter on the verdict from being pushed below, where it would repeat the work inside the lambdas
    df = df.withColumns({"_failed": failed, "_lost": lost, "_row": F.monotonically_increasing_id()})
    return df.select(
        *[F.col(f"_carry_{i}").alias(c) for i, c in enumerate(carry)], n.cast("long").alias("n_words"),
        F.col("_chars").alias("word_chars"),
        (F.length("_text") - _without(F.col("_text"), SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_filled") - F.size(F.array_distinct("_filled"))).cast("long").alias("n_dup_lines"),
        F.col("_repeat").alias("n_repeat_words"), F.col("_failed").alias("base_failed"), F.col("_clean").alias("clean_text"),
        F.col("_removed").alias("removed"), F.col("_lost").alias("lost"),
        (~F.col("_failed") & (F.col("_lost") <= MAX_LOSS) & (F.col("_row") >= 0)).alias("kept"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost")
