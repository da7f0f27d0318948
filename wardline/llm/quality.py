"""Document quality: rules within a text, and line frequency across the documents of a host.

Only DataFrame functions: counts within a text are array expressions, evaluated while the table is
scanned; only hashes of lines are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import WORD_GAP, WORD_SEPARATORS, let, store
from wardline.llm.skew import semi_join
from wardline.session import lookup_side

SYMBOLS = "#*$%&|<>"  # fixed value
REPEAT_WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# A line in more documents of a host than this percentage of them, and than the floor, is taken for boilerplate.
LINE_PERCENT = 5
LINE_FLOOR = 10
# A document with fewer words left than this percentage is rejected.
LEAST_LEFT_PERCENT = 20


def words_of(text: Column) -> Column:
    """Words of a text: the longest runs without white space."""
    return F.filter(F.split(text, WORD_GAP, -1), lambda w: w != "")


def repeated_words(words: Column, window: int = REPEAT_WINDOW) -> Column:
    """Number of words in windows that occur more than once.

    Windows are compared by a 64-bit hash of their words. Only texts in which the number of distinct
    hashes is smaller than that of windows are looked into: their (hash, place) pairs are sorted,
    those with an equal neighbour give the places of repeated windows, and each of these covers
    the words up to the next one, ``window`` at most.
    """

    def hashes(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - window)
        return F.transform(places, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))

    def with_neighbour(s: Column) -> Column:
        return F.filter(
            s, lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))
        )

    def covered(p: Column) -> Column:
        ends = F.transform(p, lambda x, j: F.least(F.lit(window), F.coalesce(F.get(p, j + 1) - x, F.lit(window))))
        return F.aggregate(ends, F.lit(0), lambda a, b: a + b)

    def count(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, j: F.struct(x.alias("h"), j.alias("i"))))
        places = let(pairs, lambda s: F.array_sort(F.transform(with_neighbour(s), lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(places, covered))

    return F.when(F.size(words) < window, 0).otherwise(let(words, lambda w: let(hashes(w), count)))


def base_columns(text: Column) -> dict[str, Column]:
    """The counts of the result's definition; null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    dense = F.translate(text, WORD_SEPARATORS, "")
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.translate(line, WORD_SEPARATORS, "") != "")
    return {
        "_words": words_of(text),
        "word_chars": F.length(dense).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }


def normal_line(line: Column) -> Column:
    """A line in lower case with single spaces."""
    return F.trim(F.regexp_replace(F.lower(line), WORD_GAP, " "))


def _host(docs: DataFrame) -> Column:
    """The host as text; a null source is a host of its own, apart from the empty one."""
    return F.when(F.col("source").isNull(), "null").otherwise(F.concat(F.lit("host "), F.col("source")))


def line_key(line: Column) -> Column:
    """The first 60 bits of a line's MD5: stands for the line, and orders lines as if at random."""
    return F.conv(F.substring(F.md5(line), 1, 15), 16, 10).cast("bigint")


def line_rows(docs: DataFrame) -> DataFrame:
    """host, text (a hash), place, line (a key) and words: a row for each line with a word of each row."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    rows = docs.select(
        _host(docs).alias("host"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text"),
        F.posexplode(F.transform(lines, normal_line)).alias("place", "line"),
    ).where("line <> ''")
    return rows.select("host", "text", "place", line_key(F.col("line")).alias("line"), F.size(F.split("line", " ")).alias("words"))


def removals(
    docs: DataFrame,
    line_percent: int = LINE_PERCENT,
    line_floor: int = LINE_FLOOR,
    least_left_percent: int = LEAST_LEFT_PERCENT,
) -> DataFrame:
    """host, text (a hash), words taken out and lines (keys) of each text that holds boilerplate.

    A line is boilerplate if more than ``line_percent`` of a host's documents hold it, and more than ``line_floor``.
    Documents count as follows. Equal texts are one document. A text with less than ``least_left_percent`` of its words
    in lines of its own has the rest in common with others: it is a copy or nothing but boilerplate. Such texts are
    one document if the smallest of their shared lines is the same. Near copies have it in common, but for those
    few that were edited there, so they do not make each other's lines boilerplate.
    """
    # Exact copies of a text meet in their places, on the map side first, and count once; so does a line that most rows hold.
    once = line_rows(docs).groupBy("host", "text", "line", "place").agg(F.max("words").alias("words"))
    lines = store(once.groupBy("host", "text", "line").agg(F.sum("words").alias("words")), "text-lines")
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("n"))
    held = store(semi_join(lines, store(counts.where("n > 1"), "line-counts"), ["host", "line"], "n"), "shared-lines")
    both = lines.select("host", "text", "words", F.lit(0).alias("shared"), F.lit(None).cast("long").alias("line")).unionByName(
        held.select("host", "text", F.lit(0).alias("words"), F.col("words").alias("shared"), "line")
    )
    of_text = both.groupBy("host", "text").agg(F.sum("words").alias("all"), F.sum("shared").alias("shared"), F.min("line").alias("least"))
    copied = 100 * (F.col("all") - F.col("shared")) < least_left_percent * F.col("all")
    # What a text counts as: the texts themselves (0), or all those of one smallest shared line (1).
    kinds = store(of_text.select("host", "text", copied.cast("int").alias("copied"), F.when(copied, F.col("least")).otherwise(F.col("text")).alias("kind")), "kinds")
    sizes = kinds.groupBy("host", "copied", "kind").agg(F.count("*").alias("n")).groupBy("host").agg(F.count("*").alias("documents"))
    counted = held.join(kinds, ["host", "text"]).groupBy("host", "line", "copied", "kind").agg(F.count("*").alias("n"))
    counted = counted.groupBy("host", "line").agg(F.count("*").alias("documents_with"), F.sum("n").alias("n"))
    limit = F.greatest(F.lit(100 * line_floor), line_percent * F.col("documents"))
    frequent = counted.join(lookup_side(store(sizes, "host-sizes")), "host").where(100 * F.col("documents_with") > limit)
    frequent = store(frequent.select("host", "line", "n"), "frequent-lines")
    gone = semi_join(held, frequent, ["host", "line"], "n").groupBy("host", "text")
    return store(gone.agg(F.sum("words").alias("words"), F.collect_set("line").alias("lines")), "line-removals")


def judge(
    docs: DataFrame,
    line_percent: int = LINE_PERCENT,
    line_floor: int = LINE_FLOOR,
    least_left_percent: int = LEAST_LEFT_PERCENT,
) -> DataFrame:
    """doc_id, n_words, the base counts, base_failed, n_boilerplate_words and kept of every row.

    A document is kept if it passes the base rules and at least ``least_left_percent`` of its words are
    left once boilerplate (see ``removals``) is taken out. Null text counts as empty; empty texts fail. Repeated rows
    get a row each and count as one text; null sources are one host; empty tables give no rows; other columns
    are not looked at.
    """
    gone = lookup_side(removals(docs, line_percent, line_floor, least_left_percent).select("host", "text", "words"))
    base = docs.select(
        "doc_id", _host(docs).alias("host"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text"),
        *[c.alias(name) for name, c in base_columns(F.col("text")).items()],
    )
    base = base.select(
        "doc_id", "host", "text", F.size("_words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        "n_dup_lines", repeated_words(F.col("_words")).cast("long").alias("n_repeat_words"),
    )
    joined = base.join(gone, ["host", "text"], "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    removed = F.coalesce("words", F.lit(0)).cast("long")
    left = F.col("n_words") - removed
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), removed.alias("n_boilerplate_words"),
        (~failed & (100 * left >= least_left_percent * F.col("n_words"))).alias("kept"),
    )


def clean(
    docs: DataFrame,
    line_percent: int = LINE_PERCENT,
    line_floor: int = LINE_FLOOR,
    least_left_percent: int = LEAST_LEFT_PERCENT,
) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps with all their columns, without boilerplate.

    Null texts count as empty and go; the text changes only where lines go; ``n_chars``, if there, follows it. Texts are not
    shuffled where the table of removals is small enough to be broadcast.
    """
    gone = removals(docs, line_percent, line_floor, least_left_percent)
    names = docs.columns
    text = F.coalesce("text", F.lit(""))
    base = docs.withColumn("_q_words", words_of(text))
    n = F.size("_q_words")
    repeats = repeated_words(F.col("_q_words"))
    base = base.where((n >= MIN_WORDS) & (100 * repeats <= MAX_REPEAT_PERCENT * n)).withColumn("_q_n", n).drop("_q_words")
    base = base.withColumn("_q_host", _host(docs)).withColumn("_q_text", F.xxhash64(text))
    gone = gone.select(F.col("host").alias("_q_host"), F.col("text").alias("_q_text"), F.col("words").alias("_q_gone"), F.col("lines").alias("_q_lines"))
    joined = base.join(lookup_side(gone), ["_q_host", "_q_text"], "left")
    left = F.col("_q_n") - F.coalesce("_q_gone", F.lit(0))
    joined = joined.where(100 * left >= least_left_percent * F.col("_q_n"))
    stays = F.filter(F.split("text", "\n", -1), lambda x: ~F.array_contains("_q_lines", line_key(normal_line(x))))
    new = F.when(F.col("_q_lines").isNull(), F.col("text")).otherwise(F.array_join(stays, "\n"))
    out = joined.withColumn("text", new)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("_q_lines").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*names)
