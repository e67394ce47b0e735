"""Line-first cleaning in DataFrame functions only.

Every line is judged on its own: it is boilerplate if stock phrases make up much of it (few other
words, or at least a quarter of its words), so that a phrase in a long line of prose costs nothing;
it fails the punctuation rule if it neither ends like a sentence nor has one inside, and the
navigation rule if separators or signs take up too many of its words or it shouts. All such lines
are removed. A document is rejected that loses more than half of its text to the three rules, that
is nothing but boilerplate, or that fails the base rules. A closing boilerplate line, such as a
licence, is removed too but counts neither as lost nor as text: it condemns no document.

All work is inside a row: no shuffle, no Python. Values used more than once are bound by a
one-element ``transform``, since Catalyst would otherwise put their expression into each lambda.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.registry import query, table

# Fixed values of the rules.
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
ENDINGS = (".", "!", "?", ":", ";", "…")
SENTENCE = "[.!?:;…][\"')\\]]*$|[\\p{L}0-9][.!?] +\\p{Lu}"
PHRASES = (
    "all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie policy",
    "we use cookies", "enable javascript", "licensed under", "subscribe to our", "sign up for",
    "click here", "read more", "copyright ©", "powered by", "follow us on", "share this",
)
WINDOW = 5
WORDS_LEAST, REPEATED_MOST, LOST_MOST = 10, 20, 50
BESIDE_MOST, PHRASE_SHARE = 10, 4  # words beside the phrases of a stock line, or the share of theirs


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def dense_length(text: Column) -> Column:
    """How many characters are no blanks."""
    return F.length(F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", ""))


def how_many(text: Column, characters: str) -> Column:
    """How often one of the characters stands in the text."""
    return F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]", ""))


def repeated_words(words: Column) -> Column:
    """How many words stand in a window of WINDOW words that the text has at least twice.

    Windows are compared by 64-bit hashes. Most texts have no window twice, which a set tells;
    the others sort theirs and add up what the repeated ones cover."""

    def covered(keys: Column) -> Column:
        ordered = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("key"), i.alias("at"))))

        def count(rows: Column) -> Column:
            twice = F.filter(rows, lambda r, j: (
                (j > 0) & (F.get(rows, j - 1)["key"] == r["key"])
            ) | ((j < F.size(rows) - 1) & (F.get(rows, j + 1)["key"] == r["key"])))
            starts = F.sort_array(F.transform(twice, lambda r: r["at"]))
            return F.aggregate(
                starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
                lambda done, at: F.struct(
                    (done["n"] + at + WINDOW - F.greatest(at, done["end"])).alias("n"), (at + WINDOW).alias("end")),
                lambda done: done["n"])

        return let(ordered, count)

    def checked(keys: Column) -> Column:
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), 0).otherwise(covered(keys))

    def of(w: Column) -> Column:
        keys = F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
        return F.when(F.size(w) <= WINDOW, 0).otherwise(let(keys, checked))

    return let(words, of)


def is_stock(line: Column) -> Column:
    """True for a line that is made up of stock phrases for the most part."""

    def phrase_words(low: Column) -> Column:
        return sum(F.when(low.contains(p), len(p.split())).otherwise(0) for p in PHRASES)

    def judged(low: Column) -> Column:
        any_ = low.contains(PHRASES[0])
        for phrase in PHRASES[1:]:
            any_ = any_ | low.contains(phrase)
        words = F.size(word_list(low))
        mostly = let(phrase_words(low), lambda n: (words - n <= BESIDE_MOST) | (n * PHRASE_SHARE >= words))
        return F.when(any_, mostly).otherwise(False)  # most lines hold none

    return let(F.lower(line), judged)


def line_fails(line: Column) -> Column:
    """True for a line that punctuation or navigation rules remove; blank lines pass.

    The cheap half of each rule comes first: most lines need no pattern at all."""

    def judged(t: Column) -> Column:
        words = F.size(F.split(t, "[\\x20\\x09-\\x0D]+"))
        unended = ~F.right(t, F.lit(1)).isin(*ENDINGS) & ~t.rlike(SENTENCE)
        signs = t.rlike(f"[{SYMBOLS}]") & let(
            how_many(t, SYMBOLS), lambda n: (n >= 2) & (n * 5 >= words))
        shouts = t.contains("!") & let(how_many(t, "!"), lambda n: (n >= 3) & (n * 3 >= words))
        return (t != "") & (unended | signs | shouts)

    return let(F.rtrim(line, F.lit(BLANKS)), judged)


def clean_lines(text: Column) -> Column:
    """The text without failing lines."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda l: ~is_stock(l) & ~line_fails(l)), "\n")


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, prose_chars, lost_chars.

    A null text has no words and fails. Blanks apart, ``prose_chars`` counts the characters outside
    boilerplate lines, ``lost_chars`` those in lines that any rule removes, but for the last line with
    a word if it is boilerplate. Repeated rows are judged each; other columns are left out, so their
    names can't clash. An empty table gives no rows.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    none = F.lit(0).cast("long")

    def chars(lines: Column, which: Callable[[Column], Column]) -> Column:
        return F.aggregate(lines, none, lambda n, l: n + F.when(which(l), l["chars"]).otherwise(0))

    def judged(line: Column) -> Column:
        return let(is_stock(line), lambda stock: F.struct(
            dense_length(line).alias("chars"), stock.alias("stock"), F.when(stock, False).otherwise(line_fails(line)).alias("fails")))

    def of_judged(lines: Column) -> Column:
        closing = F.when(F.try_element_at(lines, F.lit(-1))["stock"], F.try_element_at(lines, F.lit(-1))["chars"])
        return F.struct(
            chars(lines, lambda l: l["stock"]).alias("stock"), chars(lines, lambda l: l["fails"]).alias("failed"),
            F.coalesce(closing, F.lit(0)).cast("long").alias("closing"))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("chars"),
            repeated_words(w).cast("long").alias("repeated"))

    def of_filled(lines: Column) -> Column:
        return F.struct(
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("twice"),
            let(F.transform(lines, judged), of_judged).alias("sums"))

    def of_lines(lines: Column) -> Column:
        return let(F.filter(lines, lambda l: l.rlike("[^\\x20\\x09-\\x0D]")), of_filled)

    counted = docs.select(
        F.col(doc_id), how_many(t, SYMBOLS).cast("long").alias("n_symbols"),
        let(word_list(t), of_words).alias("words"), let(F.split(t, "\n"), of_lines).alias("lines"),
    ).select(
        doc_id, F.col("words.n").alias("n_words"), F.col("words.chars").alias("word_chars"), "n_symbols",
        F.col("lines.twice").alias("n_dup_lines"), F.col("words.repeated").alias("n_repeat_words"),
        (F.col("words.chars") - F.col("lines.sums.stock")).alias("prose_chars"),
        (F.col("lines.sums.stock") + F.col("lines.sums.failed") - F.col("lines.sums.closing")).alias("lost_chars"),
        (F.col("words.chars") - F.col("lines.sums.closing")).alias("judged_chars"))
    failed = (F.col("n_words") < WORDS_LEAST) | (100 * F.col("n_repeat_words") > REPEATED_MOST * F.col("n_words"))
    kept = ~failed & (F.col("prose_chars") > 0) & (100 * F.col("lost_chars") <= LOST_MOST * F.col("judged_chars"))
    return counted.select(
        doc_id, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), kept.alias("kept"), "prose_chars", "lost_chars")


_BLANK_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_PHRASE_WORDS_SQL = " + ".join(f"CASE WHEN contains(lower(line), '{p}') THEN {len(p.split())} ELSE 0 END" for p in PHRASES)
_SENTENCE_SQL = ("[.!?:;…]$|" + SENTENCE).replace("'", "''")
RULES_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text,
         list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
         length(translate(text, {_BLANK_SQL}, '')) AS word_chars
  FROM d),
spots AS (
  SELECT doc_id, unnest(range(0, len(words) - {WINDOW - 1})) AS pos, words FROM w WHERE len(words) > {WINDOW}),
windows AS (
  SELECT doc_id, pos, array_to_string(words[pos + 1:pos + {WINDOW}], ' ') AS k FROM spots),
twice AS (
  SELECT doc_id, pos FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT pos + o) AS n
  FROM twice, (SELECT unnest(range(0, {WINDOW})) AS o) GROUP BY doc_id),
lines AS (
  SELECT doc_id, place, line, rtrim(line, {_BLANK_SQL}) AS t,
         length(translate(line, {_BLANK_SQL}, '')) AS chars
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS place FROM d)),
judged AS (
  SELECT *, len(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+')) AS words,
         length(t) - length(translate(t, '{SYMBOLS}', '')) AS signs,
         length(t) - length(translate(t, '!', '')) AS shouts,
         {_PHRASE_WORDS_SQL} AS phrase_words,
         len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS line_words
  FROM lines),
failing AS (
  SELECT *, t <> '' AND (NOT regexp_matches(t, '{_SENTENCE_SQL}') OR (signs * 5 >= words AND signs >= 2)
                         OR (shouts * 3 >= words AND shouts >= 3)) AS fails,
         phrase_words > 0 AND (line_words - phrase_words <= {BESIDE_MOST} OR phrase_words * {PHRASE_SHARE} >= line_words) AS stock
  FROM judged),
per_doc AS (
  SELECT doc_id, count(*) FILTER (chars > 0) - count(DISTINCT line) FILTER (chars > 0) AS n_dup_lines,
         coalesce(sum(chars) FILTER (NOT stock), 0) AS prose_chars,
         coalesce(sum(chars) FILTER (fails OR stock), 0) AS removed_chars,
         coalesce(arg_max(CASE WHEN stock THEN chars ELSE 0 END, place) FILTER (chars > 0), 0) AS closing_chars
  FROM failing GROUP BY doc_id),
rows AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(prose_chars AS BIGINT) AS prose_chars, CAST(removed_chars - closing_chars AS BIGINT) AS lost_chars,
         word_chars - closing_chars AS judged_chars
  FROM w JOIN per_doc USING (doc_id) LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {WORDS_LEAST} OR 100 * n_repeat_words > {REPEATED_MOST} * n_words AS base_failed,
       NOT (n_words < {WORDS_LEAST} OR 100 * n_repeat_words > {REPEATED_MOST} * n_words)
         AND prose_chars > 0 AND 100 * lost_chars <= {LOST_MOST} * judged_chars AS kept,
       prose_chars, lost_chars
FROM rows"""


@query("op1_quality_rules", RULES_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the line rules for every document."""
    return quality_rules(table(spark, sf_dir, "documents"))
