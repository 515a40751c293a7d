"""Operator 5: quality rules, line first. Native: column expressions only.

Every line is held against three rules (punctuation, navigation, boilerplate). Lines that fail go; a document that
loses more than half of its text, or fails the base rules on its word count and repeated five-word windows, goes too.
All of it is computed within the row, so nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import free_name, let, text_of

WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A document goes if its failed lines hold more than this share of its characters.
MAX_LOST_PERCENT = 50

# What the line rules look for.
RUN_OF_MARKS = r"[!?#*$%&|<>~^=_+]{2,}"
SEPARATOR = r"(?<=\s|^)[|>»›·•](?=\s|$)"
BOILERPLATE = (
    r"(?i)\b(all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)|we use cookies"
    r"|accept (all )?cookies|enable javascript|subscribe to our newsletter|sign up for our newsletter"
    r"|share (this )?on (facebook|twitter|linkedin)|follow us on|skip to (main )?content|back to top"
    r"|click here to|lorem ipsum)\b"
)
#: A line is boilerplate if its phrases hold at least one of so many of its words.
PHRASE_SHARE = 4


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def line_fails(line: Column) -> Column:
    """Punctuation: no letter or digit at all, or runs of marks on a third of the words. Navigation: separators
    between at most four words each. Boilerplate: known phrases that hold a quarter of the words. Blank lines don't fail."""
    words = F.regexp_count(line, F.lit(WORD))
    phrases = F.regexp_count(F.array_join(F.regexp_extract_all(line, F.lit(BOILERPLATE), F.lit(0)), " "), F.lit(WORD))
    marks, separators = F.regexp_count(line, F.lit(RUN_OF_MARKS)), F.regexp_count(line, F.lit(SEPARATOR))
    return (words > 0) & (
        ~line.rlike(r"[\p{L}\p{N}]")
        | ((marks >= 2) & (3 * marks >= words))
        | ((separators >= 2) & (5 * separators >= words))
        | (line.rlike(BOILERPLATE) & (PHRASE_SHARE * phrases >= words))
    )


def repeated_words(words: Column) -> Column:
    """Number of words that lie in a window of five words found twice or more in the same text.

    Windows are told apart by a hash first: where all hashes differ, so do the windows, and nothing is sorted.
    Otherwise the windows themselves are sorted, so the count is exact.
    """
    n = F.size(words)
    hashed = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(h[i + k] for k in range(WINDOW)))))
    windows = F.array_sort(F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.struct(
        F.concat_ws(" ", *(words[i + k] for k in range(WINDOW))).alias("g"), i.alias("p"))))

    def covered(sorted_windows: Column) -> Column:
        last = F.size(sorted_windows) - 1

        def repeated(w: Column, i: Column) -> Column:
            before, after = sorted_windows[F.greatest(i - 1, F.lit(0))], sorted_windows[F.least(i + 1, last)]
            return ((i > 0) & (before.g == w.g)) | ((i < last) & (after.g == w.g))

        places = F.array_sort(F.transform(F.filter(sorted_windows, repeated), lambda w: w.p))
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("n"))
        return F.aggregate(places, start, lambda a, p: F.struct(
            p.alias("last"), (a.n + F.least(p - a["last"], F.lit(WINDOW))).alias("n")), lambda a: a.n)

    some = let(hashed, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(n <= WINDOW, F.lit(0).cast("bigint")).when(
        some, let(windows, covered)).otherwise(F.lit(0).cast("bigint"))


def verdict(text: Column) -> Column:
    """Struct of the base figures, base_failed, kept and the cleaned text. Null counts as the empty text, which fails."""
    lines = F.split(text, "\n", -1)
    with_word = F.filter(lines, lambda x: F.length(_without(x, WHITE)) > 0)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    good = F.filter(lines, lambda x: ~line_fails(x))
    length = F.length(text).cast("bigint")  # a hundred times the length of a long text is beyond 32 bits

    def judged(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        return let(repeated_words(w), lambda repeat: let(F.array_join(good, "\n"), lambda clean: let(
            (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n), lambda failed: F.struct(
                n.alias("n_words"),
                F.length(_without(text, WHITE)).cast("bigint").alias("word_chars"),
                (length - F.length(_without(text, SYMBOLS))).alias("n_symbols"),
                let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
                repeat.alias("n_repeat_words"),
                failed.alias("base_failed"),
                (~failed & (100 * (length - F.length(clean)) <= MAX_LOST_PERCENT * length)).alias("kept"),
                clean.alias("clean_text"),
            ))))

    return let(words, judged)


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def clean(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """The rows with a struct of `FIGURES` and clean_text, and the name of that column.

    Row by row: repeated rows, nulls in other columns and columns of any name go through as they are.
    """
    name = free_name(docs, "_quality")
    # as a generator the verdict is computed once a row; a filter on it would otherwise compute it again
    return docs.select("*", F.explode(F.array(verdict(text_of(text_col)))).alias(name)), name


def op5(spark: SparkSession, docs: DataFrame) -> DataFrame:
    rows, q = clean(docs.select("doc_id", "text"))
    return rows.select("doc_id", *(f"{q}.{c}" for c in FIGURES))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass, without their failed lines."""
    rows, q = clean(docs)
    rows = rows.filter(f"{q}.kept").withColumn("text", F.col(f"{q}.clean_text"))
    return rows.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


SQL = r"""
with base as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
words as (select r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w from base),
flat as (select r, unnest(w) as x, generate_subscripts(w, 1) as i from words),
grams as (
  select r, i, x || ' ' || lead(x, 1) over p || ' ' || lead(x, 2) over p || ' ' || lead(x, 3) over p
    || ' ' || lead(x, 4) over p as g
  from flat window p as (partition by r order by i)),
twice as (select r, i, count(*) over (partition by r, g) as c from grams where g is not null),
hit as (select distinct r, i + k as i from twice, (select unnest([0, 1, 2, 3, 4]) as k) where c > 1),
repeats as (select r, count(*) as n_repeat_words from hit group by r),
lines as (select r, unnest(string_split(t, chr(10))) as l from base),
marks as (
  select r, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) as nw,
    len(regexp_extract_all(array_to_string(regexp_extract_all(l, '(?i)\b(all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)|we use cookies|accept (all )?cookies|enable javascript|subscribe to our newsletter|sign up for our newsletter|share (this )?on (facebook|twitter|linkedin)|follow us on|skip to (main )?content|back to top|click here to|lorem ipsum)\b'), ' '), '[^\x20\x09-\x0D]+')) as np,
    len(regexp_extract_all(l, '[!?#*$%&|<>~^=_+]{2,}')) as nm,
    len(list_filter(regexp_split_to_array(l, '\s'), lambda x: x in ('|', '>', '»', '›', '·', '•'))) as ns
  from lines),
judged as (
  select r, l, nw, (nw > 0 and (not regexp_matches(l, '[\p{L}\p{N}]') or (nm >= 2 and 3 * nm >= nw)
    or (ns >= 2 and 5 * ns >= nw) or (np > 0 and 4 * np >= nw)))
    as bad from marks),
per as (
  select r, count(*) filter (nw > 0) - count(distinct l) filter (nw > 0) as n_dup_lines,
    coalesce(sum(length(l)) filter (not bad), 0) + greatest(count(*) filter (not bad) - 1, 0) as clean_chars
  from judged group by r),
figures as (
  select doc_id, len(w) as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols, n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words, length(t) as chars, clean_chars
  from words join per using (r) left join repeats using (r))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and 100 * (chars - clean_chars) <= 50 * chars as kept
from figures
"""
