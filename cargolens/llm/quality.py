"""Line-first quality rules, with column functions only.

Each line is judged by itself: does a sentence end in it, is it a navigation bar, is
it boilerplate.  Lines that fail are removed.  A document is rejected when the
removed lines held too large a part of its words, or when it fails the base rules
(too few words, or too many words in repeated eight-word windows).

Everything happens inside one row: no shuffle, so hot sources and groups of copies
cost what other rows cost.

Cases: null text has no words and is rejected as too short, and its cleaned text is
empty; empty text likewise; blank lines have no words, are never removed, and count
neither as lost nor as repeated; the length of a text has no limit besides that of a
string; equal rows give equal results; an empty table gives no rows.  Only the text
column is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cargolens.llm.common import let, read

SPACES = " \t\n\u000b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
WINDOW = 8

# Fixed values of the line rules.
SENTENCE_END = r"""[.!?…。！？]["')\]»”’]*([\x20\x09-\x0D]|$)"""
SEPARATOR = r"(^|[\x20\x09])[|»›>•·/]([\x20\x09\x0D]|$)"
SYMBOL = r"[#*$%&|<>]"
BOILERPLATE = (
    r"(?i)lorem ipsum|cookie policy|privacy policy|terms of (use|service)"
    r"|all rights reserved|enable javascript|click here|read more|sign in|log in"
    r"|subscribe (now|to our)|skip to (main )?content|share (this|on)|back to top"
)


@dataclass(frozen=True)
class Rules:
    """Limits; the ratios are whole numbers in percent."""

    least_words: int = 20
    most_repeated: int = 30  # words in repeated windows, of all words
    most_shouts: int = 30  # exclamation marks, of the line's words
    least_separators: int = 2
    most_separators: int = 25  # separators, of the line's words
    most_symbols: int = 50  # symbol characters, of the line's words
    boilerplate_words: int = 30  # longer lines may hold such phrases
    most_lost: int = 50  # words in removed lines, of all words


def words(text: Column) -> Column:
    """The words of a text that is not null."""
    whole = F.btrim(text, F.lit(SPACES))
    return F.when(whole == "", F.array().cast("array<string>")).otherwise(
        F.split(whole, r"[\x20\x09-\x0D]+")
    )


def _words_in(line: Column) -> Column:
    return F.regexp_count(line, F.lit(WORD))


def line_fails(line: Column, rules: Rules = Rules()) -> Column:
    """Whether a line is to be removed; blank lines stay."""

    def judged(n: Column) -> Column:
        separators = F.regexp_count(line, F.lit(SEPARATOR))
        unended = ~line.rlike(SENTENCE_END)
        shouting = F.regexp_count(line, F.lit("!")) * 100 > n * rules.most_shouts
        symbols = F.regexp_count(line, F.lit(SYMBOL)) * 100 > n * rules.most_symbols
        navigation = let(
            separators,
            lambda s: (s >= rules.least_separators) & (s * 100 >= n * rules.most_separators),
        )
        boilerplate = (n <= rules.boilerplate_words) & line.rlike(BOILERPLATE)
        return (n > 0) & (unended | shouting | symbols | navigation | boilerplate)

    return let(_words_in(line), judged)


def _repeated_words(found: Column) -> Column:
    """Words inside eight-word windows that occur twice or more, the first included."""
    starts = F.sequence(F.lit(1), F.size(found) - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(found, i, WINDOW)))

    def exact(ordered: Column) -> Column:
        # Windows in order of their words: equal ones are neighbours.
        def start_if_repeated(window: Column, k: Column) -> Column:
            before, after = F.get(ordered, k - 1), F.get(ordered, k + 1)
            same = F.coalesce(before["w"] == window["w"], F.lit(False)) | F.coalesce(
                after["w"] == window["w"], F.lit(False)
            )
            return F.when(same, window["i"])

        repeated = F.sort_array(F.array_compact(F.transform(ordered, start_if_repeated)))
        # A window adds the words behind those that the one before it covered.
        return F.aggregate(
            repeated,
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda a, i: F.struct(
                (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")
            ),
            lambda a: a["n"],
        )

    windows = F.transform(
        starts,
        lambda i: F.struct(F.array_join(F.slice(found, i, WINDOW), " ").alias("w"), i.alias("i")),
    )
    # Distinct hashes mean distinct windows; only other texts need the exact words.
    several = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return (
        F.when(F.size(found) < WINDOW, F.lit(0))
        .when(~several, F.lit(0))
        .otherwise(let(F.sort_array(windows), exact))
    )


def judge(text: Column, rules: Rules = Rules()) -> Column:
    """Counts, verdicts and the cleaned text of a text, as a struct."""
    whole = F.coalesce(text, F.lit(""))

    def lines_and_words(t: Column) -> Column:
        lines = F.split(t, "\n", -1)
        # A line is removed or kept as a whole; lines are few beside words.
        kept = F.filter(lines, lambda line: ~line_fails(line, rules))
        worded = F.filter(lines, lambda line: line.rlike(WORD))
        return F.struct(
            let(worded, lambda w: F.size(w) - F.size(F.array_distinct(w))).alias("dup_lines"),
            let(
                words(t),
                lambda w: F.struct(F.size(w).alias("n"), _repeated_words(w).alias("repeated")),
            ).alias("words"),
            F.array_join(kept, "\n").alias("clean"),
            F.length(F.translate(t, SPACES, "")).alias("chars"),
            F.regexp_count(t, F.lit(SYMBOL)).alias("symbols"),
        )

    def verdicts(m: Column) -> Column:
        n, repeated = m["words"]["n"].cast("long"), m["words"]["repeated"].cast("long")
        lost = n - _words_in(m["clean"]).cast("long")
        failed = (n < rules.least_words) | (repeated * 100 > n * rules.most_repeated)
        return F.struct(
            n.alias("n_words"),
            m["chars"].cast("long").alias("word_chars"),
            m["symbols"].cast("long").alias("n_symbols"),
            m["dup_lines"].cast("long").alias("n_dup_lines"),
            repeated.alias("n_repeat_words"),
            failed.alias("base_failed"),
            (~failed & (lost * 100 <= n * rules.most_lost)).alias("kept"),
            lost.alias("n_lost_words"),
            m["clean"].alias("clean_text"),
        )

    return let(let(whole, lines_and_words), verdicts)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and the verdict of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", judge(F.col("text")).alias("q"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return docs.select(
        "doc_id", *[f"q.{name}" for name in (*names, "base_failed", "kept", "n_lost_words")]
    )


OP3_SQL = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
lines AS (
    SELECT doc_id, line, n,
           n > 0 AND (
               NOT regexp_matches(line, '[.!?…。！？]["'')\]»”’]*([\x20\x09-\x0D]|$)')
               OR 100 * (length(line) - length(replace(line, '!', ''))) > 30 * n
               OR 100 * length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) > 50 * n
               OR (s >= 2 AND 100 * s >= 25 * n)
               OR (n <= 30 AND regexp_matches(line, '(?i)lorem ipsum|cookie policy|privacy policy|terms of (use|service)|all rights reserved|enable javascript|click here|read more|sign in|log in|subscribe (now|to our)|skip to (main )?content|share (this|on)|back to top'))
           ) AS fails
    FROM (
        SELECT doc_id, line,
               len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
               len(regexp_extract_all(line, '(^|[\x20\x09])[|»›>•·/]([\x20\x09\x0D]|$)')) AS s
        FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs)
    )
),
by_line AS (
    SELECT doc_id, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines,
           coalesce(sum(n) FILTER (fails), 0) AS n_lost_words
    FROM lines GROUP BY doc_id
),
windows AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i:i + 7]) AS times
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM docs)
),
repeats AS (
    SELECT doc_id, sum(least(8, i - before)) AS n_repeat_words
    FROM (
        SELECT doc_id, i, lag(i, 1, -8) OVER (PARTITION BY doc_id ORDER BY i) AS before
        FROM windows WHERE times > 1
    )
    GROUP BY doc_id
),
counts AS (
    SELECT doc_id, len(words) AS n_words,
           length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, n_lost_words
    FROM docs JOIN by_line USING (doc_id) LEFT JOIN repeats USING (doc_id)
),
judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND 100 * n_lost_words <= 50 * n_words AS kept,
       n_lost_words::BIGINT AS n_lost_words
FROM judged
"""
