"""Quality rules: one table of thresholds, compiled into one projection.

``MEASURES`` are counts of a text as Spark expressions; ``RULES`` bounds ratios
of two of them. ``quality`` turns both into a single ``select`` over the rows:
no user function, no join, no shuffle, so a row costs the same wherever it lies
and however its source is skewed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space and word characters of the text contract.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"  # everything that is not a symbol

# Fixed list: frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it with as was on be by this are or from at "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch "
    "de la le et les un une du que est pour dans qui par au sur pas avec "
    "el los y se las por con para del al es lo no su").split()

WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``least <= 100 * of / per <= most``, looked at from ``from_words`` words on."""

    name: str
    of: str
    per: str
    least: int = 0
    most: int = 100
    from_words: int = 0


# The threshold table. Percentages of whole counts, so that no rounding decides.
RULES = (
    Rule("word_length", "word_chars", "n_words", least=200, most=1500),
    Rule("symbols", "n_symbols", "word_chars", most=5),
    Rule("capitals", "n_capitals", "word_chars", most=60),
    Rule("dup_lines", "n_dup_lines", "n_lines", most=50),
    Rule("stop_words", "n_stop_words", "n_words", least=3, from_words=50),
)
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent of words in repeated windows


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: inside a lambda, Spark would
    compute an expression anew for every element."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column) -> Column:
    """Words lying in windows of five words that occur twice or more in the text.

    Windows are compared by a 64-bit hash; sorting the hashes shows whether any
    two agree. Only then are (hash, place) pairs sorted, each checked word by
    word against its neighbour, and the covered words counted from the places.
    """
    last = F.size(words) - F.lit(WINDOW) + 1
    window = lambda i: F.slice(words, i, WINDOW)
    hashed = lambda w, i: F.xxhash64(w, *(F.get(words, i + j) for j in range(1, WINDOW)))
    starting = F.slice(words, F.lit(1), last)
    any_twice = F.size(F.array_distinct(F.transform(starting, hashed))) < last
    pairs = F.sort_array(F.transform(starting, lambda w, i: F.struct(hashed(w, i).alias("h"), (i + 1).alias("i"))))

    def same(p: Column, other: Column) -> Column:
        return (p["h"] == other["h"]) & (window(p["i"]) == window(other["i"]))

    def starts(pairs: Column) -> Column:
        marked = F.transform(pairs, lambda p, k: F.when(
            same(p, F.get(pairs, k - 1)) | same(p, F.get(pairs, k + 1)), p["i"]))
        return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

    covered = F.aggregate(
        _bound(pairs, starts), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, i: F.struct((acc["n"] + i + WINDOW - F.greatest(acc["end"], i)).alias("n"), (i + WINDOW).alias("end")),
        lambda acc: acc["n"])
    return F.when(F.size(words) <= WINDOW, 0).when(any_twice, covered).otherwise(0)


def measures(text: Column, words: Column) -> dict[str, Column]:
    """Every count that a rule may use, as an expression."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.length(F.regexp_replace(text, SYMBOLS, "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeated_words(words),
        "n_lines": F.size(lines),
        "n_capitals": F.length(F.regexp_replace(text, "[^A-Z]+", "")),
        "n_stop_words": F.size(F.filter(words, lambda w: w.isin(*STOP_WORDS))),
    }


def fails(rule: Rule) -> Column:
    """True if the counts break the rule."""
    of, per = 100 * F.col(rule.of), F.col(rule.per)
    broken = (of < rule.least * per) | (of > rule.most * per)
    return broken & (F.col("n_words") >= rule.from_words)


def _counts(text: Column) -> Column:
    """All measures of a text as one struct. Words are bound inside, so that a
    filter pushed below a projection never splits a text once per word."""
    text = F.coalesce(text, F.lit(""))
    return _bound(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda words: F.struct(
        *(c.cast("long").alias(n) for n, c in measures(text, words).items())))


def _judged(counted: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    broken = F.concat_ws(",", *(F.when(fails(r), F.lit(r.name)) for r in rules))
    return counted.withColumns({"base_failed": base, "failed": broken}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("failed") == ""))


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every document's counts, ``base_failed``, ``kept`` and ``failed`` (names
    of the broken rules, comma-joined, in table order). ``docs`` needs doc_id
    and text.

    A null text counts as empty: no words, so it fails the base. A null doc_id
    stays; repeated rows are judged each; other columns are not read; an empty
    table gives no rows.
    """
    return _judged(docs.select("doc_id", _counts(F.col("text")).alias("c")).select("doc_id", "c.*"), rules)


def kept_rows(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are."""
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), _counts(F.col("text")).alias("c"))
    return _judged(whole.select("row", "c.*"), rules).where("kept").select("row.*")


def _sql_rules() -> str:
    return ", ".join(
        f"CASE WHEN n_words >= {r.from_words} AND (100 * {r.of} < {r.least} * {r.per} OR 100 * {r.of} > {r.most} * {r.per}) "
        f"THEN '{r.name}' END" for r in RULES)


ORACLE = f"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM t),
win AS (
  SELECT r, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS g
  FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - {WINDOW - 1})) AS i FROM w) s),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) s WHERE n > 1),
rep AS (
  SELECT r, sum(CASE WHEN nxt IS NULL THEN {WINDOW} ELSE least({WINDOW}, nxt - i) END) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM twice) s GROUP BY r),
c AS (
  SELECT w.r, doc_id, len(ws) AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         len(ls) AS n_lines,
         length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_capitals,
         len(list_filter(ws, lambda x: x IN ({", ".join(f"'{w}'" for w in STOP_WORDS)}))) AS n_stop_words
  FROM w LEFT JOIN rep ON rep.r = w.r),
j AS (
  SELECT *, (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AS base_failed,
         concat_ws(',', {_sql_rules()}) AS failed
  FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND failed = '') AS kept, n_lines, n_capitals, n_stop_words, failed
FROM j
"""
