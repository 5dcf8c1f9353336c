"""Quality rules: a table of ratio thresholds compiled into one chain of Spark projections, without user functions.

A rule names a ratio and the range it may take. ``measure`` adds the counts the ratios are made of, ``verdict`` turns
the table into a single boolean column. Everything is a built-in expression, so the plan is one scan and projections:
no shuffle, no Python, and memory bounded by one row.

Defined cases: a null text counts as empty; an empty text has no words and fails the base rules; repeated rows are judged
each on its own; an empty table gives an empty result; other columns of the input are kept by ``quality_rules`` unless
they bear the name of a measure, in which case the measure replaces them; those with the name of an inner column go.

Windows of five words are compared by their 64-bit hash within one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that for on with as was by are be at or it this an from not a "
    "de la le et les des en un une du que est pour dans qui par sur il au se ce "
    "der die das und ist zu den von mit nicht ein eine auf dem für im sich des er wie "
    "el los las y por con para una su al lo como más pero no del es"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes if low <= numerator / max(denominator, 1) <= high."""

    name: str
    numerator: str
    denominator: str
    low: float
    high: float


RULES = (
    Rule("mean_word_chars", "word_chars", "n_words", 1.5, 25.0),
    Rule("symbol_ratio", "n_symbols", "n_words", 0.0, 0.25),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 0.01, 1.0),
    Rule("dup_line_ratio", "n_dup_lines", "n_lines", 0.0, 0.6),
)
#: Columns of the projections in between.
INNER = ("_words", "_lines", "_windows", "_sorted", "_starts", "_row")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")


def _windows(words: Column) -> Column:
    """Hashes of the runs of five words; element i is the window that starts at word i."""
    later = [lambda i, k=k: F.get(words, i + k) for k in range(1, WINDOW)]
    return F.when(
        F.size(words) >= WINDOW,
        F.transform(F.slice(words, F.lit(1), F.size(words) - (WINDOW - 1)), lambda w, i: F.xxhash64(w, *(f(i) for f in later))),
    ).otherwise(F.array().cast("array<bigint>"))


def _covered(starts: Column) -> Column:
    """Words covered by windows that begin at these ascending positions."""
    gaps = F.transform(starts, lambda s, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - s, F.lit(WINDOW))))
    return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)


def measure(docs: DataFrame) -> DataFrame:
    """docs with the columns of MEASURES (long). Projections are staged so that no expression is evaluated twice."""
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in MEASURES + INNER]
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.split(F.btrim(text, F.lit(ASCII_SPACE)), r"[\x20\x09-\x0D]+")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(ASCII_SPACE)) != "")
    first = docs.select(
        *keep,
        F.when(F.translate(text, ASCII_SPACE, "") == "", F.array().cast("array<string>")).otherwise(words).alias("_words"),
        lines.alias("_lines"),
        F.length(F.translate(text, ASCII_SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    own = [*keep, "word_chars", "n_symbols"]
    second = first.select(
        *own,
        F.size("_words").cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        _windows(F.col("_words")).alias("_windows"),
    )
    own += ["n_words", "n_lines", "n_dup_lines", "n_stop_words"]
    repeated = F.size("_windows") > F.size(F.array_distinct("_windows"))
    third = second.select(*own, F.when(repeated, F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_sorted"))
    pairs = F.col("_sorted")
    same = lambda x, i: (F.get(pairs, i - 1)["h"] == x["h"]) | (F.get(pairs, i + 1)["h"] == x["h"])
    fourth = third.select(*own, F.array_sort(F.transform(F.filter(pairs, lambda x, i: F.coalesce(same(x, i), F.lit(False))), lambda x: x["i"])).alias("_starts"))
    return fourth.select(*own, F.coalesce(_covered(F.col("_starts")), F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True if every rule of the table holds."""
    out = F.lit(True)
    for r in rules:
        out = out & (F.col(r.numerator) / F.greatest(F.col(r.denominator), F.lit(1))).between(r.low, r.high)
    return out


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with its measures, base_failed and kept."""
    names = [c for c in docs.columns if c not in ("base_failed", "kept")]
    # A filter on the verdict must not sink below the measures: it would bring their whole expressions into every lambda. It stops at a
    # projection that isn't deterministic, if it needs that projection's column.
    measured = measure(docs.select(*names)).withColumn("_row", F.monotonically_increasing_id())
    failed = base_failed() | (F.col("_row") < 0)
    judged = measured.withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & verdict(rules)).drop("_row")


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL for the same rows as query op6."""
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    tests = " AND ".join(f"{r.numerator} / greatest({r.denominator}, 1) BETWEEN {r.low} AND {r.high}" for r in rules)
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
    g AS (SELECT doc_id, i, list_aggregate(words[i:i + 4], 'string_agg', ' ') AS win
          FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
    r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, win) >= 2),
    c AS (SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n FROM r, range(5) s(k) GROUP BY doc_id),
    m AS (SELECT w.doc_id, len(words)::BIGINT AS n_words,
                 length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
                 length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                 (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                 coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
                 len(list_filter(words, lambda x: lower(x) IN ({stops})))::BIGINT AS n_stop_words
          FROM w LEFT JOIN c USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
           NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND {tests} AS kept
    FROM m"""
