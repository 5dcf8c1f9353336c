"""Signal and quality scores, weights and bonuses."""

from __future__ import annotations

import fnmatch
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import expressions as X
from . import values as V


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def signal_score(url: Column, text: Column, rewards=V.SIGNAL_REWARDS, penalties=V.SIGNAL_PENALTIES) -> Column:
    """0 to 1: a base by URL type, moved by patterns, length and character shares; 0.1 below 30 words."""
    words, kind = X.word_count(text), X.classify_url(url)
    base = X.first_of([(kind == k, s) for k, s in V.SIGNAL_BASE.items()], V.SIGNAL_BASE_OTHER)
    moved = (
        base
        + 0.03 * X.total([X.matches(text, p, i).cast("int") for p, i in rewards])
        - 0.08 * X.total([X.matches(text, p, i).cast("int") for p, i in penalties])
        + F.when(words > 500, 0.05).otherwise(0.0) + F.when(words > 2000, 0.05).otherwise(0.0)
        - F.when(X.alpha_ratio(text) < 0.5, 0.1).otherwise(0.0)
        - F.when(X.distinct_ratio(text) < 0.2, 0.15).otherwise(0.0)
        - F.when(X.digit_ratio(text) > 0.3, 0.1).otherwise(0.0)
    )
    return F.when(words < 30, F.lit(0.1)).otherwise(clamp(moved, 0.0, 1.0))


def quality_score(text: Column, rewards=V.QUALITY_REWARDS, penalties=V.QUALITY_PENALTIES) -> Column:
    """0.05 to 1, from 0.5; 0.1 below 50 words."""
    words, mean = X.word_count(text), X.mean_word_length(text)
    moved = (
        F.lit(0.5)
        - F.when(words > 100_000, 0.1).otherwise(0.0)
        - F.when((mean < 3.5) | (mean > 12.0), 0.15).otherwise(0.0)
        - F.when(X.distinct_ratio(text) < 0.2, 0.2).otherwise(0.0)
        - F.when(X.digit_ratio(text) > 0.3, 0.1).otherwise(0.0)
        - F.when(X.alpha_ratio(text) < 0.6, 0.15).otherwise(0.0)
        + 0.05 * X.total([X.matches(text, p).cast("int") for p in rewards])
        - 0.08 * X.total([X.matches(text, p).cast("int") for p in penalties])
    )
    return F.when(words < 50, F.lit(0.1)).otherwise(clamp(moved, 0.05, 1.0))


#: What a domain that no rule fits has.
DOMAIN_DEFAULT = (0.8, "general_web")


def glob_regex(pattern: str) -> str:
    """A shell pattern as a regular expression of the JVM, to be found at the start."""
    return "^" + re.sub(r"\\[Zz]$", r"\\z", fnmatch.translate(pattern))


def rule_fits(domain: Column, pattern: str) -> Column:
    """Whether a rule's pattern is a star, part of the domain, or a shell pattern for the whole of it."""
    if pattern == "*":
        return F.lit(True)
    part = domain.contains(pattern)
    return part | domain.rlike(glob_regex(pattern)) if set(pattern) & set("*?[") else part


def domain_rule(domain: Column, rules=V.DOMAINS) -> tuple[Column, Column]:
    """(weight, category) of the first rule that fits, for a few rules; operators.rules has tables of any size."""
    hit = [(rule_fits(domain, p), w, c) for p, w, c in rules]
    return X.first_of([(h, w) for h, w, _ in hit], DOMAIN_DEFAULT[0]), X.first_of([(h, c) for h, _, c in hit], DOMAIN_DEFAULT[1])


def lookup(key: Column, weights: dict[str, float], default: float) -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for kv in weights.items() for x in kv))[key], F.lit(default))


def type_weight(kind: Column) -> Column:
    return lookup(kind, V.TYPE_WEIGHTS, V.TYPE_WEIGHTS["unknown"])


def language_weight(language: Column) -> Column:
    return lookup(language, V.LANGUAGE_WEIGHTS, V.LANGUAGE_WEIGHTS["unknown"])


def apply_weights(docs: DataFrame, domains=V.DOMAINS) -> DataFrame:
    """docs with domain_weight, content_type_weight, quality_score, final_weight and meta.category."""
    weight, category = domain_rule(F.col("domain"), domains)
    code = F.when((F.col("content_type") == "source_code") & (F.col("code_language") != ""), language_weight(F.col("code_language"))).otherwise(F.lit(1.0))
    scored = docs.withColumns({"domain_weight": weight, "content_type_weight": type_weight(F.col("content_type")), "quality_score": quality_score(F.col("text"))})
    out = scored.withColumn("final_weight", F.col("domain_weight") * F.col("content_type_weight") * code * F.col("quality_score"))
    if "meta" in docs.columns:
        given = F.coalesce("meta", F.create_map().cast("map<string,string>"))
        out = out.withColumn("meta", F.when(F.map_contains_key(given, "category"), given).otherwise(F.map_concat(given, F.create_map(F.lit("category"), category))))
    return out


def star_bonus(weight: Column, stars: Column) -> Column:
    return F.when(stars > 0, weight + F.least(F.log10(stars + 1) / 5, F.lit(0.4))).otherwise(weight)


def citation_bonus(weight: Column, citations: Column) -> Column:
    return F.when(citations > 0, F.least(weight + F.least(F.log10(citations + 1) / 6, F.lit(0.3)), F.lit(5.0))).otherwise(weight)
