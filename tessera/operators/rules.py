"""Ordered domain rules as a table of any size: the first rule that is a star, part of the domain, or a shell pattern for it.

Rules aren't tried one after the other: each is found by the rarest piece of three characters of what it spells out, which a domain that it fits must have, so a domain meets only the
rules whose piece it has. These few are then tried, and the first in order wins. Domains are decided once each, however many rows have them.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scores import DOMAIN_DEFAULT, glob_regex
from ..tables import written

PIECE = 3
_COMPILED = T.StructType([T.StructField("regex", T.StringType()), T.StructField("pieces", T.ArrayType(T.StringType()))])


def pieces(pattern: str, size: int = PIECE) -> list[str]:
    """Pieces that every domain has that the pattern fits: those of what it spells out, or its longest part if all are shorter; the empty one if it spells out nothing."""
    spelt = re.split(r"\*|\?|\[!?\]?[^\]]*\]", pattern) if set(pattern) & set("*?[") else [pattern]
    out = sorted({part[i : i + size] for part in spelt for i in range(len(part) - size + 1)})
    return out or [max(spelt, key=len)]


@F.pandas_udf(_COMPILED)
def _compiled(patterns: pd.Series) -> pd.DataFrame:
    known = patterns.fillna("")
    return pd.DataFrame({"regex": [glob_regex(p) if set(p) & set("*?[") else None for p in known], "pieces": [pieces(p) for p in known]})


def domain_weights(domains: DataFrame, rules: DataFrame, size: int = PIECE) -> DataFrame:
    """(domain, weight, category) of each different domain. rules: (ord, pattern, weight, category), ord different for each; a null pattern fits nothing, an empty one is part of every domain."""
    own = written(domains.select("domain").where("domain IS NOT NULL").distinct(), "domains")
    upto = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(size)), lambda k: F.transform(F.sequence(F.lit(1), F.greatest(F.length("domain") - k + 1, F.lit(1))), lambda i: F.substring("domain", i, k))))
    had = own.select("domain", F.explode(F.array_distinct(F.array_append(upto, F.lit("")))).alias("piece"))
    counts = had.groupBy("piece").agg(F.count("*").alias("n"))
    compiled = rules.where("pattern IS NOT NULL").select("ord", "pattern", "weight", "category", _compiled(F.col("pattern")).alias("x"))
    asked = compiled.select("ord", "pattern", "weight", "category", "x.regex", F.explode("x.pieces").alias("piece"))
    known = asked.join(counts, "piece", "left")
    # A piece that no domain has rules the rule out for all of them.
    rarest = known.groupBy("ord", "pattern", "weight", "category", "regex").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("x")).where("x.n > 0")
    star = rarest.where("pattern = '*'").select(F.min("ord").alias("star"))  # rules after a star are never reached
    reached = rarest.join(F.broadcast(star)).where("star IS NULL OR ord <= star").select("ord", "pattern", "weight", "category", "regex", F.col("x.piece").alias("piece"))
    met = had.join(reached, "piece").where((F.col("pattern") == "*") | F.contains("domain", "pattern") | F.coalesce(F.expr("rlike(domain, regex)"), F.lit(False)))
    first = met.groupBy("domain").agg(F.min(F.struct("ord", "weight", "category")).alias("first"))
    return own.join(first, "domain", "left").select("domain", F.coalesce("first.weight", F.lit(DOMAIN_DEFAULT[0])).alias("weight"), F.coalesce("first.category", F.lit(DOMAIN_DEFAULT[1])).alias("category"))


def apply_rules(docs: DataFrame, rules: DataFrame) -> DataFrame:
    """docs (domain) with domain_weight and category; rows without a domain have the default's."""
    found = domain_weights(docs, rules).select("domain", F.col("weight").alias("domain_weight"), "category")
    kept = docs.drop("domain_weight", "category").join(found, "domain", "left")
    return kept.withColumns({"domain_weight": F.coalesce("domain_weight", F.lit(DOMAIN_DEFAULT[0])), "category": F.coalesce("category", F.lit(DOMAIN_DEFAULT[1]))})
