"""Column builders for text and URLs. All are built-in expressions and stay in the JVM."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as V


def regex(pattern: str, ignore_case: bool) -> str:
    """The pattern with Unicode-aware classes and word boundaries."""
    return f"(?{'iu' if ignore_case else ''}U){pattern}"


def matches(text: Column, pattern: str, ignore_case: bool = True) -> Column:
    return text.rlike(regex(pattern, ignore_case))


def count_of(text: Column, pattern: str, ignore_case: bool = True) -> Column:
    return F.regexp_count(text, F.lit(regex(pattern, ignore_case)))


def total(columns: list[Column]) -> Column:
    return reduce(add, columns, F.lit(0))


def first_of(cases: list[tuple[Column, object]], default: object) -> Column:
    """The value of the first condition that holds."""
    out = None
    for condition, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return (out.otherwise(F.lit(default))) if out is not None else F.lit(default)


# --- text measures

def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)\S+")).cast("long")


def distinct_ratio(text: Column) -> Column:
    """Distinct lower-cased words over words; 0 for none."""
    words = F.array_remove(F.split(F.lower(text), r"(?U)\s+"), "")  # no lambda and no branch, so it is computed once
    return F.coalesce(F.try_divide(F.size(F.array_distinct(words)), F.size(words)), F.lit(0.0))


def share_of(text: Column, pattern: str) -> Column:
    """Characters that match a class over all characters; 0 for an empty text."""
    return F.when(F.length(text) > 0, F.regexp_count(text, F.lit(pattern)) / F.length(text)).otherwise(F.lit(0.0))


def alpha_ratio(text: Column) -> Column:
    """Letters over all characters; what isn't a letter is counted, being less."""
    return F.when(F.length(text) > 0, (F.length(text) - F.regexp_count(text, F.lit(r"\P{L}"))) / F.length(text)).otherwise(F.lit(0.0))


def digit_ratio(text: Column) -> Column:
    return share_of(text, r"\p{Nd}")


def mean_word_length(text: Column) -> Column:
    """Characters that aren't white space over words; 0 for none."""
    return F.coalesce(F.try_divide(F.length(text) - F.regexp_count(text, F.lit(r"(?U)\s")), word_count(text)), F.lit(0.0))


def squeeze(text: Column) -> Column:
    """Control and format characters out, blanks collapsed, at most one empty line in a row, ends stripped."""
    kept = F.regexp_replace(text, r"[\p{Cc}\p{Cf}&&[^\n\t]]", "")
    lines = F.regexp_replace(F.regexp_replace(kept, r"[ \t]+", " "), r"\n{3,}", "\n\n")
    return F.regexp_replace(lines, r"(?U)^\s+|\s+$", "")


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, r"<[^>]+>", " ")


def exact_key(text: Column) -> Column:
    return F.sha2(text, 256)


def normalized_key(text: Column) -> Column:
    """Hash of the lower-cased text with white space collapsed."""
    return F.sha2(F.lower(F.regexp_replace(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), r"(?U)\s+", " ")), 256)


def uniform(*keys: Column) -> Column:
    """A number in [0, 1) that depends on the keys alone, so samples don't depend on partitions."""
    digest = F.md5(F.concat_ws("|", *(k.cast("string") for k in keys)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


# --- URLs

def netloc(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def registered_domain(url: Column) -> Column:
    """The last two labels of the lower-cased authority, user and port included."""
    labels = F.split(netloc(url), r"\.")
    return F.when(F.size(labels) >= 2, F.concat_ws(".", F.slice(labels, -2, 2))).otherwise(netloc(url))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def classify_url(url: Column, rules=V.URL_TYPES) -> Column:
    return first_of([(url.rlike(p), t) for p, t in rules], "unknown")


def classify_text(text: Column, rules=V.TEXT_TYPES) -> Column:
    words = F.greatest(word_count(text), F.lit(1))
    return first_of([(count_of(text, p, i) / words >= least, t) for p, i, t, least in rules], "unknown")


def content_type(url: Column, text: Column) -> Column:
    by_url = classify_url(url)
    return F.when(by_url != "unknown", by_url).otherwise(classify_text(text))


def code_language(url: Column) -> Column:
    suffix = F.regexp_extract(F.lower(url_path(url)), r"(\.[a-z]+)$", 1)
    return F.coalesce(F.create_map(*(F.lit(x) for kv in V.CODE_SUFFIXES.items() for x in kv))[suffix], F.lit(""))


def reclassify(kind: Column, text: Column, rules=V.TYPE_KEYWORDS) -> Column:
    """Kinds that are unknown or empty by the first keyword list of which two different words occur."""
    low = F.lower(text)
    found = first_of([(total([low.contains(w).cast("int") for w in words]) >= 2, t) for words, t in rules], "unknown")
    return F.when(kind.isin("unknown", ""), found).otherwise(kind)


def public_http_url(url: Column) -> Column:
    """http or https, a host, no user, and no host that is local by its name or its address."""
    host = F.regexp_replace(netloc(url), r":\d+$", "")
    octet = lambda i: F.split(host, r"\.")[i].cast("int")
    numeric = host.rlike(r"^\d{1,3}(\.\d{1,3}){3}$")
    a, b = octet(0), octet(1)
    local = (a.isin(0, 10, 127) | (a >= 224) | ((a == 172) & b.between(16, 31)) | ((a == 192) & (b == 168)) | ((a == 169) & (b == 254)) | ((a == 100) & b.between(64, 127)) | ((a == 198) & b.isin(18, 19)))
    named = (host == "localhost") | host.endswith(".localhost") | host.endswith(".local")
    return F.coalesce(url.rlike(r"^(?i)https?://") & (host != "") & ~host.contains("@") & ~host.startswith("[") & ~named & ~F.when(numeric, local).otherwise(False), F.lit(False))


def allowed_url(url: Column, allow=V.URL_ALLOW, block=V.URL_BLOCK) -> Column:
    """Blocked patterns win; no allowed patterns allow all."""
    blocked = url.rlike("|".join(block)) if block else F.lit(False)
    return ~blocked & (url.rlike("|".join(allow)) if allow else F.lit(True))


def safe_name(name: Column) -> Column:
    kept = F.regexp_replace(F.regexp_replace(name, r"[^A-Za-z0-9._ -]", ""), r"^\s+|\s+$", "")
    return F.coalesce(F.nullif(F.substring(F.regexp_replace(kept, " ", "-"), 1, 80), F.lit("")), F.lit("dataset"))
