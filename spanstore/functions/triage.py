"""Relevance of a path and sensitivity of a text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .lines import bind
from .media import suffix

IGNORABLE, LOW, NORMAL, PRIMARY = range(4)


def relevance(path: Column, size: Column) -> Column:
    """0 ignorable, 1 low, 2 normal, 3 primary: the first rule that fits."""
    posix = F.lower(F.translate(F.coalesce(path, F.lit("")), "\\", "/"))
    name = F.regexp_extract(posix, r"(?s)([^/]*)/*$", 1)
    end = suffix(name)
    ignorable = (
        F.arrays_overlap(F.split(posix, "/", -1), F.array(*map(F.lit, fixed.IGNORABLE_PARTS)))
        | name.isin(*fixed.LOCKFILES)
        | name.contains(".min.")
        | name.endswith(".map")
        | name.endswith(".bundle.js")
        | ((F.coalesce(size, F.lit(0)) >= fixed.LARGE_ASSET_BYTES) & end.isin(".js", ".css"))
    )
    primary = name.isin(*fixed.MANIFEST_NAMES) | end.isin(*fixed.PRIMARY_SUFFIXES) | F.concat(F.lit("/"), posix).contains("/docs/")
    for prefix in fixed.MANIFEST_PREFIXES:
        primary = primary | name.startswith(prefix)
    return (
        F.when(ignorable, IGNORABLE).when(primary, PRIMARY).when(end.isin(*fixed.CODE_SUFFIXES), NORMAL).otherwise(LOW)
    )


# Letters that stand in every match, sought before the pattern: a scan for a few bytes costs a fraction of it.
HINTS = {
    "private_key": ["-----BEGIN "], "aws_access_key": ["AKIA"], "github_token": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"],
    "slack_token": ["xox"], "jwt": ["eyJ"], "connection_string": ["://"],
}
# Of names that are assigned, in lower case; the long s is an s to the pattern, and the signs for i are left out.
ASSIGNED_HINTS = "passw pwd secret token key author".split()
CARD_HINT = "(?:[0-9][ -]?){12}[0-9]"


def holds(text: Column, hints: list[str]) -> Column:
    """Whether a text has one of these."""
    found = F.lit(False)
    for hint in hints:
        found = found | F.contains(text, F.lit(hint))
    return found


def is_placeholder(value: Column) -> Column:
    """A value that stands for one to be filled in."""
    return F.regexp_like(value, F.lit("(?U)" + fixed.PLACEHOLDER))


def secret_labels(text: Column) -> Column:
    """Labels of credentials; a first match that is a placeholder hides its pattern."""
    named = []
    for label, pattern in fixed.SECRETS.items():
        hit = holds(text, HINTS[label]) & F.regexp_like(text, F.lit("(?U)" + pattern))
        if label == "connection_string":
            hit = hit & ~is_placeholder(F.regexp_extract(text, "(?U)" + pattern, 1))
        named.append(F.when(hit, F.lit(label)))
    pattern = F.lit("(?U)" + fixed.ASSIGNED_SECRET)
    likely = holds(text, [":", "="]) & (holds(F.lower(text), ASSIGNED_HINTS) | holds(text, ["ſ"]))
    hits = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(1)).alias("word"), F.regexp_extract_all(text, pattern, F.lit(2)).alias("value")
    )
    real = F.get(F.filter(F.when(likely, hits), lambda h: ~is_placeholder(h["value"])), F.lit(0))
    assigned = F.concat(F.lit("assigned_"), F.translate(F.lower(real["word"]), "-", "_"))
    return F.array_distinct(F.array_compact(F.array(*named, assigned)))


def personal_labels(text: Column) -> Column:
    """Labels of personal data: an e-mail address, a card number with a right checksum."""
    digits = lambda c: F.regexp_replace(c, "[ -]", "")
    card = F.regexp_like(text, F.lit(CARD_HINT)) & F.exists(
        F.regexp_extract_all(text, F.lit("(?U)" + fixed.CARD), F.lit(0)),
        lambda c: F.length(digits(c)).between(13, 19) & F.call_function("luhn_check", digits(c)),
    )
    email = holds(text, ["@"]) & F.regexp_like(text, F.lit("(?U)" + fixed.EMAIL))
    return F.array_compact(F.array(F.when(email, F.lit("email")), F.when(card, F.lit("card_number"))))


def sensitivity(text: Column) -> Column:
    """struct<level, labels>: secrets hide personal data."""

    def level(secret: Column, personal: Column) -> Column:
        name = F.when(F.size(secret) > 0, "secret").when(F.size(personal) > 0, "pii").otherwise("none")
        return F.struct(name.alias("level"), F.when(F.size(secret) > 0, secret).otherwise(personal).alias("labels"))

    # Bound, so that every pattern runs once however often the result is used.
    return bind(secret_labels(text), lambda secret: bind(personal_labels(text), lambda personal: level(secret, personal)))
