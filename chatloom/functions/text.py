"""Text rules of chat exports and claims as Column functions.

Patterns use ``(?U)``, so word and space classes cover all of Unicode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and marks of chat exports and of redaction.
MARKS = "[\\u200e\\u200f\\u202a-\\u202e\\u2066-\\u2069]"
OMITTED = "(?i)[\\u200e\\u200f]?(?:<\\s*)?(?:image|video|audio|sticker|document|gif|media)\\s+omitted(?:\\s*>)?"
EDITED = "(?i)[\\u200e\\u200f]?<\\s*This message was edited\\s*>?"
SYSTEM_PATTERNS = (
    "(?i)messages and calls are end-to-end encrypted",
    "(?i)joined using (?:a group link|this group's invite link)",
    "(?i)\\bwas added\\.?$",
    "^(.+?) removed (.+)$",
    "^(.+?) left\\.?$",
    "(?i)changed their phone number",
    "(?i)^this message was deleted\\.?$",
    "(?i)^you added .+$",
)
ADDED_PATTERN = "^(.+?) added (.+)$"
CREATED_PATTERN = "(?i)created group"
REDACTION_MARK = "[הוסר]"
EMAIL = "[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}"
PHONE = "(?U)(?<![\\w])\\+?[\\d][\\d\\s().\\-]{7,}\\d(?![\\w])"
SHORT_PHONE = "(?U)(?<![\\w])(?:\\*\\d{3,5}\\b|\\(\\d{3,5}\\*\\)|\\b\\d{3,5}\\*(?![\\w]))"
MOTHER_NOUN = "([למכבוש]?)ה?(?:אמא|אימא|אמהות|אימהות)[\\s\u05be\\-]+(ה?)(פונדקאי(?:ות|ת))"
MOTHER_WORD = "([למכ])אם[\\s\u05be\\-]+(ה?)(פונדקאי(?:ות|ת))"
WEBSITE = "(?:https?://|www\\.)[^\\s<>\"')\\]]+"


def strip(c: Column) -> Column:
    """Trim white space of all kinds."""
    return F.regexp_replace(c, "(?U)^\\s+|\\s+$", "")


def clean_text(c: Column) -> Column:
    """Without direction marks; narrow no-break spaces are spaces."""
    return strip(F.regexp_replace(F.regexp_replace(c, MARKS, ""), "\\u202f", " "))


def normalize_content(c: Column) -> Column:
    """Without direction marks, the note of an edit and notes of left-out media."""
    for pattern in (MARKS, EDITED, OMITTED):
        c = F.regexp_replace(c, pattern, "")
    return strip(c)


def collapse_spaces(c: Column) -> Column:
    return strip(F.regexp_replace(c, "(?U)\\s+", " "))


def is_system(content: Column, old_format: bool = False) -> Column:
    """Whether a line comes from the chat program. Empty lines do; so does the old
    format's placeholder for no text."""
    c = clean_text(content)
    hit = c == ""
    for pattern in SYSTEM_PATTERNS:
        hit = hit | c.rlike(pattern)
    hit = hit | (c.rlike(ADDED_PATTERN) & ~F.contains(F.lower(c), F.lit("added by")))
    if old_format:
        hit = hit | (F.lower(c) == "null") | c.rlike(CREATED_PATTERN)
    return hit


def parse_new_time(date: Column, time: Column, correct: bool = True) -> Column:
    """Header time of the new format. ``correct=False`` ignores AM and PM, as 24-hour
    times with a marker would be read."""
    t = strip(F.regexp_replace(F.regexp_replace(time, "\\u202f", " "), "\\s+", " "))
    text = F.concat_ws(", ", date, F.upper(t))
    if correct:
        forms = ("M/d/yy, h:mm:ss a", "M/d/yyyy, h:mm:ss a")
    else:
        text = F.regexp_replace(text, "\\s*[AP]M$", "")
        forms = ("M/d/yy, H:mm:ss", "M/d/yyyy, H:mm:ss")
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in forms]).cast("timestamp_ntz")


def parse_old_time(date: Column, time: Column) -> Column:
    text = F.concat_ws(", ", date, strip(time))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in ("M/d/yy, H:mm", "M/d/yyyy, H:mm")]).cast("timestamp_ntz")


def parse_phone_export_time(date: Column, time: Column) -> Column:
    return F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit("d/M/yyyy H:m")).cast("timestamp_ntz")


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "\\D", "")


def is_phone_sender(c: Column) -> Column:
    """At least nine digits and nothing but characters of phone numbers."""
    return (F.length(digits(c)) >= 9) & c.rlike("^[\\d\\s+().\\-]+$")


def nickname(c: Column) -> Column:
    return strip(F.regexp_replace(c, "^[~\\s]+", ""))


def month_of(iso: Column) -> Column:
    return F.substring(iso.cast("string"), 1, 7)


def duration_seconds(first: Column, last: Column) -> Column:
    return F.greatest(F.lit(0.0), gap_seconds(first, last))


def gap_seconds(first: Column, last: Column) -> Column:
    """Seconds between two timestamps without time zone."""
    return (F.unix_micros(last.cast("timestamp")) - F.unix_micros(first.cast("timestamp"))) / 1e6


def find_emails(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(EMAIL), F.lit(0))


def find_websites(c: Column) -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit(WEBSITE), F.lit(0)), lambda x: F.regexp_replace(x, "\\.+$", ""))


def find_phones(c: Column) -> Column:
    return F.array_distinct(F.concat(*[F.regexp_extract_all(c, F.lit(p), F.lit(0)) for p in (PHONE, SHORT_PHONE)]))


def redact(c: Column) -> Column:
    """Struct of the text with a mark for each address and number, and what was taken
    out: e-mail addresses first, then numbers, then short numbers, each in order."""
    c = F.coalesce(c, F.lit(""))
    found = []
    for kind, pattern in (("email", EMAIL), ("phone", PHONE), ("phone", SHORT_PHONE)):
        found.append(_typed(c, kind, pattern))
        c = F.regexp_replace(c, pattern, REDACTION_MARK)
    return F.struct(c.alias("text"), F.concat(*found).alias("redactions"))


def _typed(c: Column, kind: str, pattern: str) -> Column:
    return F.transform(
        F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), lambda v: F.struct(F.lit(kind).alias("type"), v.alias("value"))
    )


def restore(text: Column, redactions: Column) -> Column:
    """Put what was taken out back, the first mark first."""
    at = lambda t: F.locate(REDACTION_MARK, t)
    size = len(REDACTION_MARK)
    return F.aggregate(
        redactions,
        text,
        lambda t, r: F.when(
            at(t) > 0, F.concat(F.substring(t, F.lit(1), at(t) - 1), r["value"], F.substring(t, at(t) + size, F.length(t)))
        ).otherwise(t),
    )


def number_label(n: Column) -> Column:
    """A number as a whole one where it is within a hundredth of it, else with one place."""
    return F.when(F.abs(n - F.round(n)) < 0.01, F.round(n).cast("bigint").cast("string")).otherwise(F.format_string("%.1f", n.cast("double")))


def bucket_label(low: Column, high: Column) -> Column:
    """A bucket's ends, or the one value of a bucket that has no width."""
    return F.when(low == high, low.cast("bigint").cast("string")).otherwise(F.concat(number_label(low), F.lit("–"), number_label(high)))


def cache_key(*parts: Column) -> Column:
    """Content-addressed key of a request."""
    return F.sha2(F.to_json(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])), 256)


def batch_id(c: Column) -> Column:
    """A request's id in the characters that batches allow, at most 64; an empty one is ``req``."""
    return F.coalesce(F.nullif(F.substring(F.regexp_replace(c, "[^A-Za-z0-9_-]", "_"), 1, 64), F.lit("")), F.lit("req"))


def cited_urls(c: Column) -> Column:
    """Addresses in a model's answer, stops at their end left out, each once in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(r"https?://[^\s)\]>]+"), F.lit(0)), lambda u: F.regexp_replace(u, "[.,;]+$", "")))


def json_block(c: Column) -> Column:
    """The outermost object or list in a model's answer, code fences left out."""
    return F.regexp_extract(c, "(?s)(\\{.*\\}|\\[.*\\])", 1)


def correct_term(c: Column) -> Column:
    """Drop the word for mother before the word for surrogate. The article stays, but
    merges into the prepositions that take it in."""
    # a mark stands for the article until it is known what is before it
    for pattern in (MOTHER_NOUN, MOTHER_WORD):
        c = F.regexp_replace(c, f"(?U){pattern}", "$1\u0001$2\u0002$3")
        c = F.regexp_replace(c, "([לבכ])\u0001ה\u0002", "$1")
        c = F.regexp_replace(c, "[\u0001\u0002]", "")
    return c
