"""String functions of a Column, all built-in: trimming and lines as Python has them, names, URLs, HTML, counts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

#: White space as Python's str.isspace and re's \s have it; Java's (?U)\s lacks U+001C to U+001F.
SPACE = "[\\s\\x1c-\\x1f]"
_BREAKS = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"(?U)\\A{SPACE}+|{SPACE}+\\z", "")


def flat(c: Column) -> Column:
    """White space runs as one blank, and none at the ends."""
    return strip(F.regexp_replace(c, f"(?U){SPACE}+", " "))


def is_blank(c: Column) -> Column:
    return F.length(strip(c)) == 0


def lines(c: Column) -> Column:
    """str.splitlines(): a break at the end opens no further line."""
    parts = F.split(c, _BREAKS, -1)
    last_empty = F.element_at(parts, -1) == ""
    return F.when(last_empty, F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def count(c: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(pattern)), F.lit(0)).cast("long")


def replace_all(c: Column, pairs: list[tuple[str, str]]) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def contains_any(c: Column, parts: tuple[str, ...]) -> Column:
    """Whether c holds any of the parts, in either case (both lower-cased)."""
    return F.coalesce(F.lower(c).rlike("|".join(re.escape(p.lower()) for p in parts)), F.lit(False))


def sha256(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def sha_prefix(c: Column) -> Column:
    return F.substring(c, 1, 8)


def stem(name: Column) -> Column:
    """A file name without its last suffix; a leading dot alone starts no suffix, and one at the end isn't one."""
    base = F.regexp_replace(name, r"(?s)^.*/(?=.)", "")
    return F.regexp_replace(base, r"(?s)(?<=.)(?<!^\.{1,99})\.[^.]+$", "")


def safe_name(name: Column) -> Column:
    """A folder name from a file name: its stem, unsafe characters as "_", no blanks or dots at the ends."""
    cleaned = F.translate(stem(name), fixed.UNSAFE_NAME_CHARS, "_" * len(fixed.UNSAFE_NAME_CHARS))
    dots = F.regexp_replace(strip(cleaned), r"\A\.+|\.+\z", "")
    return F.coalesce(F.nullif(dots, F.lit("")), F.lit(fixed.DEFAULT_NAME))


def forward_slashes(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


def relative_to(path: Column, root: str) -> Column:
    """A path from the root on, with forward slashes; a path outside the root stays whole."""
    p, r = forward_slashes(path), root.replace("\\", "/").rstrip("/") + "/"
    return F.when(p.startswith(r), F.substring(p, len(r) + 1, 1 << 30)).otherwise(p)


def last_segment(url: Column) -> Column:
    """The last path part of a URL, without its query."""
    return F.substring_index(F.regexp_replace(F.regexp_replace(url, r"\?.*$", ""), "/+$", ""), "/", -1)


def url_quote(c: Column, safe: str = "/") -> Column:
    """Percent-encoding of all but letters, digits, "_.-~" and the safe characters."""
    c = F.replace(F.replace(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))
    return replace_all(c, [(f"%{ord(s):02X}", s) for s in safe])


def url_unquote(c: Column) -> Column:
    """Percent-decoding; a % that no two hex digits follow stays."""
    kept = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(kept)


def html_escape(c: Column) -> Column:
    return replace_all(c, [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")])


def without_soft_hyphens(c: Column) -> Column:
    return F.replace(c, F.lit("­"), F.lit(""))


def without_comments(c: Column) -> Column:
    return F.regexp_replace(c, "(?s)<!--.*?-->", "")


def letters_only(c: Column) -> Column:
    """Letters and digits of a text."""
    return F.regexp_replace(c, r"(?U)[\W_]+", "")


def digit_share(c: Column) -> Column:
    return count(c, r"\p{Nd}") / F.greatest(F.length(c), F.lit(1))


def script_count(c: Column, script: str) -> Column:
    return count(c, fixed.SCRIPTS.get(script, script))


def letter_count(c: Column) -> Column:
    return count(c, fixed.LETTERS)


def expected_chars(text: Column, lang: Column) -> Column:
    """Characters of the scripts of an OCR language; of "a+b" those of both are summed."""
    n = {s: count(text, p) for s, p in fixed.SCRIPTS.items()}
    codes = F.transform(F.split(lang, r"\+"), lambda x: F.lower(strip(x)))
    of = lambda x: F.coalesce(*(F.when(x == code, n[script]) for code, _, script in fixed.LANGUAGES), F.lit(0))
    return F.aggregate(codes, F.lit(0).cast("long"), lambda a, x: a + of(x))


def ocr_score(text: Column, lang: Column) -> Column:
    return F.struct(expected_chars(text, lang).alias("script_chars"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("total_chars"))


def for_langid(c: Column) -> Column:
    """Text without marks of emphasis, headings and lists, in one line."""
    c = F.regexp_replace(c, "[*_`~]+", " ")
    c = F.regexp_replace(c, f"(?mU)^{SPACE}*(#{{1,6}}|[-*+]|\\d+\\.){SPACE}+", "")
    return flat(c)


def is_error_page(c: Column) -> Column:
    head = F.substring(c, 1, fixed.ERROR_PAGE_HEAD)
    return F.coalesce(head.rlike("(?id)" + "|".join(f"(?:{p})" for p in fixed.ERROR_PAGE)), F.lit(False))


def is_rate_limit(message: Column) -> Column:
    return contains_any(message, fixed.RATE_LIMIT)


def timestamp_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def glob(c: Column, pattern: str) -> Column:
    """Shell-style match of a whole name, with * ? [seq] [!seq]; case counts."""
    import fnmatch

    return c.rlike("^(?:" + fnmatch.translate(pattern).replace(r"\z", r"\Z") + ")")
