"""Patterns, word lists and codes that results depend on. They are stated as they are, in their order."""

from __future__ import annotations

#: OCR language code, its ISO code and the script it is written in.
LANGUAGES = (
    ("eng", "en", "latin"),
    ("fra", "fr", "latin"),
    ("deu", "de", "latin"),
    ("spa", "es", "latin"),
    ("ita", "it", "latin"),
    ("lat", "la", "latin"),
    ("heb", "he", "hebrew"),
    ("yid", "yi", "hebrew"),
    ("ara", "ar", "arabic"),
)
#: Character classes of the scripts, and of what counts as a letter.
SCRIPTS = {"latin": "[A-Za-z]", "hebrew": "[֐-׿]", "arabic": "[؀-ۿ]"}
LETTERS = "[A-Za-zͰ-ϿЀ-ӿ԰-֏֐-׿؀-ۿ]"

#: Characters that a folder name can't hold, and the name where none is left.
UNSAFE_NAME_CHARS = '<>:"/\\|?*'
DEFAULT_NAME = "document"

#: Substrings that mark a line or sentence as boilerplate, in either case.
BOILERPLATE = (
    "JSTOR",
    "support@jstor",
    "about.jstor.org",
    "תוכן זה הורד",
    "כל השימוש בכפוף",
    "כל השימוש כפוף",
    "כל הזכויות שמורות",
    "תנאים וההגבלות",
    "אנו משתמשים בטכנולוגיית מידע",
    "downloaded from",
    "all use subject to",
    "All rights reserved",
    "doi.org/",
    "DOI:",
    "ProQuest",
    "ResearchGate",
    "Academia.edu",
    "Cambridge Core",
    "Wiley Online Library",
    "University of Chicago Press",
    "אוניברסיטת שיקגו",
)

#: What an error page in place of a translation shows in its first 400 characters, in either case.
ERROR_PAGE = (
    r"Error\s*\d{3}\s*\(",
    "That’?s an error",
    "That.{0,3}s all we know",
    "Please try again later",
    "<html",
)
ERROR_PAGE_HEAD = 400
#: What the message of a rate limit holds, in either case.
RATE_LIMIT = (
    "api connection error",
    "Read timed out",
    "Connection aborted",
    "remote end closed connection",
    "ConnectionError",
    "Too Many Requests",
    "RequestError",
)

#: Fixed limits.
CHUNK_CHARS = 4500
RATE_LIMIT_WAITS = (30.0, 90.0)
LEAST_TRIES = 5
LEAST_SPLIT_CHARS = 60
CHECKPOINT_BLOCKS = 20
LANGID_LEAST, LANGID_MOST = 40, 4000
FOREIGN_LETTERS = 80
OCR_LEAST_CHARS = 200
SUMMARY_SENTENCES, SUMMARY_LEAST_CHARS, SUMMARY_INPUT_CHARS = 3, 40, 60_000
SENTENCE_LEAST, SENTENCE_MOST, SCRIPT_LEAST, SCRIPT_SHARE, DIGIT_SHARE = 40, 600, 15, 0.25, 0.35
