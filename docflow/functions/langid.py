"""Language identification in built-in functions: by script, and within the Latin and Hebrew scripts by common words.

The script with the most letters decides first: Hebrew letters mean Hebrew or Yiddish (whichever has more of its common words,
Hebrew at a tie), Arabic letters mean Arabic. In Latin letters the language wins most of whose common words occur; ties go
to the one that is listed first, and a text without any of them has no language. Only the first LANGID_MOST characters count.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import count, flat

#: Common words by language, in order of preference at equal counts; the last two are told apart from each other alone.
STOP_WORDS = {
    "en": "the of and to in is that for it as was with be by on are this from or an".split(),
    "fr": "le la les des et en est que qui dans pour une un du par sur pas elle de au".split(),
    "de": "der die das und ist nicht mit von den zu ein eine auf für im dem des sich er als".split(),
    "es": "el los las y del que por con una se su lo al como más pero sus le ya o".split(),
    "it": "il che di gli della per non sono con nel alla più anche dei delle questo nella dal ma è".split(),
    "la": "est et non quod cum sed ut qui enim quae atque hoc sunt esse autem eius nec aut quam ad".split(),
    "he": "של את על לא זה הוא היא עם אם כי או גם אל יש כל מן בין אשר אני היה".split(),
    "yi": "און איז די דער פון צו מיט דאס אין זיך האט ער אויף ניט איך נישט פאר וואס אבער אז".split(),
}
#: Letters of words by script.
LETTERS = {"latin": "a-zà-ÿß", "hebrew": "א-ת", "arabic": "ؠ-ي"}
BY_WORDS = {"latin": ("en", "fr", "de", "es", "it", "la"), "hebrew": ("he", "yi")}
_FIRST_LOOK = fixed.LANGID_MOST * 5 // 4


def beginning(text: Column) -> Column:
    """The first characters of the flattened text; the rest of a long text isn't flattened, unless it begins with too much white space."""
    head = flat(F.substring(text, 1, _FIRST_LOOK))
    enough = (F.length(text) <= _FIRST_LOOK) | (F.length(head) >= fixed.LANGID_MOST)
    return F.substring(F.when(enough, head).otherwise(flat(text)), 1, fixed.LANGID_MOST)


def _let(value: Column, body) -> Column:
    """body of value, which is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _by_words(text: Column, script: str, none: str | None) -> Column:
    """The language of a script with the most common words in a lower-cased text; none where there is no such word. The words are
    cut out once; a count and a rank make one number each."""
    langs = BY_WORDS[script]
    top = len(langs)

    def best(words: Column) -> Column:
        own = lambda lang: F.size(F.filter(words, lambda w: w.isin(STOP_WORDS[lang])))
        return F.greatest(*(own(lang) * top + (top - 1 - i) for i, lang in enumerate(langs)))

    name = lambda b: F.get(F.array(*map(F.lit, langs)), (F.lit(top - 1) - b % top).cast("int"))
    ranked = _let(F.split(text, f"[^{LETTERS[script]}]+"), best)
    return _let(ranked, lambda b: F.when(b >= top, name(b)).otherwise(F.lit(none)))


def _language(text: Column) -> Column:
    latin, hebrew, arabic = (count(text, f"[{LETTERS[s]}]") for s in ("latin", "hebrew", "arabic"))
    other = text.rlike(f"[{LETTERS['hebrew']}{LETTERS['arabic']}]")
    own = F.when((hebrew > 0) & (hebrew >= latin) & (hebrew >= arabic), _by_words(text, "hebrew", "he")).when(arabic > latin, "ar")
    latin_lang = _by_words(text, "latin", None)
    return F.when(other, F.when(F.greatest(hebrew, arabic) < latin, latin_lang).otherwise(F.coalesce(own, latin_lang))).otherwise(latin_lang)


def detect(text: Column, least: int = fixed.LANGID_LEAST) -> Column:
    """The language of a text, null for one that is shorter than least or has no sign of any."""
    return _let(beginning(text), lambda t: F.when(F.length(t) >= least, _language(F.lower(t))))
