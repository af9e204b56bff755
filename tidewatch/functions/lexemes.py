"""Search terms of a text as column expressions: words, stop words, stems.

An analyser splits a text into lower-cased runs of letters and digits, leaves out stop
words and strips suffixes. Positions count every word, stop words too.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, functions as F

WORD = r"[\p{L}\p{N}]+"

# English words that carry no meaning of their own for a search.
STOP_WORDS = tuple(
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they "
    "them their theirs themselves what which who whom this that these those am is are was were be been being have has had having do does "
    "did doing a an the and but if or because as until while of at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then once here there when where why how all any both each few "
    "more most other some such no nor not only own same so than too very s t can will just don should now".split())

_ROOT = "[^aeiouy]*[aeiouy]+[^aeiouy].*"  # a vowel and a consonant after it
_PAST = "(?:ed|edly|ing|ingly)"

#: Suffix rules in order, each applied to what the ones before have left: pattern and what replaces it ($n is a group).
SUFFIX_RULES: tuple[tuple[str, str], ...] = (
    ("^(.*ss)es$", "$1"),
    ("^(.+)ies$", "$1i"),
    ("^(.*[aeiouy].*[^su])s$", "$1"),
    (f"^({_ROOT})eed(?:ly)?$", "$1ee"),
    (f"^(.*at){_PAST}$", "$1e"),
    (f"^(.*[aeiouy].*(?:bl|iz)){_PAST}$", "$1e"),
    (f"^(.*[aeiouy])(?:b(b)|d(d)|f(f)|g(g)|m(m)|n(n)|p(p)|t(t)){_PAST}$", "$1$2$3$4$5$6$7$8$9"),
    (f"^(.*[aeiouy])rr{_PAST}$", "$1r"),
    (f"^(.*[aeiouy].*){_PAST}$", "$1"),
    ("^(.+[^aeiouy])y$", "$1i"),
    (f"^({_ROOT})(?:ization|izer)$", "$1ize"),
    (f"^({_ROOT})(?:ational|ation|ator)$", "$1ate"),
    (f"^({_ROOT}tion)al$", "$1"),
    (f"^({_ROOT})(?:fulness|fulli)$", "$1ful"),
    (f"^({_ROOT})(?:ousness|ousli)$", "$1ous"),
    (f"^({_ROOT})(?:iveness|iviti)$", "$1ive"),
    (f"^({_ROOT})(?:alism|aliti|alli)$", "$1al"),
    (f"^({_ROOT})(?:biliti|bli)$", "$1ble"),
    (f"^({_ROOT}[en])nci$", "$1nce"),
    (f"^({_ROOT}[cdeghkmnrt])li$", "$1"),
    (f"^({_ROOT}ic)(?:ate|iti|al)$", "$1"),
    (f"^({_ROOT})(?:ness|ful|ment)$", "$1"),
    (f"^({_ROOT})e$", "$1"),
)


#: How words end that the rules change, and for how many rules in order this holds; the others are passed by with one look.
_ENDINGS: tuple[tuple[str, int], ...] = (
    ("s", 3),
    ("(?:ed|ing)(?:ly)?", 6),
    ("y", 1),
    ("(?:ization|izer|ational|ation|ator|tional|fulness|fulli|ousness|ousli|iveness|iviti|alism|aliti|alli|biliti|bli|nci|li"
     "|icate|iciti|ical|ness|ful|ment)", 12),
    ("e", 1),
)


def suffix_stem(word: Column) -> Column:
    """The word without its English suffixes."""
    stem, done = word, 0
    for ending, rules in _ENDINGS:
        stem = F.transform(F.array(stem), partial(_by_rules, ending, SUFFIX_RULES[done:done + rules]))[0]
        done += rules
    return F.when(_ends(word, "|".join(ending for ending, _ in _ENDINGS)), stem).otherwise(word)


def _by_rules(ending: str, rules: tuple[tuple[str, str], ...], word: Column) -> Column:
    """``word`` is the variable of a lambda, so what made it is computed once for the look and the rules."""
    stem = word
    for pattern, rest in rules:
        stem = F.regexp_replace(stem, pattern, rest)
    return F.when(_ends(word, ending), stem).otherwise(word)


def _ends(word: Column, ending: str) -> Column:
    """Looked at from the end; a plain pattern would be tried at every letter."""
    return word.rlike(f"$(?<={ending})")


Stemmer = Callable[[Column], Column]


def words(text: Column) -> Column:
    """All words of a text, lower-cased; null for a null text."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def is_stop_word(word: Column) -> Column:
    return word.isin(*STOP_WORDS)


def terms(text: Column, stem: Stemmer = suffix_stem) -> Column:
    """The distinct search terms of a text; the stemmer runs on its distinct words."""
    return F.array_distinct(F.transform(F.filter(F.array_distinct(words(text)), lambda w: ~is_stop_word(w)), stem))


def matches(text: Column, query: Column, stem: Stemmer = suffix_stem) -> Column:
    """Whether a text holds every term of a query; false for a query without terms, null for a null text."""
    wanted = terms(query, stem)
    return (F.size(wanted) > 0) & (F.size(F.array_except(wanted, terms(text, stem))) == 0)


def sql_stem(word: str) -> str:
    """The stem as an SQL expression, for checks."""
    for pattern, rest in SUFFIX_RULES:
        word = f"regexp_replace({word}, '{pattern}', '{rest.replace('$', chr(92))}')"
    return word


def sql_stop_words() -> str:
    return "(" + ", ".join(f"'{w}'" for w in STOP_WORDS) + ")"
