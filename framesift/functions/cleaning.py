"""Deep caption cleaning.

The steps are regular expressions that run in the JVM, most of them only on texts that show a sign
of what they look for. Only three things need Python: turning
markup into text, resolving named character references and repairing mis-decoded text. They share
two small Arrow functions, which receive NULL for every caption that cannot need them.

``(?U)`` makes word, digit and space classes cover all of Unicode; ``(?d)`` lets ``$`` see only a
line feed as a line end.
"""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from framesift.functions.captions import strip

_U = "(?Ud)"

# The patterns of the cleaning recipe.
_HOST = r"[a-zA-Z0-9.\-]+[.](?:com|co|ru|net|org|edu|gov|it)[\w/-]*\b/?(?!@)"
URL_PATTERNS = [
    rf"\b(?:https?:(?:/{{1,3}}|[a-zA-Z0-9%])|{_HOST})",
    rf"\b(?:www:(?:/{{1,3}}|[a-zA-Z0-9%])|{_HOST})",
]
NICKNAME = r"@\w+\b"
CJK = r"[\u31c0-\u9fff]+"
DASHES = (
    r"[\u002D\u058A\u05BE\u1400\u1806\u2010-\u2015\u2E17\u2E1A\u2E3A\u2E3B\u2E40\u301C\u3030\u30A0"
    r"\uFE31\uFE32\uFE58\uFE63\uFF0D]+"
)
# The same one by one, but for the hyphen.
ODD_DASHES = (
    "\u058a\u05be\u1400\u1806\u2010\u2011\u2012\u2013\u2014\u2015\u2e17\u2e1a\u2e3a\u2e3b\u2e40\u301c\u3030\u30a0"
    "\ufe31\ufe32\ufe58\ufe63\uff0d"
)
DOUBLE_QUOTES = "`´«»“”¨"
SINGLE_QUOTES = "‘’"
ENTITY_RESIDUE = [(r"&quot;?", ""), (r"&amp", "")]
IP_ADDRESS = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
ARTICLE_TIME = r"\d:\d\d\s+$"
NUMBERS_AND_FILES = [
    (r"#\d{1,3}\b", ""),
    (r"#\d{5,}\b", ""),
    (r"\b\d{6,}\b", ""),
    (r"\S+\.(?:png|jpg|jpeg|bmp|webp|eps|pdf|apk|mp4)", ""),
]
PUNCTUATION = [
    (r"[\"']{2,}", '"'),
    (r"\.{2,}", " "),
    (r"[#®•©™&@·º½¾¿¡§~)(\]\[}{|\\/*]+", " "),
    (r"\s+\.\s+", " "),
]
FILE_WORDS = ["png", "jpg", "jpeg", "bmp", "webp", "eps", "pdf", "apk", "mp4"]
SHOP_AND_ID_WORDS = [
    (r"\b[a-zA-Z]{1,3}\d{3,15}\b", ""),
    (r"\b[a-zA-Z]+\d+[a-zA-Z]+\b", ""),
    (r"\b\d+[a-zA-Z]+\d+\b", ""),
    (r"(worldwide\s+)?(free\s+)?shipping", ""),
    (r"(free\s)?download(\sfree)?", ""),
    (r"\bclick\b\s(?:for|on)\s\w+", ""),
    (r"\b(?:png|jpg|jpeg|bmp|webp|eps|pdf|apk|mp4)(\simage[s]?)?", ""),
    (r"\bpage\s+\d+\b", ""),
    (r"\b\d*[a-zA-Z]+\d+[a-zA-Z]+\d+[a-zA-Z\d]*\b", " "),
    (r"\b\d+\.?\d*[xх×]\d+\.?\d*\b", ""),
]
SPACING_AND_EDGES = [
    (r"\b\s+:\s+", ": "),
    (r"(\D[,./])\b", "$1 "),
    (r"\s+", " "),
    (r"^[\"']([\w\W]+)[\"']$", "$1"),
    (r"^['_,\-:;]", ""),
    (r"['_,\-:+]$", ""),
    (r"^\.\S+$", ""),
]


# All of ``(?U)\\s`` but the blank.
_ASCII_SPACES = "\t\n\v\f\r"
_OTHER_SPACES = "\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _chain(text: Column, steps: list[tuple[str, str]], flags: str = _U) -> Column:
    for pattern, replacement in steps:
        text = F.regexp_replace(text, flags + pattern, replacement)
    return text


def _sub_all(text: Column, steps: list[tuple[str, str]]) -> Column:
    """Replacements one after the other, by the rules for all of Unicode."""
    return _chain(text, steps)


def _sub(text: Column, pattern: str, replacement: str) -> Column:
    return _chain(text, [(pattern, replacement)])


def _sub_plain(text: Column, steps: list[tuple[str, str]]) -> Column:
    """The same for patterns without classes that depend on Unicode, which the plain rules match much faster."""
    return _chain(text, steps, "(?d)")


def _sub_often(text: Column, steps: list[tuple[str, str]]) -> Column:
    """The same in a bound text, for steps that most texts go through.

    A text of ASCII alone is matched by the plain rules, which mean the same there and are much faster;
    what the replacements leave of it is ASCII again.
    """
    return F.when(_ascii(text), _sub_plain(text, steps)).otherwise(_sub_all(text, steps))


def _sub_everywhere(text: Column, steps: list[tuple[str, str]]) -> Column:
    return F.get(F.transform(F.array(text), lambda t: _sub_often(t, steps)), F.lit(0))


def _replace_all(text: Column, old: str, new: str) -> Column:
    """Single characters for single characters; plain replacing is many times faster than ``translate``."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(new)), old, text)


def _ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def _where(text: Column, needs: Callable[[Column], Column], change: Callable[[Column], Column]) -> Column:
    """Apply a costly change only to texts that show what it looks for.

    The lambda binds the text once, however often the test and the change read it.
    """
    bound = F.transform(F.array(text), lambda t: F.when(needs(t), change(t)).otherwise(t))
    return F.get(bound, F.lit(0))


def _has(*words: str) -> Callable[[Column], Column]:
    return lambda t: reduce(lambda a, b: a | b, [F.contains(t, F.lit(w)) for w in words])


def _finds(pattern: str) -> Callable[[Column], Column]:
    return lambda t: F.when(_ascii(t), t.rlike(pattern)).otherwise(t.rlike(_U + pattern))


def unquote_plus(text: Column) -> Column:
    """Decode percent escapes and plus signs; a stray ``%`` stays as it is."""
    return _where(text, _has("%", "+"), lambda t: F.url_decode(F.regexp_replace(t, "%(?![0-9A-Fa-f]{2})", "%25")))


def unquote_and_lower(text: Column) -> Column:
    return F.replace(F.lower(strip(unquote_plus(text))), F.lit("<person>"), F.lit("person"))


def drop_urls(text: Column) -> Column:
    hint = r"https?:|www:|\.(?:co|ru|net|org|edu|gov|it)"
    return _where(text, _finds(hint), lambda t: _sub_all(t, [(p, "") for p in URL_PATTERNS]))


class _TextOnly(HTMLParser):
    """Collects text outside script, style and template elements."""

    SILENT = ("script", "style", "template")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.silent = 0

    def handle_starttag(self, tag, attrs):
        self.silent += tag in self.SILENT

    def handle_endtag(self, tag):
        if tag in self.SILENT and self.silent:
            self.silent -= 1

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)


def markup_text(source: str) -> str:
    parser = _TextOnly()
    parser.feed(source)
    parser.close()
    return "".join(parser.parts)


def repair_text(text: str) -> str:
    """Straighten quotes, undo UTF-8 read as Latin-1, compose accents, resolve references twice."""
    for curly, straight in (("“", '"'), ("”", '"'), ("‘", "'"), ("’", "'")):
        text = text.replace(curly, straight)
    if not text.isascii():
        for wrong in ("latin-1", "cp1252"):
            try:
                text = text.encode(wrong).decode("utf-8")
                break
            except (UnicodeEncodeError, UnicodeDecodeError):
                continue
    return html.unescape(html.unescape(unicodedata.normalize("NFC", text)))


@F.pandas_udf(StringType())
def _markup_text(texts: pd.Series) -> pd.Series:
    return texts.map(markup_text, na_action="ignore")


@F.pandas_udf(StringType())
def _repair_text(texts: pd.Series) -> pd.Series:
    return texts.map(repair_text, na_action="ignore")


def html_to_text(text: Column) -> Column:
    needed = F.when(text.rlike("[<&]"), text)
    return F.coalesce(_markup_text(needed), text)


def fix_text(text: Column) -> Column:
    """Repair, resolve references and trim; plain ASCII without ``&`` skips Python."""
    needed = F.when(text.rlike(r"[&\x{80}-\x{10FFFF}]"), text)
    return strip(F.coalesce(_repair_text(needed), text))


def drop_nicknames(text: Column) -> Column:
    return _where(text, _has("@"), lambda t: _sub(t, NICKNAME, ""))


def drop_cjk(text: Column) -> Column:
    return _sub_plain(text, [(CJK, "")])


def unify_dashes_and_quotes(text: Column) -> Column:
    odd = lambda t: ~_ascii(t) & t.rlike(r"[\u058A-\uFF0D]")
    text = _where(text, odd, lambda t: _replace_all(t, ODD_DASHES, "-"))
    text = _where(text, _has("--"), lambda t: F.regexp_replace(t, "-{2,}", "-"))
    return _replace_all(_replace_all(text, DOUBLE_QUOTES, '"'), SINGLE_QUOTES, "'")


def drop_residue(text: Column) -> Column:
    text = _where(text, _has("&"), lambda t: _sub_plain(t, ENTITY_RESIDUE))
    text = _where(text, _finds(r"\d[.:]\d"), lambda t: _sub_all(t, [(IP_ADDRESS, " "), (ARTICLE_TIME, "")]))
    return F.replace(text, F.lit("\\n"), F.lit(" "))  # a written-out line feed: backslash, n


def drop_numbers_and_files(text: Column) -> Column:
    hashed, numbers, files = NUMBERS_AND_FILES[:2], NUMBERS_AND_FILES[2:3], NUMBERS_AND_FILES[3:]
    text = _where(text, _has("#"), lambda t: _sub_all(t, hashed))
    text = _where(text, _finds(r"\d{6}"), lambda t: _sub_all(t, numbers))
    return _where(text, _has(*[f".{e}" for e in FILE_WORDS]), lambda t: _sub_all(t, files))


def calm_punctuation(text: Column) -> Column:
    quotes, dots, signs, points = PUNCTUATION[:1], PUNCTUATION[1:2], PUNCTUATION[2:3], PUNCTUATION[3:]
    text = _where(text, _has("\"\"", "''", "\"'", "'\""), lambda t: _sub_plain(t, quotes))
    text = _where(text, _has(".."), lambda t: _sub_plain(t, dots))
    return _sub_everywhere(_sub_plain(text, signs), points)


def split_slug(text: Column) -> Column:
    """More than three hyphens or underscores: they are word separators."""
    many = lambda t: F.length(t) - F.length(_replace_all(t, "-_", "")) > 3
    return _where(text, many, lambda t: _replace_all(t, "-_", " "))


def drop_shop_words(text: Column) -> Column:
    steps = SHOP_AND_ID_WORDS
    digit = _finds(r"\d")
    text = _where(text, digit, lambda t: _sub_often(t, steps[:3]))
    text = _where(text, _has("shipping"), lambda t: _sub_all(t, steps[3:4]))
    text = _where(text, _has("download"), lambda t: _sub_all(t, steps[4:5]))
    text = _where(text, _has("click"), lambda t: _sub_all(t, steps[5:6]))
    text = _where(text, _has(*FILE_WORDS), lambda t: _sub_all(t, steps[6:7]))
    return _where(text, digit, lambda t: _sub_often(t, steps[7:]))


def tidy_edges(text: Column) -> Column:
    text = _where(text, _has(":"), lambda t: _sub_all(t, SPACING_AND_EDGES[:1]))
    # The same places as by the listed pattern, which would try every character.
    text = _sub_everywhere(text, [(r"([,./])(?<=\D[,./])\b", "$1 ")])
    text = _where(text, lambda t: ~_ascii(t), lambda t: _replace_all(t, _OTHER_SPACES, " "))
    text = _replace_all(text, _ASCII_SPACES, " ")
    text = _where(text, _has("  "), lambda t: F.regexp_replace(t, " {2,}", " "))
    return strip(_sub_all(_sub_plain(text, SPACING_AND_EDGES[3:6]), SPACING_AND_EDGES[6:]))


# The recipe in its order.
STEPS = [
    unquote_and_lower,
    drop_urls,
    html_to_text,
    drop_nicknames,
    drop_cjk,
    unify_dashes_and_quotes,
    drop_residue,
    drop_numbers_and_files,
    calm_punctuation,
    split_slug,
    fix_text,
    drop_shop_words,
    tidy_edges,
]


def clean_once(text: Column) -> Column:
    for step in STEPS:
        text = step(text)
    return text
