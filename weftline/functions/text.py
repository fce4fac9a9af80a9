"""Text functions as native columns: they stay in the JVM and inside generated code."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.vocabulary import BLANKS, CONSONANTS, MENU_HOME, MENU_MARK, STOCK_WORDS

_SPACE = "[\\s\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\u0085\\u001c-\\u001f]"


#: The characters of _SPACE, and a character that separates pieces.
_BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_BETWEEN = "\u0001"


def _or_blank(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def strip(x: Column) -> Column:
    """Without whitespace of any kind at either end."""
    return F.btrim(x, F.lit(_BLANKS))


def collapse(x: Column) -> Column:
    """Whitespace runs as one space, trimmed."""
    return F.trim(F.regexp_replace(_or_blank(x), f"{_SPACE}+", " "))


def normalize_label(x: Column) -> Column:
    """Without whitespace and colons, in lower case."""
    return F.lower(F.regexp_replace(_or_blank(x), f"(?:{_SPACE}|:)+", ""))


def clean_lines(x: Column) -> Column:
    """Extracted page text: lines trimmed and collapsed, two blank lines at most, and '' where it only says nothing."""
    x = F.translate(_or_blank(x), "\u00a0\r", " ")
    x = F.regexp_replace(x, "[ \\t]+", " ")
    x = F.regexp_replace(x, "(?m)^[ ]+|[ ]+$", "")
    x = strip(F.regexp_replace(x, "\\n{3,}", "\n\n"))
    return F.when(x.isin(BLANKS), "").otherwise(x)


def strip_numbering(x: Column) -> Column:
    """Without the leading number of a list entry."""
    return strip(F.regexp_replace(collapse(x), "^\\d+\\.\\s*", ""))


def id_of_href(x: Column) -> Column:
    """The digits of the id parameter, or null."""
    return F.nullif(F.regexp_extract(_or_blank(x), "[?&]id=(\\d+)", 1), F.lit(""))


def item_of_href(x: Column) -> Column:
    """The id of a link to an item's page, or null for other links."""
    return F.nullif(F.regexp_extract(_or_blank(x), "(?:^|/)(?:new|download|download_picture)\\.php\\?(?:[^#]*&)?id=(\\d+)", 1), F.lit(""))


def query_param(x: Column, name: str) -> Column:
    """A parameter of a url or relative link; '' without it."""
    return F.regexp_extract(_or_blank(x), f"^[^?#]*\\?(?:[^#]*&)?{name}=([^&#]*)", 1)


def region_url(base: str, region: Column, page: Column) -> Column:
    """A region's list page; the first one has no page parameter."""
    url = F.concat(F.lit(f"{base}/district_temple.php?id="), region)
    return F.when(page == 1, url).otherwise(F.concat(url, F.lit("&Page="), page.cast("string")))


def detail_url(base: str, item: Column, english: bool = False) -> Column:
    return F.concat(F.lit(f"{base}/{'en/new_en' if english else 'new'}.php?id="), item)


def absolute_url(base: str, href: Column) -> Column:
    """A link of a page at the site's root."""
    tail = F.regexp_replace(href, "^/+|^\\./", "")
    return F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href).otherwise(F.concat(F.lit(f"{base.rstrip('/')}/"), tail))


def category_text(x: Column) -> Column:
    """Link text of a category, without the mark before and 'home' after it."""
    name = strip(F.ltrim(_or_blank(x), F.lit(MENU_MARK + _BLANKS)))
    bare = name
    for home in reversed(MENU_HOME):
        bare = F.when(F.endswith(name, F.lit(home)), F.left(name, F.length(name) - len(home))).otherwise(bare)
    return strip(bare)


def skeleton(x: Column) -> Column:
    """The consonants of a Tamil name in order, without stock words; ழ counts as க."""
    return F.translate(F.regexp_replace(F.regexp_replace(_or_blank(x), STOCK_WORDS, " "), f"[^{CONSONANTS}]", ""), "ழ", "க")


def latin_skeleton(x: Column) -> Column:
    """The consonant letters of a Latin name, with th as t and sh as s."""
    return F.regexp_replace(F.replace(F.replace(F.lower(_or_blank(x)), F.lit("th"), F.lit("t")), F.lit("sh"), F.lit("s")), "[^bcdfghjklmnpqrstvwxyz]", "")


def pincode(*addresses: Column) -> Column:
    """The first six-digit code that begins with 6, maybe with a space in the middle, in the addresses; '' without one."""
    text = F.concat_ws(" ", *(_or_blank(a) for a in addresses))
    found = F.regexp_extract(text, "(?<!\\d)(6\\d{2}\\s?\\d{3})(?!\\d)", 1)
    return F.regexp_replace(found, "\\s", "")


def ngrams(x: Column, n: int = 3) -> Column:
    """All n-grams of a string in order, repeated ones too."""
    last = F.length(x) - (n - 1)
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(x, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def alternatives(x: Column) -> Column:
    """The parts of a text with several names."""
    return F.split(_or_blank(x), "[,/()]")


def name_skeletons(name: Column, others: Column) -> Column:
    """Distinct skeletons of a name and of other names, of three letters or more."""
    every = F.concat(F.array(skeleton(name)), F.transform(alternatives(others), skeleton))
    return F.array_distinct(F.filter(every, lambda s: F.length(s) >= 3))


def has_tamil(x: Column) -> Column:
    return x.rlike("[\\u0B80-\\u0BFF]")


def content_hash(x: Column) -> Column:
    return F.sha2(x, 256)


def iso_now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")


def cell_text(x: Column, most: int = 32767) -> Column:
    """What a spreadsheet cell may hold."""
    return F.left(F.regexp_replace(_or_blank(x), "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", ""), F.lit(most))


def sentences(line: Column, least: int = 15) -> Column:
    """The sentences of a line. A piece joins the one before it if that is shorter than `least` characters or ends in an abbreviation (a last word with a dot inside). The control character U+0001 is dropped.

    Whether a piece joins depends on the length so far and the end of the piece before it: the fold carries these and a mark for each piece, and the text is put together once, so the time grows with its length.
    """
    clean = F.translate(_or_blank(line), _BETWEEN, "")
    parts = F.split(strip(clean), f"(?<=[.?!।]){_SPACE}+")

    def shape(part: Column) -> Column:
        word = F.substring_index(F.translate(part, _BLANKS, " " * len(_BLANKS)), " ", -1)
        return F.struct(F.length(part).alias("size"), (part.endswith(".") & F.contains(F.rtrim(word, F.lit(".")), F.lit("."))).alias("short"))

    def fold(state: Column, part: Column) -> Column:
        joins = (state["size"] < least) | state["short"]
        # the first piece joins nothing, and its mark isn't read
        size = F.when(joins & (state["marks"] != ""), state["size"] + 1 + part["size"]).otherwise(part["size"])
        return F.struct(size.alias("size"), part["short"].alias("short"), F.concat(state["marks"], F.when(joins, " ").otherwise(_BETWEEN)).alias("marks"))

    start = F.struct(F.lit(0).alias("size"), F.lit(False).alias("short"), F.lit("").alias("marks"))
    marks = F.split(F.aggregate(F.transform(parts, shape), start, fold, lambda s: s["marks"]), "")
    both = F.transform(F.arrays_zip(parts.alias("part"), marks.alias("mark")), lambda x: F.concat(x["mark"], x["part"]))
    whole = F.array_join(both, "")
    return F.filter(F.split(F.substr(whole, F.lit(2)), _BETWEEN), lambda s: strip(s) != "")


def apply_glossary(x: Column, terms: dict[str, str]) -> Column:
    """Whole words replaced, longest first; a word that goes on in Tamil is left alone."""
    for term in sorted(terms, key=len, reverse=True):
        to = terms[term].replace("\\", "\\\\").replace("$", "\\$")
        x = F.regexp_replace(x, f"(?<![\\u0B80-\\u0BFF])\\Q{term}\\E(?![\\u0B80-\\u0BFF])", to)
    return x


def apply_rules(x: Column, rules: dict[str, str]) -> Column:
    """Ordered regex rules; groups are written \\1."""
    for pattern, to in rules.items():
        x = F.regexp_replace(x, pattern, re.sub(r"\\(?:g<(\w+)>|(\d))", lambda m: "${%s}" % m[1] if m[1] and not m[1].isdigit() else f"${m[1] or m[2]}", to.replace("$", "\\$")))
    return x


def confidence(score: Column, runner_up: Column, same_pin: Column, has_pin: Column) -> Column:
    """exact, likely or none, from the best score and its margin."""
    margin = score - runner_up
    return (
        F.when((score >= F.lit(0.86)) & (margin >= F.lit(0.06)) & (same_pin | ~has_pin), "exact")
        .when((score >= F.lit(0.72)) & (margin >= F.lit(0.03)), "likely")
        .otherwise("none")
    )
