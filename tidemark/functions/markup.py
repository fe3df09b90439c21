"""Text, attributes and links of HTML as column expressions.

Patterns over markup are possessive: they never go back over what they matched, so they run in a loop, not by recursion,
and in time that grows with the length of the page, whatever is left open in it. What never closes reaches to the end.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# All named characters of HTML, by the first letter of the name; most names end with a semicolon.
NAMED: dict[str, dict[str, str]] = {}
for name, value in html5.items():
    NAMED.setdefault(name[0], {})[name] = value
#: The names that need no semicolon, longest first.
BARE = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
#: The value of an attribute; only quoted ones may hold a bracket.
VALUE = r"""(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|[^\s>"'][^\s>]*+)"""
#: What may follow the name in a tag, and the end of a tag.
REST, END = rf"(?:[^>=]++|=\s*+{VALUE}?+)*+", r"(?:>|\z)"
TAG = rf"</?[a-z]{REST}{END}"
#: Comments, declarations, scripts and styles, or a tag, which stays.
HIDDEN = (rf"(?is)<(?:!--.*?(?:-->|\z)|[!?][^>]*+{END}|(script|style|template)(?=[\s/>]){REST}{END}.*?(?:</\1\s*+>|\z))"
          rf"|({TAG})")
#: A tag, or the start of the page, and the text up to the next tag.
PIECE = rf"(?is)(?:{TAG}|\A)(?:[^<]++|<(?!/?+[a-z]))*+"
#: White space at the start or the end; a run inside is looked at once.
OUTER_SPACE = r"(?U)\A\s++|(?<!\s)\s++\z"
URL = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?$"


def visible(html: Column) -> Column:
    """Markup without comments, declarations, scripts and styles."""
    return F.regexp_replace(html, HIDDEN, "$2")


def pieces(html: Column) -> Column:
    """Visible markup cut before every tag; the first piece may be text only."""
    return F.regexp_extract_all(html, F.lit(PIECE), F.lit(0))


def tags(html: Column) -> Column:
    """All opening and closing tags of visible markup."""
    return F.regexp_extract_all(html, F.lit(f"(?is){TAG}"), F.lit(0))


def value_is(value: str) -> str:
    return rf"""(?:"{value}"|'{value}'|{value}(?=[\s/>]|\z))"""


def value_has(word: str) -> str:
    """Pattern of a value with this word among those that white space parts."""
    def quoted(quote: str) -> str:
        return rf"{quote}\s*+(?:(?!{word}[\s{quote}])[^{quote}\s]++\s++)*+{word}(?=[\s{quote}])"

    return rf"""(?:{quoted('"')}|{quoted("'")}|{word}(?=[\s/>]|\z))"""


def up_to(attribute: str) -> str:
    """Pattern of what comes in a tag before the value of an attribute."""
    here = rf"\s{attribute}\s*+="
    return rf"(?:(?!{here})(?:[^>=]|=\s*+{VALUE}?+))*+{here}"


def tag(name: str, attribute: str = "", value: str = "") -> str:
    """Pattern of the start of an opening tag, with an attribute whose value fits the pattern ``value``."""
    start = rf"<{name}(?=[\s/>]|\z)"
    return rf"{start}{up_to(attribute)}\s*+{value}" if attribute else start


def starts_with(piece: Column, pattern: str) -> Column:
    return piece.rlike(rf"(?is)\A{pattern}")


def attribute(opening: Column, name: str) -> Column:
    """The decoded value of an attribute of an opening tag; null if there is none."""
    found = F.regexp_extract(opening, rf"(?is)\A<[a-z][^\s/>]*+{up_to(name)}\s*+({VALUE}?+)", 1)
    quote = F.substring(found, 1, 1)
    plain = F.when(quote.isin('"', "'"), F.replace(found, quote, F.lit(""))).otherwise(found)
    return F.when(starts_with(opening, rf"<[a-z][^\s/>]*+{up_to(name)}"), characters(plain, in_value=True))


def code_point(number: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def characters(text: Column, in_value: bool = False) -> Column:
    """Text with named and numbered characters in place of their codes; unknown codes stay.

    As browsers do, a name without semicolon may have letters after it, but not in the value of an attribute,
    where it may be part of a link's query.
    """
    names = F.from_json(F.lit(json.dumps(NAMED)), "map<string, map<string, string>>")
    bare = f"^({BARE})(?![A-Za-z0-9=])" if in_value else f"^({BARE})"

    def value_of(name: Column) -> Column:
        return F.try_element_at(F.try_element_at(names, F.substring(name, 1, 1)), name)

    def decoded(part: Column) -> Column:
        decimal, hexadecimal = F.regexp_extract(part, "^#([0-9]{1,7});?", 1), F.regexp_extract(part, "^#[xX]([0-9A-Fa-f]{1,6});?", 1)
        number = F.when(decimal != "", F.try_to_number(decimal, F.lit("9999999")).cast("long")).when(
            hexadecimal != "", F.conv(hexadecimal, 16, 10).cast("long"))
        rest = F.regexp_replace(part, "^(?:#[0-9]+|#[xX][0-9A-Fa-f]+);?", "")
        full = F.concat(value_of(F.regexp_extract(part, "^([A-Za-z][A-Za-z0-9]*;)", 1)),
                        F.regexp_replace(part, "^[A-Za-z0-9]+;", ""))
        short = F.concat(value_of(F.regexp_extract(part, bare, 1)), F.regexp_replace(part, bare, ""))
        return F.when(number.between(1, 0x10FFFF), F.concat(code_point(number), rest)).otherwise(
            F.coalesce(full, short, F.concat(F.lit("&"), part)))

    parts = F.split(text, "&")
    first = F.get(parts, F.lit(0))
    others = F.transform(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), decoded)
    return F.when(F.contains(text, F.lit("&")), F.concat(first, F.array_join(others, ""))).otherwise(text)


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, OUTER_SPACE, "")


def text_of(piece: Column) -> Column:
    """The text behind the tag of a piece, decoded, without outer spaces."""
    return stripped(characters(F.regexp_replace(piece, rf"(?is)\A{TAG}", "")))


def resolve_link(base: Column, href: Column) -> Column:
    """The address a link on the page ``base`` leads to; null for a null link."""
    def parts(url):
        return [F.regexp_extract(url, URL, i) for i in range(1, 6)]

    scheme, host, path, query, _ = parts(base)
    own_scheme, _, own_path, own_query, fragment = parts(href)
    root = F.concat(scheme, F.lit("://"), host)
    folder = F.regexp_extract(path, "^(.*/)", 1)
    full = F.when(F.startswith(own_path, F.lit("/")), own_path).otherwise(
        F.concat(F.when(folder == "", "/").otherwise(folder), own_path))
    steps = F.split(full, "/")
    inner = F.filter(F.slice(steps, 2, F.greatest(F.size(steps) - 1, F.lit(0))), lambda s: s != "")
    walked = F.aggregate(inner, F.array().cast("array<string>"), lambda done, s: F.when(
        s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(s == ".", done).otherwise(
        F.concat(done, F.array(s))))
    ends_open = full.rlike(r"(^|/)\.{0,2}$") & (F.size(walked) > 0)
    joined = F.concat(F.lit("/"), F.array_join(walked, "/"), F.when(ends_open, "/").otherwise(""))
    return (
        F.when(href == "", base)
        .when(own_scheme != "", href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
        .when(own_path == "", F.concat(root, path, F.when(own_query != "", own_query).otherwise(query), fragment))
        .otherwise(F.concat(root, joined, own_query, fragment))
    )
