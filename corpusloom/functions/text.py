"""Text columns: cleaning, tokens, page joins, HTML elements, prompt prefixes."""

from __future__ import annotations

import re
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as Python's re module sees it, in Java syntax.
ANY_SPACE = r"(?U)[\s\x{1c}-\x{1f}]+"
TOKEN = r"\S+"
PAGE_BREAK = "\n\n"
# Fixed value: what may stand between an ampersand and its semicolon.
REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
ENTRY, VALUE = "\x1e", "\x1f"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Catalyst may inline an alias into a lambda and so evaluate it per element;
    a lambda variable is always evaluated once.
    """
    return F.transform(F.array(value), body)[0]


def clean_text(text: Column) -> Column:
    """Collapse white space, undo hyphenation, tighten punctuation, trim.

    The order matters: "A - B" becomes "A B" and "--  z" becomes "-z".
    """
    one_space = F.regexp_replace(text, ANY_SPACE, " ")
    joined = F.regexp_replace(one_space, "- +", "")
    tight = F.regexp_replace(joined, " +([.,;:!?])", "$1")
    return F.trim(tight)


def token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN)).cast("long")


def join_pages(pages: Column) -> Column:
    """Clean every page of an array and join them with a blank line."""
    return F.array_join(F.transform(pages, clean_text), PAGE_BREAK)


def file_name(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def flat_element(html: Column, tag: str) -> Column:
    """Outer HTML of the first ``tag`` element that does not nest; NULL if none."""
    found = F.regexp_extract(html, f"(?si)<{tag}(?:\\s[^>]*)?>.*?</{tag}>", 0)
    return F.nullif(F.trim(found), F.lit(""))


def markup_to_text(html: Column) -> Column:
    """Visible text of an HTML fragment, cleaned."""
    no_code = F.regexp_replace(html, r"(?si)<(script|style)\b.*?</\1>|<!--.*?-->", " ")
    no_tags = F.regexp_replace(no_code, r"<[^>]*>", " ")
    return clean_text(decode_entities(no_tags))


def _named_characters() -> str:
    """All named characters of HTML, and the numbers that stand for those of Windows-1252."""
    named = {name[:-1]: chars for name, chars in html5.items() if name.endswith(";")}
    for number in range(128, 160):
        char = bytes([number]).decode("cp1252", errors="ignore")
        named |= {f"#{number}": char, f"#x{number:x}": char} if char else {}
    return ENTRY.join(name + VALUE + chars for name, chars in named.items())


def decode_entities(text: Column) -> Column:
    """HTML character references as characters, each once; what is none stays."""
    # One literal, which the optimiser turns into a map.
    named = F.str_to_map(F.lit(_named_characters()), F.lit(ENTRY), F.lit(VALUE))

    def point(digits: Column, base: int) -> Column:
        number = F.conv(digits, base, 10).cast("long")
        valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))

    def decoded(part: Column) -> Column:
        name = F.regexp_extract(part, REFERENCE, 1)

        def char(name: Column) -> Column:
            digits = F.regexp_extract(name, r"^#([0-9]+)$", 1)
            hexes = F.regexp_extract(name, r"^#[xX]([0-9a-fA-F]+)$", 1)
            return F.coalesce(
                F.try_element_at(named, F.when(F.startswith(name, F.lit("#")), F.lower(name)).otherwise(name)),
                F.when(digits != "", point(digits, 10)),
                F.when(hexes != "", point(hexes, 16)),
            )

        found = F.concat(char(name), F.substring(part, F.length(name) + 2, F.length(part)))
        return F.coalesce(F.when(name != "", found), F.concat(F.lit("&"), part))

    parts = F.split(text, "&")
    rest = F.transform(F.slice(parts, 2, F.size(parts)), decoded)
    return F.when(F.contains(text, F.lit("&")), F.concat(parts[0], F.array_join(rest, ""))).otherwise(text)


def nested_element(html: Column, tag: str, attribute: str, value: str) -> Column:
    """Outer HTML of the first ``tag[attribute=value]`` element, nesting included; NULL if none.

    The page is cut into tags of that name and what lies between; comments, scripts and
    styles are between, whatever they hold. A fold over the cuts counts how deep they nest
    and keeps where the element begins and ends. One that is not closed ends with the page.
    """
    quoted = r"""(?:[^'">]++|"[^"]*+"|'[^']*+')*+"""
    tokens = F.regexp_extract_all(
        html,
        F.lit(
            rf"(?si)<!--.*?-->|<(script|style)\b{quoted}>.*?</\1\s*>|<{tag}(?=[\s/>]){quoted}>|</{tag}(?=[\s/>])[^>]*>|[^<]+|<"
        ),
        F.lit(0),
    )
    name, wanted = re.escape(attribute), re.escape(value)
    has_value = rf"""(?s)^<[^\s>]+{quoted[:-2]}*?[\s"'/](?i:{name})\s*=\s*(?:"{wanted}"|'{wanted}'|{wanted}(?=[\s/>]))"""
    start = F.struct(*(F.lit(0).alias(n) for n in ("at", "depth", "begin", "end")))

    def step(state: Column, token: Column) -> Column:
        opens = token.rlike(rf"(?i)^<{tag}[\s/>]") & ~F.endswith(token, F.lit("/>"))
        closes = F.lower(F.left(token, F.lit(len(tag) + 2))) == f"</{tag.lower()}"
        inside = (state["begin"] > 0) & (state["end"] == 0)
        begins = (state["begin"] == 0) & opens & token.rlike(has_value)
        after = state["at"] + F.length(token)
        depth = state["depth"] + F.when((inside & opens) | begins, 1).when(inside & closes, -1).otherwise(0)
        return F.struct(
            after.alias("at"),
            depth.alias("depth"),
            F.when(begins, state["at"] + 1).otherwise(state["begin"]).alias("begin"),
            F.when(inside & closes & (state["depth"] == 1), after).otherwise(state["end"]).alias("end"),
        )

    def cut(place: Column) -> Column:
        last = F.when(place["end"] > 0, place["end"]).otherwise(place["at"])
        return F.when(place["begin"] > 0, trim_space(F.substring(html, place["begin"], last - place["begin"] + 1)))

    return let(F.aggregate(tokens, start, step), cut)


def trim_space(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def strip_prompt(output: Column, prompt: Column) -> Column:
    """Generated text without the prompt it begins with."""
    return F.when(
        F.startswith(output, prompt), F.substring(output, F.length(prompt) + 1, F.length(output))
    ).otherwise(output)
