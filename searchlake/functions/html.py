"""HTML columns: one left-to-right tokenizer behind text, title and links.

A page is cut into tokens by one pattern whose alternatives are the states of
an HTML tokenizer: text, comment, raw-text element (with its content), tag
(with its attributes, quoted values included) and bogus comment.  The pattern
decides by the next character alone, so ``regexp_extract_all`` walks the page
once, from left to right, and each character belongs to exactly one token:

* ``<`` before anything but a letter, ``/``, ``!`` or ``?`` is text;
* ``>`` inside a quoted attribute value doesn't end a tag;
* script, style, title and the other raw-text elements end at their own end
  tag or with the page, a comment at its end mark or with the page;
* a tag that the page's end cuts off is dropped.

The head is the longest prefix of blanks, comments and head elements; the body
is the rest.  Text and title decode all named entities and numeric references.

The repetitions are possessive: the pattern engine then loops instead of
recursing, and can't read a broken tag in a second way.  ``pattern_set`` also
gives the plain form for engines without possessive repetition.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from searchlake.constants import BLOCK_TAGS, HEAD_TAGS, WINDOWS_1252

BLANKS = r"\t\n\f\r "

#: Elements whose content is not markup; entities are decoded in the first two.
ESCAPABLE = ("title", "textarea")
RAW = ("script", "style", "xmp", "iframe", "noembed", "noframes")

#: Stands between the pieces of a text that a dropped tag separated, until
#: entities are decoded.  Not a character of any text (it becomes a space).
JOINT = "\ufdd0"

_BLOCK = rf"(?i)^</?(?:br|{'|'.join(BLOCK_TAGS)})[{BLANKS}/>]"
REFERENCE = r"^(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*;?)"
INVISIBLE = "[\u00ad\u200b]"
SPACES = "[\t\n\f\r \u00a0]+"
CONTROLS = r"[\x00-\x1F]"


def pattern_set(possessive: bool) -> dict[str, str]:
    """The patterns by name, with or without possessive repetition."""
    p = "+" if possessive else ""
    blanks = f"[{BLANKS}]"
    name = f"[^{BLANKS}/>][^{BLANKS}/>=]*{p}"
    names = f"{name}(?:{blanks}+{p}[^{BLANKS}/>=]+{p})*{p}"
    value = f"""{blanks}*{p}={blanks}*{p}(?:"[^"]*{p}"|'[^']*{p}'|[^{BLANKS}"'>][^{BLANKS}>]*{p})"""
    rest = f"(?:[{BLANKS}/]*{p}{names}(?:{value}|{blanks}*{p}/))*{p}[{BLANKS}/]*{p}(?:{names}(?:{blanks}*{p}=)?{p}{blanks}*{p})?{p}>"

    def opening(tag: str) -> str:
        return f"<{tag}(?:>|[{BLANKS}/]{rest})"

    def closing(tag: str) -> str:
        return rf"(?:</{tag}(?:>|[{BLANKS}/][^>]*{p}>)|\z)"

    def element(tag: str) -> str:
        return rf"{opening(tag)}[\s\S]*?{closing(tag)}"

    tag = f"</?[a-z][^{BLANKS}/>]*{p}{rest}"
    comment = r"<!--(?:-?>|[\s\S]*?(?:--!?>|\z))"
    bogus = rf"<(?:[!?]|/[^a-z>])[^>]*{p}(?:>|\z)|</>"
    whole = "|".join(map(element, (*RAW, *ESCAPABLE)))
    token = rf"[^<]+{p}|{comment}|{whole}|{tag}|{bogus}|</?[a-z][\s\S]*{p}|<"
    in_head = "|".join(map(element, ("script", "style", "noframes", "title")))
    head_tag = opening(f"/?(?:{'|'.join(HEAD_TAGS)})")
    end_tag = f"</[a-z][^{BLANKS}/>]*{p}{rest}"
    return {
        "rest": rest,
        "token": f"(?i){token}",
        "head": f"(?i)^(?:{blanks}+{p}|{comment}|{in_head}|{head_tag}|{end_tag}|{bogus})*{p}",
        "raw_opening": f"(?i)^<(?:{'|'.join((*RAW, *ESCAPABLE))})(?:>|[{BLANKS}/]{rest})",
        "attribute": f"{name}(?:{value})?{p}",
        "attribute_value": rf"""^[^=]+={blanks}*{p}(?:"([^"]*)"|'([^']*)'|([\s\S]*))\z""",
    }


JVM = pattern_set(possessive=True)

RAW_TOKEN = rf"(?i)^<(?:{'|'.join((*RAW, *ESCAPABLE))})[{BLANKS}/>]"
TEXTAREA_TOKEN = rf"(?i)^<textarea[{BLANKS}/>]"
CODE_TOKEN = rf"(?i)^<(?:script|style)[{BLANKS}/>]"
TITLE_TOKEN = rf"(?i)^<title[{BLANKS}/>]"
HREF_ATTRIBUTE = rf"(?i)^href(?:[{BLANKS}=]|\z)"


def tag_token(tag: str, patterns: dict[str, str] = JVM) -> str:
    """The pattern of a whole start tag's token (one cut off is none)."""
    return rf"(?i)^<{tag}(?:>|[{BLANKS}/]{patterns['rest']})\z"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, however often the
    body uses it (a lambda variable over a one-element array)."""
    return F.element_at(F.transform(F.array(value), body), 1)


# --- entities --------------------------------------------------------------------


def entity_table() -> dict[str, str]:
    """Every named entity by its name as written, with its semicolon or, where
    the standard allows that, without."""
    return dict(html5)


def _literal_map(table: dict, types: str) -> Column:
    """A constant map; Catalyst folds it into one literal."""
    return F.from_json(F.lit(json.dumps(table)), types)


def _character(code: Column) -> Column:
    """The character of a code point as the standard reads a reference."""
    windows = _literal_map(WINDOWS_1252, "map<string,long>")
    mapped = F.coalesce(F.try_element_at(windows, code.cast("string")), code)
    bad = (mapped == 0) | mapped.between(0xD800, 0xDFFF) | (mapped > 0x10FFFF)
    point = F.when(bad, F.lit(0xFFFD)).otherwise(mapped)
    return F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")


def _numeric(reference: Column) -> Column:
    digits = F.regexp_extract(reference, "^#[xX]?0*([0-9a-fA-F]*)", 1)
    base16 = reference.rlike("^#[xX]")
    value = F.when(base16, F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("long")
    return let(F.when(F.length(digits) > 7, F.lit(1 << 30).cast("long")).otherwise(F.coalesce(value, F.lit(0).cast("long"))), _character)


def decode_entities(text, in_attribute: bool = False) -> Column:
    """Named and numeric references of a text decoded, each once.  An unknown
    name stays as it is.  In an attribute value, a name without its semicolon
    before ``=`` stays too."""

    def piece(after: Column) -> Column:
        def decoded(ref: Column) -> Column:
            rest = F.substring(after, F.length(ref) + 1, F.lit(1 << 30))
            char = F.when(ref == "", F.lit(None)).when(ref.startswith("#"), _numeric(ref)).otherwise(F.try_element_at(_literal_map(entity_table(), "map<string,string>"), ref))
            if in_attribute:
                char = F.when(ref.endswith(";") | ref.startswith("#") | ~rest.startswith("="), char)
            return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), after))

        return let(F.regexp_extract(after, REFERENCE, 0), decoded)

    def whole(t: Column) -> Column:
        parts = F.split(t, "&")
        decoded = F.concat(F.element_at(parts, 1), F.array_join(F.transform(F.slice(parts, 2, 1 << 30), piece), ""))
        return F.when(t.contains("&"), decoded).otherwise(t)

    return let(_c(text), whole)


# --- page parts ------------------------------------------------------------------


def split_page(html) -> Column:
    """``struct(head, body)``: the tokens of a page's head and of its body,
    computed from one pass each.  A null page has no tokens."""
    page = F.coalesce(F.translate(_c(html), JOINT, " "), F.lit(""))

    def cut(p: Column) -> Column:
        def parts(head: Column) -> Column:
            body = F.substring(p, F.length(head) + 1, F.lit(1 << 30))
            return F.struct(
                F.regexp_extract_all(head, F.lit(JVM["token"]), F.lit(0)).alias("head"),
                F.regexp_extract_all(body, F.lit(JVM["token"]), F.lit(0)).alias("body"),
            )

        return let(F.regexp_extract(p, JVM["head"], 0), parts)

    return let(page, cut)


def _content(token: Column) -> Column:
    """The content of a raw-text element's token."""
    name = F.regexp_extract(token, "^<([a-zA-Z]+)", 1)
    own_end = F.concat(F.lit("(?i)</"), name, F.lit(rf"(?:>|[{BLANKS}/][^>]*>)\z"))
    return F.regexp_replace(F.regexp_replace(token, JVM["raw_opening"], ""), own_end, F.lit(""))


def _text_of_token(t: Column) -> Column:
    # Entities stay undecoded in raw content: the joint parts "&" from names.
    raw = F.replace(_content(t), F.lit("&"), F.lit("&" + JOINT))
    element = (
        F.when(t.rlike(CODE_TOKEN), F.lit(" "))
        .when(t.rlike(TITLE_TOKEN), F.concat(F.lit(" "), _content(t), F.lit(" ")))
        .when(t.rlike(TEXTAREA_TOKEN), _content(t))
        .otherwise(raw)
    )
    # Most tokens are text or plain tags: two patterns tell those apart.
    tag = F.when(t.rlike(RAW_TOKEN), element).when(t.rlike(_BLOCK), F.lit(" ")).otherwise(F.lit(JOINT))
    return F.when(~t.startswith("<") | (t == "<"), t).otherwise(tag)


def text_of(parts: Column) -> Column:
    """Visible text of the body: block elements and line breaks part words,
    other tags join them; scripts, styles and comments go."""
    joined = F.array_join(F.transform(parts["body"], _text_of_token), "")
    return F.regexp_replace(F.replace(decode_entities(joined), F.lit(JOINT), F.lit("")), INVISIBLE, "")


def title_of(parts: Column) -> Column:
    """The first title of the head, blanks collapsed; '' when there is none."""
    first = F.get(F.filter(parts["head"], lambda t: t.rlike(TITLE_TOKEN)), 0)
    text = F.regexp_replace(decode_entities(_content(first)), INVISIBLE, "")
    return F.coalesce(F.trim(F.regexp_replace(text, SPACES, " ")), F.lit(""))


def _href(token: Column) -> Column:
    """The value of a start tag's first href, decoded and trimmed; '' for one
    without a value, null if it has none."""
    inside = F.regexp_replace(token, rf"^<[^{BLANKS}/>]+", "")
    attributes = F.regexp_extract_all(inside, F.lit(JVM["attribute"]), F.lit(0))
    own = F.get(F.filter(attributes, lambda a: a.rlike(HREF_ATTRIBUTE)), 0)
    value = F.concat(*[F.regexp_extract(own, JVM["attribute_value"], i) for i in (1, 2, 3)])
    return F.trim(F.regexp_replace(decode_entities(value, in_attribute=True), CONTROLS, ""))


def hrefs_of(parts: Column, tag: str) -> Column:
    """The href values of all start tags of one name, in document order."""
    tokens = F.concat(parts["head"], parts["body"])
    found = F.transform(F.filter(tokens, lambda t: t.rlike(tag_token(tag))), _href)
    return F.filter(found, lambda h: h.isNotNull())
