"""Rows from HTML columns, with regular expressions inside the JVM.

Each operator maps one page to its rows without a shuffle. A page is read as a sequence of tokens
(comments, scripts and styles, tags with their quoted attributes, text) and written again in one plain form: no
hidden parts, attribute values in double quotes and without angle brackets. Elements are then found by
cutting the page at opening tags and each piece at its closing tag, which also
covers the tags authors leave open.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.functions.scalars import classify_band, col_of, flip_name, strip

# The entities that are decoded, the ampersand last.
ENTITIES = {
    "&nbsp;": " ",
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&copy;": "©",
    "&middot;": "·",
    "&amp;": "&",
}

# Parents whose closing tag also ends an open child.
PARENTS = {
    "tr": ("tbody", "table"),
    "li": ("ul", "ol"),
    "p": ("article", "main", "section", "div", "body"),
}

HIDDEN = r"(?is)<(?:script[^>]*>.*?</script>|style[^>]*>.*?</style>|!--.*?-->)"

#: The inside of a tag: what is quoted in it may hold any character.
INSIDE = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
#: One token of a page: something hidden, a tag, text, or a bracket that begins no tag.
TOKEN = (
    rf"(?is)<!--.*?-->|<script(?=[\s>]){INSIDE}>.*?</script\s*>|<style(?=[\s>]){INSIDE}>.*?</style\s*>"
    rf"|</?[a-z]{INSIDE}>|[^<]++|<"
)
#: Pages that are not in the plain form yet: single quotes, or brackets inside quotes, in a tag.
UNPLAIN = r"""(?s)<[a-zA-Z][^<>]*(?:'|"[^"<>]*[<>])"""


def plain_tag(tag: Column) -> Column:
    """A tag with its attribute values in double quotes and without angle brackets."""
    parts = F.regexp_extract_all(tag, F.lit(r"""(?s)"[^"]*"|'[^']*'|[^"']+"""), F.lit(0))

    def value(part: Column) -> Column:
        inner = F.substring(part, F.lit(2), F.length(part) - 2)
        for char, entity in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            inner = F.replace(inner, F.lit(char), F.lit(entity))
        return F.concat(F.lit('"'), inner, F.lit('"'))

    quoted = lambda part: F.startswith(part, F.lit('"')) | F.startswith(part, F.lit("'"))
    return F.array_join(F.transform(parts, lambda part: F.when(quoted(part), value(part)).otherwise(part)), "")


def page_tokens(html: Column | str) -> Column:
    """The tokens of a page in its plain form, without what is hidden."""
    tokens = F.regexp_extract_all(col_of(html), F.lit(TOKEN), F.lit(0))
    shown = F.filter(tokens, lambda t: ~t.rlike(r"(?i)^<(?:!--|(?:script|style)[\s>])"))
    odd = lambda t: t.rlike(r"""(?s)^<[a-zA-Z].*["']""")
    # a bracket that begins no tag is text
    return F.transform(shown, lambda t: F.when(odd(t), plain_tag(t)).when(t == "<", F.lit("&lt;")).otherwise(t))


def visible(html: Column | str) -> Column:
    """The page in its plain form, without scripts, styles and comments."""
    page = col_of(html)
    return F.when(page.rlike(UNPLAIN), F.array_join(page_tokens(page), "")).otherwise(F.regexp_replace(page, HIDDEN, ""))


def opening(tag: str) -> str:
    return rf"(?i)<{tag}(?:\s[^>]*)?>"


def closing(*tags: str) -> str:
    return rf"(?i)</(?:{'|'.join(tags)})\s*>"


def numeric_entities(text: Column) -> Column:
    """The text with ``&#8217;`` and ``&#x2019;`` as the characters they number; other numbers stay as they are."""

    def character(entity: Column) -> Column:
        digits = F.regexp_extract(entity, r"&#[xX]?([0-9a-fA-F]+);", 1)
        code = F.when(entity.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).cast("int")
        known = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.when(known, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(entity)

    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"), F.lit(0)))
    replaced = F.aggregate(found, text, lambda done, entity: F.replace(done, entity, character(entity)))
    return F.when(F.contains(text, F.lit("&#")), replaced).otherwise(text)


def decode(text: Column) -> Column:
    """The text with its entities as characters, the ampersand last."""
    text = numeric_entities(text)
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def plain_text(markup: Column) -> Column:
    """Text of a piece of markup, trimmed; line breaks stay."""
    broken = F.regexp_replace(markup, r"(?i)<br\s*/?>", "\n")
    return strip(decode(F.regexp_replace(broken, r"<[^>]*>", "")))


def cut_at(markup: Column, pattern: str) -> Column:
    """What follows each match of the pattern, up to the next match."""
    pieces = F.split(markup, pattern)
    return F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))


def elements(markup: Column, tag: str) -> Column:
    """Inner markup of every element of one kind, in page order.

    An element left open ends at the next one, or where its parent closes.
    """
    pieces = cut_at(markup, opening(tag))
    return F.transform(
        pieces, lambda piece: F.get(F.split(piece, closing(tag, *PARENTS.get(tag, ())), 2), F.lit(0))
    )


def nested_markup(markup: Column, tag: str) -> tuple[Column, Column]:
    """The markup with the elements of one kind that lie inside another one as plain text, and the
    stretches that lie inside such an inner element."""
    edge = rf"(?i)</?{tag}(?:\s[^>]*)?>"
    tags = F.regexp_extract_all(markup, F.lit(edge), F.lit(0))
    steps = F.transform(tags, lambda t: F.when(F.startswith(t, F.lit("</")), -1).otherwise(1))

    def enter(state: Column, step: Column) -> Column:
        depth = F.greatest(state["depth"] + step, F.lit(0))
        return F.struct(depth.alias("depth"), F.concat(state["all"], F.array(depth)).alias("all"))

    start = F.struct(F.lit(0).alias("depth"), F.array(F.lit(0)).alias("all"))
    depths = F.aggregate(steps, start, enter, lambda state: state["all"])
    pieces = F.arrays_zip(
        depths.alias("depth"),
        F.concat(F.array(F.lit("")), tags).alias("edge"),
        F.split(markup, edge).alias("piece"),
    )

    def flattened(p: Column) -> Column:
        # the edges of the outer elements stay
        own = (p["depth"] == 0) | ((p["depth"] == 1) & ~F.startswith(p["edge"], F.lit("</")))
        text = F.regexp_replace(p["piece"], r"<[^>]*>", " ")
        return F.concat(F.when(own, p["edge"]).otherwise(" "), F.when(p["depth"] > 1, text).otherwise(p["piece"]))

    outer = F.transform(pieces, flattened)
    inner = F.transform(F.filter(pieces, lambda p: p["depth"] > 1), lambda p: p["piece"])
    return F.array_join(outer, ""), inner


def inside_containers(markup: Column, tags: Sequence[str], classes: Sequence[str]) -> Column:
    """The stretches of markup inside any of the elements, or inside a div or section of one of the classes."""
    edge = rf"(?i)</?(?:{'|'.join([*tags, 'div', 'section'])})(?:\s[^>]*)?>"
    own = rf"(?i)^</?(?:{'|'.join(tags)})[\s>]"
    marked = rf"""(?is)\sclass\s*=\s*["'][^"']*(?<![\w-])(?:{'|'.join(map(re.escape, classes))})(?![\w-])"""
    steps = F.transform(
        F.regexp_extract_all(markup, F.lit(edge), F.lit(0)),
        lambda tag: F.struct(
            F.when(F.startswith(tag, F.lit("</")), -1).otherwise(1).alias("by"),
            tag.rlike(own).alias("own"),
            tag.rlike(marked).alias("marked"),
        ),
    )

    def enter(state: Column, step: Column) -> Column:
        # depth in the elements, and depth in divisions since the marked one
        element = F.when(step["own"], F.greatest(state["element"] + step["by"], F.lit(0))).otherwise(state["element"])
        begins = (state["box"] == 0) & step["marked"] & (step["by"] > 0)
        inner = F.when(state["box"] > 0, state["box"] + step["by"]).when(begins, F.lit(1)).otherwise(F.lit(0))
        box = F.when(step["own"], state["box"]).otherwise(inner)
        return F.struct(
            element.alias("element"),
            box.alias("box"),
            F.concat(state["all"], F.array((element > 0) | (box > 0))).alias("all"),
        )

    start = F.struct(F.lit(0).alias("element"), F.lit(0).alias("box"), F.array(F.lit(False)).alias("all"))
    within = F.aggregate(steps, start, enter, lambda state: state["all"])
    pieces = F.arrays_zip(within.alias("within"), F.split(markup, edge).alias("piece"))
    return F.transform(F.filter(pieces, lambda p: p["within"]), lambda p: p["piece"])


def grid_rows(
    df: DataFrame, html: str = "html", row: str = "tr", cell: str = "td", name: str = "cells"
) -> DataFrame:
    """One row per grid row with the trimmed cell texts; empty rows are dropped.

    A grid inside a cell is text of that cell, and its own rows come after those of the outer grids.
    """

    def rows_of(markup: Column) -> Column:
        return F.transform(elements(markup, row), lambda r: F.transform(elements(r, cell), plain_text))

    keep = [c for c in df.columns if c != html]
    page = df.select(*keep, visible(html).alias("_page"))
    if row == "tr":
        outer, inner = nested_markup(F.col("_page"), "table")
        page = page.select(*keep, outer.alias("_page"), F.flatten(F.transform(inner, rows_of)).alias("_inner"))
        cells = F.concat(rows_of(F.col("_page")), F.col("_inner"))
    else:
        cells = rows_of(F.col("_page"))
    filled = F.filter(cells, lambda r: F.exists(r, lambda text: text != ""))
    return page.select(*keep, F.posexplode(filled).alias(*[f"_{x}" for x in ("row_no", "cells")])).select(
        *keep, F.col("_row_no").alias("row_no"), F.col("_cells").alias(name)
    )


#: A start tag.
START_TAG = rf"(?s)<[a-zA-Z][a-zA-Z0-9]*+{INSIDE}>"


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute in double or single quotes; null if it is missing or empty."""
    double = F.regexp_extract(tag, rf'(?is)\s{name}\s*=\s*"([^"]*)"', 1)
    single = F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*'([^']*)'", 1)
    return F.nullif(F.when(double != "", double).otherwise(single), F.lit(""))


def embedded_json(
    df: DataFrame,
    schema: T.StructType,
    element_id: str,
    attr: str,
    html: str = "html",
    name: str = "data",
) -> tuple[DataFrame, DataFrame]:
    """JSON kept in an attribute of one element: parsed rows, and rejected ones.

    Quoted attributes are units, so a ``>`` in one does not end the tag, and all entities in them are
    decoded. Pages without the element give neither; a reject holds the whole tag.
    """
    named = rf"""(?is)\sid\s*=\s*["']?{re.escape(element_id)}(?:["'\s/>])"""
    tags = F.regexp_extract_all(html, F.lit(START_TAG), F.lit(0))
    tag = F.get(F.filter(tags, lambda t: t.rlike(named)), F.lit(0))
    found = df.withColumn("_tag", tag).filter(F.col("_tag").isNotNull())
    raw = decode(attribute(F.col("_tag"), attr))
    tolerant = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = found.withColumn("_raw", raw).withColumn(
        name, F.from_json("_raw", tolerant, {"columnNameOfCorruptRecord": "_bad"})
    )
    broken = F.col(name).isNull() | F.col(f"{name}._bad").isNotNull()
    keep = [c for c in df.columns if c != html]
    good = parsed.filter(~broken).select(
        *keep, F.struct(*[F.col(f"{name}.{f}") for f in schema.fieldNames()]).alias(name)
    )
    return good, parsed.filter(broken).select(*keep, F.col("_tag").alias("rejected"))


def labelled_values(
    df: DataFrame,
    labels: Mapping[str, str],
    tag: str = "p",
    css_class: str = "match-weather__text",
    html: str = "html",
    value_tag: str = "span",
) -> DataFrame:
    """Values of labelled paragraphs as columns; "" where a label is missing.

    ``css_class`` may be one of several classes, in any quotes. ``labels`` maps a word of the paragraph to the output column. A paragraph
    counts for the first word it contains; the last such paragraph wins.
    """
    opened = rf'(?is)<{tag}\s(?:[^>]*\s)?class\s*=\s*(?:"(?:[^"]*\s)?{css_class}(?:\s[^"]*)?"|{css_class}(?=[\s>]))[^>]*>(.*?)</{tag}\s*>'
    paragraphs = F.regexp_extract_all(visible(html), F.lit(opened), F.lit(1))
    words = list(labels)

    def value_of(word: str) -> Column:
        earlier = words[: words.index(word)]

        def matches(p: Column) -> Column:
            hit = F.contains(plain_text(p), F.lit(word))
            for other in earlier:
                hit = hit & ~F.contains(plain_text(p), F.lit(other))
            return hit

        last = F.try_element_at(F.filter(F.col("_paragraphs"), matches), F.lit(-1))
        inner = F.get(elements(last, value_tag), F.lit(0))
        return F.coalesce(plain_text(inner), F.lit(""))

    keep = [c for c in df.columns if c != html]
    return df.select(*keep, paragraphs.alias("_paragraphs")).select(
        *keep, *[value_of(word).alias(out) for word, out in labels.items()]
    )


def token_stream(
    df: DataFrame,
    header: str,
    item: str,
    html: str = "html",
    header_attr: str | None = None,
    keywords: Sequence[str] = (),
    item_pattern: str | None = None,
) -> DataFrame:
    """Items of a page under the header before them; items before any header go.

    The header name is the text of ``header``, or its attribute ``header_attr``,
    which then has to hold one of ``keywords``; other elements of that kind do not
    start a group. The item is the text of ``item``. With ``item_pattern`` that
    text has to match, its group is the label, and the item is the text right
    after the element. The page is cut once at its headers and each section once
    at its items, so the work is linear in the page and nothing is shuffled.
    """
    if header_attr:
        words = "|".join(re.escape(word) for word in keywords)
        head_tag = rf'(?i:<{header}\s(?:[^>]*\s)?{header_attr}=)"[^"]*(?:{words})[^"]*"[^>]*>'
    else:
        head_tag = rf"(?i:<{header})(?:\s[^>]*)?>"

    def head_name(tag: Column, section: Column) -> Column:
        if header_attr:
            text = attribute(tag, header_attr)
        else:
            text = plain_text(F.get(F.split(section, closing(header)), F.lit(0)))
        return F.upper(F.replace(text, F.lit(" "), F.lit("_")))

    def parse(piece: Column) -> Column:
        parts = F.split(piece, closing(item, *PARENTS.get(item, ())), 2)
        inner = plain_text(F.get(parts, F.lit(0)))
        if not item_pattern:
            return F.struct(F.lit(None).cast("string").alias("label"), inner.alias("text"))
        after = F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
        return F.struct(
            F.nullif(F.regexp_extract(inner, item_pattern, 1), F.lit("")).alias("label"),
            plain_text(F.get(F.split(after, "<", 2), F.lit(0))).alias("text"),
        )

    def wanted(t: Column) -> Column:
        named = t["text"] != ""
        return named & t["label"].isNotNull() if item_pattern else named

    keep = [c for c in df.columns if c != html]
    sections = F.arrays_zip(
        F.regexp_extract_all("_page", F.lit(head_tag), F.lit(0)).alias("tag"),
        cut_at(F.col("_page"), head_tag).alias("body"),
    )
    cut = df.select(*keep, visible(html).alias("_page")).select(
        *keep, F.posexplode(sections).alias("section_no", "_section")
    )
    named = cut.select(
        *keep,
        "section_no",
        head_name(F.col("_section.tag"), F.col("_section.body")).alias("group"),
        F.transform(cut_at(F.col("_section.body"), opening(item)), parse).alias("_items"),
    )
    return named.select(
        *keep, "section_no", "group", F.posexplode(F.filter("_items", wanted)).alias("item_no", "_item")
    ).select(*keep, "section_no", "item_no", "group", "_item.*")


def team_lists(df: DataFrame, keywords: Sequence[str], html: str = "html") -> DataFrame:
    """Numbered player lists under team logos: team, jersey, name and status."""
    items = token_stream(df, "img", "strong", html, "alt", keywords, r"^(\d+)\.$")
    jersey = F.col("label").cast("int")
    keep = [c for c in df.columns if c != html]
    return items.select(
        *keep,
        F.col("group").alias("team"),
        jersey.alias("jersey"),
        F.col("text").alias("player_name_raw"),
        flip_name("text").alias("player_name"),
        classify_band(jersey).alias("status"),
    )


def article_text(df: DataFrame, html: str = "html", long_enough: int = 30) -> DataFrame:
    """Title and body of an article.

    The body is made of the paragraphs inside article or main, or inside a division for entry or post
    content; a page without any gives its longer paragraphs instead.
    """
    regions = inside_containers(F.col("_page"), ["article", "main"], ["entry-content", "post-content"])
    inside = F.flatten(F.transform(regions, lambda r: F.transform(elements(r, "p"), plain_text)))
    texts = F.filter(inside, lambda t: t != "")
    anywhere = F.filter(
        F.transform(elements(F.col("_page"), "p"), plain_text), lambda t: F.length(t) > long_enough
    )
    title = plain_text(F.coalesce(F.get(elements(F.col("_page"), "title"), F.lit(0)), F.lit("")))
    chosen = F.when(F.size("_texts") > 0, F.col("_texts")).otherwise(anywhere)
    keep = [c for c in df.columns if c != html]
    return (
        df.select(*keep, visible(html).alias("_page"))
        .select(*keep, "_page", texts.alias("_texts"))
        .select(*keep, title.alias("title"), F.array_join(chosen, "\n\n").alias("body"))
    )


def url_slug(url: Column | str, length: int = 80) -> Column:
    """File-name form of a URL: path only, words joined by dashes."""
    path = F.regexp_replace(col_of(url), r"https?://[^/]+/", "")
    words = F.regexp_replace(path, r"[^a-zA-Z0-9]+", "-")
    return F.substring(F.regexp_replace(words, r"^-+|-+$", ""), 1, length)
