"""Column builders for JSON-LD, maps and markup."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from groundplan.functions.text import col


def links(html: str | Column, pattern: str = r'href="([^"#?]+)"', base: str = "") -> Column:
    """Distinct matches of the pattern's group in order, behind a base."""
    found = F.array_distinct(F.regexp_extract_all(col(html), F.lit(pattern), F.lit(1)))
    return F.transform(found, lambda u: F.concat(F.lit(base), u)) if base else found


def sitemap_locs(xml: str | Column) -> Column:
    return F.regexp_extract_all(col(xml), F.lit(r"<loc>([^<]+)</loc>"), F.lit(1))


def ld_json(html: str | Column) -> Column:
    """array<variant> of all JSON-LD nodes of a page that can be parsed, lists and @graph flattened."""
    blocks = F.transform(F.regexp_extract_all(col(html), F.lit(r"(?s)ld\+json[^>]*>(.*?)</script>"), F.lit(1)), lambda b: F.try_parse_json(b))

    def items(v: Column) -> Column:
        return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))

    def graph(v: Column) -> Column:
        return F.coalesce(F.try_variant_get(v, "$['@graph']", "array<variant>"), F.array(v))

    flat = F.flatten(F.transform(F.filter(blocks, lambda b: b.isNotNull()), items))
    return F.flatten(F.transform(flat, graph))


def has_type(node: Column, *types: str) -> Column:
    """Whether a node's @type, a name or a list of names, has one of these."""
    kinds = F.coalesce(F.try_variant_get(node, "$['@type']", "array<string>"), F.array(F.try_variant_get(node, "$['@type']", "string")))
    return F.coalesce(F.arrays_overlap(kinds, F.array(*[F.lit(t) for t in types])), F.lit(False))


def first_of_type(nodes: Column, *types: str) -> Column:
    return F.get(F.filter(nodes, lambda n: has_type(n, *types)), F.lit(0))


def field(node: Column, path: str, kind: str = "string") -> Column:
    """An optional field; null if it or its parents aren't there."""
    return F.try_variant_get(node, path, kind)


def first_offer(node: Column, name: str) -> Column:
    """A field of `offers`, which is one object or a list of them."""
    return F.coalesce(field(node, f"$.offers[0].{name}"), field(node, f"$.offers.{name}"))


def row_map(columns: Column, cells: Column) -> Column:
    """map<string,string> of header and cells: other headers than cells give col0, col1, ...; a repeated header counts once."""
    names = F.when(F.size(columns) == F.size(cells), columns).otherwise(F.transform(F.sequence(F.lit(0), F.size(cells) - 1), lambda i: F.concat(F.lit("col"), i)))
    return F.when(F.size(cells) > 0, first_wins(F.arrays_zip(names.alias("key"), cells.alias("value")))).otherwise(F.create_map().cast("map<string,string>"))


def first_wins(entries: Column) -> Column:
    """A map of entries in which the first of equal keys counts."""
    kept = F.filter(entries, lambda e, i: F.array_position(F.transform(entries, lambda x: x.getItem("key")), e.getItem("key")) == i + 1)
    return F.map_from_arrays(F.transform(kept, lambda e: e.getItem("key")), F.transform(kept, lambda e: e.getItem("value")))


def ordered_sections(sections: Column, known: list[str]) -> Column:
    """The map with the known keys first, in their order, and the others behind them as they come."""
    entries = F.map_entries(sections)
    order = F.array(*[F.lit(k) for k in known])
    first = F.filter(F.transform(order, lambda k: F.struct(k.alias("key"), F.try_element_at(sections, k).alias("value"))), lambda e: F.map_contains_key(sections, e["key"]))
    return F.map_from_entries(F.concat(first, F.filter(entries, lambda e: ~F.array_contains(order, e["key"]))))


def flatten_sections(sections: Column, summary: Column | None = None, sep: str = " :: ") -> Column:
    """map of "section :: key" (and "summary.key") from a map of maps."""
    entries = F.flatten(
        F.transform(F.map_entries(sections), lambda s: F.transform(F.map_entries(s["value"]), lambda e: F.struct(F.concat(s["key"], F.lit(sep), e["key"]).alias("key"), e["value"].alias("value"))))
    )
    if summary is None:
        return F.map_from_entries(entries)
    head = F.transform(F.map_entries(F.coalesce(summary, F.create_map().cast("map<string,string>"))), lambda e: F.struct(F.concat(F.lit("summary."), e["key"]).alias("key"), e["value"].alias("value")))
    return F.map_from_entries(F.concat(head, entries))


def ocr_words(tsv: str | Column) -> Column:
    """array<struct<text, conf, left, top, width, height, line>> of recogniser TSV: the header, short and blank rows are skipped."""
    rows = F.slice(F.split(col(tsv), "\n"), F.lit(2), F.lit(1 << 30))
    cells = F.transform(rows, lambda r: F.split(r, "\t"))
    made = F.transform(
        F.filter(cells, lambda c: (F.size(c) >= 12) & (F.trim(F.get(c, F.lit(11))) != "")),
        lambda c: F.struct(
            F.get(c, F.lit(11)).alias("text"),
            F.get(c, F.lit(10)).try_cast("double").alias("conf"),
            *[F.get(c, F.lit(i)).try_cast("int").alias(n) for i, n in ((6, "left"), (7, "top"), (8, "width"), (9, "height"))],
            F.concat_ws("-", F.get(c, F.lit(2)), F.get(c, F.lit(3)), F.get(c, F.lit(4))).alias("line"),
        ),
    )
    return F.filter(made, lambda w: w["conf"].isNotNull() & w["left"].isNotNull() & w["top"].isNotNull() & w["width"].isNotNull() & w["height"].isNotNull())


def mean_confidence(words: Column) -> Column:
    """Mean confidence of words with one of 0 or more, to one digit; 0 without any."""
    sure = F.transform(F.filter(words, lambda w: w["conf"] >= 0), lambda w: w["conf"])
    return F.coalesce(F.bround(F.try_divide(F.aggregate(sure, F.lit(0.0), lambda a, x: a + x), F.size(sure)), 1), F.lit(0.0))


def sure_words(words: Column, least: float) -> Column:
    """The words that were recognised with at least so much confidence."""
    return F.filter(words, lambda w: w["conf"] >= least)
