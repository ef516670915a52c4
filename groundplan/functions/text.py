"""Column builders for text: keys, categories, money, numbers, HTML, addresses. Null in, null out unless said otherwise."""

from __future__ import annotations

import html
import re

from pyspark.sql import Column, functions as F, types as T

SPACES = r"(?U)\s+"


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank_to_null(x: str | Column) -> Column:
    """Trimmed text; blank is missing."""
    return F.nullif(clean_space(x), F.lit(""))


def clean_space(x: str | Column) -> Column:
    """White space of any kind collapsed and trimmed."""
    return F.trim(F.regexp_replace(col(x), SPACES, " "))


def title_case(x: str | Column) -> Column:
    """Upper case for each letter that doesn't follow a letter, lower case for the others ("semi/fully" to "Semi/Fully")."""
    parts = F.split(F.lower(col(x)), r"(?<!\p{L})(?=\p{L})")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))), "")


def normalize_category(x: str | Column) -> Column:
    """One spelling for a category: "ready-to-move Property" to "Ready To Move"; blank is null."""
    s = F.trim(F.regexp_replace(F.trim(col(x)), r"(?i)\s*\b(property|properties)$", ""))
    return F.nullif(F.trim(title_case(F.regexp_replace(s, r"[\s\-]+", " "))), F.lit(""))


def place_key(x: str | Column) -> Column:
    """Lower-case key of a place without up to two trailing city, state or country names; blank is null."""
    s = F.trim(F.lower(col(x)))
    for _ in range(2):
        s = F.regexp_replace(s, r"[\s,]+(hyderabad|telangana|india)$", "")
    return F.nullif(clean_space(F.regexp_replace(s, "[^a-z0-9 ]", " ")), F.lit(""))


def name_key(x: str | Column) -> Column:
    """Upper-case letters and digits with single spaces; null is the empty key."""
    return F.coalesce(clean_space(F.regexp_replace(F.upper(col(x)), "[^A-Z0-9 ]", " ")), F.lit(""))


def pincode_key(x: str | Column) -> Column:
    """A code that may have come as a double ("500081.0") as text; junk, NaN and infinities are null."""
    d = col(x).cast("string").try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < 1e15), d.cast("long").cast("string"))


def number(x: str | Column) -> Column:
    """The first number with thousands commas."""
    return F.replace(F.regexp_substr(col(x), F.lit(r"[\d,]+(?:\.\d+)?")), F.lit(","), F.lit("")).try_cast("double")


#: Rupees in a unit of money (fixed values).
MONEY_UNITS = {"crores": 1e7, "crore": 1e7, "cr": 1e7, "lakhs": 1e5, "lakh": 1e5, "lacs": 1e5, "lac": 1e5, "l": 1e5, "k": 1e3}


def money(x: str | Column) -> Column:
    """Rupees of "1.5 Cr", "68 Lac", "₹ 5,000"; null without a number. The pattern is a fixed value."""
    pattern = r"(?i)([\d,]+(?:\.\d+)?)\s*(Crores?|Cr|Lacs?|Lakhs?|L|K)?\b"
    s = F.replace(col(x), F.lit("₹"), F.lit(" "))
    amount = F.replace(F.regexp_extract(s, pattern, 1), F.lit(","), F.lit("")).try_cast("double")
    unit = F.lower(F.regexp_extract(s, pattern, 2))
    table = F.create_map(*[F.lit(x) for kv in MONEY_UNITS.items() for x in kv])
    factor = F.coalesce(F.try_element_at(table, unit), F.lit(1.0))
    return amount * factor


def first_group(x: str | Column, pattern: str, group: int = 1) -> Column:
    """The trimmed group of the first match, '' without one."""
    return F.coalesce(F.trim(F.regexp_extract(col(x), pattern, group)), F.lit(""))


@F.udf(T.StringType(), useArrow=True)
def _unescaped(s):
    return None if s is None else html.unescape(s)


def _unescape_only(names: tuple[str, ...]):
    """A function of a column that resolves references by these names, with their semicolon, and no others."""
    found = re.compile(f"&(?:{'|'.join(map(re.escape, names))});")

    @F.udf(T.StringType(), useArrow=True)
    def run(s):
        return None if s is None else found.sub(lambda m: html.unescape(m.group()), s)

    return run


def unescape(x: str | Column, names: tuple[str, ...] | None = None) -> Column:
    """Named and numeric character references resolved once, as browsers do; what is none stays.

    Browsers also take some references without a semicolon ("&amp" where a text was cut off). With `names` only these are
    resolved, and only where they end in a semicolon. The one step here that leaves the JVM (in Arrow batches): the table
    has over two thousand names, and as an expression it would be copied into every plan that reads a page.
    """
    return (_unescape_only(names) if names else _unescaped)(col(x))


def html_to_text(x: str | Column, names: tuple[str, ...] | None = None) -> Column:
    """Visible text: character references resolved first, then scripts, styles and tags become spaces, white space collapses."""
    s = F.regexp_replace(unescape(x, names), r"(?s)<script.*?</script>|<style.*?</style>|<[^>]+>", " ")
    return F.regexp_replace(s, SPACES, " ")


def url_domain(x: str | Column) -> Column:
    """Host in lower case without "www."; a label for rows without a URL."""
    host = F.regexp_extract(F.lower(col(x)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.coalesce(F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit("")), F.lit("unknown (no URL)"))


def repair_url(x: str | Column) -> Column:
    """A URL without spreadsheet cell references pasted into it."""
    return F.regexp_replace(col(x), r"\+A\d+:[A-Z]+\d+", "")


def segment(x: str | Column, n: int, sep: str = "/") -> Column:
    """The n-th part from the left (1...) or from the right (-1...), null beyond."""
    return F.try_element_at(F.split(col(x), sep), F.lit(n))


def unslug(x: str | Column) -> Column:
    return title_case(F.replace(col(x), F.lit("-"), F.lit(" ")))


def join_non_empty(*parts: str | Column, sep: str = ", ") -> Column:
    """The parts that aren't null or empty."""
    return F.concat_ws(sep, *[F.nullif(col(p) if not isinstance(p, str) else F.col(p), F.lit("")) for p in parts])


def url_decode(x: str | Column) -> Column:
    """Percent escapes decoded once; a plus sign stays."""
    return F.try_url_decode(F.replace(col(x), F.lit("+"), F.lit("%2B")))


def slugify(x: str | Column) -> Column:
    return F.regexp_replace(col(x), r"[^\p{L}\p{N}]", "_")


def bound(value: Column, make) -> Column:
    """make(value) with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def key_values(x: str | Column, keys: list[str]) -> Column:
    """map<string,string> of flat text: a key's value reaches to the next key; keys stand as whole words, first place counts."""

    def hits(s: Column) -> Column:
        at = [F.struct(F.regexp_instr(s, F.lit(rf"(?<![A-Za-z])\Q{k}\E(?![A-Za-z])")).alias("p"), F.lit(k).alias("k")) for k in keys]
        return F.array_sort(F.filter(F.array(*at), lambda h: h["p"] > 0))

    def entry(s: Column, found: Column, h: Column, i: Column) -> Column:
        begin = h["p"] + F.length(h["k"])
        end = F.coalesce(F.get(found, i + 1)["p"], F.length(s) + 1)
        return F.struct(h["k"].alias("key"), F.trim(F.substr(s, begin, F.greatest(end - begin, F.lit(0)))).alias("value"))

    return bound(col(x), lambda s: bound(hits(s), lambda found: F.map_from_entries(F.transform(found, lambda h, i: entry(s, found, h, i)))))


def tidy(x: str | Column) -> Column:
    """Lines without trailing space, one blank line at most between others, none at the edges."""
    s = F.regexp_replace(col(x), r"(?m)[ \t\x0B\f\r]+$", "")
    return F.regexp_replace(F.regexp_replace(s, r"\n{3,}", "\n\n"), r"^\n+|\n+\z", "")


def groups_as_rows(x: str | Column, pattern: str, n: int) -> Column:
    """array<struct<g1...gn>> of all matches' groups."""
    return F.arrays_zip(*[F.regexp_extract_all(col(x), F.lit(pattern), F.lit(i)).alias(f"g{i}") for i in range(1, n + 1)])


def deal_type(url: str | Column) -> Column:
    """Lease, Rent, Sale or Unknown by a URL's wording, in this order."""
    u = F.coalesce(F.lower(col(url)), F.lit(""))
    return F.when(u.contains("for-lease"), "Lease").when(u.rlike("for-rent|-rent-"), "Rent").when(u.rlike("for-sale|resale|-sale-"), "Sale").otherwise("Unknown")


def deal_type_two_way(url: str | Column) -> Column:
    """As deal_type, a lease counting as Rent."""
    d = deal_type(url)
    return F.when(d == "Lease", "Rent").otherwise(d)


def site(url: str | Column, names: dict[str, str]) -> Column:
    """The label of the first substring found; null is 'unknown', none found 'other'."""
    u = F.lower(col(url))
    out = F.lit("other")
    for part, label in reversed(names.items()):
        out = F.when(u.contains(part), label).otherwise(out)
    return F.when(u.isNull(), "unknown").otherwise(out)


def token_sort(x: str | Column) -> Column:
    """A name's words in order."""
    return F.array_join(F.array_sort(F.filter(F.split(col(x), r"\s+"), lambda w: w != "")), " ")


def lcs_length(a: str | Column, b: str | Column) -> Column:
    """Longest common subsequence of two short strings as a pure expression (volume goes through operators.fuzzy)."""
    x, y = F.split(col(a), ""), F.split(col(b), "")
    start = F.array_repeat(F.lit(0), F.size(y) + 1)

    def row(prev: Column, ch: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.size(y)),
            F.array(F.lit(0)),
            lambda acc, j: F.array_append(acc, F.when(ch == F.get(y, j - 1), F.get(prev, j - 1) + 1).otherwise(F.greatest(F.get(prev, j), F.element_at(acc, -1)))),
        )

    return F.when((F.length(col(a)) == 0) | (F.length(col(b)) == 0), 0).otherwise(F.element_at(F.aggregate(x, start, row), -1))
