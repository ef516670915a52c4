"""Registry pages: result grids, pager and row tokens, detail pages. HTML trees are read with the standard library's parser."""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, functions as F, types as T

from groundplan.functions.json_html import ordered_sections
from groundplan.functions.text import col

#: Sections of a detail page in the order in which they are shown (fixed values); others come behind them.
KNOWN_ORDER = [
    "General Information", "Address For Official Communication", "Contact Details", "Project Information", "Bank Details", "Land Details",
    "Address Details", "Development Work", "Building Details", "Project Professional Information", "Uploaded Orders",
]
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


def _clean(s: str) -> str:
    return re.sub(r"\s+", " ", s or "").strip()


class _Tables(HTMLParser):
    """Tables as lists of rows of (text, is header, links); label and value pairs; headings in order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[dict] = []
        self.pairs: list[tuple[str, str, str]] = []
        self.open: list[dict] = []
        self.section, self.heading, self.label, self.value = "", None, None, None
        self.pending: str | None = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "table":
            self.open.append({"section": self.section, "rows": []})
        elif tag == "tr" and self.open:
            self.open[-1]["rows"].append([])
        elif tag in ("td", "th") and self.open and self.open[-1]["rows"]:
            self.open[-1]["rows"][-1].append({"text": "", "head": tag == "th", "links": []})
        elif tag == "a" and self.open and self.open[-1]["rows"] and self.open[-1]["rows"][-1] and a.get("href"):
            self.open[-1]["rows"][-1][-1]["links"].append(a["href"])
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6", "legend"):
            self.heading = ""
        elif tag == "label":
            self.label = ""
        elif tag in ("span", "div", "p") and self.pending is not None and self.value is None:
            self.value = ""
        elif tag in ("input", "textarea") and self.pending is not None and a.get("value") is not None:
            self._pair(a["value"])

    def handle_endtag(self, tag):
        if tag == "table" and self.open:
            self.tables.append(self.open.pop())
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6", "legend") and self.heading is not None:
            self.section, self.heading = _clean(self.heading), None
        elif tag == "label" and self.label is not None:
            text = _clean(self.label).rstrip(":").strip()
            self.label = None
            if text:
                self.pending, self.value = text, None
        elif tag in ("span", "div", "p") and self.value is not None and self.pending is not None and _clean(self.value):
            self._pair(self.value)

    def _pair(self, value: str) -> None:
        self.pairs.append((self.section, self.pending, _clean(value)))
        self.pending, self.value = None, None

    def handle_data(self, data):
        if self.heading is not None:
            self.heading += data
        elif self.label is not None:
            self.label += data
        else:
            if self.value is not None:
                self.value += data
            if self.open and self.open[-1]["rows"] and self.open[-1]["rows"][-1]:
                self.open[-1]["rows"][-1][-1]["text"] += data


def _parsed(html: str | None) -> _Tables:
    p = _Tables()
    p.feed(html or "")
    p.close()
    p.tables += reversed(p.open)
    return p


def named(columns: list[str], cells: list[str]) -> dict[str, str]:
    """A row by its header, or by position where the numbers differ; the first of equal names counts."""
    names = columns if len(columns) == len(cells) else [f"col{i}" for i in range(len(cells))]
    out: dict[str, str] = {}
    for k, v in zip(names, cells, strict=True):
        out.setdefault(k, v)
    return out


_TEXT = T.StringType()
_MAP = T.MapType(_TEXT, _TEXT)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


@F.udf(_struct(columns=T.ArrayType(_TEXT), rows=T.ArrayType(_struct(cells=_MAP, links=T.ArrayType(_TEXT)))), useArrow=True)
def parse_grid(html):
    """The largest table of a results page: header names and rows with their links."""
    tables = [t for t in _parsed(html).tables if t["rows"]]
    if not tables:
        return [], []
    rows = max(tables, key=lambda t: len(t["rows"]))["rows"]
    head = rows[0] if rows and all(c["head"] for c in rows[0]) and rows[0] else None
    columns = [_clean(c["text"]) for c in head] if head else []
    body = [r for r in (rows[1:] if head else rows) if r and not all(c["head"] for c in r)]
    return columns, [(named(columns, [_clean(c["text"]) for c in r]), [x for c in r for x in c["links"]]) for r in body]


@F.udf(_struct(sections=T.MapType(_TEXT, _MAP), tables=T.MapType(_TEXT, T.ArrayType(_MAP)), raw_labels=_MAP), useArrow=True)
def parse_detail(html):
    """A detail page: values of labels by section (the first of equal labels counts), tables by section, all labels flat."""
    p = _parsed(html)
    sections: dict[str, dict[str, str]] = {}
    labels: dict[str, str] = {}
    for section, label, value in p.pairs:
        sections.setdefault(section or "General", {}).setdefault(label, value)
        labels.setdefault(label, value)
    tables: dict[str, list[dict[str, str]]] = {}
    for t in p.tables:
        rows = [r for r in t["rows"] if r]
        if len(rows) == 0:
            continue
        if all(len(r) == 2 and not r[1]["head"] for r in rows):
            for a, b in rows:
                k, v = _clean(a["text"]).rstrip(":").strip(), _clean(b["text"])
                if k:
                    sections.setdefault(t["section"] or "General", {}).setdefault(k, v)
                    labels.setdefault(k, v)
        elif len(rows) > 1:
            columns = [_clean(c["text"]) for c in rows[0]]
            tables.setdefault(t["section"] or "General", []).extend(named(columns, [_clean(c["text"]) for c in r]) for r in rows[1:])
    return sections, tables, labels


def pager(html: str | Column) -> dict[str, Column]:
    """Numbers of records and pages, the page numbers linked, and the row tokens in order without repeats."""
    c = col(html)
    return {
        "records": F.replace(F.regexp_extract(c, r"(?i)of\s+([\d,]+)\s+records", 1), F.lit(","), F.lit("")).try_cast("int"),
        "pages": F.regexp_extract(c, r"(?i)page\s+\d+\s+of\s+(\d+)", 1).try_cast("int"),
        "page_numbers": F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(r"[?&]page=(\d+)"), F.lit(1)), lambda x: x.cast("int")))),
        "tokens": F.array_distinct(F.regexp_extract_all(c, F.lit(r"[?&](?:token|q)=([^\"'&]+)"), F.lit(1))),
    }


def select_options(html: str | Column, name: str) -> Column:
    """array<struct<value, label>> of a <select>'s options that have a value."""
    inner = F.regexp_extract(col(html), rf'(?s)<select[^>]*name="{re.escape(name)}"[^>]*>(.*?)</select>', 1)
    pairs = F.arrays_zip(
        F.regexp_extract_all(inner, F.lit(r'<option[^>]*value="([^"]*)"[^>]*>([^<]*)'), F.lit(1)).alias("value"),
        F.regexp_extract_all(inner, F.lit(r'<option[^>]*value="([^"]*)"[^>]*>([^<]*)'), F.lit(2)).alias("label"),
    )
    return F.filter(F.transform(pairs, lambda p: F.struct(F.trim(p["value"]).alias("value"), F.trim(p["label"]).alias("label"))), lambda p: ~p["value"].isin("", "0"))


def response_status(text: str | Column) -> Column:
    """ok, captcha or expired by a response's phrases."""
    s = F.lower(F.coalesce(col(text), F.lit("")))
    return F.when(s.rlike("captcha|verification code"), "captcha").when(s.rlike("session (?:has )?expired|invalid token"), "expired").otherwise("ok")


def enriched(pages: DataFrame, html: str = "html", token: str = "token") -> tuple[DataFrame, DataFrame]:
    """Records parsed from detail pages, and the rows to try again (expired, rejected or empty)."""
    x = pages.withColumn("status", response_status(html)).withColumn("detail", parse_detail(html))
    x = x.withColumn("detail", F.col("detail").withField("sections", ordered_sections(F.col("detail.sections"), KNOWN_ORDER)))
    good = (F.col("status") == "ok") & (F.size(F.map_keys("detail.sections")) > 0)
    return x.filter(good).select(token, "detail"), x.filter(~good).select(token, F.when(F.col("status") == "ok", "empty").otherwise(F.col("status")).alias("error"))
