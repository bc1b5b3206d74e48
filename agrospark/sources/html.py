"""HTML price boards (S7) and page fields.

Boards are parsed per page with the standard-library ``html.parser`` inside
``mapInPandas`` (Arrow batches; one page at a time, never a whole table in
one task).  Simple page fields (title, links) are native regexes.
"""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOARD_SCHEMA = ("page_id long, board string, entry_pos int, crop string, "
                "ars array<string>, usd array<string>, price_text string")


class _BoardParser(HTMLParser):
    """Collects board A (``div.tab_content > p`` + next table: row 2 ARS,
    row 3 USD ``<strong>`` texts) and board B (``div.pizarra-card`` with
    ``p.pizarra-titulo`` and ``p.pizarra-precio``)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = []          # (tag, classes)
        self.a_entries = []      # [crop, rows]
        self.b_cards = []        # [title, [prices]]
        self._text = None
        self._pending_crop = None
        self._rows = None
        self._cells = None
        self._in_strong = False

    def _classes(self, attrs):
        return (dict(attrs).get("class") or "").split()

    def handle_starttag(self, tag, attrs):
        cls = self._classes(attrs)
        parent = self.stack[-1] if self.stack else (None, [])
        self.stack.append((tag, cls))
        if tag == "p" and parent[0] == "div" and "tab_content" in parent[1]:
            self._text = ("a_crop", [])
        elif tag == "div" and "pizarra-card" in cls:
            self.b_cards.append([None, []])
        elif tag == "p" and self.b_cards and ("pizarra-titulo" in cls or "pizarra-precio" in cls):
            self._text = ("b_title" if "pizarra-titulo" in cls else "b_price", [])
        elif tag == "table" and self._pending_crop is not None:
            self._rows = []
        elif tag == "tr" and self._rows is not None:
            self._cells = []
        elif tag == "strong" and self._cells is not None:
            self._in_strong = True
            self._text = ("strong", [])

    def handle_endtag(self, tag):
        while self.stack:
            t, _ = self.stack.pop()
            if t == tag:
                break
        if self._text and tag in ("p", "strong"):
            kind, parts = self._text
            txt = "".join(parts).strip()
            if kind == "a_crop":
                self._pending_crop = txt
            elif kind == "b_title":
                self.b_cards[-1][0] = txt
            elif kind == "b_price":
                self.b_cards[-1][1].append(txt)
            elif kind == "strong" and self._cells is not None:
                self._cells.append(txt)
            self._text = None
        elif tag == "tr" and self._rows is not None and self._cells is not None:
            self._rows.append(self._cells)
            self._cells = None
        elif tag == "table" and self._rows is not None:
            self.a_entries.append([self._pending_crop, self._rows])
            self._pending_crop, self._rows = None, None

    def handle_data(self, data):
        if self._text is not None:
            self._text[1].append(data)


def _parse_boards(batches):
    import pandas as pd
    for pdf in batches:
        out = []
        for pid, html in zip(pdf["page_id"], pdf["html"]):
            p = _BoardParser()
            p.feed(html or "")
            for i, (crop, rows) in enumerate(p.a_entries):
                # a board entry needs three rows: header, ARS, USD
                if crop is None or len(rows) < 3:
                    continue
                out.append((int(pid), "A", i, crop, rows[1], rows[2], None))
            for i, (title, prices) in enumerate(p.b_cards):
                out.append((int(pid), "B", i, title, None, None, prices[0] if prices else None))
        yield pd.DataFrame(out, columns=["page_id", "board", "entry_pos", "crop", "ars", "usd",
                                         "price_text"])


def price_boards(pages: DataFrame, html: str = "html", page_id: str = "page_id") -> DataFrame:
    """Landed board pages -> one row per board entry / card."""
    return pages.select(F.col(page_id).alias("page_id"), F.col(html).alias("html")) \
        .mapInPandas(_parse_boards, BOARD_SCHEMA)


def page_fields(pages: DataFrame, html: str = "html") -> DataFrame:
    """Title text and link targets of each page (native regexes)."""
    links = F.regexp_extract_all(F.col(html), F.lit(r'<a href="([^"]*)"'), 1)
    return pages.select(
        "*",
        F.regexp_extract(F.col(html), r"<title>([^<]*)</title>", 1).alias("title"),
        F.size(links).alias("n_links"),
        F.try_element_at(links, F.lit(1)).alias("first_link"))
