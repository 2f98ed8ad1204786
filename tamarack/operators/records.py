"""Structured match records from stored result pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions.html import drop_hidden, drop_tags, unescape_entities
from tamarack.functions.text import trim_text


@dataclass(frozen=True)
class RecordSpec:
    """Where a page keeps its record. The defaults are fixed values of the page format."""

    person: str = "b-fight-details__person"
    won: str = "b-fight-details__person-status_style_green"
    other: str = "b-fight-details__person-status_style_gray"
    sides: tuple[str, str] = ("fighter_a", "fighter_b")
    cells: tuple[str, ...] = (
        "kd",
        "sig_str",
        "sig_str_pct",
        "total_str",
        "td",
        "td_pct",
        "sub_att",
        "rev",
        "ctrl",
    )
    unknown: str = "Unknown"

    def fields(self) -> list[str]:
        a, b = self.sides
        return [a, b, *[f"{side}_{c}" for c in self.cells for side in (a, b)]]


def _with_class(tag: str, names: str) -> str:
    """Pattern of a start tag that has one of the class names, which is its first group."""
    return rf"""(?is)<{tag}(?=\s)[^>]*?\sclass\s*=\s*["'](?:[^"']*\s)?({names})(?:\s[^"']*)?["'][^>]*>"""


def _shown(html: Column) -> Column:
    return trim_text(unescape_entities(drop_tags(html)))


def _winner(body: Column, spec: RecordSpec) -> Column:
    """From the person blocks, each from its start to the next one or to the table."""
    blocks = F.split(body, _with_class("div", spec.person), -1)
    blocks = F.transform(F.slice(blocks, 2, 1 << 20), lambda x: F.get(F.split(x, "(?i)<table", 2), 0))
    status = _with_class("i", f"{spec.won}|{spec.other}") + r"(.*?)</i\s*>"
    heading = r"(?is)<h3(?:\s[^>]*)?>.*?<a(?:\s[^>]*)?>(.*?)</a\s*>"
    persons = F.transform(
        blocks,
        lambda x: F.struct(
            F.regexp_extract(x, status, 1).alias("status"),
            _shown(F.regexp_extract(x, status, 2)).alias("shown"),
            F.when(x.rlike(heading), _shown(F.regexp_extract(x, heading, 1))).alias("name"),
        ),
    )
    won = F.filter(persons, lambda x: x["status"] == spec.won)
    other = F.filter(persons, lambda x: x["status"] == spec.other)
    return F.when(F.size(won) > 0, F.get(won, 0)["name"]).otherwise(
        F.coalesce(F.get(other, 0)["shown"], F.lit(spec.unknown))
    )


def _cells(body: Column) -> Column:
    """Paragraph texts of every cell of the second table row."""
    row = F.get(F.split(body, r"(?i)<tr(?:\s[^>]*)?>", -1), 2)
    cells = F.slice(F.split(row, r"(?i)<td(?:\s[^>]*)?>", -1), 2, 1 << 20)
    paragraph = F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)</p\s*>")
    return F.transform(cells, lambda x: F.transform(F.regexp_extract_all(x, paragraph, F.lit(1)), _shown))


def extract_records(pages: DataFrame, spec: RecordSpec = RecordSpec()) -> DataFrame:
    """``(page_id, winner, fields...)``, one row per page whatever it holds.

    The winner is the name in the person block marked as won, else the text of
    the other status (such as NC or D), else ``Unknown``. Fields come from the
    second table row: each cell has a paragraph per side. A column that is not
    selected is not computed.
    """
    rows = pages.select("page_id", drop_hidden(F.coalesce("html", F.lit(""))).alias("__body"))
    rows = rows.withColumn("__cells", _cells(F.col("__body")))
    fields = [F.get(F.get("__cells", F.lit(i // 2)), F.lit(i % 2)).alias(n) for i, n in enumerate(spec.fields())]
    return rows.select("page_id", _winner(F.col("__body"), spec).alias("winner"), *fields)


def winner_label(df: DataFrame, winner: str = "winner", a: str = "fighter_a", b: str = "fighter_b") -> DataFrame:
    """Add ``winner_color``: nc, d, red (first side), blue (second side) or unknown."""
    w, first, second = [F.lower(F.trim(c)) for c in (winner, a, b)]
    label = (
        F.when(w == "nc", "nc")
        .when(w.isin("d", "draw"), "d")
        .when(w == first, "red")
        .when(w == second, "blue")
        .otherwise("unknown")
    )
    return df.withColumn("winner_color", label)
