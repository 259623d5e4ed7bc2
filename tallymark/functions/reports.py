"""Facts that the name of a report file, or one line of it, gives away."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from tallymark.functions.numbers import as_column
from tallymark.schemas import REPORT_HEADERS, STATE_REPORT_TYPES

OTHER = "Other"
BOM = "\ufeff"
# Every character that counts as a blank.
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
MONTH_PATTERN = r"^\d{4}-[A-Za-z]{3}$"
STRICT_MONTH_PATTERN = r"^\d{4}-(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)$"
# While a line is split on commas, one inside quotes is written with an escape sign, and so is
# the sign itself, so that any text comes back as it was.
_ESCAPE = "\u0001"
_COMMA, _SELF = _ESCAPE + "b", _ESCAPE + "a"


@dataclass(frozen=True)
class ReportNaming:
    """How report files are named: ``<prefix>_<report>_<code>_monthwise_<from>_<to>.csv``.

    Set ``prefix`` to the leading word of the delivered files.
    """

    prefix: str = "market"
    headers: dict = field(default_factory=lambda: dict(REPORT_HEADERS))
    skip_words: tuple = ("test", "sample")

    def stem(self, dataset_type: str) -> str:
        return f"{self.prefix}_{dataset_type.lower()}_"


DEFAULT_NAMING = ReportNaming()


def base_name(path) -> Column:
    return F.lower(F.element_at(F.split(as_column(path), "/"), -1))


def report_type(path, naming: ReportNaming = DEFAULT_NAMING) -> Column:
    """Dataset type told by the file name; ``Other`` for files to be skipped."""
    name = base_name(path)
    kind = F
    for word in naming.skip_words:
        kind = kind.when(F.contains(name, F.lit(word)), F.lit(OTHER))
    for dataset_type in naming.headers:
        kind = kind.when(F.startswith(name, F.lit(naming.stem(dataset_type))), F.lit(dataset_type))
    return kind.otherwise(F.lit(OTHER))


def is_national(path, naming: ReportNaming = DEFAULT_NAMING) -> Column:
    """Country-wide reports: no state code in the name, or yearly maker files."""
    name = base_name(path)
    hit = F.regexp_like(
        name, F.lit(rf"^{re.escape(naming.stem('Manufacturer'))}\d{{4}}_\d{{4}}\.csv$"))
    for dataset_type in naming.headers:
        hit = hit | F.startswith(name, F.lit(naming.stem(dataset_type) + "monthwise_"))
    return hit


def state_code(path, naming: ReportNaming = DEFAULT_NAMING) -> Column:
    """Two-letter code from the base name, NULL when no state report name matches.

    The report types are tried one after the other over the whole name, by the order of
    the alternatives.
    """
    stems = "|".join(".*?" + re.escape(naming.stem(t)) for t in STATE_REPORT_TYPES)
    return F.nullif(
        F.regexp_extract(base_name(path), f"^(?:{stems})([a-z]{{2}})_", 1), F.lit(""))


def expected_header(dataset_type, naming: ReportNaming = DEFAULT_NAMING) -> Column:
    pairs = [F.lit(x) for kv in naming.headers.items() for x in kv]
    return F.element_at(F.create_map(*pairs), as_column(dataset_type))


def header_key(cell) -> Column:
    """Header cell without marks and quotes, in lower case, for comparison."""
    return F.lower(F.trim(F.regexp_replace(as_column(cell), f"[{BOM}\"']", "")))


def strip_blanks(text) -> Column:
    """Text without outer blanks of any kind, no-break ones included."""
    return F.btrim(as_column(text), F.lit(BLANKS))


def strip_cell(cell) -> Column:
    return strip_blanks(F.translate(as_column(cell), BOM + '"', ""))


def split_cells(line) -> Column:
    """Cells of one CSV record, quotes removed; commas and line breaks inside quotes stay.

    Pieces between quote marks alternate between outside and inside, so escaping
    the commas of the odd ones gives a split of any width in one pass.
    """
    line = as_column(line)

    def swapped(text: Column, old: str, new: str) -> Column:
        return F.replace(text, F.lit(old), F.lit(new))

    held = F.array_join(
        F.transform(
            F.split(swapped(line, _ESCAPE, _SELF), '"'),
            lambda piece, i: F.when(i % 2 == 1, swapped(piece, ",", _COMMA)).otherwise(piece)),
        "")
    quoted = F.transform(
        F.split(held, ","), lambda c: swapped(swapped(c, _COMMA, ","), _SELF, _ESCAPE))
    cells = F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, ","))
    return F.transform(cells, strip_cell)


def month_columns(header_cells) -> Column:
    """Month columns of a header: place, label and calendar fields.

    Labels are read as dates here, once per report and not once per cell; one that is no
    month has NULL fields. The first of repeated labels counts.
    """
    cells = as_column(header_cells)
    placed = F.transform(
        cells, lambda label, i: F.struct(i.alias("position"), label.alias("label")))
    months = F.filter(
        placed,
        lambda x: F.regexp_like(x["label"], F.lit(MONTH_PATTERN))
        & (F.array_position(cells, x["label"]) == x["position"] + 1))
    return F.transform(months, _with_calendar)


def _with_calendar(month: Column) -> Column:
    day = period_of(month["label"])
    return F.struct(
        month["position"].alias("position"),
        month["label"].alias("label"),
        F.date_format(day, "yyyy-MM-dd").alias("period"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        month_name(day).alias("month_name"))


def period_of(label) -> Column:
    """``2016-Jan`` as the first day of that month, NULL when it is no month."""
    label = as_column(label)
    tidy = F.concat(F.substring(label, 1, 5), F.initcap(F.substring(label, 6, 3)))
    return F.try_to_date(tidy, "yyyy-MMM")


def first_of_month(year, month) -> Column:
    """First day of a month; NULL when there is no such month."""
    year, month = as_column(year), as_column(month)
    real = year.between(1, 9999) & month.between(1, 12)
    return F.when(real, F.make_date(year, month, F.lit(1)))


def month_name(date) -> Column:
    return F.date_format(as_column(date), "MMMM")
