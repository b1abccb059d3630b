"""Text, number and date expressions of the filing corpus: Column in, Column out, no Python on the executors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as a token of Latin letters and digits, and as a run of Hangul syllables.
WORD, HANGUL = r"[a-z]+|[0-9][0-9,.]*", r"[가-힣]+"
#: Fixed value: number tokens; a number has digits, then digits, commas or dots.
NUMBER = r"[0-9][0-9,.]*"
#: Ten thousand, million, hundred million, trillion: the units that amounts may be restated in.
UNITS = (10_000, 1_000_000, 100_000_000, 1_000_000_000_000)
YEAR = r"(?:19|20)[0-9]{2}"
#: Entities that stay when a bare ampersand is escaped.
BARE_AMP = r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);)"
CLOSING_TAG = r"</([A-Z][A-Z0-9_-]*)>"
SCHEMA_NAME = r'noNamespaceSchemaLocation="([^"]+)"'
#: Words of judgement that a source has to say itself.
JUDGEMENT = ("부족", "충분", "넉넉", "위험", "안전", "감당", "무리", "여유", "우려", "긍정적", "부정적", "좋다", "나쁘다", "과도", "적정", "가능성이 높", "가능성이 낮", "개선", "악화", "유리", "불리")


def let(value: Column, body) -> Column:  # noqa: ANN001
    """body(value), value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column) -> Column:
    """White space of any script off both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def squeeze(c: Column) -> Column:
    """All white space removed."""
    return F.regexp_replace(c, r"(?U)\s+", "")


def without_tags(c: Column, by: str = "") -> Column:
    return F.regexp_replace(c, "<[^>]+>", by)


def fallback_text(c: Column) -> Column:
    """The paragraph that stands for a document that cannot be parsed."""
    return F.substring(collapse(without_tags(c, " ")), 1, 20000)


def tokens(c: Column) -> Column:
    """Lower-case words and numbers, then the syllable pairs of each Hangul run (a single syllable as it is)."""
    low = F.lower(c)
    pairs = lambda w: F.when(F.length(w) == 1, F.array(w)).otherwise(F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: F.substr(w, i, F.lit(2))))
    return F.concat(F.regexp_extract_all(low, F.lit(WORD), F.lit(0)), F.flatten(F.transform(F.regexp_extract_all(low, F.lit(HANGUL), F.lit(0)), pairs)))


def plain_number(tok: Column) -> Column:
    """A number token without commas, trailing dots and one trailing .0."""
    return F.regexp_replace(F.regexp_replace(F.replace(tok, F.lit(","), F.lit("")), r"\.+$", ""), r"\.0$", "")


def numbers(c: Column) -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit(NUMBER), F.lit(0)), plain_number)


def allowed_numbers(c: Column) -> Column:
    """The numbers of a source and whole ones restated in larger units, rounded down."""

    def restated(n: Column) -> Column:
        big = F.when(n.rlike("^[0-9]{1,38}$"), n.cast("decimal(38,0)"))
        floors = F.array(*(F.when(big >= u, F.floor(big / F.lit(u).cast("decimal(38,0)")).cast("decimal(38,0)").cast("string")) for u in UNITS))
        return F.concat(F.array(n), F.filter(floors, lambda x: x.isNotNull()))

    return F.array_distinct(F.flatten(F.transform(numbers(c), restated)))


def fabricated(answer: Column, source: Column) -> Column:
    """Numbers of an answer that no source allows; bare years are judged elsewhere."""
    return F.filter(F.array_except(numbers(answer), allowed_numbers(source)), lambda n: ~n.rlike(f"^{YEAR}$"))


def foreign_years(answer: Column, source: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.regexp_extract_all(answer, F.lit(YEAR), F.lit(0)), lambda y: ~source.contains(y))))


def judgements(answer: Column, source: Column) -> Column:
    return F.filter(F.array(*map(F.lit, JUDGEMENT)), lambda t: answer.contains(t) & ~source.contains(t))


def derived_subtype(report_name: Column, subtype: Column) -> Column:
    """The subtype, or else the last bracket of the report's name without its correction marks, or the name itself."""
    cleaned = strip(F.regexp_replace(report_name, r"^\[기재정정\]|\[첨부추가\]", ""))
    bracket = F.regexp_extract(cleaned, r"\(([^()]+)\)\s*$", 1)
    return F.when(subtype != "", subtype).when(bracket != "", bracket).otherwise(cleaned)


def iso_date(day: Column) -> Column:
    return F.when(day.isNotNull(), F.concat_ws("-", F.substring(day, 1, 4), F.substring(day, 5, 2), F.substring(day, 7, 2)))


def later_dates(c: Column, day: Column) -> Column:
    """ISO dates in a text after a day, invalid ones left out."""
    found = F.array_distinct(F.regexp_extract_all(c, F.lit("[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.lit(0)))
    return F.array_sort(F.filter(found, lambda d: F.coalesce(F.try_to_date(d, "yyyy-MM-dd") > day, F.lit(False))))


def eok(c: Column) -> Column:
    """The first amount of a text in hundred millions, rounded down, with the unit."""
    digits = F.replace(F.regexp_extract(c, "[0-9][0-9,]*", 0), F.lit(","), F.lit(""))
    return F.when(digits == "", "").otherwise(F.concat(F.format_number(F.expr("bigint(0)") + F.floor(digits.cast("double") / 1e8), 0), F.lit("억원")))


def schema_peek(c: Column) -> Column:
    head = F.substring(c, 1, 400)
    name = F.regexp_extract(head, SCHEMA_NAME, 1)
    return F.when(c.isNull(), "unreadable").when(name != "", name).when(strip(head).rlike("^(?:<html|<!)"), "n/a_html").otherwise("unknown")


def sniffed(head: Column) -> Column:
    """The kind of content from its first characters (bytes read as Latin-1)."""
    near = F.substring(head, 1, 512)
    return (
        F.when(near.rlike(r"^\s*%PDF"), "pdf")
        .when(near.rlike(r"(?i)^\s*<(?:!doctype\s+html|html\b)"), "kind_html")
        .when(near.rlike(r"(?i)^\s*<\?xml\b") | F.substring(head, 1, 2000).rlike(r"(?i)<DOCUMENT\b"), "dart_xml")
        .otherwise("unknown")
    )


def declared_encoding(head: Column) -> Column:
    near = F.substring(head, 1, 512)
    xml = F.regexp_extract(near, r'(?i)<\?xml[^>]*\bencoding="([^"]+)"', 1)
    meta = F.regexp_extract(near, r"""(?i)charset=["']?([A-Za-z0-9_-]+)""", 1)
    return F.when(xml != "", F.lower(xml)).when(meta != "", F.lower(meta))


def known_tags(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(CLOSING_TAG), F.lit(1))))


def escaped_markup(c: Column) -> Column:
    """Bare ampersands and bare '<' escaped; a '<' is markup if it opens a tag that the document also closes."""
    tags = F.array_sort(known_tags(c), lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1).when(a < b, -1).otherwise(1))
    named = F.concat(F.lit(r"<(?!/|!|\?|(?:"), F.array_join(tags, "|"), F.lit(r")(?=[\s>/]))"))
    pattern = F.when(F.size(tags) > 0, named).otherwise(r"<(?![A-Za-z/!?])")
    return F.regexp_replace(F.regexp_replace(c, BARE_AMP, "&amp;"), pattern, F.lit("&lt;"))


def unit_text(caption: Column) -> Column:
    got = strip(F.regexp_extract(caption, r"\(\s*단위\s*[:：]\s*([^)]+)\)", 1))
    return F.when(got != "", got)


def period_text(caption: Column) -> Column:
    got = strip(F.regexp_extract(caption, r"제\s*[0-9]+\s*기[^,)\]\s]*", 0))
    return F.when(got != "", got)


def consolidation(hierarchy: Column) -> Column:
    """struct(basis, reason) from the nearest title that says consolidated or separate; both in one title: neither."""
    a, b = F.lit("연결"), F.lit("별도")
    said = F.filter(F.reverse(hierarchy), lambda t: t.contains(a) | t.contains(b))
    title = F.try_element_at(said, F.lit(1))
    both = title.contains(a) & title.contains(b)
    basis = F.when(both, F.lit(None).cast("string")).when(title.contains(a), a).when(title.contains(b), b)
    reason = F.when(both, F.concat(F.lit("ambiguous: title='"), title, F.lit("' contains both 연결 and 별도"))).when(
        title.isNotNull(), F.concat(F.lit("matched '"), basis, F.lit("' in section_hierarchy title='"), title, F.lit("'"))
    )
    return F.struct(basis.alias("basis"), reason.alias("reason"))


def is_footnote(c: Column) -> Column:
    return c.startswith("※") | c.rlike(r"^주[0-9]*\)")


def title_level(title: Column) -> Column:
    """3 for N-M, 1 for Roman numerals and 【, 2 for a number with dot or space, 0 for others."""
    t = strip(title)
    return F.when(t.rlike(r"^[0-9]+-[0-9]+"), 3).when(t.rlike(r"^(?:[IVXLCDM]+\.|[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]+\.?|【)"), 1).when(t.rlike(r"^[0-9]+[.\s]"), 2).otherwise(0)


def distinct_neighbours(cells: Column) -> Column:
    """A row without cells that repeat the cell before them."""
    return let(cells, lambda c: F.filter(c, lambda x, i: (i == 0) | ~x.eqNullSafe(F.get(c, i - 1))))


def row_line(cells: Column) -> Column:
    """A table row as a line; null if there is nothing but blanks and bars."""
    line = strip(F.array_join(distinct_neighbours(F.transform(cells, strip)), " | "))
    return let(line, lambda x: F.when(~x.rlike("^[ |]*$"), x))


def line_windows(text: Column, window: int = 12, stride: int = 8) -> Column:
    """Overlapping windows of a text's lines that are not blank; the last one reaches the end."""
    lines = F.filter(F.split(text, "\n"), lambda x: strip(x) != "")

    def cut(held: Column) -> Column:
        last = F.greatest(F.lit(0), F.ceil((F.size(held) - window) / float(stride)).cast("int")) * stride
        return F.when(F.size(held) == 0, F.array().cast("array<string>")).otherwise(
            F.transform(F.sequence(F.lit(0), last, F.lit(stride)), lambda s: F.array_join(F.slice(held, s + 1, F.lit(window)), "\n"))
        )

    return let(lines, cut)


def block(text: Column, patterns: list[str], span: int = 1) -> Column:
    """The first line that holds all patterns and the lines after it, `span` in all; null if there is none."""

    def cut(lines: Column) -> Column:
        at = F.array_position(F.transform(lines, lambda x: reduce(lambda a, b: a & b, (x.contains(p) for p in patterns))), True)
        return let(at, lambda k: F.when(k > 0, F.array_join(F.slice(lines, k.cast("int"), F.lit(span)), "\n")))

    return let(F.split(text, "\n"), cut)


def highlight(text: Column, needles: Column) -> Column:
    """Spans (start, end) of the first occurrence of each needle, by start, without those that begin inside one before."""
    span = "struct<start:int,end:int>"
    found = F.filter(
        F.transform(needles, lambda n: F.struct((F.instr(text, n) - 1).alias("start"), F.length(n).alias("n"))), lambda s: (s["start"] >= 0) & (s["n"] > 0)
    )
    spans = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), (s["start"] + s["n"]).alias("end"))))
    return F.aggregate(
        spans,
        F.array().cast(f"array<{span}>"),
        lambda acc, s: F.when((F.size(acc) == 0) | (F.element_at(acc, -1)["end"] <= s["start"]), F.concat(acc, F.array(s))).otherwise(acc),
    )


def overlap(line: Column, wanted: Column) -> Column:
    """Share of a line's tokens that are wanted; 0 for a line without tokens."""
    return let(tokens(line), lambda t: F.coalesce(F.size(F.filter(t, lambda x: F.array_contains(wanted, x))) / F.nullif(F.size(t), F.lit(0)), F.lit(0.0)))


def amount(c: Column) -> Column:
    """The first amount of a text as a number; a dash or nothing is null."""
    return F.when(~strip(c).isin("-", ""), F.replace(F.regexp_extract(c, "-?[0-9,]+", 0), F.lit(","), F.lit("")).try_cast("bigint"))


def day_text(c: Column) -> Column:
    """YYYY-MM-DD from a date with 년/월/일, dots, dashes or slashes."""
    at = lambda k: F.regexp_extract(c, r"([0-9]{4})\s*[년./-]\s*([0-9]{1,2})\s*[월./-]\s*([0-9]{1,2})", k)
    return F.when(at(1) != "", F.concat_ws("-", at(1), F.lpad(at(2), 2, "0"), F.lpad(at(3), 2, "0")))
