"""Table cells as arrays of struct<row,col,text,rowspan,colspan,tag>: rows, header rows, shape, the rectangle they cover."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from disclosa.functions.text import let

CELL = "struct<row:int,col:int,text:string,rowspan:int,colspan:int,tag:string>"


def rows_of(cells: Column) -> Column:
    """array<array<cell>>: rows 0 to the last, empty ones kept, cells by column.

    Cells are sorted by row, so a row is the slice that begins at its first cell: found by its place, not by a filter
    over all cells for each row.
    """

    def cut(c: Column) -> Column:
        numbers = F.transform(c, lambda x: x["row"])
        first = F.filter(F.transform(c, lambda x, i: F.struct(x["row"].alias("row"), i.alias("at"))), lambda x: (x["at"] == 0) | (F.get(c, x["at"] - 1)["row"] != x["row"]))
        ends = lambda f: F.map_from_entries(F.transform(f, lambda x, k: F.struct(x["row"], F.struct((x["at"] + 1).alias("at"), (F.coalesce(F.get(f, k + 1)["at"], F.size(c)) - x["at"]).alias("n")))))
        rows = lambda m: F.transform(F.sequence(F.lit(0), F.array_max(numbers)), lambda r: let(F.try_element_at(m, r), lambda e: F.when(e.isNull(), F.array().cast(f"array<{CELL}>")).otherwise(F.slice(c, e["at"], e["n"]))))
        return F.when(F.size(c) > 0, let(let(first, ends), rows)).otherwise(F.array().cast(f"array<array<{CELL}>>"))

    return let(F.array_sort(cells), cut)


def header_rows(rows: Column) -> Column:
    """Rows where more than half of the cells are TH."""
    marked = F.transform(rows, lambda r, i: F.when(F.size(F.filter(r, lambda c: F.upper(c["tag"]) == "TH")) * 2 > F.size(r), i))
    return F.filter(marked, lambda i: i.isNotNull())


def widths(rows: Column) -> Column:
    """Columns of each row, spans counted."""
    return F.transform(rows, lambda r: F.aggregate(r, F.lit(0), lambda a, c: a + c["colspan"]))


def usual_width(counts: Column) -> Column:
    """The most frequent width; of equally frequent ones the first seen."""
    tally = lambda c: F.transform(F.array_distinct(c), lambda w: F.struct((-F.size(F.filter(c, lambda x: x == w))).alias("n"), F.array_position(c, w).alias("at"), w.alias("w")))
    return let(counts, lambda c: F.array_min(tally(c))["w"])


def odd_rows(counts: Column) -> Column:
    """Numbers of the rows whose width is not the usual one."""
    return let(counts, lambda c: let(usual_width(c), lambda u: F.filter(F.transform(c, lambda w, i: F.when(w != u, i)), lambda i: i.isNotNull())))


def shape_note(counts: Column) -> Column:
    """How many rows deviate, and the first five of them; null if none does."""
    shown = lambda o: F.concat(F.lit("["), F.array_join(F.slice(o, 1, 5), ", "), F.lit("]"), F.when(F.size(o) > 5, "...").otherwise(""))
    return let(
        odd_rows(counts),
        lambda o: F.when(F.size(o) > 0, F.concat(F.size(o), F.lit("/"), F.size(counts), F.lit(" rows have column count != mode("), usual_width(counts), F.lit(") — rows "), shown(o))),
    )


def has_merged(cells: Column) -> Column:
    return F.exists(cells, lambda c: (c["rowspan"] > 1) | (c["colspan"] > 1))


def rectangle(rows: Column) -> Column:
    """array<array<string>>: every place that a cell covers holds its text, others hold ''.

    The width is the largest column number plus span, before cells move right past those that hang down from above, so
    what moves beyond it is cut off. One fold over the cells; the grid is a flat array with nulls for free places.
    """
    wide = F.array_max(F.flatten(F.transform(rows, lambda r: F.transform(r, lambda c: c["col"] + c["colspan"]))))

    def build(w: Column) -> Column:
        size = F.size(rows) * w
        state = F.struct(F.array_repeat(F.lit(None).cast("string"), size).alias("grid"), F.lit(-1).alias("row"), F.lit(0).alias("at"))

        def put(s: Column, c: Column) -> Column:
            begun = F.when(c["row"] == s["row"], s["at"]).otherwise(0)
            free = F.filter(F.sequence(F.lit(0), w - 1), lambda p: (p >= begun) & F.get(s["grid"], c["row"] * w + p).isNull())
            at = F.coalesce(F.try_element_at(free, F.lit(1)), w)
            inside = lambda k, a: F.floor(k / w).between(c["row"], c["row"] + c["rowspan"] - 1) & (k % w).between(a, a + c["colspan"] - 1)
            filled = lambda a: F.struct(F.transform(s["grid"], lambda x, k: F.when(inside(k, a), c["text"]).otherwise(x)).alias("grid"), c["row"].alias("row"), (a + c["colspan"]).alias("at"))
            return let(at, filled)

        flat = F.aggregate(F.flatten(rows), state, put, lambda s: s["grid"])
        cut = lambda g: F.transform(F.sequence(F.lit(0), F.size(rows) - 1), lambda r: F.transform(F.slice(g, r * w + 1, w), lambda x: F.coalesce(x, F.lit(""))))
        return let(flat, cut)

    return F.when((F.size(rows) > 0) & (wide > 0), let(wide, build)).otherwise(F.array().cast("array<array<string>>"))
