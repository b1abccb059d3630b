"""The section tree of a file as one fold over its titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from disclosa.functions.text import let

OPEN = "struct<level:int,at:int,title:string>"
SECTION = "struct<at:int,title:string,level:int,confident:boolean,parent:int,hierarchy:array<string>>"
END = "struct<at:int,end:int>"


def fold(titles: Column, total: Column | None = None) -> Column:
    """struct(sections, ends) of titles, an array<struct<at,title,own>> in order; own: the title's title_level(), read before they
    are gathered; total: the file's node count, without it there are no ends.

    A title without a number goes one level below the title before it. A title closes the open ones of its level and
    below; what is open then is its hierarchy, the innermost its parent (null: the root). Spark computes each mention
    inside a lambda anew, so a mention has to be cheap there.
    """
    empty = {"open": OPEN, "out": SECTION} | ({} if total is None else {"ends": END})
    start = F.struct(F.lit(0).alias("level"), *(F.array().cast(f"array<{kind}>").alias(name) for name, kind in empty.items()))

    def push(s: Column, t: Column) -> Column:
        level = F.when(t["own"] > 0, t["own"]).otherwise(s["level"] + 1)
        return let(F.filter(s["open"], lambda o: o["level"] < level), lambda kept: grown(s, t, level, kept))

    def grown(s: Column, t: Column, level: Column, kept: Column) -> Column:
        here = F.struct(
            t["at"].alias("at"),
            t["title"].alias("title"),
            level.alias("level"),
            (t["own"] > 0).alias("confident"),
            F.try_element_at(kept, F.lit(-1))["at"].alias("parent"),
            kept["title"].alias("hierarchy"),
        )
        opened = F.struct(level.alias("level"), t["at"].alias("at"), t["title"].alias("title"))
        held = [level.alias("level"), F.array_append(kept, opened).alias("open"), F.array_append(s["out"], here).alias("out")]
        if total is None:
            return F.struct(*held)
        # Levels rise along the open titles, so those that stay come first.
        shut = F.slice(s["open"], F.size(kept) + 1, F.size(s["open"]))
        closed = F.transform(shut, lambda o: F.struct(o["at"].alias("at"), (t["at"] - 1).alias("end")))
        return F.struct(*held, F.concat(s["ends"], closed).alias("ends"))

    def close(s: Column) -> Column:
        if total is None:
            return F.struct(s["out"].alias("sections"))
        last = F.transform(s["open"], lambda o: F.struct(o["at"].alias("at"), (total - 1).cast("int").alias("end")))
        return F.struct(s["out"].alias("sections"), F.concat(s["ends"], last).alias("ends"))

    return F.aggregate(titles, start, push, close)
