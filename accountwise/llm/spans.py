"""Places of regular-expression matches in texts, as Spark columns.

A span is a struct (start, kind, end): code points, the end exclusive, kind a number. Spark's expressions give the
texts of all matches and what lies between them; running lengths make places of them. Running sums and maxima go over
chunks of an array and then over the chunks, so a text with many matches costs little more than its share.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_ONE = "struct<start:int,end:int,text:string,part:string>"
_MATCH = f"array<{_ONE}>"
#: Elements that are gone through with a growing array; texts with more spans are cut by their letters once.
CHUNK, FEW = 128, 16


def none_found() -> Column:
    return F.array().cast(_MATCH)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body over a value that is computed once: within a lambda, a column of the row would be computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(
    items: Column, kind: str, value: Callable[[Column], Column], add: Callable[[Column, Column], Column], start: int
) -> Column:
    """Each element as (x, before): what ``add`` makes of the values of all elements before it. ``kind``: the elements' type."""
    empty = F.array().cast(f"array<struct<x:{kind},before:int>>")
    chunks = bound(items, lambda all_: F.transform(
        F.sequence(F.lit(0), F.floor(F.greatest(F.size(all_) - 1, F.lit(0)) / CHUNK).cast("int")),
        lambda c: F.slice(all_, c * CHUNK + 1, F.lit(CHUNK)),
    ))

    def within(chunk: Column) -> Column:
        return F.aggregate(
            chunk, F.struct(F.lit(start).alias("top"), empty.alias("out")),
            lambda s, x: F.struct(
                add(s["top"], value(x)).alias("top"),
                F.concat(s["out"], F.array(F.struct(x.alias("x"), s["top"].alias("before")))).alias("out")),
        )

    parts = F.transform(chunks, within)
    none = F.array().cast(f"array<struct<base:int,part:array<struct<x:{kind},before:int>>>>")
    carried = F.aggregate(
        parts, F.struct(F.lit(start).alias("top"), none.alias("out")),
        lambda s, p: F.struct(
            add(s["top"], p["top"]).alias("top"),
            F.concat(s["out"], F.array(F.struct(s["top"].alias("base"), p["out"].alias("part")))).alias("out")),
        lambda s: s["out"],
    )
    return F.flatten(F.transform(carried, lambda c: F.transform(
        c["part"], lambda p: F.struct(p["x"].alias("x"), add(c["base"], p["before"]).alias("before")))))


def found(text: Column, pattern: str, part: int = 0) -> Column:
    """All matches, leftmost and not overlapping: start, end, the match, and a group of it."""
    between = F.split(text, pattern, -1)
    pairs = F.arrays_zip(
        between.alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(part)).alias("part"),
    )
    length = lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["whole"]), F.lit(0))
    placed = _running(pairs, "struct<gap:string,whole:string,part:string>", length, lambda a, b: a + b, 0)

    def one(p: Column) -> Column:
        begin = p["before"] + F.length(p["x"]["gap"])
        return F.struct(
            begin.alias("start"), (begin + F.length(p["x"]["whole"])).alias("end"), p["x"]["whole"].alias("text"),
            p["x"]["part"].alias("part"))

    return F.transform(F.filter(placed, lambda p: p["x"]["whole"].isNotNull()), one)


def spans(matches: Column, kind: int) -> Column:
    return F.transform(
        matches, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))
    )


def listed(sorted_spans: Column, kinds: Sequence[str]) -> Column:
    """kind:start:end, joined by commas, in the order given."""
    names = F.array(*(F.lit(k) for k in kinds))
    return F.array_join(
        F.transform(sorted_spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def apart(matches: Column, others: Column, kind: str = _ONE) -> Column:
    """The matches that overlap none of the other spans, in order of their ends.

    A span reaches into a match if it starts before the match's end and ends after its start: in the order of those places,
    the largest end so far decides.
    """
    event = f"struct<at:int,other:boolean,reach:int,m:{kind}>"
    events = F.array_sort(F.concat(
        F.transform(matches, lambda m: F.struct(m["end"].alias("at"), F.lit(False).alias("other"), F.lit(-1).alias("reach"), m.alias("m"))),
        F.transform(others, lambda o: F.struct(
            o["start"].alias("at"), F.lit(True).alias("other"), o["end"].alias("reach"), F.lit(None).cast(kind).alias("m"))),
    ))
    marked = _running(events, event, lambda x: x["reach"], F.greatest, -1)
    free = F.filter(marked, lambda p: ~p["x"]["other"] & (p["before"] <= p["x"]["m"]["start"]))
    return F.when(F.size(others) > 0, F.transform(free, lambda p: p["x"]["m"])).otherwise(matches)


def cut_by(text: Column, cuts: Column, body: Callable[[Callable[[Column, Column], Column]], Column]) -> Column:
    """The body over a function (at, length) that cuts the text. For many cuts the text is taken apart once, since finding a
    place in a text means going through all before it."""
    return F.when(cuts <= FEW, body(lambda at, n: F.substring(text, at + 1, n))).otherwise(
        bound(F.split(text, ""), lambda letters: body(
            lambda at, n: F.array_join(F.slice(letters, at + 1, F.least(n, F.size(letters))), ""))))


def masked(text: Column, sorted_spans: Column, marks: Sequence[str]) -> Column:
    """The text with a mark, by kind, for every span; spans that overlap become one."""
    names = F.array(*(F.lit(m) for m in marks))
    reached = _running(sorted_spans, "struct<start:int,kind:int,end:int>", lambda s: s["end"], F.greatest, 0)
    fresh = F.filter(reached, lambda p: p["x"]["start"] >= p["before"])
    last = F.array_max(F.transform(sorted_spans, lambda s: s["end"]))

    def joined(cut: Callable[[Column, Column], Column]) -> Column:
        pieces = F.transform(fresh, lambda p: F.concat(cut(p["before"], p["x"]["start"] - p["before"]), F.get(names, p["x"]["kind"])))
        return F.concat(F.array_join(pieces, ""), cut(last, F.length(text)))

    return F.when(F.size(sorted_spans) == 0, text).otherwise(cut_by(text, F.size(sorted_spans), joined))
