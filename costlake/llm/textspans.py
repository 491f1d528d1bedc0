"""Spans of regular-expression matches in whole texts, with SQL functions only.

A span is struct<start, end, match, before, after>: code points, end exclusive, and the
text next to the match, as far as asked for. Arrays are built by transform over running
sums, which are summed in blocks, so that the work stays linear in the text and in the
number of its spans. Patterns here repeat groups possessively: the regex engine then
loops instead of recursing, so that very long texts cannot overflow the stack.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,match:string,before:string,after:string>>"
#: Elements of an array that are summed one after the other, and code points of a block of text.
BLOCK, TEXT_BLOCK = 64, 1024
#: Neighbouring matches that a span's surroundings may reach across.
REACH = 3


def no_spans() -> Column:
    return F.array().cast(SPAN)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value evaluated once a row however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def running(values: Column, first: Column, merge: Callable[[Column, Column], Column], levels: int = 2) -> Column:
    """first, then the results of merging first with one, two, ... all of values: an array with one element more.

    first must be neutral to merge. Blocks of BLOCK values are merged each for itself and
    then raised by what stands before them, which is found in the same way.
    """

    def stepwise(part: Column) -> Column:
        return F.aggregate(part, F.array(first), lambda acc, v: F.concat(acc, F.array(merge(F.element_at(acc, -1), v))))

    if levels == 0:
        return stepwise(values)

    def in_blocks(v: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(v), F.lit(BLOCK))
        blocks = F.transform(starts, lambda at: stepwise(F.slice(v, at, BLOCK)))
        return let(
            blocks,
            lambda own: let(
                running(F.transform(own, lambda b: F.element_at(b, -1)), first, merge, levels - 1),
                lambda before: F.concat(
                    F.flatten(
                        F.transform(
                            own, lambda b, i: F.transform(F.slice(b, 1, F.size(b) - 1), lambda x: merge(F.get(before, i), x))
                        )
                    ),
                    F.array(F.element_at(before, -1)),
                ),
            ),
        )

    return let(values, lambda v: F.when(F.size(v) > BLOCK, in_blocks(v)).otherwise(stepwise(v)))


def running_sum(values: Column) -> Column:
    return running(values, F.lit(0), lambda a, b: a + b)


def running_max(values: Column) -> Column:
    return running(values, F.lit(0), F.greatest)


def find_spans(text: Column, pattern: str, shown: int = 0, before: int = 0, after: int = 0) -> Column:
    """Leftmost non-overlapping matches of pattern, which must not match the empty string.

    A span's match is the group shown, which may reach beyond the span's end if it is
    within a lookahead; before and after are so many characters of the text around it, as
    far as REACH further matches. Texts without a match cost one scan, others three.
    """
    extracted = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def spans(matches: Column, pieces: Column, groups: Column) -> Column:
        widths = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda p, m: F.length(p) + F.length(m))

        def left(i: Column) -> Column:
            near = [F.concat(F.coalesce(F.substring(F.get(pieces, i - k), -before, before), F.lit("")), F.coalesce(F.get(matches, i - k), F.lit(""))) for k in range(REACH, 0, -1)]
            return F.substring(F.concat(*near, F.substring(F.get(pieces, i), -before, before)), -before, before)

        def right(i: Column) -> Column:
            near = [F.concat(F.coalesce(F.get(matches, i + k), F.lit("")), F.coalesce(F.substring(F.get(pieces, i + k + 1), 1, after), F.lit(""))) for k in range(1, REACH + 1)]
            return F.substring(F.concat(F.substring(F.get(pieces, i + 1), 1, after), *near), 1, after)

        def span(ends: Column, m: Column, i: Column) -> Column:
            end = F.get(ends, i + 1)
            return F.struct(
                (end - F.length(m)).alias("start"),
                end.alias("end"),
                F.get(groups, i).alias("match"),
                (left(i) if before else F.lit("")).alias("before"),
                (right(i) if after else F.lit("")).alias("after"),
            )

        return let(running_sum(widths), lambda ends: F.transform(matches, lambda m, i: span(ends, m, i)))

    found = let(
        extracted,
        lambda matches: let(
            F.split(text, pattern, -1),
            lambda pieces: let(F.regexp_extract_all(text, F.lit(pattern), F.lit(shown)), lambda groups: spans(matches, pieces, groups))
            if shown
            else spans(matches, pieces, matches),
        ),
    )
    return F.when(text.rlike(pattern), found).otherwise(no_spans())


def joined(spans: Column) -> Column:
    """kind:start:end of an array of structs with these fields, comma-joined in the array's order."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")),
        ),
        ",",
    )


def apart_from(spans: Column, others: Column) -> Column:
    """The spans, arrays of structs with start and end, that share no character with any of others.

    Both are sorted together; a span is touched if one of the others before it ends after
    its start, or one of the others after it starts before its end.
    """
    far = F.lit(2147483647)
    tagged = F.concat(
        F.transform(others, lambda o: F.struct(o["start"].alias("start"), o["end"].alias("end"), F.lit(-1).alias("at"))),
        F.transform(spans, lambda s, i: F.struct(s["start"].alias("start"), s["end"].alias("end"), i.alias("at"))),
    )

    def untouched(all_of: Column) -> Column:
        ends = running_max(F.transform(all_of, lambda s: F.when(s["at"] < 0, s["end"]).otherwise(0)))
        starts = running(F.reverse(F.transform(all_of, lambda s: F.when(s["at"] < 0, s["start"]).otherwise(far))), far, F.least)
        return let(
            ends,
            lambda e: let(
                starts,
                lambda n: F.filter(
                    F.transform(
                        all_of,
                        lambda s, i: F.when(
                            (s["at"] >= 0) & (F.get(e, i) <= s["start"]) & (F.get(n, F.size(all_of) - 1 - i) >= s["end"]), s["at"]
                        ),
                    ),
                    F.isnotnull,
                ),
            ),
        )

    alone = let(spans, lambda own: F.transform(let(F.array_sort(tagged), untouched), lambda i: F.get(own, i)))
    return F.when(F.size(spans) == 0, spans).when(F.size(others) == 0, spans).otherwise(alone)


def replace_spans(text: Column, spans: Column) -> Column:
    """text with each span replaced by <KIND>; spans sorted by start, overlapping ones share the mark of the first.

    Gaps are cut from blocks of TEXT_BLOCK characters, so that none is looked for from the text's beginning.
    """

    def cut(blocks: Column, start: Column, end: Column) -> Column:
        first, last = F.floor(start / TEXT_BLOCK).cast("int"), F.floor(end / TEXT_BLOCK).cast("int")
        head = F.substring(F.get(blocks, first), start % TEXT_BLOCK + 1, F.lit(TEXT_BLOCK))
        tail = F.coalesce(F.substring(F.get(blocks, last), F.lit(1), end % TEXT_BLOCK), F.lit(""))
        within = F.substring(F.get(blocks, first), start % TEXT_BLOCK + 1, end - start)
        between = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        return F.when(start >= end, "").when(first == last, within).otherwise(F.concat(head, between, tail))

    def marked(own: Column, blocks: Column, ends: Column) -> Column:
        def mark(s: Column, i: Column) -> Column:
            reached = F.get(ends, i)
            return F.when(
                s["start"] >= reached, F.concat(cut(blocks, reached, s["start"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))
            ).otherwise("")

        rest = cut(blocks, F.element_at(ends, -1), F.length(text))
        return F.concat(F.array_join(F.transform(own, mark), ""), rest)

    whole = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{TEXT_BLOCK}}}+"), F.lit(0))
    found = let(
        spans,
        lambda own: F.when(F.size(own) == 0, text).otherwise(
            let(whole, lambda blocks: let(running_max(F.transform(own, lambda s: s["end"])), lambda ends: marked(own, blocks, ends)))
        ),
    )
    return F.when(text.isNotNull(), found)
